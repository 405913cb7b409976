"""Reading raw extracts and small control data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.schema import ENTITIES, RAW_COLUMNS, SCHEMAS, STAGING, raw_schema


def read_raw(spark: SparkSession, path: str, entity: str) -> DataFrame:
    """Delimited text with one header line and optional double quotes; every column is text."""
    return spark.read.schema(raw_schema(entity)).csv(path, header=True, quote='"', escape='"')


MALFORMED = "malformed_row"


def read_checked(spark: SparkSession, path: str, entity: str, multi_line: bool = False, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """(rows, malformed): delimited text as in `read_raw`, apart by whether a line has as many fields as it should.

    A malformed line is kept as it is in `line`. With `multi_line` a quoted field may hold line ends, and a
    file is then read by one task.
    """
    # A reader that skips columns does not count the fields.
    reader = spark.read.schema(f"{raw_schema(entity)}, _line STRING").option("columnPruning", "false")
    read = reader.csv(
        path, header=header, quote='"', escape='"', mode="PERMISSIVE", columnNameOfCorruptRecord="_line", multiLine=multi_line
    )
    # A reader that is asked for the bad lines alone does not look at the fields: the key keeps it from that.
    malformed = read.filter(F.col("_line").isNotNull() & F.coalesce(F.col(RAW_COLUMNS[entity][0]) != "\0", F.lit(True)))
    malformed = malformed.select(F.col("_line").alias("line"))
    return read.filter(F.col("_line").isNull()).drop("_line"), malformed


def malformed_rejects(malformed: DataFrame, as_of: Column) -> DataFrame:
    """Malformed lines as rows of a reject log."""
    return malformed.select(
        F.to_json(F.struct("line")).alias("row_data"), F.lit(MALFORMED).alias("reason"), as_of.alias("logged_at")
    )


def read_positional(spark: SparkSession, path: str) -> DataFrame:
    """Columns named c1 .. cn whatever the header says, all text."""
    df = spark.read.csv(path, header=True, quote='"', escape='"', inferSchema=False)
    return df.toDF(*[f"c{i + 1}" for i in range(len(df.columns))])


def rename_positional(df: DataFrame, entity: str) -> DataFrame:
    """Give auto-named columns the names of the entity."""
    names = RAW_COLUMNS[entity]
    if len(df.columns) != len(names):
        raise ValueError(f"{entity} has {len(names)} columns, the file has {len(df.columns)}")
    return df.toDF(*names)


def read_profile(spark: SparkSession, path: str) -> DataFrame:
    """(entity, clean, bad, total) from the profile document."""
    doc = spark.read.json(path, multiLine=True)
    rows = F.array(
        *[
            F.struct(
                F.lit(e).alias("entity"),
                *[F.col(f"entities.{e}.{c}").cast("bigint").alias(c) for c in ("clean", "bad", "total")],
            )
            for e in ENTITIES
        ]
    )
    return doc.select(F.inline(rows))


def seed_watermarks(spark: SparkSession) -> DataFrame:
    """The control table before any load."""
    rows = [("ORDERS",), ("PAYMENTS",), ("CUSTOMERS",)]
    seeded = spark.createDataFrame(rows, "table_name STRING").withColumn(
        "last_loaded_at", F.lit("1900-01-01 00:00:00").cast("timestamp_ntz")
    )
    return seeded.to(spark.createDataFrame([], SCHEMAS[STAGING]["load_watermarks"]).schema)


def preview(df: DataFrame, order: list[str], n: int = 10) -> DataFrame:
    """A few rows, the same ones every time."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in order]).limit(n)
