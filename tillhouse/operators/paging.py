"""Pages of a table by an index of key ranges: a page reads its ranges only.

The rows are dealt into ranges of their order, sorted, and written one folder a range. The index counts the
rows of each range, so the first row of every range is known, and a page of any offset is found in the few
ranges it overlaps. All pages together are the table, whatever their size.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_RANGE = "_range"


def _ascending(order: list[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in order]


@dataclass(frozen=True)
class Pages:
    """`rows` with their range, `index` with (range, first row, rows), and the order, which tells all rows apart."""

    rows: DataFrame
    index: DataFrame
    order: list[str]

    def page(self, limit: int, offset: int = 0) -> DataFrame:
        """`limit` rows from `offset` on; the plan holds the ranges that they lie in and no others."""
        first, n = F.col("first"), F.col("n")
        wanted = self.index.filter((first < offset + limit) & (first + n > offset)).orderBy("first").collect()
        rows = self.rows.filter(F.col(_RANGE).isin([r[_RANGE] for r in wanted])).drop(_RANGE)
        skipped = offset - wanted[0]["first"] if wanted else 0
        return rows.orderBy(*_ascending(self.order)).offset(skipped).limit(limit)

    def numbered(self, limit: int) -> DataFrame:
        """All rows with the number of their page, from 0; every range is numbered on its own."""
        place = F.row_number().over(Window.partitionBy(_RANGE).orderBy(*_ascending(self.order)))
        # One row for each range of the index: the planner sees its size.
        met = self.rows.withColumn("_place", place).join(self.index.select(_RANGE, "first"), _RANGE)
        page = F.expr(f"(first + _place - 1) div {limit}L").alias("page")
        return met.select(page, *[c for c in self.rows.columns if c != _RANGE])


def build_pages(df: DataFrame, order: list[str], path: str) -> Pages:
    """Write `df` as ranges of `order` under `path`, with their index."""
    ranged = df.repartitionByRange(*_ascending(order)).sortWithinPartitions(*_ascending(order))
    ranged.withColumn(_RANGE, F.spark_partition_id()).write.partitionBy(_RANGE).parquet(f"{path}/rows")
    spark = df.sparkSession
    rows = spark.read.schema(f"{_ddl(df)}, {_RANGE} INT").parquet(f"{path}/rows")
    counts = rows.groupBy(_RANGE).agg(F.count(F.lit(1)).alias("n"))
    # One row for each range.
    before = Window.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    counts.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0))).coalesce(1).write.parquet(f"{path}/index")
    return open_pages(spark, path, order, rows)


def open_pages(spark: SparkSession, path: str, order: list[str], rows: DataFrame | None = None) -> Pages:
    rows = spark.read.parquet(f"{path}/rows") if rows is None else rows
    return Pages(rows, spark.read.schema(f"{_RANGE} INT, n BIGINT, first BIGINT").parquet(f"{path}/index"), order)


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in df.dtypes)
