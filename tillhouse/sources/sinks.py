"""Writing results out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANGE = "range"


def export_csv(df: DataFrame, path: str) -> None:
    """All rows as CSV with a header, one file per task."""
    df.write.mode("errorifexists").csv(
        path,
        header=True,
        quote='"',
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )


def write_raw(df: DataFrame, path: str, parquet: bool = False) -> None:
    """A raw extract as CSV, and beside it as Parquet if wanted."""
    export_csv(df, f"{path}/csv")
    if parquet:
        df.write.mode("errorifexists").parquet(f"{path}/parquet")


def fact_month() -> Column:
    """The partition column of the fact, from its date key: 202501."""
    return F.floor(F.col("date_sk") / 100).cast("int").alias("year_month")


def clustered(fact: DataFrame, by: str = "date_sk") -> DataFrame:
    """Rows gathered by date and sorted, so that files and row groups can be skipped by date.

    Rebalancing lets adaptive execution cut a very busy day into several tasks and merge quiet
    days, by the sizes it measures; unlike a range partitioning it needs no sampling run of the
    whole fact plan. Gathering by `year_month` instead makes one file per month, which suits a
    fact of a few gigabytes. With `range`, bounds are sampled from date and item: files follow each
    other by date, and a very busy day is cut at an item, so that no two files of a month overlap but
    on such a day. Pass a stored fact then, since the sampling reads it.
    """
    if by == RANGE:
        keys = ("date_sk", "order_item_id")
        return fact.withColumn("year_month", fact_month()).repartitionByRange(*keys).sortWithinPartitions("year_month", *keys)
    return (
        fact.withColumn("year_month", fact_month())
        .hint("rebalance", by)
        .sortWithinPartitions("year_month", "date_sk")
    )


def file_spans(fact: DataFrame) -> DataFrame:
    """(year_month, file, n, first, last): rows and days of every file of a stored fact; reads the date key alone."""
    return fact.groupBy("year_month", F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("n"), F.min("date_sk").alias("first"), F.max("date_sk").alias("last")
    )


def month_spans(spans: DataFrame) -> DataFrame:
    """(year_month, files, n, first_day, last_day, overlaps): how many files of a month begin before another one has ended."""
    before = Window.partitionBy("year_month").orderBy("first", "last", "file").rowsBetween(Window.unboundedPreceding, -1)
    late = F.coalesce(F.col("first") < F.max("last").over(before), F.lit(False))
    return spans.withColumn("late", late).groupBy("year_month").agg(
        F.count(F.lit(1)).alias("files"), F.sum("n").alias("n"), F.min("first").alias("first_day"),
        F.max("last").alias("last_day"), F.count_if("late").alias("overlaps"),
    )


def write_fact(fact: DataFrame, path: str, by: str = "date_sk") -> None:
    clustered(fact, by).write.mode("errorifexists").partitionBy("year_month").parquet(path)


def to_client(df: DataFrame, max_rows: int):
    """A small result as a pandas frame; refuses a large one instead of cutting it."""
    rows = df.limit(max_rows + 1).toPandas()
    if len(rows) > max_rows:
        raise ValueError(f"more than {max_rows} rows; aggregate first or write to files")
    return rows
