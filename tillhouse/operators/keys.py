"""Generated integer keys without a single-task numbering step."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_BUCKET, _OFFSET = "_bucket", "_offset"


def key_bucket(keys: list[str], digits: int = 3) -> Column:
    """The first hex digits of a digest of the key: 16^digits even, data-independent buckets."""
    text = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    return F.substring(F.md5(text), 1, digits)


def assign_sk(
    df: DataFrame, keys: list[str], name: str, start: int | Column = 1, digits: int = 3
) -> DataFrame:
    """Number the rows `start, start + 1, ...` in (bucket, key) order.

    `keys` must be unique in `df`. Rows are counted per bucket, the running totals (at most
    16^digits rows, so broadcasting them is bounded) give each bucket its first number, and rows
    are numbered inside their bucket. The numbers depend on the keys alone, not on partitions,
    so a recomputed task gives the same ones.
    """
    tagged = df.withColumn(_BUCKET, key_bucket(keys, digits))
    before = Window.orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        tagged.groupBy(_BUCKET)
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(_BUCKET, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias(_OFFSET))
    )
    within = Window.partitionBy(_BUCKET).orderBy(*[F.col(k).asc_nulls_first() for k in keys])
    first = start if isinstance(start, Column) else F.lit(start)
    numbered = tagged.withColumn("_row", F.row_number().over(within)).join(
        F.broadcast(offsets), _BUCKET
    )
    number = (F.col(_OFFSET) + F.col("_row") - 1 + first).cast("bigint").alias(name)
    return numbered.select(number, *df.columns)


def new_keys(df: DataFrame, keys: list[str], name: str, registry: DataFrame, start: Column | None = None) -> DataFrame:
    """(keys, name): numbers for the keys of `df` that `registry` lacks.

    They follow its largest number, or begin at `start`, in the order of `assign_sk`. NULL is a key like any other.
    """
    lacking = lacking_keys(df, registry, keys).select(*keys)
    first = next_sk(registry, name) if start is None else start
    return assign_sk(lacking, keys, name, first).select(*keys, name)


def lacking_keys(df: DataFrame, registry: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of `df` whose keys `registry` lacks."""
    return df.alias("new").join(registry.alias("old"), _same(keys, "new", "old"), "left_anti")


def numbered_by(df: DataFrame, keys: list[str], name: str, registry: DataFrame) -> DataFrame:
    """`df` with the numbers that `registry` (keys, name) holds for all its keys."""
    columns = [F.col(f"new.{c}") for c in df.columns]
    met = df.alias("new").join(registry.alias("old"), _same(keys, "new", "old"))
    return met.select(F.col(f"old.{name}").alias(name), *columns)


def _same(keys: list[str], left: str, right: str) -> Column:
    parts = [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys]
    return reduce(Column.__and__, parts)


def next_sk(df: DataFrame, name: str) -> Column:
    """One more than the largest key so far, as a scalar subquery; 1 for an empty table."""
    return df.agg((F.coalesce(F.max(name), F.lit(0)) + 1).alias("n")).scalar()
