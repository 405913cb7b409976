"""Keyed deduplication that survives hot keys.

A `row_number()` window would move every copy of a key into one task. Here the first row of a
key is an aggregate (`min` over an ordering struct), so each map task sends at most one row per
key. The other rows are found by a join against the keys that do repeat; that join is a plain
shuffle join, which adaptive execution splits when one key is hot.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.operators.joins import splittable_join

FIRST, ROWS = "_first", "_rows"
_CHUNK = 100_000


def ordering(columns: list[str], nulls_last: Sequence[str] = ()) -> Column:
    """A comparable struct of `columns`; NULLs come first but in `nulls_last`."""
    parts = []
    for name in columns:
        if name in nulls_last:
            parts.append(f"{name} IS NULL AS {name}_is_null")
        parts.append(name)
    return F.expr(f"struct({', '.join(parts)})")


def first_rows(df: DataFrame, key: str, columns: list[str], nulls_last: Sequence[str] = ()) -> DataFrame:
    """(key, _first, _rows): the first row of each key in `columns` order, and the row count."""
    return df.groupBy(key).agg(
        F.min(ordering(columns, nulls_last)).alias(FIRST), F.count(F.lit(1)).alias(ROWS)
    )


def unpack(first: DataFrame, key: str, columns: list[str]) -> DataFrame:
    return first.selectExpr(key, *[f"{FIRST}.{c} AS {c}" for c in columns])


def other_rows(
    df: DataFrame, first: DataFrame, key: str, columns: list[str], nulls_last: Sequence[str] = ()
) -> DataFrame:
    """Every row of `df` that is not the first of its key, copies included.

    Rows after the first pass through. Exact copies of the first are counted and all but one
    written out again, in chunks so that no task writes a hot group alone.
    """
    repeated = first.filter(F.col(ROWS) > 1).select(key, FIRST)
    own = df.select(key, ordering(columns, nulls_last).alias("_own"))
    met = splittable_join(own, repeated, key)
    is_later = F.col("_own") > F.col(FIRST)
    later = met.filter(is_later).selectExpr(key, *[f"_own.{c} AS {c}" for c in columns])
    # Written as "not later" rather than "equal", which would become a join key and cost a
    # shuffle of its own; this way both branches share the shuffles.
    copies = (
        met.filter(~is_later)
        .groupBy(key, FIRST)
        .agg((F.count(F.lit(1)) - 1).alias("_left"))
        .filter("_left > 0")
    )
    return later.unionByName(unpack(_repeat(copies, key), key, columns))


def _repeat(copies: DataFrame, key: str) -> DataFrame:
    """`_left` rows for each row, spread over tasks by chunk."""
    chunks = copies.withColumn("_chunk", F.explode(F.expr(f"sequence(0L, (_left - 1) div {_CHUNK}L)")))
    spread = chunks.repartition(key, "_chunk")
    size = F.least(F.lit(_CHUNK).cast("long"), F.col("_left") - F.col("_chunk") * _CHUNK)
    return spread.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), size)))
