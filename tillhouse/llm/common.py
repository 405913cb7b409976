"""What the corpus operators share: kept tables, small Arrow batches, connected components."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.operators.joins import splittable_join
from tillhouse.session import discard, stored

# Every input column travels inside this struct, so no name of an operator can clash with it.
ROW = "_row"


def ship(spark: SparkSession) -> None:
    """Send this library to the Python workers, once per application; they need not have it installed."""
    context = spark.sparkContext
    if getattr(context, "_tillhouse_shipped", False):
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(), "tillhouse.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, names in os.walk(top):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.relpath(path, os.path.dirname(top)))
    context.addPyFile(target)
    context._tillhouse_shipped = True


def keep(df: DataFrame, purpose: str) -> DataFrame:
    """Write `df` as Parquet into the shared folder and read it back.

    Work behind it is not repeated when an executor is lost, and later plans start from files.
    """
    kept = stored(df, f"llm-{purpose}")
    for made in _MADE:
        made.append(kept)
    return kept


# The kept tables of the blocks that are open.
_MADE: list[list[DataFrame]] = []


@contextmanager
def scratch() -> Iterator[list[DataFrame]]:
    """The list of tables that are kept inside the block, so that they can be discarded once they are not needed."""
    _MADE.append([])
    try:
        yield _MADE[-1]
    finally:
        _MADE.pop()


@contextmanager
def batch_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Hand Python at most `rows` rows at once for what is executed inside the block."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def packed(df: DataFrame) -> DataFrame:
    """`df` with all its columns inside the struct `ROW`."""
    return df.select(F.struct(*[df[f"`{c}`"] for c in df.columns]).alias(ROW))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the `edges` a, b: root is the smallest node it is connected to.

    Large star and small star in turn (Kiveris et al. 2014) until nothing changes. Each turn
    aggregates neighbours to a minimum before they are shuffled, and is written to the shared
    folder, which then loses the turn before. A hub is a hot join key, which adaptive execution can split.
    The number of turns grows with the logarithm of the longest path.
    """
    lo, hi = F.least("a", "b"), F.greatest("a", "b")
    now = keep(edges.select(hi.alias("hi"), lo.alias("lo")).where("hi != lo").distinct(), "edges")
    state = None
    while (found := now.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo"))).first()) != state:
        state = found
        both = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(
            now.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        )
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = keep(
            splittable_join(both.where("v > u"), least, "u")
            .select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct(),
            "large-star",
        )
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        moved = splittable_join(large, least, "hi").where("lo != m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        after = keep(least.select("hi", F.col("m").alias("lo")).union(moved).distinct(), "small-star")
        discard(now, large)
        now = after
    nodes = now.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
    return nodes.union(now.select("lo", "lo").distinct())
