"""Top-k, paging, and equal-frequency segments."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.session import stored


def top_k(df: DataFrame, by: str, k: int, tiebreak: list[str]) -> DataFrame:
    """The k largest by `by` (NULL counts as largest); ties go by `tiebreak`."""
    return df.orderBy(
        F.col(by).desc_nulls_first(), *[F.col(c).asc_nulls_last() for c in tiebreak]
    ).limit(k)


def page(df: DataFrame, order: list[str], limit: int, offset: int = 0) -> DataFrame:
    """One page of a stable order."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in order]).offset(offset).limit(limit)


@dataclass
class _Cut:
    """The value at a rank, known to lie between two values of which `below` rows lie before the lower one."""

    rank: int
    below: int
    low: object
    high: object


def rank_cuts(values: DataFrame, column: str, parts: int, buckets: int = 4096) -> list:
    """The exact values at 0-based ranks floor(i * (n - 1) / parts), i = 1 .. parts - 1; none for no values.

    Selection by histograms: a pass counts the rows between the bounds of each cut in equal buckets, and the
    bucket that holds the rank gives the next bounds, until they are one value. A pass returns at most
    `buckets` rows for each cut, and a few passes are enough, since each narrows the bounds `buckets` times.
    `values` is read in every pass, so it should be stored.
    """
    value = F.col(column)
    present = values.filter(value.isNotNull()).select(value.alias("_v"))
    ends = present.agg(F.count("*").alias("n"), F.min("_v").alias("low"), F.max("_v").alias("high")).first()
    cuts = [_Cut(i * (ends.n - 1) // parts, 0, ends.low, ends.high) for i in range(1, parts)] if ends.n else []
    while open_ := [c for c in cuts if c.low != c.high]:
        bounds = sorted({(c.low, c.high) for c in open_})
        met = F.filter(F.array(*[_place(i, low, high, buckets) for i, (low, high) in enumerate(bounds)]), lambda p: p.isNotNull())
        counted = present.select("_v", F.explode(met).alias("p")).groupBy("p").agg(
            F.count("*").alias("n"), F.min("_v").alias("low"), F.max("_v").alias("high")
        )
        found: dict[int, list] = {}
        for row in counted.collect():
            found.setdefault(row.p.cut, []).append(row)
        for cut in open_:
            for row in sorted(found[bounds.index((cut.low, cut.high))], key=lambda r: r.low):
                if cut.rank < cut.below + row.n:
                    cut.low, cut.high = row.low, row.high
                    break
                cut.below += row.n
    return [c.low for c in cuts]


def _place(cut: int, low, high, buckets: int) -> Column:
    """Which bucket between two values a row falls into, NULL if it lies outside."""
    start, width = float(low), float(high) - float(low)
    if width > 0:
        share = (F.col("_v").cast("double") - F.lit(start)) / F.lit(width)
        bucket = F.least(F.floor(share * buckets), F.lit(buckets - 1)).cast("string")
    else:
        # Values that are one and the same as doubles are told apart as they are.
        bucket = F.col("_v").cast("string")
    inside = F.col("_v").between(F.lit(low), F.lit(high))
    return F.when(inside, F.struct(F.lit(cut).alias("cut"), bucket.alias("bucket")))


def label_segments(values: DataFrame, column: str, labels: list[str]) -> DataFrame:
    """Add `segment`: the rows cut into len(labels) groups of equal size, ties kept together.

    `values` is stored first, since the search for the cuts reads it more than once.
    """
    values = stored(values, "segments")
    cuts = rank_cuts(values, column, len(labels))
    chain = F
    for cut, label in zip(cuts, labels):
        chain = chain.when(F.col(column) <= F.lit(cut), F.lit(label))
    if not cuts:
        return values.withColumn("segment", F.lit(None).cast("string"))
    segment = F.when(F.col(column).isNotNull(), chain.otherwise(F.lit(labels[-1])))
    return values.withColumn("segment", segment)
