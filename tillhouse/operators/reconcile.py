"""Planted against detected."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.operators.profiling import union_all
from tillhouse.operators.rules import ENTITY
from tillhouse.operators.staging import quality_counts


def staging_counts(raws: Mapping[str, DataFrame], as_of: Column, mode: str | None = None) -> DataFrame:
    """(entity, clean, errors) for each raw table."""
    return union_all(
        [
            quality_counts(raw, ENTITY[name], as_of, mode)
            .agg(
                F.coalesce(F.sum(F.when(F.col("reason") == "clean", F.col("n"))), F.lit(0)).alias("clean"),
                F.coalesce(F.sum(F.when(F.col("reason") != "clean", F.col("n"))), F.lit(0)).alias("errors"),
            )
            .select(F.lit(name).alias("entity"), "clean", "errors")
            for name, raw in raws.items()
        ]
    )


def loaded_counts(counts: DataFrame) -> DataFrame:
    """(entity, clean, errors) from the counts that a load published."""
    is_clean = F.col("reason") == "clean"
    return counts.groupBy("entity").agg(
        F.coalesce(F.sum(F.when(is_clean, F.col("n"))), F.lit(0)).alias("clean"),
        F.coalesce(F.sum(F.when(~is_clean, F.col("n"))), F.lit(0)).alias("errors"),
    )


def reconcile(profile: DataFrame, detected: DataFrame) -> DataFrame:
    """Join (entity, clean, bad, total) with (entity, clean, errors) and say whether they agree.

    Both sides hold one row per entity.
    """
    known = profile.select("entity", F.col("bad").alias("planted"), F.col("total"))
    found = detected.select("entity", F.col("errors").alias("detected"))
    gap = F.coalesce("detected", F.lit(0)) - F.coalesce("planted", F.lit(0))
    return known.join(found, "entity", "full").select(
        "entity",
        "planted",
        "detected",
        "total",
        gap.alias("gap"),
        F.when(gap == 0, F.lit("match")).when(gap > 0, F.lit("over")).otherwise(F.lit("under")).alias("result"),
    )
