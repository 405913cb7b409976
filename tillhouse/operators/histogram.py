"""Equal-width histogram."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.functions.text import bin_label
from tillhouse.session import stored


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """(bin, bin_start, bin_end, n, bin_label), empty bins included.

    Bins are half open but for the last, NULLs are dropped, one repeated value gets a range of
    width 1 around it, and an empty input counts zero over 0 to 1. The values are stored, since they are read
    twice: for the limits and for the counts.
    """
    spark = df.sparkSession
    value = F.col(column).cast("double")
    present = stored(df.filter(F.col(column).isNotNull()).select(value.alias("v")), "histogram")
    found = present.agg(
        F.coalesce(F.min("v"), F.lit(0.0)).alias("lo"), F.coalesce(F.max("v"), F.lit(1.0)).alias("hi")
    )
    pad = F.when(F.col("lo") == F.col("hi"), F.lit(0.5)).otherwise(F.lit(0.0))
    limits = found.select(
        F.struct((F.col("lo") - pad).alias("lo"), (F.col("hi") + pad).alias("hi")).alias("range")
    ).scalar()

    lo, hi = F.col("_r.lo"), F.col("_r.hi")
    step = (hi - lo) / F.lit(float(bins))

    def edge(i):
        return F.when(i == bins, hi).otherwise(lo + i * step)

    guess = F.least(F.floor((F.col("v") - lo) / step), F.lit(bins - 1))
    # Division may land one bin off; the edges decide.
    settled = (
        F.when(F.col("v") < edge(F.col("_g")), F.col("_g") - 1)
        .when((F.col("v") >= edge(F.col("_g") + 1)) & (F.col("_g") < bins - 1), F.col("_g") + 1)
        .otherwise(F.col("_g"))
    )
    counted = (
        present.withColumn("_r", limits)
        .withColumn("_g", guess)
        .groupBy(settled.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    frame = (
        spark.range(0, bins, 1, 1)
        .select(F.col("id").alias("bin"))
        .withColumn("_r", limits)
        .withColumns({"bin_start": edge(F.col("bin")), "bin_end": edge(F.col("bin") + 1)})
        .drop("_r")
    )
    return frame.join(counted, "bin", "left").select(
        F.col("bin").cast("int").alias("bin"),
        "bin_start",
        "bin_end",
        F.coalesce("n", F.lit(0)).alias("n"),
        bin_label(F.col("bin_start"), F.col("bin_end")).alias("bin_label"),
    )
