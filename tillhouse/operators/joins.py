"""Joins against a side that holds each key once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SPLIT = "_split"


def splittable_join(left: DataFrame, right: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """An equi join whose hot keys adaptive execution can split.

    Skew handling needs a plain shuffle right below both join inputs. A side that is already
    partitioned by the key (an aggregate, say) gets none, and a hot key on the other side then
    stays in one task. Joining on the key and a function of the key forces the shuffles, and
    cannot change the result.
    """
    keys = [on] if isinstance(on, str) else list(on)
    tag = F.pmod(F.xxhash64(*keys), F.lit(1024))
    return left.withColumn(_SPLIT, tag).join(
        right.withColumn(_SPLIT, tag), [*keys, _SPLIT], how
    ).drop(_SPLIT)
