"""Customer history: expire changed versions and open new ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.operators.keys import assign_sk, next_sk
from tillhouse.plans.dims import current, customer_versions
from tillhouse.schema import DW, columns_of

REFERENCE, NULL_SAFE = "reference", "null_safe"
TRACKED = ("city", "email_masked", "phone_masked")


def changed(mode: str) -> Column:
    """Whether a tracked field of `old` differs from `new`.

    `reference` compares with plain inequality, so a change from or to NULL goes unseen.
    """
    if mode not in (REFERENCE, NULL_SAFE):
        raise ValueError(f"unknown mode {mode}")
    differs = F.lit(False)
    for name in TRACKED:
        old, new = F.col(f"old.{name}"), F.col(f"new.{name}")
        differs = differs | (~old.eqNullSafe(new) if mode == NULL_SAFE else old != new)
    return F.coalesce(differs, F.lit(False))


def _met(dim: DataFrame, source: DataFrame, as_of: Column, mode: str) -> DataFrame:
    """Current versions beside staged customers: (old, new, expires)."""
    old = current(dim).select(F.col("customer_code").alias("_code"), F.struct(*dim.columns).alias("old"))
    versions = customer_versions(source, as_of)
    new = versions.select(
        F.col("customer_code").alias("_code"), F.struct(*versions.columns).alias("new")
    )
    both = F.col("old").isNotNull() & F.col("new").isNotNull()
    return old.join(new, "_code", "full").withColumn("expires", both & changed(mode))


def scd2_parts(
    dim: DataFrame, source: DataFrame, as_of: Column, mode: str = REFERENCE, first_sk: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """(closed, open): what a source refresh closes, and the current versions after it.

    A current version whose tracked fields changed is closed at `as_of`; every source customer
    left without a current version gets one that starts at the same moment. Customers missing
    from the source stay current. `source` holds each customer once, as staging makes it. Versions
    of `dim` that are closed already are in neither part. `first_sk` is the first free key, by
    default the one after all of `dim`.
    """
    names = columns_of(DW, "dim_customer")
    dim = dim.select(*names)
    met = _met(dim, source, as_of, mode)
    ended = {"eff_end_date": as_of, "is_current": F.lit(False)}
    closed = met.filter("expires").select(*[ended.get(n, F.col(f"old.{n}")).alias(n) for n in names])
    kept = met.filter(F.col("old").isNotNull() & ~F.col("expires")).select("old.*")
    opened = met.filter(F.col("new").isNotNull() & (F.col("old").isNull() | F.col("expires"))).select("new.*")
    first = next_sk(dim, "customer_sk") if first_sk is None else first_sk
    numbered = assign_sk(opened, ["customer_code"], "customer_sk", first)
    return closed, kept.unionByName(numbered.select(*names))


def scd2_apply(dim: DataFrame, source: DataFrame, as_of: Column, mode: str = REFERENCE) -> DataFrame:
    """The whole dimension after a source refresh, as in `scd2_parts`.

    Closed history is passed through without a shuffle; current rows and the source meet in one
    full join that the branches share.
    """
    closed, open_ = scd2_parts(dim, source, as_of, mode)
    return past(dim).select(*columns_of(DW, "dim_customer")).unionByName(closed).unionByName(open_)


def past(dim: DataFrame) -> DataFrame:
    """The versions that are closed."""
    return dim.filter(~F.coalesce("is_current", F.lit(False)))


def history(dim: DataFrame, customer_code: str) -> DataFrame:
    """All versions of one customer, oldest first."""
    return (
        dim.filter(F.col("customer_code") == customer_code)
        .select("customer_code", "city", "eff_start_date", "eff_end_date", "is_current")
        .orderBy(F.col("eff_start_date").asc_nulls_last(), F.col("eff_end_date").asc_nulls_last())
    )
