"""Order increments by watermark."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.functions import casts
from tillhouse.functions import predicates as p
from tillhouse.operators.joins import splittable_join
from tillhouse.operators.mutate import update_where
from tillhouse.operators.profiling import row_count, union_all
from tillhouse.operators.rules import CONTENT_FIRST, ORDERS, Entity
from tillhouse.operators.staging import landed, pack_row, stage

ORDERS_TABLE = "ORDERS"


# The reason of an order that no customer is named in; a full load keeps such orders.
MISSING_CUSTOMER = "missing_customer_code"


@dataclass(frozen=True)
class Increment:
    added: DataFrame
    errors: DataFrame
    orders_clean: DataFrame
    watermarks: DataFrame


@dataclass(frozen=True)
class Admitted:
    clean: DataFrame
    errors: DataFrame


def admit(
    raw: DataFrame, loaded: DataFrame, as_of: Column, entity: Entity, also: tuple[Column, str] | None = None
) -> Admitted:
    """Arrived rows, each either clean or rejected with a reason.

    They pass the rules of the entity and are deduplicated, a fit row before an unfit one; those whose key
    is in `loaded` are rejected as duplicates, and where `also` (a test and its reason) holds as well.
    Loaded keys are cut down to the arriving ones first, so a small arrival is what travels, not the table.
    """
    key = entity.key
    arriving = raw.select(key).filter(F.col(key).isNotNull())
    old = loaded.select(key).join(arriving, key, "left_semi").distinct().withColumn("_old", F.lit(True))
    met = splittable_join(raw.select(*entity.columns), old, key, "left")
    return admit_marked(met, F.col("_old").isNotNull(), as_of, entity, also)


def admit_marked(
    met: DataFrame, old: Column, as_of: Column, entity: Entity, also: tuple[Column, str] | None = None
) -> Admitted:
    """As `admit`, where `old` says which rows have a key that is loaded."""
    test, name = also or (F.lit(False), "")
    candidate = ~old & ~test
    staged = landed(met.filter(candidate).select(*entity.columns), entity, as_of, CONTENT_FIRST)
    reason = F.coalesce(entity.reason(as_of), F.when(test, F.lit(name)), F.lit(entity.duplicate_reason))
    others = met.filter(~candidate).select(
        pack_row(entity.columns).alias("row_data"), reason.alias("reason"), as_of.alias("logged_at")
    )
    return Admitted(staged.clean, staged.errors.unionByName(others))


def no_customer() -> tuple[Column, str]:
    return F.col("customer_code").isNull(), MISSING_CUSTOMER


def admit_orders(raw: DataFrame, loaded: DataFrame, as_of: Column) -> Admitted:
    """Arrived orders as in `admit`; those without a customer are rejected."""
    return admit(raw, loaded, as_of, ORDERS, no_customer())


def watermark(watermarks: DataFrame, table: str = ORDERS_TABLE) -> Column:
    """The last loaded moment of a table as a scalar subquery; NULL selects no rows."""
    return (
        watermarks.filter(F.col("table_name") == table)
        .agg(F.max("last_loaded_at").alias("at"))
        .scalar()
    )


def since(df: DataFrame, column: str, after: Column, until: Column) -> DataFrame:
    """`after` < column <= `until`."""
    return df.filter((F.col(column) > after) & (F.col(column) <= until))


def set_watermark(watermarks: DataFrame, at: Column, table: str = ORDERS_TABLE) -> DataFrame:
    return update_where(watermarks, F.col("table_name") == table, {"last_loaded_at": at})


def incremental_orders(
    raw_orders: DataFrame,
    orders_clean: DataFrame,
    watermarks: DataFrame,
    as_of: Column,
    validate: bool = False,
) -> Increment:
    """Orders newer than the watermark, the clean table with them, and the moved watermark.

    By default rows are only checked for the orphan sentinel (a NULL customer is dropped as
    well) and for time, and nothing is logged. With `validate` every row of the window goes to
    `added` or to `errors`, as in `admit_orders`. A date that does not parse is in no window, so
    such rows are always looked at: pass new arrivals only, or they are found again.
    """
    at = casts.to_timestamp(F.col("order_date"))
    if validate:
        dated = raw_orders.withColumn("_at", at)
        unread = dated.filter(F.col("_at").isNull())
        window = since(dated, "_at", watermark(watermarks), as_of).unionByName(unread).drop("_at")
        admitted = admit_orders(window, orders_clean, as_of)
        added, errors = admitted.clean, admitted.errors
    else:
        # Only the window is typed and checked; what is older was loaded before.
        dated = raw_orders.filter(p.not_orphan("customer_code")).withColumn("_at", at)
        window = since(dated, "_at", watermark(watermarks), as_of)
        added, errors = window.select(*ORDERS.typed()), stage(raw_orders.limit(0), ORDERS, as_of).errors
    return Increment(
        added,
        errors,
        orders_clean.unionByName(added),
        set_watermark(watermarks, as_of),
    )


def increment_delta(before: DataFrame, after: DataFrame) -> DataFrame:
    """(orders_before, orders_after, added) row counts."""
    counts = union_all(
        [
            row_count(before).select(F.lit(0).alias("is_after"), "n"),
            row_count(after).select(F.lit(1).alias("is_after"), "n"),
        ]
    )
    return counts.agg(
        F.sum(F.when(F.col("is_after") == 0, F.col("n"))).alias("orders_before"),
        F.sum(F.when(F.col("is_after") == 1, F.col("n"))).alias("orders_after"),
    ).withColumn("added", F.col("orders_after") - F.col("orders_before"))
