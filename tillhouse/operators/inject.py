"""Plant a known number of labelled defects into a clean table, for tests of the quarantine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.operators.profiling import union_all
from tillhouse.schema import ENTITIES, ORPHAN

DUPLICATE_KEY = "duplicate_key"

# Days ahead of the run's point in time, at most.
_FUTURE_DAYS = {"updated_at": 364, "order_date": 119}

# Defect, and the text that each column gets. None is a missing value, "-" a
# negated number, "future" a time after the run's point in time.
DEFECTS: dict[str, dict[str, dict[str, str | None]]] = {
    "customers": {
        "missing": {"city": None, "email": None},
        "future_date": {"updated_at": "future"},
        DUPLICATE_KEY: {},
        "type_mismatch": {"phone": "NOT_A_NUMBER"},
    },
    "products": {
        "missing": {"product_name": None},
        "negative": {"unit_price": "-"},
        DUPLICATE_KEY: {},
        "type_mismatch": {"unit_price": "FREE"},
    },
    "orders": {
        "orphan": {"customer_code": ORPHAN},
        "future_date": {"order_date": "future"},
        DUPLICATE_KEY: {},
        "missing": {"order_state": None},
    },
    "order_items": {
        "orphan_product": {"product_code": ORPHAN},
        "orphan_order": {"order_id": ORPHAN},
        "negative": {"quantity": "-"},
        "type_mismatch": {"unit_price": "TWENTY"},
        DUPLICATE_KEY: {},
    },
    "payments": {
        "orphan_order": {"order_id": ORPHAN},
        "negative": {"payment_amount": "-"},
        "type_mismatch": {"payment_amount": "MANY"},
        DUPLICATE_KEY: {},
        "missing": {"payment_method": None},
    },
}


def as_text(clean: DataFrame) -> DataFrame:
    """Typed rows back to the all-text raw form."""
    return clean.select(*[F.col(c).cast("string").alias(c) for c in clean.columns])


def draw(key: str, seed: int, salt: str, sides: int) -> Column:
    """A whole number below `sides` that depends on the key and the seed alone."""
    digest = F.md5(F.concat_ws("|", F.col(key), F.lit(str(seed)), F.lit(salt)))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % sides


def _spoiled(column: str, text: str | None, key: str, seed: int, as_of: Column) -> Column:
    if text is None:
        return F.lit(None).cast("string")
    if text == "-":
        return F.concat(F.lit("-"), F.col(column))
    if text == "future":
        days = (draw(key, seed, column, _FUTURE_DAYS[column]) + 1).cast("int")
        return (as_of + F.make_dt_interval(days)).cast("string")
    return F.lit(text)


def inject(
    clean: DataFrame, entity: str, key: str, as_of: Column, seed: int = 23, per_mille: int = 140
) -> DataFrame:
    """All clean rows, and a spoiled extra row for about `per_mille` of them.

    Adds `defect` (NULL for clean rows). A spoiled row gets a key of its own, but for the
    duplicate-key defect, which repeats the key of the row it was made from.
    """
    defects = DEFECTS[entity]
    names = list(defects)
    kind = F.element_at(
        F.array(*[F.lit(n) for n in names]), (draw(key, seed, "kind", len(names)) + 1).cast("int")
    )
    # Each row is read once: it comes out as it is, and where it is picked a second time with its defect.
    picked = draw(key, seed, "pick", 1000) < per_mille
    twice = F.when(picked, F.array(F.lit(None).cast("string"), kind)).otherwise(F.array(F.lit(None).cast("string")))
    cells = []
    for column in clean.columns:
        value = F.col(column)
        if column == key:
            value = F.when(F.col("defect").isNull() | (F.col("defect") == DUPLICATE_KEY), value).otherwise(
                F.concat(value, F.lit("-B"))
            )
        for defect, spoils in defects.items():
            if column in spoils:
                value = F.when(
                    F.col("defect") == defect, _spoiled(column, spoils[column], key, seed, as_of)
                ).otherwise(value)
        cells.append(value.alias(column))
    return clean.withColumn("defect", F.explode(twice)).select(*cells, "defect")


def shuffle(df: DataFrame, seed: int, partitions: int | None = None) -> DataFrame:
    """A repeatable reordering: rows dealt evenly over partitions, each in seeded hash order.

    Dealing (not hashing) keeps many copies of one row from landing in one task. Without a number
    of partitions there are as many as the size asks for.
    """
    dealt = df.repartition(partitions) if partitions else df.hint("rebalance")
    return dealt.sortWithinPartitions(F.xxhash64(*df.columns, F.lit(seed)))


def planted(injected: dict[str, DataFrame]) -> DataFrame:
    """(entity, defect, n) with defect `clean` for untouched rows."""
    return union_all(
        [
            df.groupBy(F.coalesce("defect", F.lit("clean")).alias("defect"))
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.lit(name).alias("entity"), "defect", "n")
            for name, df in injected.items()
        ]
    )


def profile_of(injected: dict[str, DataFrame], seed: int) -> DataFrame:
    """One row shaped like the profile document: clean, bad and total per entity and overall."""
    per_entity = planted(injected)

    def counts(where: Column) -> Column:
        is_clean = F.col("defect") == "clean"
        clean = F.coalesce(F.sum(F.when(where & is_clean, F.col("n"))), F.lit(0))
        bad = F.coalesce(F.sum(F.when(where & ~is_clean, F.col("n"))), F.lit(0))
        return F.struct(clean.alias("clean"), bad.alias("bad"), (clean + bad).alias("total"))

    every = counts(F.lit(True))
    return per_entity.agg(
        F.lit(seed).alias("seed"),
        F.struct(*[counts(F.col("entity") == e).alias(e) for e in ENTITIES]).alias("entities"),
        F.struct(
            every["clean"].alias("clean_sum"),
            every["bad"].alias("bad_sum"),
            every["total"].alias("merged_sum"),
        ).alias("grand_totals"),
        F.lit(ORPHAN).alias("orphan_placeholders"),
    )
