"""Counts and checks over whole tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.functions import predicates as p
from tillhouse.operators.ranking import top_k


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def layer_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, n) for each table."""
    return union_all(
        [row_count(df).select(F.lit(name).alias("table_name"), "n") for name, df in tables.items()]
    )


def condition_counts(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """(issue, n): all conditions in one pass over the table."""
    counts = df.agg(*[F.count_if(test).alias(name) for name, test in conditions.items()])
    pairs = F.array(
        *[F.struct(F.lit(name).alias("issue"), F.col(name).alias("n")) for name in conditions]
    )
    return counts.select(F.inline(pairs))


def _issues(as_of: Column) -> dict[str, dict[str, Column]]:
    """The issues looked for in each raw table."""
    return {
        "orders": {"orphan_orders": p.is_orphan("customer_code")},
        "order_items": {
            "orphan_items": p.is_orphan("product_code"),
            "negative_quantities": p.negative("quantity"),
        },
        "payments": {"orphan_payments": p.is_orphan("order_id")},
        "customers": {"customers_updated_after_today": p.future("updated_at", as_of)},
    }


def issue_counts(raws: Mapping[str, DataFrame], as_of: Column) -> DataFrame:
    """Lost parents, negative quantities and future updates in the raw tables."""
    return union_all([condition_counts(raws[name], tests) for name, tests in _issues(as_of).items()])


def _repeated(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("duplicate_count")).filter(
        "duplicate_count > 1"
    )


def duplicate_keys(df: DataFrame, key: str, k: int = 20) -> DataFrame:
    """The k most repeated keys; NULL is a key like any other."""
    return top_k(_repeated(df, key), "duplicate_count", k, [key])


def duplicate_stats(df: DataFrame, key: str) -> DataFrame:
    """Number of repeated keys, and of rows beyond the first of each (NULL if there are none)."""
    return _repeated(df, key).agg(
        F.count(F.lit(1)).alias("duplicated_keys"),
        F.sum(F.col("duplicate_count") - 1).alias("extra_rows"),
    )


def type_mismatches(df: DataFrame, key: str, column: str, data_type: str = "decimal(18,2)") -> DataFrame:
    """Rows whose value is present but does not parse."""
    return df.filter(p.type_mismatch(column, data_type)).select(key, column)


def require_unique(df: DataFrame, keys: list[str], what: str) -> None:
    """Raise if a key repeats. Runs a job; used before a load, not inside a plan."""
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(1)
    if not repeated.isEmpty():
        raise ValueError(f"{what}: {', '.join(keys)} is not unique")


def describe(df: DataFrame) -> DataFrame:
    """(position, col_name, data_type, n_rows, n_present) for each column, in one pass."""
    fields = df.schema.fields
    counts = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count(F.col(f.name)).alias(f"c{i}") for i, f in enumerate(fields)],
    )
    entries = F.array(
        *[
            F.struct(
                F.lit(i + 1).alias("position"),
                F.lit(f.name).alias("col_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
                F.col("n_rows"),
                F.col(f"c{i}").alias("n_present"),
            )
            for i, f in enumerate(fields)
        ]
    )
    return counts.select(F.inline(entries))


def shape(df: DataFrame) -> tuple[int, int]:
    return df.count(), len(df.columns)


def profile_raw(raws: Mapping[str, DataFrame], keys: Mapping[str, str], as_of: Column) -> DataFrame:
    """(metric, n): the raw profiling report - row counts, issues, bad prices, repeated keys.

    Rows and issues of a table are counted in one pass, and its keys in another that reads no other column.
    """
    issues = _issues(as_of)
    prices = {"products": {"price_type_mismatches": p.type_mismatch("unit_price")}}
    counted = [
        condition_counts(
            df, {f"rows_{name}": F.lit(True), **issues.get(name, {}), **prices.get(name, {})}
        ).withColumnRenamed("issue", "metric")
        for name, df in raws.items()
    ]
    repeated = [
        _repeated(df, keys[name]).agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(f"duplicate_keys_{name}").alias("metric"), "n"
        )
        for name, df in raws.items()
    ]
    return union_all([*counted, *repeated])
