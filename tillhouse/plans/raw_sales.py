"""Revenue straight from the raw tables.

Lost parents are left out; duplicate and negative rows are not, so a repeated key multiplies
revenue, as a plain join does. Items are summed to the join key first: that keeps the result,
shrinks the shuffle, and takes a hot order or product out of the join. Hot keys on the other
side are split at run time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.functions import casts
from tillhouse.functions import predicates as p
from tillhouse.operators.joins import splittable_join
from tillhouse.operators.ranking import top_k

_AMOUNT = "_amount"


def _sold(items: DataFrame, key: str) -> DataFrame:
    """Amount per order or product, over items of a known product."""
    amount = F.sum(casts.to_money(F.col("line_amount")))
    return items.filter(p.not_orphan("product_code")).groupBy(key).agg(amount.alias(_AMOUNT))


def _order_revenue(orders: DataFrame, items: DataFrame, *columns: Column | str) -> DataFrame:
    """Exact revenue of the orders with a known customer, by order columns."""
    headers = orders.filter(p.not_orphan("customer_code")).select("order_id", *columns)
    by = headers.columns[1:]
    return (
        splittable_join(headers, _sold(items, "order_id"), "order_id")
        .groupBy(*by)
        .agg(F.sum(_AMOUNT).alias("revenue"))
    )


def _as_double(df: DataFrame, column: str = "revenue") -> DataFrame:
    return df.withColumn(column, F.col(column).cast("double"))


def monthly_revenue(orders: DataFrame, items: DataFrame) -> DataFrame:
    """(month, revenue), oldest first; unparsable dates form a last NULL month."""
    month = casts.month_start(casts.to_timestamp(F.col("order_date"))).alias("month")
    return _as_double(_order_revenue(orders, items, month)).orderBy(F.col("month").asc_nulls_last())


def top_cities(orders: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """(order_city, revenue) of the k best cities."""
    revenue = _order_revenue(orders.filter(F.col("order_city").isNotNull()), items, "order_city")
    return _as_double(top_k(revenue, "revenue", k, ["order_city"]))


def top_products(items: DataFrame, products: DataFrame, k: int = 10) -> DataFrame:
    """(product_name, revenue) of the k best names; one name may stand for many codes."""
    revenue = (
        splittable_join(
            products.select("product_code", "product_name"), _sold(items, "product_code"), "product_code"
        )
        .groupBy("product_name")
        .agg(F.sum(_AMOUNT).alias("revenue"))
    )
    return _as_double(top_k(revenue, "revenue", k, ["product_name"]))


def customer_lifetime_value(
    customers: DataFrame, orders: DataFrame, items: DataFrame, k: int = 20
) -> DataFrame:
    """(customer_code, full_name, lifetime_value) of the k best customers."""
    spend = _order_revenue(orders, items, "customer_code")
    value = (
        splittable_join(customers.select("customer_code", "full_name"), spend, "customer_code")
        .groupBy("customer_code", "full_name")
        .agg(F.sum("revenue").alias("lifetime_value"))
    )
    return _as_double(
        top_k(value, "lifetime_value", k, ["customer_code", "full_name"]), "lifetime_value"
    )
