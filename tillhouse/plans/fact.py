"""Sales fact and the denormalised star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.functions import casts
from tillhouse.plans.dims import Dims, current

PARTS = ("date", "product", "location", "customer")


def _resolved_orders(orders: DataFrame, dim_customer: DataFrame, dim_location: DataFrame, how: str) -> DataFrame:
    """Order headers with their keys. Done before the items join: there are far fewer headers."""
    customers = current(dim_customer).select("customer_sk", "customer_code")
    places = dim_location.select(
        "location_sk", F.col("city").alias("order_city"), F.col("state").alias("order_state")
    )
    return (
        orders.join(customers, "customer_code", how)
        .join(places, ["order_city", "order_state"], "left")
        .select(
            "order_id",
            "customer_sk",
            "location_sk",
            casts.date_key(F.col("order_date")).alias("date_sk"),
            F.col("status").alias("order_status"),
        )
    )


def build_fact_sales(
    items: DataFrame, orders: DataFrame, dim_customer: DataFrame, dim_product: DataFrame, dim_location: DataFrame
) -> DataFrame:
    """One row per clean item whose order, current customer and product are known."""
    headers = _resolved_orders(orders, dim_customer, dim_location, "inner")
    products = dim_product.select("product_sk", "product_code")
    return (
        items.join(headers, "order_id")
        .join(products, "product_code")
        .select(
            "order_item_id", "order_id", "customer_sk", "product_sk", "location_sk", "date_sk",
            "quantity", "unit_price", "line_amount", "order_status",
        )
    )


def fact_rejects(items: DataFrame, orders: DataFrame, dim_customer: DataFrame, dim_product: DataFrame) -> DataFrame:
    """The clean items that the fact's inner joins leave out, with the first parent missing."""
    customers = current(dim_customer).select("customer_code", F.lit(True).alias("has_customer"))
    headers = orders.join(customers, "customer_code", "left").select(
        "order_id", F.lit(True).alias("has_order"), "has_customer"
    )
    products = dim_product.select("product_code", F.lit(True).alias("has_product"))
    parent = (
        F.when(F.col("has_order").isNull(), "order")
        .when(F.col("has_customer").isNull(), "customer")
        .when(F.col("has_product").isNull(), "product")
    )
    return (
        items.join(headers, "order_id", "left")
        .join(products, "product_code", "left")
        .select("order_item_id", "order_id", "product_code", parent.alias("missing_parent"))
        .filter(F.col("missing_parent").isNotNull())
    )


def _part(dims: Dims, part: str, current_only: bool) -> tuple[str, DataFrame]:
    if part == "date":
        return "date_sk", dims.date
    if part == "product":
        return "product_sk", dims.product.withColumnsRenamed(
            {"unit_price": "product_unit_price", "is_active": "product_is_active"}
        )
    if part == "location":
        return "location_sk", dims.location.withColumnsRenamed(
            {"city": "location_city", "state": "location_state"}
        )
    customer = current(dims.customer) if current_only else dims.customer
    return "customer_sk", customer.withColumnsRenamed(
        {"city": "customer_city", "state": "customer_state", "is_active": "customer_is_active"}
    )


def star(fact: DataFrame, dims: Dims, parts: tuple[str, ...] = PARTS, current_only: bool = True) -> DataFrame:
    """The fact with dimension attributes, one left join per part asked for.

    No side is forced to be broadcast: Spark does so where the size it knows allows it.

    With `current_only`, sales of an expired customer version keep NULL customer attributes;
    without it they keep the attributes that held at the time.
    """
    wide = fact
    for part in parts:
        key, dim = _part(dims, part, current_only)
        wide = wide.join(dim, key, "left")
    return wide
