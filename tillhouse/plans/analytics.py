"""Reports on the warehouse.

Every report first sums the fact per surrogate key and joins the dimension afterwards: map-side
sums collapse a hot customer, product or day, and the join moves one row per key instead of the
fact. Rows without the grouping attribute are left out of a report, but not out of the totals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillhouse.functions.text import inr_label, month_label
from tillhouse.operators import histogram as hist
from tillhouse.operators.ranking import label_segments, top_k
from tillhouse.plans.dims import Dims, current
from tillhouse.session import stored

SEGMENTS = ["Low", "Medium", "High"]


def apply_filters(fact: DataFrame, dims: Dims, category: str | None = None, year: int | None = None) -> DataFrame:
    """The fact rows of one category and/or year; None means all.

    The year is also put as a range on the date key, which reaches the file scan, and on the
    partition column of a stored fact, which skips the folders of other years.
    """
    if category is not None:
        products = dims.product.filter(F.col("category") == category)
        fact = fact.join(products.select("product_sk"), "product_sk", "left_semi")
    if year is not None:
        days = dims.date.filter(F.col("year") == year).select("date_sk")
        fact = fact.filter(F.col("date_sk").between(year * 10000, year * 10000 + 9999))
        if "year_month" in fact.columns:
            fact = fact.filter(F.col("year_month").between(year * 100 + 1, year * 100 + 12))
        fact = fact.join(days, "date_sk", "left_semi")
    return fact


def _per_key(fact: DataFrame, key: str) -> DataFrame:
    return fact.filter(F.col(key).isNotNull()).groupBy(key).agg(F.sum("line_amount").alias("_amount"))


def _by(fact: DataFrame, dim: DataFrame, key: str, *columns: str) -> DataFrame:
    """Exact revenue by dimension columns; rows where one of them is NULL are dropped."""
    named = dim.select(key, *columns).na.drop(subset=list(columns))
    return (
        _per_key(fact, key)
        .join(named, key)
        .groupBy(*columns)
        .agg(F.sum("_amount").alias("revenue"))
    )


def _as_double(df: DataFrame, column: str = "revenue") -> DataFrame:
    return df.withColumn(column, F.col(column).cast("double"))


def monthly_revenue(fact: DataFrame, dims: Dims) -> DataFrame:
    """(year, month, label, revenue), oldest first."""
    days = dims.date.select("date_sk", "year", "month")
    months = (
        _per_key(fact, "date_sk")
        .join(days, "date_sk")
        .groupBy("year", "month")
        .agg(F.sum("_amount").alias("revenue"))
    )
    return _as_double(
        months.select("year", "month", month_label(F.col("year"), F.col("month")).alias("label"), "revenue")
    ).orderBy("year", "month")


def category_revenue(fact: DataFrame, dims: Dims) -> DataFrame:
    """(category, revenue), best first."""
    revenue = _by(fact, dims.product, "product_sk", "category")
    return _as_double(revenue.orderBy(F.col("revenue").desc_nulls_first(), "category"))


def top_order_cities(fact: DataFrame, dims: Dims, k: int = 10) -> DataFrame:
    """(city, revenue) by the city the order went to."""
    revenue = _by(fact, dims.location, "location_sk", "city")
    return _as_double(top_k(revenue, "revenue", k, ["city"]))


def _customers(dims: Dims, current_only: bool) -> DataFrame:
    return current(dims.customer) if current_only else dims.customer


def top_customer_cities(fact: DataFrame, dims: Dims, k: int = 10, current_only: bool = True) -> DataFrame:
    """(city, revenue) by the city the customer lives in."""
    revenue = _by(fact, _customers(dims, current_only), "customer_sk", "city")
    return _as_double(top_k(revenue, "revenue", k, ["city"]))


def display_order(top: DataFrame) -> DataFrame:
    """A top-k result, smallest first, with money text for the axis."""
    return top.withColumn("revenue_text", inr_label(F.col("revenue"), decimals=0, gap="")).orderBy(
        F.col("revenue").asc_nulls_last(), "city"
    )


def customer_spend(fact: DataFrame, dims: Dims, current_only: bool = True) -> DataFrame:
    """(customer_code, spend), exact."""
    return _by(fact, _customers(dims, current_only), "customer_sk", "customer_code").withColumnRenamed(
        "revenue", "spend"
    )


def spend_segments(fact: DataFrame, dims: Dims, current_only: bool = True) -> DataFrame:
    """(customer_code, spend, segment): customers cut into three equal groups by spend."""
    return label_segments(customer_spend(fact, dims, current_only), "spend", SEGMENTS)


def segment_counts(segments: DataFrame) -> DataFrame:
    """(segment, customers, share_pct), largest first."""
    counts = segments.groupBy("segment").agg(F.count(F.lit(1)).alias("customers"))
    # The window sees the three segments only.
    total = F.sum("customers").over(Window.partitionBy())
    share = F.round(F.col("customers").cast("double") * 100 / total, 1)
    return counts.withColumn("share_pct", share).orderBy(F.col("customers").desc(), "segment")


def line_amount_histogram(fact: DataFrame, bins: int = 30) -> DataFrame:
    """Distribution of line amounts."""
    return hist.histogram(fact, "line_amount", bins)


def kpis(fact: DataFrame, dims: Dims, current_only: bool = True) -> DataFrame:
    """One row: revenue, orders, average order value, customers, and their money texts.

    One pass sums the fact per order and customer; orders and customers are counted from those sums, each with
    its own map-side distinct.
    """
    sums = fact.groupBy("order_id", "customer_sk").agg(F.sum("line_amount").alias("_amount"))
    sums = stored(sums, "order-sums")
    buyers = (
        sums.select("customer_sk").distinct().join(
            _customers(dims, current_only).select("customer_sk", "customer_code"), "customer_sk"
        )
    ).agg(F.count_distinct("customer_code").alias("n"))
    totals = sums.agg(
        F.coalesce(F.sum("_amount"), F.lit(0)).cast("double").alias("total_revenue"),
        F.count_distinct("order_id").alias("total_orders"),
    )
    average = F.when(
        F.col("total_orders") > 0, F.col("total_revenue") / F.col("total_orders")
    ).otherwise(F.lit(0.0))
    return totals.select(
        "total_revenue",
        "total_orders",
        average.alias("avg_order_value"),
        buyers.scalar().alias("unique_customers"),
        inr_label(F.col("total_revenue")).alias("revenue_text"),
        inr_label(average).alias("avg_order_text"),
        F.format_number("total_orders", 0).alias("orders_text"),
    )


def filter_choices(fact: DataFrame, dims: Dims) -> DataFrame:
    """(filter, choice): the categories and years that sales have, sorted.

    One pass finds the distinct keys of both kinds.
    """
    kinds = F.array(
        F.struct(F.lit("category").alias("filter"), F.col("product_sk").cast("bigint").alias("sk")),
        F.struct(F.lit("year").alias("filter"), F.col("date_sk").cast("bigint").alias("sk")),
    )
    sold = stored(fact.select(F.inline(kinds)).distinct(), "sold-keys")
    categories = (
        sold.filter("filter = 'category'").join(dims.product, F.col("sk") == F.col("product_sk"))
        .select("filter", F.col("category").alias("choice"))
    )
    years = (
        sold.filter("filter = 'year'").join(dims.date, F.col("sk") == F.col("date_sk"))
        .select("filter", F.col("year").cast("string").alias("choice"))
    )
    return categories.unionByName(years).na.drop(subset=["choice"]).distinct().orderBy("filter", "choice")
