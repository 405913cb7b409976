"""Dimension builds."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.functions import casts
from tillhouse.functions.masking import mask_email, mask_phone
from tillhouse.operators.keys import assign_sk
from tillhouse.schema import DW, columns_of


@dataclass(frozen=True)
class Dims:
    date: DataFrame
    product: DataFrame
    location: DataFrame
    customer: DataFrame


def date_spine(spark: SparkSession, start: date | str, n_days: int) -> DataFrame:
    """One row per day, without gaps."""
    if n_days < 1:
        raise ValueError("a calendar has at least one day")
    first = F.lit(str(start)).cast("date")
    return spark.range(0, n_days, 1, 1).select(
        F.date_add(first, F.col("id").cast("int")).alias("full_date")
    )


def date_spine_between(spark: SparkSession, first: date, last: date) -> DataFrame:
    return date_spine(spark, first, (last - first).days + 1)


def date_spine_of(df: DataFrame, column: str) -> DataFrame:
    """Every day from the first to the last one found in `column`."""
    day = F.col(column).cast("date")
    ends = df.agg(F.min(day).alias("first"), F.max(day).alias("last"))
    return ends.select(F.explode(F.sequence("first", "last")).alias("full_date"))


def calendar(spine: DataFrame) -> DataFrame:
    """The calendar attributes of each day; weeks start on Sunday."""
    day = F.col("full_date")
    return spine.select(
        casts.date_key(day).alias("date_sk"),
        day,
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.monthname(day).alias("month_name"),
        F.dayofmonth(day).alias("day"),
        F.dayname(day).alias("day_of_week"),
        F.dayofweek(day).isin(1, 7).alias("is_weekend"),
    )


def build_dim_date(spark: SparkSession, start: date | str = "2023-01-01", n_days: int = 1500) -> DataFrame:
    return calendar(date_spine(spark, start, n_days))


def build_dim_product(products_clean: DataFrame) -> DataFrame:
    """Latest attributes only, no history."""
    return assign_sk(products_clean, ["product_code"], "product_sk").select(
        *columns_of(DW, "dim_product")
    )


def places(orders_clean: DataFrame) -> DataFrame:
    """The distinct city and state pairs of the orders."""
    return (
        orders_clean.filter(F.col("order_city").isNotNull())
        .select(F.col("order_city").alias("city"), F.col("order_state").alias("state"))
        .distinct()
    )


def build_dim_location(orders_clean: DataFrame) -> DataFrame:
    return assign_sk(places(orders_clean), ["city", "state"], "location_sk")


def customer_versions(customers: DataFrame, start: Column) -> DataFrame:
    """Staged customers as masked current versions, without surrogate keys."""
    return customers.select(
        "customer_code",
        "full_name",
        mask_email(F.col("email")).alias("email_masked"),
        mask_phone(F.col("phone")).alias("phone_masked"),
        "gender",
        "city",
        "state",
        "is_active",
        start.alias("eff_start_date"),
        F.lit(None).cast("timestamp_ntz").alias("eff_end_date"),
        F.lit(True).alias("is_current"),
    )


def build_dim_customer(customers_clean: DataFrame) -> DataFrame:
    """First load: every customer is current since its creation."""
    return assign_sk(first_versions(customers_clean), ["customer_code"], "customer_sk")


def first_versions(customers_clean: DataFrame) -> DataFrame:
    """Every customer as current since its creation, without surrogate keys."""
    return customer_versions(customers_clean, F.col("created_at"))


def current(dim_customer: DataFrame) -> DataFrame:
    return dim_customer.filter("is_current")
