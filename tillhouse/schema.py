"""Column names and types of every table in the three layers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

ORPHAN = "__ORPHAN__"

RAW, STAGING, DW = "raw", "staging", "dw"

# The raw column order is part of the file format.
RAW_COLUMNS: dict[str, list[str]] = {
    "customers": [
        "customer_code", "first_name", "last_name", "full_name", "email", "gender",
        "city", "state", "phone", "created_at", "updated_at", "is_active",
    ],
    "products": ["product_code", "product_name", "category", "unit_price", "is_active"],
    "orders": ["order_id", "customer_code", "order_date", "status", "order_city", "order_state"],
    "order_items": [
        "order_item_id", "order_id", "product_code", "quantity", "unit_price", "line_amount",
    ],
    "payments": ["payment_id", "order_id", "payment_amount", "payment_method", "payment_date"],
}

ENTITIES = list(RAW_COLUMNS)

_TYPED = {
    "created_at": "TIMESTAMP_NTZ",
    "updated_at": "TIMESTAMP_NTZ",
    "order_date": "TIMESTAMP_NTZ",
    "payment_date": "TIMESTAMP_NTZ",
    "is_active": "BOOLEAN",
    "quantity": "BIGINT",
    "unit_price": "DECIMAL(18,2)",
    "line_amount": "DECIMAL(18,2)",
    "payment_amount": "DECIMAL(18,2)",
}


def raw_schema(entity: str) -> str:
    """Every raw column is text; typing happens in staging."""
    return ", ".join(f"{c} STRING" for c in RAW_COLUMNS[entity])


def _clean_schema(entity: str) -> str:
    return ", ".join(f"{c} {_TYPED.get(c, 'STRING')}" for c in RAW_COLUMNS[entity])


SCHEMAS: dict[str, dict[str, str]] = {
    RAW: {f"{e}_raw": raw_schema(e) for e in ENTITIES},
    STAGING: {
        **{f"{e}_clean": _clean_schema(e) for e in ENTITIES},
        **{
            f"{e}_errors": "row_data STRING, reason STRING, logged_at TIMESTAMP_NTZ"
            for e in ENTITIES
        },
        "load_watermarks": "table_name STRING, last_loaded_at TIMESTAMP_NTZ",
        "load_arrivals": (
            "consumer STRING, table_name STRING, folder STRING, file STRING, bytes BIGINT, n_rows BIGINT, "
            "landed_at TIMESTAMP_NTZ, loaded_at TIMESTAMP_NTZ"
        ),
        "load_counts": "entity STRING, reason STRING, n BIGINT",
    },
    DW: {
        "key_customer": "customer_code STRING, customer_sk BIGINT",
        "key_product": "product_code STRING, product_sk BIGINT",
        "key_location": "city STRING, state STRING, location_sk BIGINT",
        "dim_customer": (
            "customer_sk BIGINT, customer_code STRING, full_name STRING, email_masked STRING, "
            "phone_masked STRING, gender STRING, city STRING, state STRING, is_active BOOLEAN, "
            "eff_start_date TIMESTAMP_NTZ, eff_end_date TIMESTAMP_NTZ, is_current BOOLEAN"
        ),
        "dim_product": (
            "product_sk BIGINT, product_code STRING, product_name STRING, category STRING, "
            "unit_price DECIMAL(18,2), is_active BOOLEAN"
        ),
        "dim_location": "location_sk BIGINT, city STRING, state STRING",
        "dim_date": (
            "date_sk INT, full_date DATE, year INT, quarter INT, month INT, month_name STRING, "
            "day INT, day_of_week STRING, is_weekend BOOLEAN"
        ),
        "fact_sales": (
            "order_item_id STRING, order_id STRING, customer_sk BIGINT, product_sk BIGINT, "
            "location_sk BIGINT, date_sk INT, quantity BIGINT, unit_price DECIMAL(18,2), "
            "line_amount DECIMAL(18,2), order_status STRING"
        ),
        "fact_pending": _clean_schema("order_items"),
    },
}


def columns_of(layer: str, name: str) -> list[str]:
    return [part.split()[0] for part in SCHEMAS[layer][name].split(", ")]


def empty_table(spark: SparkSession, layer: str, name: str) -> DataFrame:
    """A typed table without rows."""
    return spark.createDataFrame([], SCHEMAS[layer][name])
