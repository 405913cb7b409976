"""The raw extracts as views over the benchmark tables, with defects from key arithmetic."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tillhouse.schema import ENTITIES, RAW_COLUMNS

AS_OF = "2001-07-01 00:00:00"
WATERMARK = "2001-06-01 00:00:00"
CALENDAR_START, CALENDAR_DAYS = "1995-01-01", 2500

# One SQL expression per raw column, the same text for Spark and for DuckDB.
EXPRESSIONS: dict[str, dict[str, str]] = {
    "customers": {
        "customer_code": "'C'||lpad(CAST(CASE WHEN c_custkey%50=7 THEN c_custkey-1 ELSE c_custkey END AS STRING),7,'0')",
        "first_name": "lower(c_mktsegment)",
        "last_name": "c_name",
        "full_name": "CASE WHEN c_custkey%50=10 THEN ' ' ELSE c_name END",
        "email": "CASE WHEN c_custkey%50=1 THEN NULL ELSE lower(c_mktsegment)||CAST(c_custkey AS STRING)||'@example.com' END",
        "gender": "CASE WHEN c_custkey%2=0 THEN 'male' ELSE 'female' END",
        "city": "CASE WHEN c_custkey%50=2 THEN NULL WHEN c_custkey%50=3 THEN '  ' ELSE n_name END",
        "state": "r_name",
        "phone": "CASE WHEN c_custkey%50=4 THEN 'NOT_A_NUMBER' WHEN c_custkey%50=5 THEN NULL ELSE '+91 '||lpad(CAST(c_custkey AS STRING),10,'0') END",
        "created_at": "'1995-01-01 00:00:00'",
        "updated_at": "CASE WHEN c_custkey%50=8 THEN '2099-01-01 00:00:00' WHEN c_custkey%50=9 THEN 'not-a-date' "
        "ELSE '1996-01-'||lpad(CAST(1+c_custkey%28 AS STRING),2,'0')||' 00:00:00' END",
        "is_active": "CASE WHEN c_custkey%10=0 THEN 'False' ELSE 'True' END",
    },
    "products": {
        "product_code": "'P'||lpad(CAST(CASE WHEN p_partkey%40=7 THEN p_partkey-1 ELSE p_partkey END AS STRING),6,'0')",
        "product_name": "CASE WHEN p_partkey%40=1 THEN NULL ELSE p_name END",
        "category": "CASE WHEN p_partkey%40=2 THEN ' ' WHEN p_partkey%80=7 THEN NULL ELSE p_type END",
        "unit_price": "CASE WHEN p_partkey%40=3 THEN 'FREE' WHEN p_partkey%40=4 THEN '-5.25' "
        "ELSE CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS STRING) END",
        "is_active": "'True'",
    },
    "orders": {
        "order_id": "'O'||lpad(CAST(CASE WHEN o_orderkey%40=7 THEN o_orderkey-1 ELSE o_orderkey END AS STRING),8,'0')",
        "customer_code": "CASE WHEN o_orderkey%40=1 THEN '__ORPHAN__' ELSE 'C'||lpad(CAST(o_custkey AS STRING),7,'0') END",
        "order_date": "CASE WHEN o_orderkey%40=3 THEN 'not-a-date' ELSE CAST(o_orderdate AS STRING) END",
        "status": "CASE o_orderstatus WHEN 'O' THEN 'PLACED' WHEN 'P' THEN 'SHIPPED' ELSE 'DELIVERED' END",
        "order_city": "n_name",
        "order_state": "CASE WHEN o_orderkey%40=2 THEN NULL ELSE r_name END",
    },
    "order_items": {
        "order_item_id": "'OI'||lpad(CAST(l_orderkey AS STRING),8,'0')||'-'||CAST(l_linenumber AS STRING)",
        "order_id": "CASE WHEN l_suppkey%25=1 THEN '__ORPHAN__' ELSE 'O'||lpad(CAST(l_orderkey AS STRING),8,'0') END",
        "product_code": "CASE WHEN l_suppkey%25=2 THEN '__ORPHAN__' ELSE 'P'||lpad(CAST(l_partkey AS STRING),6,'0') END",
        "quantity": "CASE WHEN l_suppkey%25=3 THEN NULL WHEN l_suppkey%25=4 THEN '-2' ELSE CAST(CAST(l_quantity AS INT) AS STRING) END",
        "unit_price": "CASE WHEN l_suppkey%25=5 THEN 'TWENTY' WHEN l_suppkey%25=6 THEN '-1.50' "
        "ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS STRING) END",
        "line_amount": "CASE WHEN l_suppkey%25=7 THEN NULL WHEN l_suppkey%25=8 THEN '-9.99' "
        "ELSE CAST(CAST(CAST(l_quantity AS INT)*CAST(l_extendedprice AS DECIMAL(18,2)) AS DECIMAL(18,2)) AS STRING) END",
    },
    "payments": {
        "payment_id": "'PM'||lpad(CAST(CASE WHEN o_orderkey%30=7 THEN o_orderkey-1 ELSE o_orderkey END AS STRING),8,'0')",
        "order_id": "CASE WHEN o_orderkey%30=1 THEN '__ORPHAN__' ELSE 'O'||lpad(CAST(o_orderkey AS STRING),8,'0') END",
        "payment_amount": "CASE WHEN o_orderkey%30=2 THEN 'MANY' WHEN o_orderkey%30=3 THEN '-12.5' "
        "ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING) END",
        "payment_method": "CASE WHEN o_orderkey%30=4 THEN NULL WHEN o_orderkey%5=0 THEN 'CARD' WHEN o_orderkey%5=1 THEN 'UPI' "
        "WHEN o_orderkey%5=2 THEN 'NETBANKING' WHEN o_orderkey%5=3 THEN 'COD' ELSE 'WALLET' END",
        "payment_date": "CASE WHEN o_orderkey%30=5 THEN 'not-a-date' ELSE CAST(o_orderdate AS STRING) END",
    },
}

# Base table, and the lookups (table, left key, right key) its expressions need.
INPUTS: dict[str, tuple[str, list[tuple[str, str, str]]]] = {
    "customers": ("customer", [("nation", "c_nationkey", "n_nationkey"), ("region", "n_regionkey", "r_regionkey")]),
    "products": ("part", []),
    "orders": (
        "orders",
        [
            ("customer", "o_custkey", "c_custkey"),
            ("nation", "c_nationkey", "n_nationkey"),
            ("region", "n_regionkey", "r_regionkey"),
        ],
    ),
    "order_items": ("lineitem", []),
    "payments": ("orders", []),
}

# Columns spoiled once more, over finished raw tables, for rules that the extracts above do not meet.
SPOILED: dict[str, dict[str, str]] = {
    "customers": {"customer_code": "CASE WHEN customer_code LIKE '%3' THEN NULL ELSE customer_code END"},
    "products": {"product_code": "CASE WHEN product_code LIKE '%3' THEN NULL ELSE product_code END"},
    "orders": {"order_id": "CASE WHEN order_id LIKE '%3' THEN NULL ELSE order_id END"},
    "order_items": {
        "order_item_id": "CASE WHEN order_item_id LIKE '%3' THEN NULL ELSE order_item_id END",
        "quantity": "CASE WHEN product_code LIKE '%4' THEN 'two' ELSE quantity END",
        "line_amount": "CASE WHEN product_code LIKE '%5' THEN 'MUCH' ELSE line_amount END",
    },
    "payments": {"payment_id": "CASE WHEN payment_id LIKE '%3' THEN NULL ELSE payment_id END"},
}

# A refreshed customer extract, from the clean customers as raw columns.
_NUMBER = "CAST(substr(customer_code,2) AS INT)"
REFRESH: dict[str, str] = {
    "customer_code": "customer_code",
    "full_name": "full_name",
    "email": f"CASE WHEN {_NUMBER}%20=13 THEN 'z'||email "
    f"WHEN {_NUMBER}%20=14 THEN substr(email,1,1)||'x'||substr(email,2) ELSE email END",
    "gender": "gender",
    "city": f"CASE WHEN {_NUMBER}%20=11 THEN 'Porto' ELSE city END",
    "state": f"CASE WHEN {_NUMBER}%20=16 THEN 'CHANGED' ELSE state END",
    "phone": f"CASE WHEN {_NUMBER}%20=15 THEN NULL ELSE phone END",
    "is_active": "is_active",
}
ARRIVALS = f"{_NUMBER}%100=17"


class BaseTables:
    """The benchmark tables of one folder, each opened once."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._open: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._open:
            self._open[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._open[name]


def as_raw(tables: BaseTables, entity: str, base: DataFrame, *extra: str) -> DataFrame:
    """`base` joined with its lookups and put into the entity's raw form."""
    for table, left, right in INPUTS[entity][1]:
        other = tables[table]
        base = base.join(other, base[left] == other[right])
    return base.selectExpr(
        *[f"{EXPRESSIONS[entity][c]} AS {c}" for c in RAW_COLUMNS[entity]], *extra
    )


class RawTables(Mapping):
    """The five raw extracts by name, each planned when it is asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.base = BaseTables(spark, sf_dir)
        self._planned: dict[str, DataFrame] = {}

    def __getitem__(self, entity: str) -> DataFrame:
        if entity not in self._planned:
            self._planned[entity] = as_raw(self.base, entity, self.base[INPUTS[entity][0]])
        return self._planned[entity]

    def __iter__(self):
        return iter(ENTITIES)

    def __len__(self) -> int:
        return len(ENTITIES)


def spoiled(raw: DataFrame, entity: str) -> DataFrame:
    """A raw table with some keys missing and some numbers unreadable."""
    return raw.selectExpr(*[f"{SPOILED[entity].get(c, c)} AS {c}" for c in RAW_COLUMNS[entity]])


def refreshed_customers(customers_clean: DataFrame) -> DataFrame:
    """Known customers with some fields changed, and a few new ones."""
    known = customers_clean.selectExpr(*[f"{text} AS {name}" for name, text in REFRESH.items()])
    arrivals = customers_clean.filter(ARRIVALS).selectExpr(
        *[f"'N'||substr(customer_code,2) AS {n}" if n == "customer_code" else n for n in REFRESH]
    )
    return known.unionByName(arrivals)
