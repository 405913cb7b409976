"""Hot keys: a third of all rows on one key must be split at run time, with whole results."""

from pyspark.sql import functions as F

from tillhouse.operators.rules import ORDER_ITEMS
from tillhouse.operators.staging import stage
from tillhouse.plans import dims, raw_sales
from tillhouse.plans.fact import build_fact_sales

SMALL = {
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "20k",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "40k",
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    # A shuffle partition is cut between map tasks; at this size coalescing would leave only one.
    "spark__sql__adaptive__coalescePartitions__enabled": "false",
}
N = 60_000


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def hot(share_key, other):
    return F.when(F.col("id") % 3 == 0, F.lit(share_key)).otherwise(other)


def items(spark, **cells):
    base = {
        "order_item_id": F.format_string("OI%d", "id"),
        "order_id": F.format_string("O%d", F.col("id") % 5000),
        "product_code": F.format_string("P%d", F.col("id") % 300),
        "quantity": (F.col("id") % 5 + 1).cast("string"),
        "unit_price": F.lit("2.00"),
        "line_amount": F.md5(F.col("id").cast("string")),
    }
    return spark.range(0, N, 1, 16).select(*[c.alias(n) for n, c in {**base, **cells}.items()])


def test_hot_key_in_quarantine_is_split(spark, as_of, settings):
    settings(**SMALL)
    raw = items(spark, order_item_id=hot("HOT", F.format_string("OI%d", F.col("id") % 20000)),
                order_id=F.format_string("O%d", "id"))
    errors = stage(raw, ORDER_ITEMS, as_of).errors
    keys = raw.select("order_item_id").distinct().count()
    assert errors.count() == N - keys
    assert "skew=true" in final_plan(errors)


def test_hot_order_and_hot_customer_in_the_fact_are_split(spark, as_of, settings):
    settings(**SMALL)
    bought = items(spark, order_id=hot("O1", F.format_string("O%d", F.col("id") % 5000)), line_amount=F.lit("2.00"))
    clean = stage(bought, ORDER_ITEMS, as_of).clean
    orders = spark.range(0, 30000, 1, 16).select(
        F.format_string("O%d", "id").alias("order_id"),
        hot("C1", F.format_string("C%d", F.col("id") % 700)).alias("customer_code"),
        F.lit("1999-01-01").cast("timestamp_ntz").alias("order_date"),
        F.md5(F.col("id").cast("string")).alias("status"),
        F.concat(F.lit("City"), F.col("id") % 50).alias("order_city"),
        F.concat(F.lit("State"), F.col("id") % 50 % 7).alias("order_state"),
    )
    customers = spark.range(1000).select(
        F.col("id").alias("customer_sk"), F.format_string("C%d", "id").alias("customer_code"),
        F.lit(True).alias("is_current"),
    )
    products = spark.range(1000).select(
        F.col("id").alias("product_sk"), F.format_string("P%d", "id").alias("product_code")
    )
    fact = build_fact_sales(clean, orders, customers, products, dims.build_dim_location(orders))
    plan = final_plan(fact)
    assert fact.count() == N
    assert plan.count("skew=true") >= 2


def test_hot_order_header_and_hot_item_key_in_raw_sales(spark, settings):
    """A third of the items and of the headers share one order; revenue multiplies as in a join."""
    settings(**SMALL)
    sold = items(spark, order_id=hot("O0", F.format_string("O%d", F.col("id") % 5000)), line_amount=F.lit("2.00"))
    sold = sold.filter(F.crc32("order_item_id") % 10 == 0)
    orders = spark.range(0, 30000, 1, 16).select(
        hot("O0", F.format_string("O%d", "id")).alias("order_id"),
        F.format_string("C%d", "id").alias("customer_code"),
        F.lit("1999-01-01 00:00:00").alias("order_date"),
        F.md5(F.col("id").cast("string")).alias("order_city"),
    )
    revenue = raw_sales.top_cities(orders, sold, k=30000)
    assert "skew=true" in final_plan(revenue)
    naive = orders.join(sold, "order_id").groupBy("order_city").agg((F.count("*") * 2.0).alias("revenue"))
    assert sorted(map(tuple, revenue.collect())) == sorted(map(tuple, naive.collect()))
