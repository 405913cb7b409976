"""Time a full load and the headline queries; prints one JSON line.

The reports run on the loaded warehouse tables, the raw and staging queries on the raw rows.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.operators import reconcile, staging
from tillhouse.operators.rules import ENTITY
from tillhouse.functions import casts
from tillhouse.plans import analytics, arrivals, fact, full_load, raw_sales, scd2
from tillhouse.session import build_session, shared_dir
from tillhouse.sources import testdata
from tillhouse.sources.layers import Layers

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = build_session(
        "bench",
        master=f"local[{CPUS}]",
        **{"spark.sql.shuffle.partitions": CPUS, "spark.driver.memory": "16g", "spark.log.level": "ERROR"},
    )
    layers = Layers(spark, shared_dir(spark, "bench"))
    as_of = casts.moment(testdata.AS_OF)
    times: dict[str, float] = {}

    def clock(name: str, action) -> None:
        start = time.perf_counter()
        action()
        times[name] = round(time.perf_counter() - start, 3)

    clock("load_raw", lambda: full_load.load_raw(layers, testdata.RawTables(spark, SF_DIR), int(CPUS)))
    raw = full_load.open_raw(layers)
    clock("full_load", lambda: full_load.full_load(layers, None, testdata.AS_OF, fact_by="year_month"))
    dims, sales = full_load.open_dims(layers), full_load.open_fact(layers)
    orders, items = raw["orders"], raw["order_items"]
    customers_clean = layers.table("staging", "customers_clean")

    def filtered() -> DataFrame:
        return analytics.apply_filters(full_load.open_fact(layers, 1997), dims, "ECONOMY", 1997)

    plans = {
        "q_raw_monthly_revenue": lambda: raw_sales.monthly_revenue(orders, items),
        "q_raw_top_cities": lambda: raw_sales.top_cities(orders, items),
        "q_raw_top_products": lambda: raw_sales.top_products(items, raw["products"]),
        "q_raw_clv": lambda: raw_sales.customer_lifetime_value(raw["customers"], orders, items),
        "staging_counts": lambda: reconcile.staging_counts(raw, as_of),
        "stage_order_items_clean": lambda: staging.stage(items, ENTITY["order_items"], as_of).clean,
        "stage_order_items_errors": lambda: staging.stage(items, ENTITY["order_items"], as_of).errors,
        "star": lambda: fact.star(sales, dims),
        "q_monthly_revenue": lambda: analytics.monthly_revenue(sales, dims),
        "q_category_revenue": lambda: analytics.category_revenue(sales, dims),
        "q_top_customer_cities": lambda: analytics.top_customer_cities(sales, dims),
        "q_top_order_cities": lambda: analytics.top_order_cities(sales, dims),
        "q_spend_segments": lambda: analytics.segment_counts(analytics.spend_segments(sales, dims)),
        "q_line_amount_histogram": lambda: analytics.line_amount_histogram(sales),
        "q_kpis": lambda: analytics.kpis(sales, dims),
        "q_kpis_filtered": lambda: analytics.kpis(filtered(), dims),
        "q_monthly_revenue_filtered": lambda: analytics.monthly_revenue(filtered(), dims),
        "filter_choices": lambda: analytics.filter_choices(sales, dims),
        "scd2_apply": lambda: scd2.scd2_apply(
            dims.customer, testdata.refreshed_customers(customers_clean), as_of
        ),
    }
    for name, plan in plans.items():
        clock(name, lambda plan=plan: run(plan()))
    # A hundredth of the orders arrives, and staging and the warehouse follow.
    arrived = orders.filter(F.pmod(F.xxhash64("order_id"), F.lit(100)) == 0).withColumn("order_id", F.concat(F.lit("N"), "order_id"))
    arrivals.land(layers, "orders", arrived)
    clock("increment_1_percent", lambda: arrivals.increment(layers, testdata.AS_OF, ("orders",)))
    clock("refresh_warehouse", lambda: arrivals.refresh_warehouse(layers, testdata.AS_OF))
    print(
        json.dumps(
            {
                "metric": "total time of a full load and the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(SF_DIR.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    sys.exit(main())
