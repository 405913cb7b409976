"""Steps that read their input once, whatever they do with it afterwards."""

import os

import pytest
from pyspark.sql import functions as F

from tillhouse.operators import inject, staging
from tillhouse.operators.histogram import histogram
from tillhouse.operators.rules import ENTITY, ORDER_ITEMS
from tillhouse.operators.staging import landed, quality_counts
from tillhouse.plans import analytics, arrivals, full_load
from tillhouse.plans.catalog import Shop
from tillhouse.plans.dims import Dims
from tillhouse.schema import ENTITIES
from tillhouse.sources.layers import Layers
from tillhouse.sources.testdata import AS_OF

GOOD = ("OI1", "O1", "P1", "2", "1.50", "3.00")


@pytest.fixture
def items(spark, tmp_path):
    """Raw order items in files: fit ones, one that repeats, and unfit ones."""
    rows = [GOOD, GOOD, ("OI2", *GOOD[1:]), ("OI3", *GOOD[1:4], "FREE", "3.00"), (None, *GOOD[1:])]
    path = str(tmp_path / "source-items")
    spark.createDataFrame(rows, ", ".join(f"{c} STRING" for c in ORDER_ITEMS.columns)).write.parquet(path)
    return spark.read.parquet(path)


def scans(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("Relation")


def test_staged_tables_read_landed_rows(items, as_of):
    staged = landed(items, ORDER_ITEMS, as_of)
    for kind, n in (("clean", 2), ("errors", 3)):
        out = getattr(staged, kind)
        assert out.count() == n
        assert not any("source-items" in f for f in out.inputFiles())
        # One folder for both verdicts: rows going to several would be sorted by the tasks that write them.
        assert not any("unfit=" in f for f in out.inputFiles())


def test_repeated_keys_are_ranked_once(items, as_of):
    """Clean rows and rejects both need the first row of a key, which is ranked for one of them only."""
    staged = landed(items, ORDER_ITEMS, as_of)
    for kind in ("clean", "errors"):
        assert any("order_items-first" in f for f in getattr(staged, kind).inputFiles())


def test_many_repeated_keys_move_few_other_rows(spark, as_of, settings, monkeypatch):
    """Too many repeated keys to broadcast: the rows of other keys stay where they are, whatever their bits."""
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    raw = spark.range(0, 6000, 1, 4).select(
        F.format_string("OI%d", F.when(F.col("id") < 600, F.col("id") % 300).otherwise(F.col("id"))).alias("order_item_id"),
        *[F.lit(v).alias(c) for c, v in zip(ORDER_ITEMS.columns[1:], GOOD[1:])],
    )
    staged = landed(raw, ORDER_ITEMS, as_of)
    assert (staged.clean.count(), staged.errors.count()) == (5700, 300)
    clear, met = staged._sorted_out
    assert met.filter("_again").count() == 600 and met.count() < 700 and clear.count() + met.count() == 6000
    # A map that is full tells nothing, and the result is the same.
    monkeypatch.setattr(staging, "_BITS", 64)
    full = landed(raw, ORDER_ITEMS, as_of)
    assert full._sorted_out[1].count() > 5000
    assert sorted(full.clean.collect()) == sorted(staged.clean.collect())
    assert sorted(full.errors.collect()) == sorted(staged.errors.collect())


def test_what_waits_for_its_order_is_found_once(spark, tmp_path, monkeypatch):
    """A refresh stores the candidates that it reads three times, and removes them."""
    stored, kept = arrivals.stored, {}

    def watched(df, purpose):
        kept[purpose] = stored(df, purpose)
        return kept[purpose]

    monkeypatch.setattr(arrivals, "stored", watched)
    layers, raw = Layers(spark, str(tmp_path)), Shop(spark, "/root/testdata/sf0.001").raw
    full_load.full_load(layers, raw, AS_OF, fact_by="year_month")
    arrivals.refresh_warehouse(layers, AS_OF)
    assert set(kept) == {"fact-candidates", "fact-arrived"}
    assert not any(os.path.exists(df.stored_at) for df in kept.values())


def test_queries_stage_landed_rows(spark):
    clean = Shop(spark, "/root/testdata/sf0.001").clean("order_items")
    assert not any("lineitem" in f for f in clean.inputFiles())


def test_verdicts_are_counted_in_one_scan(items, as_of):
    counts = quality_counts(items, ORDER_ITEMS, as_of)
    assert scans(counts) == 1
    assert {r.reason: r.n for r in counts.collect()} == {
        "clean": 2, "duplicate_order_item_id": 1, "price_type_mismatch": 1, "missing_order_item_id": 1,
    }


def test_rules_are_not_moved_below_a_filter(spark, as_of):
    """In `reference` mode only the key is asked for in a filter."""
    rows = [("C1", *["x"] * 11), (None, *["x"] * 11)]
    raw = spark.createDataFrame(rows, ", ".join(f"{c} STRING" for c in ENTITY["customers"].columns))
    plan = quality_counts(raw, ENTITY["customers"], as_of)._jdf.queryExecution().optimizedPlan().toString()
    assert not any("CASE WHEN" in line for line in plan.splitlines() if "Filter" in line)


def test_injection_reads_its_rows_once(items, as_of):
    found = inject.inject(items.filter("order_item_id IS NOT NULL"), "order_items", "order_item_id", as_of, per_mille=1000)
    assert scans(found) == 1
    assert found.filter("defect IS NULL").count() == found.filter("defect IS NOT NULL").count() == 4


def test_histogram_and_reports_read_the_fact_once(spark, tmp_path):
    path = str(tmp_path / "source-fact")
    spark.createDataFrame(
        [("O1", 1, 1, 20200101, 10.0), ("O1", 1, 2, 20200101, 30.0), ("O2", None, None, 20210101, 5.0), ("O3", 2, 3, None, None)],
        "order_id STRING, customer_sk BIGINT, product_sk BIGINT, date_sk INT, line_amount DOUBLE",
    ).withColumn("line_amount", F.col("line_amount").cast("decimal(18,2)")).write.parquet(path)
    fact = spark.read.parquet(path)
    dims = Dims(
        spark.createDataFrame([(20200101, 2020), (20210101, 2021)], "date_sk INT, year INT"),
        spark.createDataFrame([(1, "Toys"), (2, "Toys"), (3, None)], "product_sk BIGINT, category STRING"),
        None,
        spark.createDataFrame([(1, "C1", True), (2, "C2", False)], "customer_sk BIGINT, customer_code STRING, is_current BOOLEAN"),
    )
    found = {
        "bars": histogram(fact, "line_amount", 5),
        "kpis": analytics.kpis(fact, dims),
        "choices": analytics.filter_choices(fact, dims),
    }
    for df in found.values():
        assert not any("source-fact" in f for f in df.inputFiles())
    assert [r.n for r in found["bars"].orderBy("bin").collect()] == [1, 1, 0, 0, 1]
    kpis = found["kpis"].first()
    assert (kpis.total_revenue, kpis.total_orders, kpis.unique_customers) == (45.0, 3, 1)
    assert [tuple(r) for r in found["choices"].collect()] == [("category", "Toys"), ("year", "2020"), ("year", "2021")]


def test_planted_rows_are_stored(spark):
    injected = Shop(spark, "/root/testdata/sf0.001").injected
    assert list(injected) == list(ENTITIES)
    assert all(f"{name}-injected" in f for name, df in injected.items() for f in df.inputFiles())
