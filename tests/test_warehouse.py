"""Dimensions, fact, reports, loads and files."""

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tillhouse.functions import predicates
from tillhouse.functions.casts import moment
from tillhouse.operators import inject, profiling, reconcile
from tillhouse.operators.rules import CONTENT_FIRST, ENTITY
from tillhouse.plans import analytics, dims, full_load, incremental
from tillhouse.plans.catalog import Shop
from tillhouse.schema import DW, ENTITIES, SCHEMAS, STAGING, empty_table
from tillhouse.sources import raw as sources
from tillhouse.sources import sinks
from tillhouse.sources.layers import ConflictError, Layers, closed_folders
from tillhouse.sources.testdata import AS_OF, RawTables

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def raw(spark):
    return RawTables(spark, SF_DIR)


@pytest.fixture(scope="module")
def layers(spark, raw, tmp_path_factory):
    loaded = Layers(spark, str(tmp_path_factory.mktemp("warehouse")))
    full_load.load_raw(loaded, raw)
    full_load.full_load(loaded, full_load.open_raw(loaded), AS_OF, fact_by="year_month")
    return loaded


def rows(df):
    return sorted(df.collect(), key=str)


def test_calendar(spark):
    days = dims.build_dim_date(spark).collect()
    assert (days[0].full_date, days[-1].full_date) == (date(2023, 1, 1), date(2027, 2, 8))
    assert tuple(days[0]) == (20230101, date(2023, 1, 1), 2023, 1, 1, "Jan", 1, "Sun", True)
    assert all(d.is_weekend == (d.full_date.weekday() >= 5) for d in days)
    with pytest.raises(ValueError):
        dims.date_spine(spark, "2023-01-01", 0)


def test_tables_have_the_declared_types(spark, layers):
    for layer, name in [(DW, n) for n in SCHEMAS[DW] if n != "fact_pending"] + [(STAGING, f"{e}_errors") for e in ENTITIES]:
        read = spark.read.parquet(*layers.paths(layer, name))
        declared = empty_table(spark, layer, name).dtypes
        assert [t for t in read.dtypes if t[0] != "year_month"] == declared


def test_clean_and_errors_add_up(layers):
    for e in ENTITIES:
        raw_rows, clean, errors = layers.tables(("raw", f"{e}_raw"), (STAGING, f"{e}_clean"), (STAGING, f"{e}_errors"))
        assert clean.count() + errors.count() == raw_rows.count()
        assert profiling.duplicate_stats(clean, ENTITY[e].key).first().duplicated_keys == 0


def test_fact_counts(layers):
    assert full_load.open_fact(layers).count() == 717
    assert layers.table(STAGING, "order_items_clean").count() == 1085


def test_loading_again_changes_nothing(spark, layers, raw):
    names = [(DW, n) for n in SCHEMAS[DW] if n != "fact_pending"] + [(STAGING, f"{e}_clean") for e in ENTITIES]
    before = [rows(t) for t in layers.tables(*names)]
    full_load.full_load(layers, raw, AS_OF)
    assert [rows(t) for t in layers.tables(*names)] == before
    assert layers.versions()[DW, "fact_sales"].number == 2


def test_two_writers_from_one_base_both_stay(spark, tmp_path):
    layers = Layers(spark, str(tmp_path))
    layers.replace("x", "t", spark.range(3))
    base = layers.versions()
    one = layers.write("x", "t", spark.range(10, 12), base, append=True)
    two = layers.write("x", "t", spark.range(20, 21), base, append=True)
    other = layers.write("x", "t", spark.range(1), base)
    layers.publish([one])
    layers.publish([two])
    assert sorted(r.id for r in layers.table("x", "t").collect()) == [0, 1, 2, 10, 11, 20]
    with pytest.raises(ConflictError):
        layers.publish([other])


def test_stored_fact_is_pruned_by_year(layers):
    plan = analytics.apply_filters(full_load.open_fact(layers), full_load.open_dims(layers), year=1997)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "year_month" in text.split("PartitionFilters: [")[1].split("]")[0]


def test_negative_numbers_of_any_size(spark):
    df = spark.createDataFrame([("-1e30",), ("-0.00000000001",), ("0",), ("x",), (None,)], "v string")
    assert [r[0] for r in df.select(predicates.negative("v")).collect()] == [True, True, False, None, None]


def test_unpublished_files_are_not_read(spark, tmp_path):
    layers = Layers(spark, str(tmp_path))
    layers.replace("x", "t", spark.range(3))
    layers.write("x", "t", spark.range(100), layers.versions())
    assert layers.table("x", "t").count() == 3
    layers.replace("x", "t", layers.table("x", "t").filter("id > 0"))
    assert layers.table("x", "t").count() == 2
    assert layers.append("x", "t", spark.range(5)).count() == 7
    layers.write("x", "t", spark.range(50), layers.versions(), append=True)  # dies before publishing
    assert layers.table("x", "t").columns == ["id"] and layers.table("x", "t").count() == 7
    assert layers.append("x", "t", spark.range(1)).count() == 8
    assert layers.replace("x", "t", spark.range(2)).count() == 2
    with pytest.raises(LookupError):
        layers.table("x", "other")


def test_repeated_dimension_key_stops_the_load(spark):
    days = dims.build_dim_date(spark, "2001-01-01", 5)
    with pytest.raises(ValueError, match="date_sk is not unique"):
        profiling.require_unique(days.unionByName(days), ["date_sk"], "dim_date")


def test_year_filter_reaches_the_scan(layers):
    fact = full_load.open_fact(layers, 1997)
    plan = fact._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year_month" in plan
    book = full_load.open_dims(layers)
    scoped = analytics.apply_filters(full_load.open_fact(layers), book, year=1997)
    plan = scoped._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(date_sk,19970000)" in plan


def test_filtered_reports_equal_slices(layers):
    book, sales = full_load.open_dims(layers), full_load.open_fact(layers)
    whole = {(r.year, r.month): r.revenue for r in analytics.monthly_revenue(sales, book).collect()}
    sliced = analytics.monthly_revenue(analytics.apply_filters(sales, book, year=1997), book).collect()
    assert {(r.year, r.month): r.revenue for r in sliced} == {k: v for k, v in whole.items() if k[0] == 1997}


def test_reports_on_nothing(layers):
    book, sales = full_load.open_dims(layers), full_load.open_fact(layers).limit(0)
    row = analytics.kpis(sales, book).first()
    assert (row.total_revenue, row.total_orders, row.avg_order_value, row.unique_customers) == (0.0, 0, 0.0, 0)
    assert analytics.segment_counts(analytics.spend_segments(sales, book)).count() == 0
    assert analytics.monthly_revenue(sales, book).count() == 0
    assert analytics.line_amount_histogram(sales).agg(F.sum("n")).first()[0] == 0


def test_invariants_of_the_reports(layers):
    book, sales = full_load.open_dims(layers), full_load.open_fact(layers)
    spend = analytics.spend_segments(sales, book)
    counts = analytics.segment_counts(spend).collect()
    assert sum(r.customers for r in counts) == spend.count()
    assert sum(r.n for r in analytics.line_amount_histogram(sales).collect()) == sales.count()
    total = analytics.kpis(sales, book).first().total_revenue
    months = analytics.monthly_revenue(sales, book).collect()
    assert sum(r.revenue for r in months) == pytest.approx(total)


def test_fact_files_are_cut_by_month_and_date(layers, spark):
    fact = full_load.open_fact(layers)
    files = fact.groupBy(F.input_file_name().alias("f")).agg(F.count_distinct("year_month").alias("n"))
    assert files.agg(F.max("n")).first()[0] == 1


# Increments


def test_increment_is_idempotent(spark, raw, tmp_path, as_of):
    layers = Layers(spark, str(tmp_path))
    early = raw["orders"].filter(F.col("order_date") <= "2001-05-01")
    full_load.load_staging(layers, {"orders": early}, as_of)
    first = layers.table(STAGING, "orders_clean").count()
    after = full_load.increment(layers, raw["orders"], AS_OF).count()
    assert after > first
    assert full_load.increment(layers, raw["orders"], AS_OF).count() == after
    layers.replace(STAGING, "load_watermarks", sources.seed_watermarks(spark))
    assert full_load.increment(layers, raw["orders"], AS_OF).count() == after
    assert len(layers.versions()[STAGING, "orders_clean"].folders) > 1
    assert layers.compact(STAGING, "orders_clean").count() == after
    assert len(layers.versions()[STAGING, "orders_clean"].folders) == 1
    marks = {r.table_name: r.last_loaded_at for r in layers.table(STAGING, "load_watermarks").collect()}
    assert marks == {"ORDERS": datetime(2001, 7, 1), "PAYMENTS": datetime(1900, 1, 1), "CUSTOMERS": datetime(1900, 1, 1)}


def test_increment_bounds(spark, as_of):
    names = SCHEMAS["raw"]["orders_raw"]
    stamps = ["2001-06-01 00:00:00", "2001-06-01 00:00:00.000001", "2001-07-01 00:00:00", "2001-07-01 00:00:01", "x"]
    arrived = [(f"O{i}", "C1", t, "PLACED", "Pune", "MH") for i, t in enumerate(stamps)]
    arrived += [("O8", None, stamps[2], "PLACED", "Pune", "MH"), ("O9", "__ORPHAN__", stamps[2], "PLACED", "Pune", "MH")]
    arrived += [("O2", "C1", stamps[2], "PLACED", "Pune", "MH"), ("OA", "C1", stamps[2], "PLACED", "Pune", None)]
    loaded = spark.createDataFrame([("O1", "C1", datetime(2001, 6, 1, 0, 0, 0, 1), "PLACED", "Pune", "MH")],
                                   SCHEMAS["staging"]["orders_clean"])
    marks = incremental.set_watermark(sources.seed_watermarks(spark), moment("2001-06-01 00:00:00"))
    df = spark.createDataFrame(arrived, names)
    plain = incremental.incremental_orders(df, loaded, marks, as_of)
    assert sorted(r.order_id for r in plain.added.collect()) == ["O1", "O2", "O2", "OA"]
    checked = incremental.incremental_orders(df, loaded, marks, as_of, validate=True)
    assert [r.order_id for r in checked.added.collect()] == ["O2"]
    assert sorted(r.reason for r in checked.errors.collect()) == sorted(
        ["invalid_date_format", "missing_customer_code", "orphan_customer", "missing_order_state", "duplicate_order_id", "duplicate_order_id"]
    )
    nothing = incremental.incremental_orders(df, loaded, marks.limit(0), as_of)
    assert nothing.added.count() == 0


def test_refresh_is_published(spark, layers):
    source = layers.table(STAGING, "customers_clean").withColumn("city", F.lit("Porto"))
    n = source.count()
    after = full_load.refresh_customers(layers, source, "2001-08-01 00:00:00")
    assert after.filter("is_current").count() == n and after.count() == 2 * n
    assert full_load.refresh_customers(layers, source, "2001-09-01 00:00:00").count() == 2 * n


def test_refresh_keeps_closed_versions_where_they_are(spark, layers):
    def moved(city, at):
        source = layers.table(STAGING, "customers_clean").withColumn("city", F.lit(city))
        after = full_load.refresh_customers(layers, source, at)
        return after, layers.versions()[DW, "dim_customer"]

    before = layers.versions()[DW, "dim_customer"]
    n = layers.table(DW, "dim_customer").filter("is_current").count()
    _, first = moved("Braga", "2001-10-01 00:00:00")
    after, second = moved("Faro", "2001-11-01 00:00:00")
    assert set(closed_folders(before)) < set(closed_folders(first)) < set(closed_folders(second))
    assert len(second.folders) == len(closed_folders(second)) + 1
    closed = layers.folder_frame(DW, "dim_customer", closed_folders(second))
    assert closed.filter("is_current").count() == 0 and after.filter("is_current").count() == n
    assert closed.filter("city = 'Braga'").count() == n
    assert after.count() == after.select("customer_sk").distinct().count()


# Planted defects


def test_planted_equals_detected(spark, as_of):
    planted = Shop(spark, SF_DIR).injected
    found = reconcile.staging_counts(planted, as_of, CONTENT_FIRST)
    profile = inject.profile_of(planted, 23)
    doc = json.loads(profile.toJSON().first())
    assert set(doc) == {"seed", "entities", "grand_totals", "orphan_placeholders"}
    for r in found.collect():
        assert doc["entities"][r.entity]["bad"] == r.errors > 0
        assert doc["entities"][r.entity]["clean"] == r.clean


def test_injection_is_repeatable_and_seeded(spark):
    clean = inject.as_text(Shop(spark, SF_DIR).staged("products", CONTENT_FIRST).clean)

    def bad(seed):
        return rows(inject.inject(clean, "products", "product_code", moment(AS_OF), seed).filter("defect IS NOT NULL"))

    assert bad(1) == bad(1) != bad(2)


def test_shuffle_keeps_all_rows(raw):
    df = raw["products"]
    once = inject.shuffle(df, 5, 4)
    assert rows(once) == rows(df)
    assert once.collect() == inject.shuffle(df, 5, 4).collect()
    assert once.rdd.getNumPartitions() == 4


def test_reconcile_names_gaps(spark):
    profile = spark.createDataFrame([("a", 5, 2, 7), ("b", 5, 2, 7), ("c", 5, 2, 7)], "entity STRING, clean LONG, bad LONG, total LONG")
    found = spark.createDataFrame([("a", 5, 2), ("b", 4, 3), ("c", 6, 1)], "entity STRING, clean LONG, errors LONG")
    assert {r.entity: r.result for r in reconcile.reconcile(profile, found).collect()} == {"a": "match", "b": "over", "c": "under"}


# Files


def test_csv_forms(spark, tmp_path):
    (tmp_path / "p.csv").write_text('C1,C2,C3,C4,C5\nP1,"pen, blue",Toys,1.50,True\nP2,"say ""hi""",,"",False\n')
    df = sources.rename_positional(sources.read_positional(spark, str(tmp_path / "p.csv")), "products")
    assert [tuple(r) for r in df.collect()] == [
        ("P1", "pen, blue", "Toys", "1.50", "True"), ("P2", 'say "hi"', None, None, "False"),
    ]
    named = sources.read_raw(spark, str(tmp_path / "p.csv"), "products")
    assert rows(named) == rows(df)
    with pytest.raises(ValueError):
        sources.rename_positional(df, "orders")


def test_raw_copy_in_parquet(spark, raw, tmp_path):
    sinks.write_raw(raw["products"], str(tmp_path / "products"), parquet=True)
    assert rows(spark.read.parquet(str(tmp_path / "products" / "parquet"))) == rows(raw["products"])
    assert rows(sources.read_raw(spark, str(tmp_path / "products" / "csv"), "products")) == rows(raw["products"])


def test_fact_sink(spark, layers, tmp_path):
    fact = full_load.open_fact(layers).drop("year_month")
    sinks.write_fact(fact, str(tmp_path / "fact"))
    assert rows(spark.read.parquet(str(tmp_path / "fact")).select(fact.columns)) == rows(fact)


def test_client_refuses_large_results(spark):
    assert len(sinks.to_client(spark.range(5), max_rows=5)) == 5
    with pytest.raises(ValueError):
        sinks.to_client(spark.range(11), max_rows=10)


def test_shape_and_preview(spark):
    df = spark.range(20).withColumn("x", F.lit(1))
    assert profiling.shape(df) == (20, 2)
    assert [r.id for r in sources.preview(df, ["id"], 3).collect()] == [0, 1, 2]


def test_null_is_a_duplicate_key_of_its_own(spark):
    df = spark.createDataFrame([(None,), (None,), ("a",), ("b",), ("b",)], "k STRING")
    assert [(r.k, r.duplicate_count) for r in profiling.duplicate_keys(df, "k").collect()] == [("b", 2), (None, 2)]
    assert tuple(profiling.duplicate_stats(df, "k").first()) == (2, 2)
    assert tuple(profiling.duplicate_stats(df.filter("k = 'a'"), "k").first()) == (0, None)
