"""Increments by arrival, the warehouse that follows, and keys that stay."""

import shutil

import pytest
from pyspark.sql import functions as F

from tillhouse.operators.keys import assign_sk, new_keys, numbered_by
from tillhouse.plans import arrivals, full_load
from tillhouse.schema import DW, RAW, STAGING, raw_schema
from tillhouse.sources.layers import Layers
from tillhouse.sources.testdata import AS_OF, RawTables

SF_DIR = "/root/testdata/sf0.001"
FIRST = "2001-05-01 00:00:00"


def rows(df):
    return sorted(df.collect(), key=str)


def files(df):
    return set(df.inputFiles())


@pytest.fixture(scope="module")
def raw(spark):
    return RawTables(spark, SF_DIR)


@pytest.fixture(scope="module")
def first_load(spark, raw, tmp_path_factory):
    """A warehouse over the orders of the first years."""
    folder = tmp_path_factory.mktemp("first")
    loaded = Layers(spark, str(folder))
    for entity, table in raw.items():
        early = table.filter(F.col("order_date") <= "1999-12-31") if entity == "orders" else table
        arrivals.land(loaded, entity, early)
    full_load.full_load(loaded, None, FIRST, fact_by="year_month")
    return folder


@pytest.fixture
def layers(spark, first_load, tmp_path):
    """A copy of that warehouse for each test."""
    shutil.copytree(first_load, tmp_path, dirs_exist_ok=True)
    return Layers(spark, str(tmp_path))


def order(order_id, **cells):
    base = {"customer_code": "C0000014", "order_date": "2001-06-30 10:00:00", "status": "PLACED", "order_city": "NATION_1", "order_state": "REGION_1"}
    return (order_id, *{**base, **cells}.values())


def test_only_new_files_are_read(spark, layers, raw, monkeypatch):
    seen = []
    unread = arrivals.unread

    def watched(layers_, known, consumer, layer, name):
        found = unread(layers_, known, consumer, layer, name)
        seen.extend(found.rows.inputFiles() if found.rows is not None else [])
        return found

    monkeypatch.setattr(arrivals, "unread", watched)
    assert arrivals.increment(layers, AS_OF) == {}
    folder = arrivals.land(layers, "orders", raw["orders"].filter(F.col("order_date") > "1999-12-31"))
    seen.clear()
    read = arrivals.increment(layers, AS_OF)
    assert set(read) == {"orders"} and seen and all(f"version={folder}/" in f for f in seen)
    assert arrivals.increment(layers, AS_OF) == {}
    log = layers.table(STAGING, "load_arrivals").filter("consumer = 'staging' AND table_name = 'orders_raw'")
    assert log.agg(F.sum("n_rows")).first()[0] == layers.table(RAW, "orders_raw").count()
    assert log.filter("bytes > 0 AND landed_at IS NOT NULL").count() == log.count()


def test_every_row_of_an_arrival_is_accounted_for(spark, layers):
    known = layers.table(STAGING, "orders_clean").first().order_id
    arrived = [
        order("X1"), order("X1", status="SHIPPED"), order(known), order("X2", order_date="1996-02-03 00:00:00"),  # late
        order("X3", customer_code=None), order("X4", customer_code="__ORPHAN__"), order("X5", order_state=" "),
        order("X6", order_date="soon"), order("X7", order_date="2001-07-02 00:00:00"), order(None),
    ]
    before, errors = layers.table(STAGING, "orders_clean").count(), layers.table(STAGING, "orders_errors").count()
    arrivals.land(layers, "orders", spark.createDataFrame(arrived, raw_schema("orders")))
    arrivals.increment(layers, AS_OF)
    assert layers.table(STAGING, "orders_clean").count() == before + 2
    assert layers.table(STAGING, "orders_errors").count() == errors + 8
    # A bad row that arrives again is logged again.
    arrivals.land(layers, "orders", spark.createDataFrame(arrived[-1:], raw_schema("orders")))
    arrivals.increment(layers, AS_OF)
    assert layers.table(STAGING, "orders_errors").count() == errors + 9


def test_a_run_that_dies_has_done_nothing(spark, layers, monkeypatch):
    arrivals.land(layers, "orders", spark.createDataFrame([order("X1")], raw_schema("orders")))
    before = layers.versions()
    with monkeypatch.context() as broken:
        broken.setattr(Layers, "publish", lambda self, written: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            arrivals.increment(layers, AS_OF)
    assert layers.versions() == before
    arrivals.increment(layers, AS_OF)
    assert layers.table(STAGING, "orders_clean").filter("order_id = 'X1'").count() == 1


def test_untouched_months_keep_their_files(spark, layers, raw):
    fact = full_load.open_fact(layers)
    n, old = fact.count(), files(fact)
    months = {r[0] for r in fact.select("year_month").distinct().collect()}
    touched = sorted(months)[3]
    day = f"{touched // 100}-{touched % 100:02d}-10 00:00:00"
    item = raw["order_items"].filter("quantity > 0").first()
    product = layers.table(DW, "dim_product").first().product_code
    arrivals.land(layers, "orders", spark.createDataFrame([order("X1", order_date=day), order("X2", order_city="Atlantis")], raw_schema("orders")))
    items = [("I1", "X1", product, "2", "3.00", "6.00"), ("I2", "X2", product, "1", "3.00", "3.00"), ("I3", "none yet", product, "1", "3.00", "3.00")]
    arrivals.land(layers, "order_items", spark.createDataFrame(items, raw_schema("order_items")))
    arrivals.increment(layers, AS_OF)
    assert arrivals.refresh_warehouse(layers, AS_OF) == [touched, 200106]
    after = full_load.open_fact(layers)
    assert after.count() == n + 2 and item is not None
    kept = {f for f in old if f"year_month={touched}/" not in f}
    assert kept <= files(after) and not (old - kept) & files(after)
    place = layers.table(DW, "dim_location").filter("city = 'Atlantis'").first()
    assert after.filter("order_item_id = 'I2'").first().location_sk == place.location_sk
    # The item that waits is resolved when its order comes.
    arrivals.land(layers, "orders", spark.createDataFrame([order("none yet")], raw_schema("orders")))
    arrivals.increment(layers, AS_OF)
    assert arrivals.refresh_warehouse(layers, AS_OF) == [200106]
    last = full_load.open_fact(layers)
    assert last.count() == n + 3 and last.filter("order_item_id = 'I3'").count() == 1
    assert arrivals.refresh_warehouse(layers, AS_OF) == []
    assert rows(full_load.open_fact(layers, 2001)) == rows(last.filter("year_month BETWEEN 200101 AND 200112"))


def test_a_full_load_after_increments_starts_anew(spark, layers, raw):
    arrivals.land(layers, "orders", raw["orders"].filter(F.col("order_date") > "1999-12-31"))
    arrivals.increment(layers, AS_OF)
    arrivals.refresh_warehouse(layers, AS_OF)
    by_increment = rows(full_load.open_fact(layers).drop("year_month"))
    full_load.full_load(layers, None, AS_OF, fact_by="year_month")
    assert arrivals.increment(layers, AS_OF) == {} and arrivals.refresh_warehouse(layers, AS_OF) == []
    assert rows(full_load.open_fact(layers).drop("year_month")) == by_increment


def test_old_keys_keep_their_numbers(spark):
    keys = [(f"K{i}", None if i % 7 == 0 else f"s{i % 3}") for i in range(500)]
    first = spark.createDataFrame(keys[:400], "k STRING, s STRING")
    registry = assign_sk(first, ["k", "s"], "sk")
    whole = spark.createDataFrame(keys[100:], "k STRING, s STRING").withColumn("x", F.lit(1))
    added = new_keys(whole, ["k", "s"], "sk", registry.select("k", "s", "sk"))
    assert sorted(r.sk for r in added.collect()) == list(range(401, 501))
    book = registry.select("k", "s", "sk").unionByName(added)
    found = {(r.k, r.s): r.sk for r in numbered_by(whole, ["k", "s"], "sk", book).collect()}
    old = {(r.k, r.s): r.sk for r in registry.collect()}
    assert len(found) == 400 and all(found[k] == old[k] for k in keys[100:400])


def test_a_reload_with_new_products_renumbers_nothing(spark, layers):
    names = {"dim_product": ("product_code", "product_sk"), "dim_customer": ("customer_code", "customer_sk")}
    before = {n: {r[0]: r[1] for r in layers.table(DW, n).select(*c).collect()} for n, c in names.items()}
    some = layers.table(STAGING, "products_clean").limit(3).withColumn("product_code", F.concat(F.lit("0new"), "product_code"))
    layers.replace(STAGING, "products_clean", layers.table(STAGING, "products_clean").unionByName(some))
    full_load.load_warehouse(layers, fact_by="year_month")
    for n, c in names.items():
        after = {r[0]: r[1] for r in layers.table(DW, n).select(*c).collect()}
        assert {k: after[k] for k in before[n]} == before[n]
    assert layers.table(DW, "dim_product").count() == len(before["dim_product"]) + 3
