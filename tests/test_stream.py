"""The order stream: rules, deduplication across files and runs, restart."""

from pyspark.sql import functions as F

from tillhouse.plans import catalog
from tillhouse.schema import SCHEMAS
from tillhouse.streaming import orders as stream

ROW = "order_id STRING, customer_code STRING, order_date STRING, status STRING, order_city STRING, order_state STRING"


def arrive(spark, path, ids, **cells):
    rows = spark.createDataFrame([(i,) for i in ids], "order_id STRING")
    base = {"customer_code": "C1", "order_date": "2001-06-30 10:00:00", "status": "PLACED", "order_city": "Pune", "order_state": "MH"}
    rows.select("order_id", *[F.lit(v).cast("string").alias(c) for c, v in {**base, **cells}.items()]).coalesce(
        1
    ).write.mode("append").parquet(path)


def test_two_runs_with_overlap(spark, tmp_path, as_of):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    arrive(spark, source, [f"O{i}" for i in range(50)] + ["O1", "O2"])
    arrive(spark, source, ["O3", "O50"])
    arrive(spark, source, ["X1"], customer_code="__ORPHAN__")
    arrive(spark, source, ["X2"], customer_code=None)
    arrive(spark, source, ["X3"], order_state=" ")
    arrive(spark, source, ["X4"], order_date="not-a-date")
    arrive(spark, source, ["X5"], order_date="2001-07-02 00:00:00")
    stream.stream_orders(spark, source, out, checkpoint, as_of)
    loaded = stream.loaded_orders(spark, out)
    assert sorted(r.order_id for r in loaded.collect()) == sorted(f"O{i}" for i in range(51))
    assert loaded.dtypes == spark.createDataFrame([], SCHEMAS["staging"]["orders_clean"]).dtypes
    arrive(spark, source, [f"O{i}" for i in range(40, 60)])
    stream.stream_orders(spark, source, out, checkpoint, as_of)
    assert sorted(r.order_id for r in stream.loaded_orders(spark, out).collect()) == sorted(f"O{i}" for i in range(60))
    stream.stream_orders(spark, source, out, checkpoint, as_of)
    assert stream.loaded_orders(spark, out).count() == 60


def test_hot_key_over_many_files(spark, tmp_path, as_of):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for _ in range(4):
        arrive(spark, source, ["HOT"] * 100 + ["A"])
    stream.stream_orders(spark, source, out, str(tmp_path / "ckpt"), as_of)
    assert sorted(r.order_id for r in stream.loaded_orders(spark, out).collect()) == ["A", "HOT"]


def test_late_rows_are_kept_and_every_row_is_accounted_for(spark, tmp_path, as_of):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    arrive(spark, source, ["O1"], order_date="2001-06-30 00:00:00")
    stream.stream_orders(spark, source, out, checkpoint, as_of, files_per_batch=1)
    arrive(spark, source, ["O2", "O1"], order_date="2001-06-01 00:00:00")
    arrive(spark, source, ["O3", "O2"], order_date="2000-01-01 00:00:00")
    arrive(spark, source, ["X1"], customer_code=None)
    arrive(spark, source, ["X2"], order_date="no date")
    stream.stream_orders(spark, source, out, checkpoint, as_of, files_per_batch=1)
    assert sorted(r.order_id for r in stream.loaded_orders(spark, out).collect()) == ["O1", "O2", "O3"]
    reasons = sorted(r.reason for r in stream.rejected_orders(spark, out).collect())
    assert reasons == ["duplicate_order_id", "duplicate_order_id", "invalid_date_format", "missing_customer_code"]


def test_registered_stream_runs_several_batches(spark):
    shop = catalog.Shop(spark, "/root/testdata/sf0.001")
    out = catalog._streamed(shop)
    batches = spark.read.parquet(f"{out}/clean").select("batch_id").distinct().count()
    assert batches == 4
    assert stream.loaded_orders(spark, out).count() + stream.rejected_orders(spark, out).count() == shop.raw["orders"].count()
