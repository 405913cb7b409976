"""Order increments as a restartable stream: the checkpoint takes the place of the control table."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.operators.joins import splittable_join
from tillhouse.operators.rules import ORDERS
from tillhouse.plans.incremental import admit_marked, no_customer
from tillhouse.schema import raw_schema

ERROR_SCHEMA = "row_data STRING, reason STRING, logged_at TIMESTAMP_NTZ"


def read_orders_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """New raw order files (Parquet) as they arrive."""
    reader = spark.readStream.schema(raw_schema("orders"))
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def _read(spark: SparkSession, out: str, kind: str, schema) -> DataFrame:
    """The rows of one kind with the batch that wrote them."""
    with_batch = spark.createDataFrame([], schema).withColumn("batch_id", F.lit(0).cast("bigint")).schema
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{out}/{kind}")
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], with_batch)
    return spark.read.schema(with_batch).parquet(f"{out}/{kind}")


def with_first_keys(rows: DataFrame, fit: Column) -> DataFrame:
    """`rows`, and one more row, `is_first`, for each order of which no batch before had a fit row.

    The keys are state that never expires, so late rows are known however late they are, and a batch looks
    at the keys that arrive in it and no others. Both parts read the same files in the same batch.
    """
    others = [F.lit(None).cast("string").alias(c) for c in ORDERS.columns if c != ORDERS.key]
    firsts = rows.filter(fit).select(ORDERS.key).dropDuplicates([ORDERS.key])
    marks = firsts.select(ORDERS.key, *others, F.lit(True).alias("is_first"))
    return rows.withColumn("is_first", F.lit(False)).unionByName(marks)


def _load_batch(out: str, as_of: Column):
    def load(batch: DataFrame, batch_id: int) -> None:
        # A batch that is run again after a failure starts from the state of the batch before, and overwrites its own folders.
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        firsts = batch.filter("is_first").select(ORDERS.key, "is_first")
        met = splittable_join(batch.filter("NOT is_first").drop("is_first"), firsts, ORDERS.key, "left")
        admitted = admit_marked(met, F.col("is_first").isNull(), as_of, ORDERS, no_customer())
        admitted.errors.write.mode("overwrite").parquet(f"{out}/errors/batch_id={batch_id}")
        admitted.clean.write.mode("overwrite").parquet(f"{out}/clean/batch_id={batch_id}")
        batch.unpersist()

    return load


def load_available(raw: DataFrame, out: str, checkpoint: str, as_of: Column) -> None:
    """Load everything that has arrived since the last run, and stop.

    Every row goes to `clean` or to `errors`, however late it is: what was loaded is known from keyed
    state that does not expire (kept on disk by the session's state store). A key that repeats within a
    batch is handled as in a full load, and one that was loaded by an earlier batch is rejected. Rows that
    break a rule do not touch the state.
    """
    fit = ORDERS.reason(as_of).isNull() & F.col("customer_code").isNotNull()
    rows = raw.select(*ORDERS.columns)
    query = (
        with_first_keys(rows, fit).writeStream.foreachBatch(_load_batch(out, as_of))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def stream_orders(
    spark: SparkSession, source: str, out: str, checkpoint: str, as_of: Column, files_per_batch: int | None = None
) -> None:
    load_available(read_orders_stream(spark, source, files_per_batch), out, checkpoint, as_of)


def loaded_orders(spark: SparkSession, out: str) -> DataFrame:
    clean = spark.createDataFrame([], raw_schema("orders")).select(*ORDERS.typed()).schema
    return _read(spark, out, "clean", clean).select(*ORDERS.columns)


def rejected_orders(spark: SparkSession, out: str) -> DataFrame:
    return _read(spark, out, "errors", ERROR_SCHEMA).drop("batch_id")
