"""Session settings the library is tuned for, and the shared scratch folder of a cluster."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# SQL settings that may be changed on a running session.
TUNING = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    # Hot join keys are split at run time, even where that costs one more shuffle.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Streaming state on local disk, so that it may outgrow the memory.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # Rows apart by verdict are written without a sort, up to this many open files a task.
    "spark.sql.maxConcurrentOutputFileWriters": "8",
    # Plans are built from many small expressions; recording a Python stack for each is slow.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


# What one task should hold of a shuffle.
PARTITION_BYTES = 128 * 1024 * 1024


def shuffle_partitions(input_bytes: int) -> int:
    """Enough shuffle partitions for the largest shuffle; adaptive execution merges spare ones."""
    return max(200, -(-input_bytes // PARTITION_BYTES))


def build_session(
    app: str = "tillhouse", master: str | None = None, input_bytes: int | None = None, **conf: str
) -> SparkSession:
    """A session with `TUNING`; on a cluster leave `master` unset and let spark-submit name it.

    `input_bytes`, the size of the raw tables, sets the number of shuffle partitions.
    """
    if input_bytes is not None:
        conf.setdefault("spark.sql.shuffle.partitions", str(shuffle_partitions(input_bytes)))
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for name, value in {**TUNING, **conf}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path under the folder named by `spark.checkpoint.dir`.

    The setting is read, never changed. Only where it is unset (local tests) a folder of this
    machine is used, since there every task runs on it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="tillhouse-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, purpose: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write `df` into the shared folder and read it back.

    What follows starts from files: work behind them is not repeated, and the planner knows their size.
    `discard` removes them again.
    """
    path = shared_dir(df.sparkSession, purpose)
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(path)
    read = df.sparkSession.read.schema(df.schema).parquet(path)
    read.stored_at = path
    return read


def discard(*frames: DataFrame) -> None:
    """Remove the files of `stored` frames that nothing will read again."""
    for frame in frames:
        spark = frame.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(frame.stored_at)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
