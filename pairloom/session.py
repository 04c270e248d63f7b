"""Session settings and the shared scratch folder."""

from __future__ import annotations

import ctypes
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import SparkSession

#: The most bytes of an Arrow batch of whole rows.
ROW_BATCH_BYTES = 4 << 20

_own_scratch: dict[str, tempfile.TemporaryDirectory] = {}


def local_session(name: str = "pairloom", cores: int = 8) -> SparkSession:
    """A session for tests and benchmarks; a cluster brings its own settings."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the folder the cluster shares between its executors.

    The folder is that of ``spark.checkpoint.dir`` or of ``setCheckpointDir``. Only
    a session on one machine may have neither: it gets a temporary folder, once per
    application, which goes when the interpreter ends. Elsewhere each executor would
    write to its own disk, so it is an error.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        app = context.applicationId
        if app not in _own_scratch:
            _own_scratch[app] = tempfile.TemporaryDirectory(prefix="pairloom-", ignore_cleanup_errors=True)
        root = _own_scratch[app].name
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df, name: str = "table"):
    """Write ``df`` to the scratch folder and read it back.

    Cuts the lineage in a way that outlives lost executors, and gives Catalyst
    the real size of the table for its choice of join.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def discard(df) -> None:
    """Delete a table of ``stored`` that nothing reads any more."""
    jvm, context = df.sparkSession._jvm, df.sparkSession.sparkContext
    path = jvm.org.apache.hadoop.fs.Path(df._stored_at)
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def drop_shuffles(spark: SparkSession) -> None:
    """Let go the shuffle files of jobs that are over. Spark deletes them once the driver has collected the plan they
    belong to, which a driver with memory to spare may not do before the disks are full."""
    spark.sparkContext._jvm.System.gc()


def give_back_memory() -> None:
    """Hand freed memory back at the end of a task: a worker lives on and would keep what the largest of its tasks took."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def small_batches(spark: SparkSession) -> None:
    """From now on Arrow batches are bounded by few bytes; a bound that the session has set itself stays."""
    conf, default = spark.conf, str(64 << 20) + "b"
    if conf.get("spark.sql.execution.arrow.maxBytesPerBatch", default) == default:
        conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ROW_BATCH_BYTES))
