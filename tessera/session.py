"""Session helpers: sane defaults for the engine and the shared lineage folder."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Callable, Iterable
from concurrent.futures import Executor
from contextlib import contextmanager

import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

# Defaults every job here relies on. AQE re-plans joins and shuffle sizes at run
# time, splits skewed join partitions and turns small joins into broadcasts only
# after measuring them.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Remove checkpoint files of results that are no longer referenced.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


# A starting point for a large cluster (hundreds of executors, ~100 TB of
# input): many initial shuffle partitions that AQE coalesces to ~256 MB, skew
# splitting of partitions 5x the median, 256 MB scan splits, and broadcasts
# only below 64 MB measured at run time.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
}


def build_session(master: str | None = None, app_name: str = "tessera",
                  shuffle_partitions: int | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the engine defaults.

    On a cluster leave ``master`` unset so spark-submit decides; locally pass
    ``local[n]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (conf or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared lineage folder, setting a local one only if none is set.

    A cluster names a shared folder in ``spark.checkpoint.dir``; that is used as
    is. Only when the session has none (local tests) is a fresh folder made.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared lineage folder for written intermediates."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{os.urandom(6).hex()}")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


# Rows that one task of a sized shuffle sorts or groups.
ROWS_PER_TASK = 500_000


@contextmanager
def sized_shuffles(spark: SparkSession, rows: int):
    """Shuffles inside the block have a partition for every ``ROWS_PER_TASK`` of
    so many rows, if that is more than the session's number, and are not merged
    again: what a task holds then does not grow with the input. Run the job
    inside the block."""
    parts = -(-rows // ROWS_PER_TASK)
    if parts <= shuffle_partitions(spark):
        yield
        return
    sized = {"spark.sql.shuffle.partitions": str(parts),
             "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in sized}
    for k, v in sized.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def together(spark: SparkSession, pool: Executor, work: Callable, items: Iterable) -> list:
    """``work(item)`` for every item on the pool's threads, in the order given;
    the results in that order. Every call is wrapped by itself: the wrapper
    copies the local properties once, and calls that share the copy take each
    other's SQL execution ids away ("Cannot parse null string")."""
    calls = [pool.submit(inheritable_thread_target(spark)(work), item) for item in items]
    try:
        return [c.result() for c in calls]
    finally:
        for c in calls:
            c.cancel()


def small_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few rows as a table of plain columns. They reach the JVM as one Arrow
    batch, so that reading them starts no Python worker."""
    fields = to_arrow_schema(StructType.fromDDL(schema))
    columns = [pa.array([r[i] for r in rows], type=f.type) for i, f in enumerate(fields)]
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema=fields))


_SHARED: dict = {}


def input_state(spark: SparkSession, sf_dir: str) -> tuple:
    """Name, size and time of every file of the Parquet tables in ``sf_dir``:
    changes when an input changes. Only the folder is listed, through Spark's
    file system; no job runs and no file is opened."""
    path = spark._jvm.org.apache.hadoop.fs.Path(sf_dir)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    state, waiting = [], [s for s in fs.listStatus(path) if s.getPath().getName().endswith(".parquet")]
    while waiting:
        status = waiting.pop()
        if status.isDirectory():
            waiting.extend(fs.listStatus(status.getPath()))
        else:
            state.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
    return tuple(sorted(state))


def shared(spark: SparkSession, name: str, sf_dir: str, build):
    """What ``build()`` gives (a model, a path, a table), kept for the queries
    of one application that need the same and built anew once an input file
    under ``sf_dir`` has changed. ``release`` drops all of it."""
    slot = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), name)
    state = input_state(spark, sf_dir)
    if slot not in _SHARED or _SHARED[slot][0] != state:
        _SHARED[slot] = (state, build())
    return _SHARED[slot][1]


def release(spark: SparkSession) -> None:
    """Forget all shared models and tables of the session's application."""
    for slot in [s for s in _SHARED if s[0] == spark.sparkContext.applicationId]:
        del _SHARED[slot]


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet to the shared folder and read back, so
    its readers prune columns and push filters into the files."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialized(spark: SparkSession, name: str, sf_dir: str, build) -> DataFrame:
    """A derived table that several queries or branches of a plan read, written
    once per application and state of the inputs: without it each branch
    recomputes the joins and aggregates behind it."""
    return shared(spark, name, sf_dir, lambda: stored(build(), name))
