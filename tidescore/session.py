"""Session set-up, shared scratch tables, and the size check behind broadcasts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor, wait
from contextlib import contextmanager
from contextvars import ContextVar, copy_context

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.util import inheritable_thread_target

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
CHANGELOGS = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"
DEFAULT_BROADCAST_BYTES = 128 * 1024 * 1024
BYTES_PER_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
STATE_PARTITIONS_PER_CORE = 2


def build_session(master: str | None = None, app: str = "tidescore", **conf) -> SparkSession:
    """A session with the settings the package expects; the cluster's own values win elsewhere."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # The JVM never compiles methods above 8000 bytes of code. Wide rows through joins exceed
        # that as one method; beyond the limit Spark runs the operators one by one, compiled.
        "spark.sql.codegen.hugeMethodLimit": "8000",
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
        CHANGELOGS: "true",
    }
    settings.update({k: str(v) for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_rocksdb(spark: SparkSession) -> None:
    """Stateful processors run on the RocksDB state store only; switch a session that has another.

    With change logs, which the change feed reads: a session that has not set them writes whole snapshots instead.
    """
    for key, value in (("spark.sql.streaming.stateStore.providerClass", ROCKSDB), (CHANGELOGS, "true")):
        if spark.conf.get(key, "") != value:
            spark.conf.set(key, value)


@contextmanager
def kept_batches(spark: SparkSession, batches: int) -> Iterator[None]:
    """Streams started inside keep the state and change logs of that many batches, for a feed that reads them all."""
    key = "spark.sql.streaming.minBatchesToRetain"
    before = spark.conf.get(key, "100")
    spark.conf.set(key, str(max(batches, int(before))))
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def state_partitions(spark: SparkSession, per_core: int = STATE_PARTITIONS_PER_CORE) -> Iterator[None]:
    """Streams started inside for the first time keep their state in at most `per_core` partitions per core.

    Every batch opens each partition's store and starts a worker for it, rows or none, so their number must not follow
    the size of the tables: a batch's rows are bounded by its source. A restarted stream keeps the number it began with.
    """
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(int(before), per_core * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def batches_by_rows(spark: SparkSession) -> Iterator[None]:
    """Streams started inside cut the batches for their Python workers by the number of rows alone.

    With a limit in bytes Spark adds up a batch's size again after every row, which takes longer than to write the row.
    For rows of keys and numbers only: documents need the limit. What a task holds is bounded by the source's limit per trigger.
    """
    before = spark.conf.get(BYTES_PER_BATCH)
    spark.conf.set(BYTES_PER_BATCH, str((1 << 31) - 1))
    try:
        yield
    finally:
        spark.conf.set(BYTES_PER_BATCH, before)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or a test folder where it is unset."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        # setCheckpointDir adds a random leaf of its own; one level up is ours.
        return current.rsplit("/", 1)[0]
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="tidescore-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Deal rows over all cores when the scan has fewer tasks than the cluster has cores.

    A table of one row group is read by one task, and everything after it in that stage would
    run there too. Large tables have more splits than cores and pass through unchanged.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, F.xxhash64(*keys))


def _scratch_root(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/tidescore-scratch/{spark.sparkContext.applicationId}"


# The innermost scope of this thread: batches of two streams run side by side, each in a thread of its own.
_scope: ContextVar[list[str] | None] = ContextVar("tidescore_scope", default=None)


def scratch_path(spark: SparkSession, label: str) -> str:
    path = f"{_scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    made = _scope.get()
    if made is not None:
        made.append(path)
    return path


def delete_path(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete the scratch tables made inside when it ends; nothing read from them may outlive it."""
    made: list[str] = []
    token = _scope.set(made)
    try:
        yield
    finally:
        _scope.reset(token)
        for path in made:
            delete_path(spark, path)


def side_by_side(spark: SparkSession, *steps: Callable[[], object]) -> list:
    """What independent steps return, in order; their jobs run at the same time, so that planning one does not leave the cores idle.

    The steps have the caller's scope of scratch tables and its job group. All have ended when this returns or raises.
    """
    if len(steps) < 2:
        return [step() for step in steps]
    with ThreadPoolExecutor(len(steps), "tidescore") as pool:
        running = [pool.submit(inheritable_thread_target(spark)(copy_context().run), step) for step in steps]
        wait(running)
    return [r.result() for r in running]


def scratch_table(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write `df` once to the shared folder and read it back.

    Cuts lineage and fixes values, such as partition numbers, that a recomputation after a
    lost executor could change.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release_scratch(spark: SparkSession) -> None:
    """Delete the scratch tables of this application; call when their readers are finished."""
    delete_path(spark, _scratch_root(spark))


def broadcast_limit(spark: SparkSession) -> int:
    """Largest table, in bytes, that this package sends to every executor."""
    return int(spark.conf.get("spark.tidescore.broadcastBytes", str(DEFAULT_BROADCAST_BYTES)))


def value_bytes(value: Column, kind: T.DataType) -> Column:
    """Bytes of a value: the length of strings and binaries, eight for numbers and the like, sums of what is nested."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        size = F.octet_length(value)
    elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.NumericType, T.BooleanType)):
        size = F.size(value) * 8
    elif isinstance(kind, T.ArrayType):
        each = lambda total, item: total + value_bytes(item, kind.elementType)
        size = F.aggregate(value, F.lit(0).cast("long"), each)
    elif isinstance(kind, T.MapType):
        size = value_bytes(F.map_entries(value), T.ArrayType(T.StructType(
            [T.StructField("key", kind.keyType), T.StructField("value", kind.valueType)])))
    elif isinstance(kind, T.StructType):
        size = sum((value_bytes(value[f.name], f.dataType) for f in kind.fields), F.lit(0).cast("long"))
    else:
        return F.lit(8).cast("long")
    return F.coalesce(size.cast("long"), F.lit(0).cast("long")) + 8


def row_bytes(df: DataFrame) -> Column:
    """Size of a row's values."""
    return sum((value_bytes(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields), F.lit(16).cast("long"))


def measured_bytes(df: DataFrame) -> int:
    """Size of a table's values, added up on the executors without rendering any."""
    return int(df.select(F.sum(row_bytes(df)).alias("n")).first().n or 0)


def fits_broadcast(df: DataFrame) -> bool:
    return measured_bytes(df) <= broadcast_limit(df.sparkSession)


def checked_broadcast(df: DataFrame) -> DataFrame:
    """Hint a broadcast only when the measured size allows it; else leave the join to shuffle."""
    return F.broadcast(df) if fits_broadcast(df) else df
