"""Session settings the plans rely on, and durable cut points owned by a run."""

from __future__ import annotations

import atexit
import math
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Target bytes of one shuffle partition before adaptive execution coalesces.
SHUFFLE_PARTITION_BYTES = 1024 * 1024 * 1024

# Adaptive execution carries three jobs here: it picks broadcast joins from
# measured sizes, splits skewed join partitions, and coalesces small ones.
# The forced skew join accepts one extra shuffle rather than one endless task.
_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # What small partitions are merged up to, compressed; a task that joins several
    # sorted inputs holds some twenty times that.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32m",
    # Arrow batches to Python by bytes: a row may be a block of many.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 * 1024 * 1024),
}

# For runs that store much more than they read. Shuffle files go when the action that
# wrote them ends, not when the driver's memory is next collected. Files of zstd are so
# small that a table of millions of rows would pass for one to broadcast, hence the factor.
_LEAN_DISK = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.sources.fileCompressionFactor": "4.0",
}

# Tables written at a time: cores that one's last tasks leave idle take another's.
WRITES_AT_ONCE = 4

# Compressed input bytes for which a shuffle starts with one more partition.
INPUT_BYTES_PER_PARTITION = 4 * 1024 * 1024
# Input bytes a model that can be built in slices takes at a time.
INPUT_BYTES_PER_SLICE = 512 * 1024 * 1024
_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
# The number ``size_shuffles`` has set last, None if the caller's settings stand.
_sized: str | None = None
# Partitions by the size of the inputs named last, whether set or not.
_wanted = 1


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings, leaving anything the caller chose untouched."""
    chosen = spark.conf.getAll
    for key, value in _SETTINGS.items():
        if key not in chosen:
            spark.conf.set(key, value)
    _unsize(spark)
    return spark


@contextmanager
def lean_disk(spark: SparkSession) -> Iterator[None]:
    """Inside, files take less disk; what the caller chose stands, and all is as before at the end."""
    added = [key for key in _LEAN_DISK if key not in spark.conf.getAll]
    for key in added:
        spark.conf.set(key, _LEAN_DISK[key])
    try:
        yield
    finally:
        for key in added:
            spark.conf.unset(key)


def _unsize(spark: SparkSession) -> None:
    global _sized
    if _sized is not None and spark.conf.get(_INITIAL, None) == _sized:
        spark.conf.unset(_INITIAL)
    _sized = None


def size_shuffles(spark: SparkSession, paths: Iterable[str]) -> None:
    """Let shuffles start with partitions by the size of the input files ``paths``.

    Adaptive execution merges small partitions but never adds any, so with a fixed
    number a task's share, and the memory it sorts and joins it in, would grow with
    the input. Never fewer than ``spark.sql.shuffle.partitions``; a number the
    caller chose stands. The next ``prepare`` takes it back.
    """
    global _sized, _wanted
    _unsize(spark)
    total = sum(file_bytes(spark, p) for p in paths if path_exists(spark, p))
    _wanted = math.ceil(total / INPUT_BYTES_PER_PARTITION)
    if spark.conf.get(_INITIAL, None) is not None:
        return
    if _wanted > int(spark.conf.get("spark.sql.shuffle.partitions")):
        _sized = str(_wanted)
        spark.conf.set(_INITIAL, _sized)


def at_once(write: Callable[[str], object], names: Iterable[str]) -> list:
    """``write`` of every name, several at a time; results in order, the first error is raised."""
    with ThreadPoolExecutor(WRITES_AT_ONCE) as pool:
        return list(pool.map(write, names))


def sized_buckets(spark: SparkSession) -> int:
    """Buckets for a table stored from the inputs ``size_shuffles`` was called with last."""
    return max(spark.sparkContext.defaultParallelism, _wanted)


def sized_slices() -> int:
    """Slices for a model built from the inputs ``size_shuffles`` was called with last."""
    return max(1, math.ceil(_wanted * INPUT_BYTES_PER_PARTITION / INPUT_BYTES_PER_SLICE))


def suggested_partitions(*inputs: DataFrame) -> int:
    """Shuffle partitions for a job over these inputs, about a gigabyte each.

    For a job to put into ``spark.sql.shuffle.partitions`` before it starts:
    adaptive execution merges small partitions, but cannot add any. The sizes
    are Catalyst's estimates of the inputs; no job runs.
    """
    cores = inputs[0].sparkSession.sparkContext.defaultParallelism
    total = sum(
        int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) for df in inputs
    )
    return max(cores, math.ceil(total / SHUFFLE_PARTITION_BYTES))


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, for checkpoints and cut points.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session may
    fall back to a temporary folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    root = tempfile.mkdtemp(prefix="stockweave-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(root)
    return spark.sparkContext.getCheckpointDir()


_run_folders: list[str] = []


def delete_folder(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def file_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of all files in a folder."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(where).getLength()


def changed_at(spark: SparkSession, path: str) -> int:
    """When a file or folder was changed last, as its file system says."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.getFileStatus(where).getModificationTime()


@contextmanager
def run_scope(spark: SparkSession) -> Iterator[str]:
    """A run: cut points made inside go to its own folder, deleted when it ends.

    Results must be written or collected inside, as they may read the cuts.
    """
    folder = f"{shared_dir(spark).rstrip('/')}/run-{uuid.uuid4().hex}"
    _run_folders.append(folder)
    try:
        yield folder
    finally:
        _run_folders.remove(folder)
        delete_folder(spark, folder)


def run_folder(spark: SparkSession) -> str:
    """The folder of the current run, or the shared one outside of any."""
    return _run_folders[-1] if _run_folders else shared_dir(spark).rstrip("/")


def materialize(df: DataFrame) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    Unlike a cached frame the copy survives lost executors, and unlike an RDD
    checkpoint it keeps columnar pruning and true sizes for join planning.
    Inside ``run_scope`` the copy goes when the run ends; otherwise the caller
    of the query owns what lies in ``spark.checkpoint.dir``.
    """
    spark = df.sparkSession
    path = f"{run_folder(spark)}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
