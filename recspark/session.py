"""Session settings and the shared folder that lineage cuts are written to."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
#: Adaptive execution merges partitions of a shuffle but splits none of a grouping, a range or a
#: window, so shuffles start with many. For 100 TB, set it to about one per 256 MB of the largest shuffle.
INITIAL_PARTITIONS = 2_000
_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
STATE_ON_DISK = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Removes the shuffle files of a query when it has ended, and not when the driver happens to collect its garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app_name: str = "recspark", master: str | None = None, **conf: object) -> SparkSession:
    """Session with the settings the operators are planned for.

    Joins on customer or article keys rely on adaptive execution to split
    skewed partitions, so it is switched on here even where a site default
    turns it off. Streaming state lives on disk rather than in the heap. Where a number of
    shuffle partitions is asked for, adaptive execution starts with that number, also when it is changed later.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config(STATE_STORE, STATE_ON_DISK)
    )
    if master:
        builder = builder.master(master)
    if "spark.sql.shuffle.partitions" not in conf:
        builder = builder.config(_INITIAL, str(INITIAL_PARTITIONS))
    for key, value in conf.items():
        builder = builder.config(key, str(value))
    return builder.getOrCreate()


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """The session with some settings changed, as they were before once the block is left."""
    held = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in held.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster it
    would be a different disk on every machine.
    """
    sc = spark.sparkContext
    named = sc.getConf().get(CHECKPOINT_DIR) or spark.conf.get(CHECKPOINT_DIR, None)
    current = sc.getCheckpointDir()
    if named:
        if current is None:
            sc.setCheckpointDir(named)
        return named.rstrip("/")
    if current is None:
        if not sc.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="recspark-"))
        current = sc.getCheckpointDir()
    return current.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in this application's own folder, which may be deleted once it has ended."""
    return f"{shared_dir(spark)}/recspark/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


class _Writes:
    """How many writes run now. Modules travel with the tasks; the copy there knows of none, as a lock cannot be sent."""

    def __init__(self) -> None:
        self.lock, self.now, self.held = threading.Lock(), 0, None

    def __reduce__(self):
        return _Writes, ()


_writes = _Writes()


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What is written inside leaves no shuffle files. Threads may be inside at the same time; the last one puts the setting back."""
    with _writes.lock:
        if not _writes.now:
            _writes.held = spark.conf.get(SHUFFLE_CLEANUP, None)
            spark.conf.set(SHUFFLE_CLEANUP, "true")
        _writes.now += 1
    try:
        yield
    finally:
        with _writes.lock:
            _writes.now -= 1
            if not _writes.now:
                spark.conf.unset(SHUFFLE_CLEANUP) if _writes.held is None else spark.conf.set(SHUFFLE_CLEANUP, _writes.held)


def stored(df: DataFrame, name: str, **options: str) -> tuple[str, DataFrame]:
    """Write ``df`` to a new path of the shared folder and read it back; (path, table)."""
    path = scratch_path(df.sparkSession, name)
    with shuffles_removed(df.sparkSession):
        df.write.options(**options).parquet(path)
    return path, df.sparkSession.read.schema(df.schema).parquet(path)


def freeze(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage in one pass over the data, survives the loss of any
    executor, and gives the planner real file sizes, so that it can choose a
    broadcast by itself when (and only when) the table is small. Shuffle files
    that led to it are removed at once.
    """
    return stored(df, name, **options)[1]


def discard(spark: SparkSession, path: str) -> None:
    """Remove a table of the shared folder that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def side_by_side(spark: SparkSession, *jobs: Callable):
    """Run jobs that do not need each other at the same time, so that one fills the gaps of another."""
    shared_dir(spark)
    with ThreadPoolExecutor(len(jobs)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
        return [job.result() for job in running]
