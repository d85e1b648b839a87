"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Settings every run relies on; both may be changed on a live session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # Percentile buffers are hash-aggregated; the default of 128 groups sends
    # a (store x channel x edge) aggregate to the sort-based fallback.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "16384",
    # Events repeat a lot, so a shuffled MB is about 35 MB in a task that sorts
    # them by case, and up to 75 where cases are then aggregated.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    # Documents, hashes and ids of the stored tables take half the room they have with snappy.
    "spark.sql.parquet.compression.codec": "zstd",
}

#: Whether shuffle files are removed at the end of each execution.
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Settings for a session of our own.  Shuffle partition counts are left to
#: AQE coalescing: a cluster sets spark.sql.shuffle.partitions high once.
BUILD_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Streaming keys outgrow the heap long before they outgrow the disks.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(app_name: str = "tracelark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings above; keyword pairs come in ``conf`` with ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**BUILD_CONF, **RUNTIME_CONF}.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), str(value))
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else built."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Within it, the shuffle files of an execution go when it ends, not when the driver happens to collect garbage.

    For frames that are executed once, like those that are written; another execution of the same frame would have to compute them anew.
    Streams started within it do the same for the batches they hand out, but not for their own plans: see ``collect_garbage``.
    """
    before = spark.conf.get(RELEASE, None)
    spark.conf.set(RELEASE, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(RELEASE)
        else:
            spark.conf.set(RELEASE, before)


def collect_garbage(spark: SparkSession) -> None:
    """Have the shuffle files of streams that ended removed: Spark does so once nothing in the driver refers to them any more."""
    gc.collect()
    spark._jvm.System.gc()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may go without the setting; it then gets a temporary
    folder, which on a cluster would be unreachable from other machines.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if configured:
        if not context.getCheckpointDir():
            context.setCheckpointDir(configured)
        return configured.rstrip("/")
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="tracelark-")
    context.setCheckpointDir(folder)
    return folder


def fresh_dir(spark: SparkSession, tag: str) -> str:
    """A new, not yet existing path below the shared folder."""
    return f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
