"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import gc
import os
import tempfile
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job wants: adaptive execution (runtime coalescing, skew-join
# splitting, broadcast conversion) and UTC so timestamps mean the same thing
# on every executor.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Intermediate checkpoints are deleted once nothing references them.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, app: str = "itemwise",
              shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's base settings.

    On a cluster leave ``master`` unset and size ``shuffle_partitions`` for the
    data (AQE coalesces small partitions at run time); locally pass
    ``local[N]`` and a partition count close to N.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if master and master.startswith("local"):
        # Local mode runs every task inside the driver JVM.
        conf["spark.driver.memory"] = os.environ.get("ITEMWISE_DRIVER_MEMORY", "16g")
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    The cluster's value always wins.  Only in local mode, where driver and
    tasks share one machine, may it be unset: then a private folder is made
    and registered.  On any other master an unset folder is an error, since
    executors could not see a folder of the driver's machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not root:
        root = context.getCheckpointDir()
    if not root:
        master = context.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="itemwise-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if not context.getCheckpointDir():
        context.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder (its scheme,
    such as ``hdfs://`` or ``file://``, is kept).  It belongs to the innermost
    open ``scratch_scope``."""
    path = f"{checkpoint_root(spark)}/itemwise/{name}-{uuid.uuid4().hex[:12]}"
    if _SCOPES:
        _SCOPES[-1].append(path)
    return path


_SCOPES: list[list[str]] = []


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Deletes, at its end, every scratch folder made inside: write the result
    to its place before the scope ends.

        with scratch_scope(spark):
            near_duplicates(docs).write.parquet(target)

    Tables that are still to be read must not be left inside a closed scope;
    without a scope, scratch folders stay until the folder's owner clears it."""
    _SCOPES.append([])
    try:
        yield
    finally:
        remove_folders(spark, _SCOPES.pop())


def remove_folders(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def write_scratch(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as parquet below the shared checkpoint folder and
    read it back: lineage is cut, a lost executor costs nothing, and readers
    still prune columns and push filters down."""
    spark, schema = df.sparkSession, df.schema
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


@contextmanager
def skewed_joins_split(spark: SparkSession) -> Iterator[None]:
    """Actions inside split skewed joins also where later steps use the join's
    partitioning; Spark then shuffles for those steps after all."""
    name = "spark.sql.adaptive.forceOptimizeSkewedJoin"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def small_batches(spark: SparkSession, limit: int = 8 << 20) -> None:
    """Bound the bytes of a batch that Spark hands to Python, which otherwise
    counts rows only and may hold thousands of long texts.  A smaller limit of
    the session stays."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    have = spark.conf.get(name, None)
    if have is None or spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(have) > limit:
        spark.conf.set(name, str(limit))


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark's cleaner drop shuffle files of finished phases now instead
    of at the driver's next full collection; nothing else depends on it."""
    for _ in range(2):  # the first pass only lets go of plans that hold shuffles
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.4)
