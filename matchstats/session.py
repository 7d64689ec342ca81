"""Session helpers: a tuned local session for tests/bench and checkpointing."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "matchstats") -> SparkSession:
    """Build (or reuse) a session with AQE on and the UI off.

    On a cluster the caller's session already exists and it is
    returned unchanged; these settings only shape local runs.
    """
    if (running := SparkSession.getActiveSession()) is not None:
        ensure_checkpoint_dir(running)
        return running
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or cpus
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.default.parallelism", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.localShuffleReader.enabled", "true")
        # AQE converts a shuffle join to a broadcast only from the *measured*
        # size of the finished shuffle stage (the daily state tables).
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "64MB")
        .config("spark.driver.memory", os.environ.get("MATCHSTATS_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # remove reliable-checkpoint files once their DataFrames are unreachable
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; only when unset (tests)
    fall back to a fresh scratch folder."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: point it at a shared folder (HDFS/S3/...) "
                               "visible to every executor")
        conf_dir = tempfile.mkdtemp(prefix="matchstats-ckpt-")  # local mode only (tests)
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint directory.

    Used where a plan is re-read several times (model folds) or where the
    partition layout must be stable across two passes (global row numbers).
    Survives executor loss, unlike a local checkpoint.
    """
    ensure_checkpoint_dir(df.sparkSession)
    # A reliable checkpoint of an uncached plan computes it twice (once for
    # the job, once to write the files); persisting first makes the write
    # read the cached blocks.  The cache is dropped once the files exist.
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return cached.checkpoint(eager=True)
    finally:
        cached.unpersist()


def work_table(df: DataFrame, name: str) -> DataFrame:
    """``df``, written to the shared checkpoint folder and read again: the plan
    is cut, and a lost executor costs a re-read.  For tables that are replaced
    many times: ``remove_work_table`` takes one away."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/work-{name}-{uuid.uuid4().hex}"
    with shuffles_removed(spark):  # what is written is read from the folder
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._work_path = path
    return out


#: Whether Spark removes a query's shuffle files as soon as the query has ended.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Bytes that a file counts beside its own; as much as a partition holds: each file is one by itself.
OPEN_COST = "spark.sql.files.openCostInBytes"
_SETTINGS_LOCK, _settings = threading.Lock(), {}


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """The session's setting within; several threads of the driver may be
    within at once, the last one restores what was before the first."""
    at = (id(spark), key)
    with _SETTINGS_LOCK:
        within, before = _settings.get(at) or (0, spark.conf.get(key, None))
        _settings[at] = within + 1, before
        spark.conf.set(key, value)
    try:
        yield
    finally:
        with _SETTINGS_LOCK:
            within, before = _settings.pop(at)
            if within > 1:
                _settings[at] = within - 1, before
            elif before is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, before)


def shuffles_removed(spark: SparkSession):
    """Queries that run within leave no shuffle files behind; otherwise they lie
    on the executors' disks until the driver collects its garbage.  A query
    that needs them again computes them again."""
    return _setting(spark, SHUFFLE_CLEANUP, "true")


def files_apart(spark: SparkSession):
    """Tables read within have a partition for each of their files at least."""
    return _setting(spark, OPEN_COST, "128MB")


def remove_work_table(df: DataFrame) -> None:
    spark = df.sparkSession
    target = spark._jvm.org.apache.hadoop.fs.Path(df._work_path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def ship_code(spark: SparkSession) -> None:
    """Send this package to the Python workers (like ``--py-files``), once per
    application; their working folder need not be the repository."""
    sc = spark.sparkContext
    if getattr(sc, "_matchstats_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="matchstats-code-"), "matchstats_code.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _dirs, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(target)
    sc._matchstats_shipped = True
