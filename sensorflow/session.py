"""Session helpers.

The library never hard-codes jars, credentials or hosts: callers pass a
session.  ``build_session`` is what tests and the bench use; on a cluster the
session comes from spark-submit and only ``scratch_path`` is used.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 2 << 20


def build_session(
    master: str = "local[*]",
    app: str = "sensorflow",
    shuffle_partitions: int = 8,
    driver_memory: str | None = None,
    extra: dict | None = None,
) -> SparkSession:
    """Local/test session: UTC, ANSI on, AQE on, UI off.

    A checkpoint directory is set only when the caller did not provide one
    (tests); on a cluster ``spark.checkpoint.dir`` names the shared folder.
    """
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if driver_memory:
        conf["spark.driver.memory"] = driver_memory
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and job-owned tables.

    Read from the session (``spark.checkpoint.dir`` or the SparkContext's
    checkpoint dir).  When neither is set, a ``local`` master (tests, bench)
    gets a private folder; on a cluster executors could not see such a folder,
    so the call fails and asks for ``spark.checkpoint.dir``.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.sparkContext.getCheckpointDir()
        except Exception:  # Spark Connect has no SparkContext
            root = None
    if not root:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError(
                "set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="sensorflow-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
        root = spark.sparkContext.getCheckpointDir() or root
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the checkpoint root for one run."""
    return f"{checkpoint_root(spark)}/sensorflow/{name}-{uuid.uuid4().hex[:12]}"


def hadoop_path(spark: SparkSession, path: str):
    """``(file system, path)`` of Hadoop for a path of any scheme."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    """Asked of the file system: a failed read would show in the log, and in the
    listeners of every running job."""
    fs, p = hadoop_path(spark, path)
    return fs.exists(p)


def materialize(df, name: str = "stage", codec: str | None = None):
    """Cut lineage: write ``df`` once as a parquet table in the session's
    checkpoint folder (shared on a cluster) and read it back.  Used where one
    parsed input feeds several outputs, so messages are parsed once, and a
    lost executor re-reads the written table instead of replaying the parse.
    (An eager ``checkpoint()`` without ``persist`` would compute the plan
    twice: once to count, once to write.)  ``codec`` names the compression of
    the files, by default the session's."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


def bound_batches(spark: SparkSession) -> None:
    """Rows cross to Python in Arrow batches of some ``BATCH_BYTES`` from now on,
    unless the session already sets a bound of its own.  Spark's default lets a
    batch hold a whole partition of texts; the JVM and the worker each keep that
    outside the heap, and an executor's threads hold on to it after the task.
    Only the cut changes, no row."""
    if spark.conf.get(ARROW_BYTES, None) is None:
        spark.conf.set(ARROW_BYTES, str(BATCH_BYTES))


def discard(*frames) -> None:
    """Remove the tables behind frames that ``materialize`` returned, once
    nothing reads them any more.  Only folders below the checkpoint root of
    the session are ever touched."""
    for df in frames:
        spark = df.sparkSession
        root = f"{checkpoint_root(spark)}/sensorflow/"
        bare = root.split(":", 1)[-1].lstrip("/")
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if folder.split(":", 1)[-1].lstrip("/").startswith(bare):
                fs, path = hadoop_path(spark, folder)
                fs.delete(path, True)
