"""Session set-up and the shared scratch folder used to cut lineage."""

from __future__ import annotations

import os
import shutil
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_local_folders: list[str] = []
_shipped: set[str] = set()


def build_session(app_name: str = "quaero", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are written for.

    AQE splits skewed join partitions on its own; the forced variant allows the
    split even where it costs one more exchange.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of the session.

    Idempotent per context: the source tree is zipped once and added as a file.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    base = os.path.join(tempfile.mkdtemp(prefix="quaero-package-"), "quaero")
    archive = shutil.make_archive(base, "zip", os.path.dirname(root), os.path.basename(root))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster.

    Only a local master may fall back to a temporary folder, since there the
    driver and the executors are one process.
    """
    configured = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_KEY} to a folder that all executors can reach")
    if not _local_folders:
        _local_folders.append(tempfile.mkdtemp(prefix="quaero-"))
    return _local_folders[0]


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Lost executors then re-read files instead of replaying the lineage, and the
    reader still prunes columns and sees the true size. Shuffle files of the write go
    when it ends, and not when the driver's garbage is collected.
    """
    spark = df.sparkSession
    path = os.path.join(shared_folder(spark), "quaero", f"{label}-{uuid.uuid4().hex}")
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables of :func:`materialize` that nothing reads any more: what came of them must be materialized too."""
    for table in tables:
        spark = table.sparkSession
        top = os.path.join(shared_folder(spark), "quaero")
        hadoop = spark._jvm.org.apache.hadoop.fs
        for folder in {os.path.dirname(file) for file in table.inputFiles()}:
            path = hadoop.Path(folder)
            if path.getParent().toUri().getPath() != hadoop.Path(top).toUri().getPath():
                raise ValueError(f"{folder} is no table of {top}")
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def expire(spark: SparkSession, folder: str, older_than_seconds: float, prefix: str = "", keep: str = "") -> int:
    """Delete the folders right below ``folder`` last written so long ago; returns their number.

    ``expire(spark, shared_folder(spark) + "/quaero", ...)`` clears the tables of
    :func:`materialize`; choose a time no running job needs them any more.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    root = hadoop.Path(folder)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(root):
        return 0
    latest, gone = time.time() * 1000 - older_than_seconds * 1000, 0
    for status in files.listStatus(root):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith(prefix) and name != keep and status.getModificationTime() < latest:
            gone += files.delete(status.getPath(), True)
    return gone
