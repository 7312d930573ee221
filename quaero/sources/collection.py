"""Persisted tables: the chunk collection, dataset splits and the audit log."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quaero.session import expire


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        return bool(spark.read.parquet(path).columns)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise


def lay_out(df: DataFrame) -> DataFrame:
    """Sort by source, so lookups skip files and row groups by their min and max.

    The ids take part in the ranges: a source with a third of all rows is spread
    over many of them. Finding the ranges runs the input once more, so lay out
    documents *before* they are chunked and embedded; row-wise steps keep the order.
    """
    keys = [c for c in ("source", "doc_key", "corpus_id", "chunk_no") if c in df.columns]
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys) if keys else df


def write_collection(df: DataFrame, path: str) -> None:
    """Store a new collection; fails if there is one already. A build that died before is no collection."""
    if _pointer(df.sparkSession, path) is not None:
        raise FileExistsError(f"[PATH_ALREADY_EXISTS] there is a collection at {path}")
    _write_version(df, path)


def _pointer(spark: SparkSession, path: str) -> str | None:
    """The version made current last; of two made so in the same microsecond, one for all readers."""
    if not _exists(spark, f"{path}/pointer"):
        return None
    return spark.read.parquet(f"{path}/pointer").agg(F.max_by("version", F.struct("at", "version"))).first()[0]


def _write_version(df: DataFrame, path: str) -> None:
    """A folder of its own, then the pointer: writers never share a folder, readers never see a half one."""
    version = uuid.uuid4().hex
    df.write.mode("errorifexists").parquet(f"{path}/version={version}")
    now = df.sparkSession.range(1).select(F.lit(version).alias("version"), F.current_timestamp().alias("at"))
    now.write.mode("append").parquet(f"{path}/pointer")


def open_collection(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a stored collection."""
    version = _pointer(spark, path)
    if version is None:
        raise FileNotFoundError(f"no collection at {path}")
    return spark.read.parquet(f"{path}/version={version}")


def reset_collection(df: DataFrame, path: str) -> DataFrame:
    """Replace the collection by ``df``: a new version is written, then made current.

    Readers of the old version are not disturbed, and ``df`` may be built from it.
    """
    _write_version(df, path)
    return open_collection(df.sparkSession, path)


def expire_versions(spark: SparkSession, path: str, older_than_seconds: float) -> int:
    """Delete versions that are not current and were last written so long ago; returns their number."""
    return expire(spark, path, older_than_seconds, "version=", keep=f"version={_pointer(spark, path)}")


def open_or_build(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Open the collection, building and storing it first if there is none."""
    if _pointer(spark, path) is None:
        write_collection(build(), path)
    return open_collection(spark, path)


def find_source(collection: DataFrame, source: str) -> DataFrame:
    """All rows of one source file; the predicate reaches the sorted files."""
    return collection.where(F.col("source") == source)


def write_folds(nested: DataFrame, path: str) -> None:
    """Store each row once under ``role=/fold=``; training sets are derived on reading."""
    nested.write.mode("overwrite").partitionBy("role", "fold").parquet(path)


def write_roles(split: DataFrame, path: str) -> None:
    """Store a two-way split under ``role=``."""
    split.write.mode("overwrite").partitionBy("role").parquet(path)


def read_fold(spark: SparkSession, path: str, fold: int, role: str) -> DataFrame:
    """``dev``, ``train`` or ``test`` rows of one run; only the folders needed are read."""
    stored = spark.read.parquet(path)
    wanted: Column
    if role == "test":
        wanted = F.col("role") == "test"
    else:
        same = F.col("fold") == fold
        wanted = (F.col("role") == "cv") & (same if role == "dev" else ~same)
    return stored.where(wanted).drop("role", "fold")


def append_audit(verdicts: DataFrame, path: str, at: str = "answered_at") -> None:
    """Append answers with their cited sources to the log, one folder per day."""
    verdicts.withColumn("date", F.to_date(at)).write.mode("append").partitionBy("date").parquet(path)
