"""Small helpers the training-data operators share."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quaero.session import discard, materialize, shared_folder

BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
_SPARK_DEFAULT, _BATCH = "67108864b", str(8 << 20)


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches hold at most 8 MB (or one row), unless the session sets another size than Spark's own.

    The setting bounds a Python worker's memory on long texts; no result depends on it.
    """
    if spark.conf.get(BATCH_BYTES, _SPARK_DEFAULT) == _SPARK_DEFAULT:
        spark.conf.set(BATCH_BYTES, _BATCH)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder name below the shared one."""
    return os.path.join(shared_folder(spark), "quaero", f"{label}-{uuid.uuid4().hex}")


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def ragged_take(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of the concatenated runs ``[start, start + length)``."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    before = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    return np.arange(total, dtype=np.int64) + np.repeat(starts - before, lengths)


def fewer_batches(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in batches of ``size`` bytes or more, but for the last."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.nbytes
        if n >= size:
            yield pa.concat_batches(held)
            held, n = [], 0
    if held:
        yield pa.concat_batches(held)


def whole_groups(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[pa.Table]:
    """The rows of sorted batches in tables that end where a group of equal numbers ``keys`` ends.

    What is held of a group grows with the group; callers bound it.
    """
    held = None
    for batch in batches:
        if batch.num_rows:
            part = pa.Table.from_batches([batch])
            part = part if held is None else pa.concat_tables([held, part])
            last = np.ones(part.num_rows, dtype=bool)
            for key in keys:
                values = part[key].to_numpy()
                last &= values == values[-1]
            whole = int(last.argmax())
            held = part.slice(whole)
            if whole:
                yield part.slice(0, whole).combine_chunks()
    if held is not None:
        yield held.combine_chunks()


__all__ = ["bounded_batches", "discard", "fewer_batches", "materialize", "new_folder", "ragged_take", "table", "text_or_empty", "whole_groups"]
