"""Vector expressions and the hashed bag-of-words embedding."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from quaero.functions.text import tokens

DEFAULT_DIMS = 256
SLICE_ROWS = 256  # texts whose buckets are counted at a time


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def _doubles(vector: Column) -> Column:
    return vector.cast("array<double>")


def _shared_length(left: Column, right: Column) -> Column:
    return F.least(F.size(left), F.size(right))


def dot(left: Column, right: Column) -> Column:
    """Inner product over the shared leading dimensions, in double precision."""
    n = _shared_length(left, right)
    return _sum(
        F.zip_with(
            F.slice(_doubles(left), F.lit(1), n),
            F.slice(_doubles(right), F.lit(1), n),
            lambda a, b: a * b,
        )
    )


def norm(vector: Column) -> Column:
    return F.sqrt(_sum(F.transform(_doubles(vector), lambda x: x * x)))


def cosine(left: Column, right: Column) -> Column:
    """Cosine similarity; 0.0 when either vector has no length, NULL when one is missing."""
    ratio = F.try_divide(dot(left, right), norm(left) * norm(right))
    return F.when(left.isNotNull() & right.isNotNull(), F.coalesce(ratio, F.lit(0.0)))


def squared_l2(left: Column, right: Column) -> Column:
    n = _shared_length(left, right)
    return _sum(
        F.zip_with(
            F.slice(_doubles(left), F.lit(1), n),
            F.slice(_doubles(right), F.lit(1), n),
            lambda a, b: (a - b) * (a - b),
        )
    )


def token_buckets(text: Column, dims: int = DEFAULT_DIMS) -> Column:
    """Bucket of every lower-case token: the first 32 bits of its md5, modulo ``dims``."""
    return F.transform(
        tokens(F.lower(F.coalesce(text, F.lit("")))),
        lambda t: (
            F.conv(F.substring(F.md5(t.cast("binary")), 1, 8), 16, 10).cast("bigint") % dims
        ).cast("int"),
    )


def hash_embed(text: Column, dims: int = DEFAULT_DIMS, normalize: bool = False) -> Column:
    """Bag-of-words vector of ``text``: token counts per hash bucket.

    The counts are whole numbers, so their inner products are exact. Hashing
    runs in the JVM; the Arrow function only counts, with no shuffle of tokens, and
    holds the counts of a batch and the buckets of a slice of it.
    """

    @F.arrow_udf("array<float>")
    def count(buckets: pa.Array) -> pa.Array:
        out = np.zeros((len(buckets), dims), dtype=np.float32)
        for start in range(0, len(buckets), SLICE_ROWS):
            part = buckets.slice(start, SLICE_ROWS)
            places = np.repeat(np.arange(len(part)) * dims, np.asarray(part.value_lengths()))
            counts = np.bincount(places + part.flatten().to_numpy(), minlength=len(part) * dims).reshape(-1, dims)
            if normalize:
                lengths = np.sqrt(np.square(counts.astype(np.float32), dtype=np.float64).sum(axis=1))
                counts = counts / np.where(lengths > 0, lengths, 1.0)[:, None]
            out[start : start + SLICE_ROWS] = counts
        return pa.ListArray.from_arrays(np.arange(len(out) + 1, dtype=np.int32) * dims, out.reshape(-1))

    return count(token_buckets(text, dims))
