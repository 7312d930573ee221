"""Recursive character chunking: overlapping pieces cut at the coarsest separator."""

from __future__ import annotations

from collections import deque
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Separators from coarse to fine, chunk size and overlap in characters.
SEPARATORS = ("\n\n", "\n", ".", " ", "")
CHUNK_SIZE = 1000
CHUNK_OVERLAP = 200
SLICE_ROWS = 64  # texts that are Python strings at a time


def _pieces(text: str, separator: str) -> list[str]:
    """Cut before each separator, so a piece starts with the separator that led to it."""
    if not separator:
        return list(text)
    head, *rest = text.split(separator)
    return [p for p in [head, *(separator + r for r in rest)] if p]


def _pack(pieces: Sequence[str], size: int, overlap: int) -> list[str]:
    """Join neighbouring pieces up to ``size``; the next chunk repeats up to ``overlap``."""
    chunks = []
    held: deque[str] = deque()
    total = 0
    for piece in pieces:
        if total + len(piece) > size:
            chunks.append("".join(held).strip())
            while held and (total > overlap or total + len(piece) > size):
                total -= len(held.popleft())
        held.append(piece)
        total += len(piece)
    chunks.append("".join(held).strip())
    return [c for c in chunks if c]


def split_text(
    text: str,
    size: int = CHUNK_SIZE,
    overlap: int = CHUNK_OVERLAP,
    separators: Sequence[str] = SEPARATORS,
) -> list[str]:
    """Chunks of one text, in text order."""
    level = next(
        (i for i, s in enumerate(separators) if s in text), len(separators) - 1
    )
    finer = separators[level + 1 :]
    chunks: list[str] = []
    small: list[str] = []
    for piece in _pieces(text, separators[level]):
        if len(piece) < size:
            small.append(piece)
            continue
        chunks += _pack(small, size, overlap)
        small = []
        # the empty separator ends the ladder: what it leaves cannot be cut again
        if finer and separators[level]:
            chunks += split_text(piece, size, overlap, finer)
        else:
            chunks.append(piece)
    return chunks + _pack(small, size, overlap)


def chunks_of(
    text: Column,
    size: int = CHUNK_SIZE,
    overlap: int = CHUNK_OVERLAP,
    separators: Sequence[str] = SEPARATORS,
) -> Column:
    if not 0 <= overlap <= size:
        raise ValueError("overlap must lie between 0 and the chunk size")

    @F.arrow_udf("array<string>")
    def cut(texts: pa.Array) -> pa.Array:
        kind = pa.list_(pa.string())
        return pa.concat_arrays([
            pa.array([split_text(t, size, overlap, separators) for t in texts.slice(start, SLICE_ROWS).to_pylist()], kind)
            for start in range(0, len(texts), SLICE_ROWS)
        ] or [pa.array([], kind)])

    return cut(F.coalesce(text, F.lit("")))


def chunk_documents(
    df: DataFrame,
    text: str = "page_content",
    size: int = CHUNK_SIZE,
    overlap: int = CHUNK_OVERLAP,
    separators: Sequence[str] = SEPARATORS,
) -> DataFrame:
    """One row per chunk: ``chunk_no`` and the chunk in place of ``text``.

    All other columns are carried along. Rows are cut on their own, so nothing is
    shuffled.
    """
    others = [c for c in df.columns if c != text]
    return df.select(
        *others, F.posexplode(chunks_of(F.col(text), size, overlap, separators))
    ).select(*others, F.col("pos").alias("chunk_no"), F.col("col").alias(text))
