"""Vectorised text kernels over Arrow columns: words, shingles and byte lengths.

Everything works on the UTF-8 bytes of many texts at once, so no Python code
runs per word. Texts are taken in slices of bounded size to bound memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 512 << 10
SHINGLE_WORDS = 5

# Odd constants of the multiplicative hashes; any odd 64-bit numbers do.
_BYTE_MULT = np.uint64(0x9E3779B97F4A7C15)
_WORD_MULT = np.uint64(0xD6E8FEB86659FD93)
_LEN_MULT = np.uint64(0xA0761D6478BD642F)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64 bits (xor-shift and multiply, twice)."""
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(32)
    return h


_powers = np.ones(1, dtype=np.uint64)


def power_table(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        table = np.full(max(n, 256, 2 * len(_powers)), _BYTE_MULT, dtype=np.uint64)
        table[0] = 1
        _powers = np.multiply.accumulate(table)
    return _powers


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column (null: empty) and its n + 1 offsets."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "" if pa.types.is_string(column.type) else b"")
    if len(column) == 0:
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    width = np.int64 if column.type in (pa.large_string(), pa.large_binary()) else np.int32
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes each; a longer text stands alone."""
    n, at = len(offsets) - 1, 0
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        end = min(n, max(end, at + 1))
        yield at, end
        at = end


def fold_table(separators: bytes, zero_digits: bool = False) -> np.ndarray:
    """For each byte 0 if it separates words, else one more than its form in a word: A-Z in lower case."""
    made = np.arange(1, 257, dtype=np.uint16)
    made[65:91] += 32
    if zero_digits:
        made[48:58] = 49
    made[list(separators)] = 0
    return made


BLANKS = fold_table(bytes([32, *range(9, 14)]))


def hash_words(
    data: np.ndarray, offsets: np.ndarray, table: np.ndarray = BLANKS, with_chars: bool = False
) -> tuple[np.ndarray, ...]:
    """The hash of each word and the row it stands in; with ``with_chars`` its code points as well.

    Words are the runs of bytes that ``table`` does not map to 0, in the form it
    gives: by default what stands between space and \\x09 to \\x0D, A-Z in lower case.
    ``offsets`` are the n + 1 bounds of the rows; a bound ends a word.
    """
    folded = table[data]
    keep = folded != 0
    start = keep.copy()
    start[1:] &= ~keep[:-1]
    heads = offsets[:-1]
    heads = heads[heads < len(data)]
    start[heads] = keep[heads]
    at = np.flatnonzero(start)
    if not len(at):
        nothing = np.zeros(0, dtype=np.int64)
        return (nothing.astype(np.uint64), nothing, *([nothing] if with_chars else []))
    row = np.searchsorted(offsets, at, side="right") - 1
    inside = folded[keep]
    first = np.flatnonzero(start[keep])
    length = np.diff(np.append(first, len(inside)))
    place = np.arange(len(inside)) - np.repeat(first, length)
    powers = power_table(int(length.max()) + 1)
    h = np.add.reduceat(inside.astype(np.uint64) * powers[place], first)
    h = mix(h + length.astype(np.uint64) * _LEN_MULT)
    if not with_chars:
        return h, row
    return h, row, np.add.reduceat(((inside - 1) & 0xC0) != 0x80, first, dtype=np.int64)


def hash_shingles(
    words: np.ndarray, row: np.ndarray, n_rows: int, width: int = SHINGLE_WORDS
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all word sequences of ``width``; a shorter text is one sequence.

    Returns (hashes, offsets of the rows). A row without words has none.
    """
    counts = np.bincount(row, minlength=n_rows)
    if len(words) >= width:
        h = words[: len(words) - width + 1].copy()
        for k in range(1, width):
            h *= _WORD_MULT
            h += words[k : len(words) - width + 1 + k]
        whole = row[: len(h)] == row[width - 1 :]
        h, at = mix(h[whole] + np.uint64(width)), row[: len(whole)][whole]
    else:
        h, at = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        begins = np.concatenate(([0], np.cumsum(counts)))
        made = np.zeros(len(short), dtype=np.uint64)
        for k in range(width - 1):
            inside = k < counts[short]
            taken = words[np.minimum(begins[short] + k, len(words) - 1)]
            made = np.where(inside, made * _WORD_MULT + taken, made)
        made = mix(made + counts[short].astype(np.uint64))
        h, at = np.concatenate((h, made)), np.concatenate((at, short))
        order = np.argsort(at, kind="stable")
        h, at = h[order], at[order]
    return h, np.concatenate(([0], np.cumsum(np.bincount(at, minlength=n_rows))))


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int = SHINGLE_WORDS) -> list[np.ndarray]:
    """For each text its sorted distinct shingle hashes."""
    words, row = hash_words(data, offsets)
    h, ends = hash_shingles(words, row, len(offsets) - 1, width)
    return [np.unique(h[a:b]) for a, b in zip(ends[:-1], ends[1:])]


def column_shingle_sets(column: pa.Array, width: int = SHINGLE_WORDS) -> Iterator[np.ndarray]:
    """``shingle_sets`` over a string column, slice by slice."""
    data, offsets = text_bytes(column)
    for a, b in slices(offsets):
        yield from shingle_sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], width)


def segment_hashes(data: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the segments that ``start`` marks begin, their lengths and their hashes.

    Segments cover all bytes; ``start[0]`` must be set. Case is kept.
    """
    first = np.flatnonzero(start)
    length = np.diff(np.append(first, len(data)))
    place = np.arange(len(data)) - np.repeat(first, length)
    table = power_table(int(length.max()) + 1 if len(length) else 1)
    h = np.add.reduceat((data.astype(np.uint64) + np.uint64(1)) * table[place], first)
    return first, length, mix(h + length.astype(np.uint64) * _LEN_MULT)


# One counter byte per bit of a hash byte, so that eight bits are added at once.
_LANES = np.array(
    [sum(1 << (8 * k) for k in range(8) if value >> (7 - k) & 1) for value in range(256)], dtype=np.uint64
)


def simhash(words: np.ndarray, row: np.ndarray, n_rows: int) -> np.ndarray:
    """A SimHash of 64 bits for each row from its word hashes: ``n_rows`` x 8 bytes.

    A bit is set where more words have it than not; without words all bits are 0.
    """
    made = np.zeros((n_rows, 8), dtype=np.uint8)
    if not len(words):
        return made
    heads = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
    sizes = np.diff(np.append(heads, len(words)))
    pieces = -(-sizes // 255)  # a byte counts to 255
    within = np.arange(int(pieces.sum())) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    starts = np.repeat(heads, pieces) + 255 * within
    owner = np.cumsum(pieces) - pieces
    hashes = np.ascontiguousarray(words).view(np.uint8).reshape(-1, 8)
    for k in range(8):
        lanes = np.add.reduceat(_LANES[hashes[:, k]], starts)
        counts = lanes.view(np.uint8).reshape(-1, 8).astype(np.int64)
        counts = np.add.reduceat(counts, owner, axis=0)
        made[row[heads], k] = np.packbits(2 * counts > sizes[:, None], axis=1, bitorder="little").ravel()
    return made
