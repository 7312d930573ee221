"""Token counts under a sentencepiece BPE model, merged in batches of ragged arrays.

A blank only ever opens a piece of the vocabulary, so merges never cross from a
letter to a following blank: texts fall into pre-tokens there. The distinct
pre-tokens of a slice lie in one flat array of symbols. In each round every
pre-token applies its own lowest-rank pair (the leftmost of equals), all at once;
pre-tokens without a pair leave the arrays, and their surviving symbols count.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaero.llm.common import ragged_take
from quaero.llm.kernels import segment_hashes, slices, text_bytes

LIMIT = 4096
LONG_SYMBOLS = 512
#: Larger slices share more pre-tokens among their texts.
SLICE_BYTES = 1 << 20
_BLANK = "▁"
_NONE = np.int64(1) << np.int64(30)
#: Texts whose counts a model must give like the library, else its settings are not supported.
_PROBES = ("", " ", "  ", "a  b ", "\n", "▁x", "café ① è", " 　q\t", "<s> </s> <unk> <0x0A>", "\x00aaa aaaa" + " " * 9)


class PieceCounter:
    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        plain = [i for i in range(n) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        ids = {model.id_to_piece(i): i for i in plain}
        if any(_BLANK in piece.lstrip(_BLANK) for piece in ids):
            raise ValueError("a piece holds a blank after another character; pre-tokens cannot be cut at blanks")
        order = {score: k for k, score in enumerate(sorted({model.get_score(i) for i in plain}, reverse=True))}
        self.char = np.full(0x110000, -1, dtype=np.int64)
        pairs: dict[int, tuple[int, int]] = {}
        for piece, i in ids.items():
            if len(piece) == 1:
                self.char[ord(piece)] = i
            for k in range(1, len(piece)):
                left, right = ids.get(piece[:k]), ids.get(piece[k:])
                if left is not None and right is not None:
                    pairs[left * n + right] = (order[model.get_score(i)], i)
        self.char[32] = self.char[ord(_BLANK)]
        self.n = np.int64(n)
        self.keys = np.array(sorted(pairs), dtype=np.int64)
        self.ranks = np.array([pairs[k][0] for k in self.keys.tolist()], dtype=np.int64)
        self.made = np.array([pairs[k][1] for k in self.keys.tolist()], dtype=np.int64)
        data, offsets = text_bytes(pa.array(_PROBES))
        if self.counts(data, offsets).tolist() != [len(x) for x in model.encode(list(_PROBES), num_threads=1)]:
            raise ValueError("the model's settings are not those this counter follows")

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and product of symbol pairs; rank ``_NONE`` where there is no such piece."""
        key = np.where((left < 0) | (right < 0), np.int64(-1), left * self.n + right)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[at] == key
        return np.where(hit, self.ranks[at], _NONE), self.made[at]

    def _merge_long(self, symbols: list[int]) -> list[int]:
        """The same merges over one long pre-token, with a heap: n log n steps."""
        n, after, before = len(symbols), list(range(1, len(symbols) + 1)), list(range(-1, len(symbols) - 1))
        rank, made = self._pairs(np.array(symbols[:-1]), np.array(symbols[1:]))
        heap = [(int(r), i, symbols[i], symbols[i + 1], int(m)) for i, (r, m) in enumerate(zip(rank, made)) if r < _NONE]
        heapq.heapify(heap)
        gone: list[int | None] = list(symbols)
        while heap:
            _, i, a, b, m = heapq.heappop(heap)
            j = after[i]
            if gone[i] != a or j >= n or gone[j] != b:
                continue
            gone[i], gone[j] = m, None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for x in (before[i], i):
                y = after[x] if x >= 0 else n
                if x >= 0 and y < n:
                    r, made_id = self._pairs(np.array([gone[x]]), np.array([gone[y]]))
                    if r[0] < _NONE:
                        heapq.heappush(heap, (int(r[0]), x, gone[x], gone[y], int(made_id[0])))
        return [x for x in gone if x is not None]

    def _merged(self, symbol: np.ndarray, length: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Tokens of each pre-token, given its symbols; ``weight`` counts an unknown symbol's bytes."""
        counts = np.zeros(len(length), dtype=np.int64)
        begins = np.cumsum(length) - length
        for k in np.flatnonzero(length > LONG_SYMBOLS).tolist():
            part = slice(begins[k], begins[k] + length[k])
            kept = self._merge_long(symbol[part].tolist())
            unknown = symbol[part] < 0
            counts[k] = sum(x >= 0 for x in kept) + int(weight[part][unknown].sum())
        short = np.repeat(length <= LONG_SYMBOLS, length)
        owner = np.repeat(np.arange(len(length)), length)[short]
        symbol, weight = symbol[short], weight[short]
        if not len(symbol):
            return counts
        rank, made = self._pairs(symbol, np.append(symbol[1:], -1))
        last = np.append(owner[1:] != owner[:-1], True)
        rank[last] = _NONE
        while len(symbol):
            heads = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            best = np.minimum.reduceat((rank << np.int64(32)) | np.arange(len(rank), dtype=np.int64), heads)
            alive = (best >> np.int64(32)) < _NONE
            sizes = np.diff(np.append(heads, len(symbol)))
            stays = np.repeat(alive, sizes)
            if not alive.all():
                counts += np.bincount(owner[~stays], weights=weight[~stays], minlength=len(counts)).astype(np.int64)
            at = (best & np.int64(0xFFFFFFFF))[alive]
            symbol[at], weight[at] = made[at], 1
            stays[at + 1] = False
            shift = np.cumsum(stays) - 1
            at = shift[at]
            symbol, owner, weight, rank, made = symbol[stays], owner[stays], weight[stays], rank[stays], made[stays]
            if not len(symbol):
                break
            last = np.append(owner[1:] != owner[:-1], True)
            for x in (at, at[at > 0] - 1):
                r, m = self._pairs(symbol[x], symbol[np.minimum(x + 1, len(symbol) - 1)])
                rank[x], made[x] = np.where(last[x], _NONE, r), m
        return counts

    def counts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Tokens of each text of a slice."""
        n = len(offsets) - 1
        raw = data.tobytes()
        if _BLANK.encode() in raw:
            texts = [raw[a:b].replace(_BLANK.encode(), b" ") for a, b in zip(offsets[:-1], offsets[1:])]
            data, offsets = text_bytes(pa.array(texts, type=pa.binary()))
        if not len(data):
            return np.zeros(n, dtype=np.int64)
        full = np.flatnonzero(np.diff(offsets) > 0)  # a text is led by a blank of its own
        data = np.insert(data, offsets[full], 32)
        added = np.zeros(n + 1, dtype=np.int64)
        added[full + 1] = 1
        offsets = offsets + np.cumsum(added)
        start = np.zeros(len(data), dtype=bool)
        start[1:] = (data[1:] == 32) & (data[:-1] != 32)
        start[offsets[full]] = True
        first, length, h = segment_hashes(data, start)
        _, at, back = np.unique(h, return_index=True, return_inverse=True)
        taken = data[ragged_take(first[at], length[at])]
        codes = np.frombuffer(taken.tobytes().decode().encode("utf-32-le"), dtype=np.uint32)
        opens = (taken & 0xC0) != 0x80
        ends = np.cumsum(length[at])
        chars = np.add.reduceat(opens, ends - length[at], dtype=np.int64)
        widths = np.diff(np.append(np.flatnonzero(opens), len(taken)))
        symbol = self.char[codes]
        made = self._merged(symbol, chars, np.where(symbol >= 0, 1, widths))
        row = np.searchsorted(offsets, first, side="right") - 1
        return np.bincount(row, weights=made[back], minlength=n).astype(np.int64)


def count_tokens(
    docs: DataFrame, model_path: str, text_col: str = "text", limit: int = LIMIT
) -> DataFrame:
    """``docs`` without its text, plus n_bytes, n_tokens and over_limit.

    Row-wise, no shuffle. A null text counts as empty: no bytes, no tokens. Other
    columns, null ids and repeated rows pass through; an empty table stays empty.
    Columns that already bear the new names are replaced.
    """
    new = ("n_bytes", "n_tokens", "over_limit")
    kept = [f for f in docs.schema.fields if f.name != text_col and f.name not in new]
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PieceCounter(model_path)
        for batch in batches:
            data, offsets = text_bytes(batch.column(text_col))
            parts = [
                counter.counts(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]) for a, b in slices(offsets, SLICE_BYTES)
            ]
            counts = np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64)
            columns = [*batch.select(names).columns, pa.array(np.diff(offsets)), pa.array(counts)]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "n_bytes", "n_tokens"])

    fields = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "n_bytes long, n_tokens long"])
    rows = docs.select(*names, F.col(text_col).cast("string").alias(text_col))
    return rows.mapInArrow(run, fields).withColumn("over_limit", F.col("n_tokens") > limit)
