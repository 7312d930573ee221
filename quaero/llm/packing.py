"""Packing: concatenate all documents' tokens and cut the stream into fixed windows.

Two passes. The first tokenises each partition once, keeps the ids as a table in
the shared folder and notes each document's offset inside its partition. Prefix
sums over the partition totals (one row per partition) turn these into global
offsets. The second pass cuts at multiples of the window; a document that crosses
a window end gets one boundary record per window it touches. No document moves.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quaero.llm.common import materialize, ragged_take
from quaero.llm.kernels import segment_hashes, slices, text_bytes

WINDOW = 1024
END_ID = 0
#: Larger slices share more words among their texts.
SLICE_BYTES = 1 << 20

TOKENS = "part int, before long, n_tokens long, ids binary"
PIECES = (
    "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


def word_starts(data: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Marks text starts and every single space between two other characters.

    A byte-level pre-tokenizer always begins a new piece at such a space, so the
    parts can be encoded on their own. Where a neighbour may belong to a blank
    beyond ASCII there is no mark: the part is longer, the ids are the same.
    """
    blank = (data == 32) | ((data >= 9) & (data <= 13)) | ((data >= 28) & (data <= 31))
    start = np.zeros(len(data), dtype=bool)
    if len(data) > 2:
        here, before, after = data[1:-1] == 32, ~blank[:-2], ~blank[2:]
        lead = data[2:]
        after &= (lead < 0xC2) | ((lead >= 0xC3) & (lead < 0xE1)) | (lead >= 0xE4)
        # the character before: plain, or of two bytes from C3 on, or of three from E4 on
        two, three = np.zeros(len(data) - 2, dtype=bool), np.zeros(len(data) - 2, dtype=bool)
        two[1:] = (data[:-3] >= 0xC3) & (data[:-3] < 0xE0)
        three[2:] = (data[:-4] >= 0xE4) & (data[:-4] < 0xF0)
        before &= (data[:-2] < 0x80) | two | three
        start[1:-1] = here & before & after
    # a space that opens or closes a text stays with its neighbour
    start[heads[heads < len(data)]] = True
    closing = heads[1:] - 1
    closing = closing[(closing >= 0) & (closing < len(data))]
    start[closing] &= np.isin(closing, heads)
    return start


class WordEncoder:
    """Token ids of whole texts under a byte-level BPE file of the tokenizers library.

    The distinct words of a slice are joined and encoded in one call, with the
    file's own vocabulary as merge ranks, and then dealt back to their places. A
    word at a text's end, or with characters of three and more bytes, goes through
    the tokenizers library by itself; so does any text when the file has other
    settings than the plain ones (no normalizer, no prefix space, ids as ranks).
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from public_tokenizers import PATTERN
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.width = np.uint16 if self.model.get_vocab_size() <= 1 << 16 else np.uint32
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        added = {x["content"]: x["id"] for x in parts["added_tokens"]}
        # bytes that print stand for themselves; the others follow from 256 on
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
        hidden = [b for b in range(256) if b not in shown]
        char = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}
        ranks = {bytes(char[c] for c in word): i for word, i in parts["model"]["vocab"].items() if word not in added}
        self.special = list(added)
        self.fast = tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=added)
        self.size = np.zeros(self.model.get_vocab_size(), dtype=np.int64)
        for word, i in ranks.items():
            self.size[i] = len(word)
        for word, i in added.items():
            self.size[i] = len(word.encode())

    def _joined(self, raw: bytes, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words that stand one after the other, and their counts; ``ends`` in bytes."""
        text = raw.decode()
        plain = not any(x in text for x in self.special)
        ids = np.array(
            self.fast.encode_ordinary(text) if plain else self.fast.encode(text, allowed_special="all"), dtype=np.int64
        )
        token_ends = np.searchsorted(np.cumsum(self.size[ids]), ends, side="left") + 1
        return ids.astype(self.width), np.diff(np.concatenate(([0], token_ends)))

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, offsets of the texts) for the texts of one slice."""
        n = len(offsets) - 1
        if not len(data):
            return np.zeros(0, dtype=self.width), np.zeros(n + 1, dtype=np.int64)
        first, length, h = segment_hashes(data, word_starts(data, offsets))
        edge = np.isin(first, offsets) | np.isin(first + length, offsets)
        edge |= np.add.reduceat(data >= 0xE0, first, dtype=np.int64) > 0
        _, at, back = np.unique(h, return_index=True, return_inverse=True)
        inner, outer = np.flatnonzero(~edge[at]), np.flatnonzero(edge[at])
        sizes = np.zeros(len(at), dtype=np.int64)
        ids = [np.zeros(0, dtype=self.width)]
        if len(inner):
            taken = data[ragged_take(first[at[inner]], length[at[inner]])].tobytes()
            made, sizes[inner] = self._joined(taken, np.cumsum(length[at[inner]]))
            ids.append(made)
        if len(outer):
            words = [data[first[i] : first[i] + length[i]].tobytes().decode() for i in at[outer]]
            runs = [x.ids for x in self.model.encode_batch_fast(words, add_special_tokens=False)]
            sizes[outer] = [len(x) for x in runs]
            ids.append(np.array([i for x in runs for i in x], dtype=self.width))
        order = np.concatenate((inner, outer))
        begins = np.zeros(len(at), dtype=np.int64)
        begins[order] = np.cumsum(sizes[order]) - sizes[order]
        flat = np.concatenate(ids)[ragged_take(begins[back], sizes[back])]
        row = np.searchsorted(offsets, first, side="right") - 1
        counts = np.bincount(row, weights=sizes[back], minlength=n).astype(np.int64)
        return flat, np.concatenate(([0], np.cumsum(counts)))


def tokenize(docs: DataFrame, text_col: str, path: str, end_id: int | None = END_ID) -> DataFrame:
    """``docs`` without its text, plus part, before, n_tokens and ids.

    ``part`` is the task that wrote the row and ``before`` the tokens before it in
    that task; both are facts of the written table, so write it before use.
    """
    kept = [f for f in docs.schema.fields if f.name != text_col]
    names = [f.name for f in kept]
    end = [] if end_id is None else [end_id]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, before = WordEncoder(path), TaskContext.get().partitionId(), 0
        for batch in batches:
            data, offsets = text_bytes(batch.column(text_col))
            rest = batch.select(names)
            for a, b in slices(offsets, SLICE_BYTES):
                ids, ends = encoder.encode(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                tail = np.array(end, dtype=encoder.width)
                runs = [np.concatenate((ids[x:y], tail)) for x, y in zip(ends[:-1], ends[1:])]
                sizes = np.diff(ends) + len(tail)
                places = before + np.cumsum(sizes) - sizes
                before += int(sizes.sum())
                columns = [
                    *rest.slice(a, b - a).columns, pa.array(np.full(b - a, part, dtype=np.int32)), pa.array(places),
                    pa.array(sizes), pa.array([x.astype("<u4" if x.itemsize == 4 else "<u2").tobytes() for x in runs]),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[*names, "part", "before", "n_tokens", "ids"])

    fields = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), TOKENS])
    return docs.mapInArrow(run, fields)


def with_offsets(tokens: DataFrame) -> DataFrame:
    """Adds ``at``, the place of a row's first token in the concatenation of all partitions.

    The broadcast side has one row of two numbers per partition of the written
    table, so it grows with the number of files, not of rows.
    """
    totals = tokens.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("total").over(order), F.lit(0)).alias("base"))
    return tokens.join(F.broadcast(bases), "part").withColumn("at", F.col("base") + F.col("before")).drop("base")


def cut(tokens: DataFrame, key_cols: list[str], window: int = WINDOW, id_bytes: int = 2) -> DataFrame:
    """One row per document and window it touches."""
    fields = [tokens.schema[k] for k in key_cols]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, n = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("at", "n_tokens"))
            windows = np.where(n > 0, (at + n - 1) // window - at // window + 1, 0)
            row = np.repeat(np.arange(len(n)), windows)
            if not len(row):
                continue
            sequence = ragged_take(at // window, windows)
            begin = np.maximum(sequence * window, at[row])
            end = np.minimum((sequence + 1) * window, at[row] + n[row])
            start, length = begin - at[row], end - begin
            ids, crc = batch.column("ids"), np.empty(len(row), dtype=np.int64)
            held, run_ids = -1, b""
            for k, (r, s, m) in enumerate(zip(row.tolist(), start.tolist(), length.tolist())):
                if r != held:
                    held, raw = r, np.frombuffer(ids[r].as_buffer(), dtype=f"<u{id_bytes}")
                    run_ids = raw.astype("<u4").tobytes()
                crc[k] = zlib.crc32(run_ids[4 * s : 4 * (s + m)])
            take = pa.array(row)
            columns = [batch.column(c).take(take) for c in key_cols]
            columns += [pa.array(x) for x in (start, length, crc, n[row], sequence, begin - sequence * window)]
            yield pa.RecordBatch.from_arrays(
                columns,
                names=[*key_cols, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
            )

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), PIECES])
    return tokens.select(*key_cols, "at", "n_tokens", "ids").mapInArrow(run, schema)


def pack(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
    window: int = WINDOW, end_id: int = END_ID,
) -> DataFrame:
    """Pieces of all documents in windows of ``window`` tokens; only the last window may be short.

    A null or empty text is the end token alone. Repeated rows and null ids are
    packed like any other row: rows are never merged. Other columns are ignored;
    an empty table gives no pieces.
    """
    from tokenizers import Tokenizer

    id_bytes = 2 if Tokenizer.from_file(tokenizer_path).get_vocab_size() <= 1 << 16 else 4
    rows = docs.select(F.col(id_col).alias("key"), F.col(text_col).cast("string").alias("text"))
    tokens = materialize(tokenize(rows, "text", tokenizer_path, end_id), "tokens")
    return cut(with_offsets(tokens), ["key"], window, id_bytes).withColumnRenamed("key", id_col)
