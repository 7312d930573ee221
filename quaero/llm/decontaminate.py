"""Benchmark decontamination: short test items found inside long documents.

Items are grouped by their number of shingles (classes of a factor two). An item
is known by the smallest of its shingle hashes, a bottom-k MinHash signature. Its
length follows from the class: an item of n shingles that is contained to the
share t misses at most n - ceil(t n) of them, so one more than that many values
must hold one the document has. A document is a candidate where it meets any
value of a signature; all its candidates are then counted on the full sets. No
link is lost, whatever the length of the document.

The documents are never shuffled. The items go to the executors in blocks of
bounded size, one pass over the documents each, so a larger benchmark costs more
passes and not more memory.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaero.llm.common import materialize, ragged_take
from quaero.llm.kernels import SHINGLE_WORDS, column_shingle_sets

CONTAINMENT = 0.8
BLOCK_SHINGLES = 1 << 20

MATCHES = "item_id long, item_shingles long, shared_shingles long"


def item_sets(items: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """(item_id, n, size_class, shingles): the distinct shingle hashes, smallest first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(column_shingle_sets(batch.column("text"), width))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("item_id"), pa.array([len(s) for s in sets], type=pa.int64()),
                    pa.array([len(s).bit_length() for s in sets], type=pa.int32()),
                    pa.array([s.tobytes() for s in sets], type=pa.binary()),
                ],
                names=["item_id", "n", "size_class", "shingles"],
            )

    rows = items.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "item_id long, n long, size_class int, shingles binary").where("n > 0")


class ItemBlock:
    """The items of one pass: signature values with their item, and the full sets."""

    def __init__(self, rows: list, containment: float) -> None:
        self.ids = [r.item_id for r in rows]
        sets = [np.frombuffer(r.shingles, dtype=np.uint64) for r in rows]
        self.sizes = np.array([len(s) for s in sets], dtype=np.int64)
        self.need = np.array([math.ceil(containment * len(s) - 1e-9) for s in sets], dtype=np.int64)
        # the signature length of a class is that of its longest member
        length = {}
        for r in rows:
            spare = r.n - math.ceil(containment * r.n - 1e-9) + 1
            length[r.size_class] = max(length.get(r.size_class, 1), spare)
        marks = [s[: length[r.size_class]] for r, s in zip(rows, sets)]
        value = np.concatenate(marks)
        owner = np.repeat(np.arange(len(rows)), [len(m) for m in marks])
        order = np.argsort(value, kind="stable")
        self.value, self.owner = value[order], owner[order]
        self.all, self.all_owner = np.concatenate(sets), np.repeat(np.arange(len(rows)), self.sizes)
        order = np.argsort(self.all, kind="stable")
        self.all, self.all_owner = self.all[order], self.all_owner[order]
        # the distinct item shingles, where the items of each begin, and which of them are signature values
        self.names, self.begins = np.unique(self.all, return_index=True)
        self.begins = np.append(self.begins, len(self.all))
        self.marks, self.mark_begins = np.unique(self.value, return_index=True)
        self.mark_begins = np.append(self.mark_begins, len(self.value))
        self.filter = np.zeros(1 << 23, dtype=bool)  # of the 23 high bits of every item shingle
        self.filter[(self.all >> np.uint64(41)).astype(np.int64)] = True

    def matches(self, have: np.ndarray) -> list[tuple[int, int]]:
        """(item, shared shingles) for one document's distinct hashes, sorted."""
        have = have[self.filter[(have >> np.uint64(41)).astype(np.int64)]]
        owners = self._owners(have, self.marks, self.mark_begins, self.owner)
        if not len(owners):
            return []
        candidates = np.unique(owners)
        owners = self._owners(have, self.names, self.begins, self.all_owner)
        found, shared = np.unique(owners[np.isin(owners, candidates)], return_counts=True)
        good = shared >= self.need[found]
        return list(zip(found[good].tolist(), shared[good].tolist()))

    @staticmethod
    def _owners(have: np.ndarray, names: np.ndarray, begins: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """The items of those of ``have`` that are among ``names``: the work grows with the document, not the block."""
        at = np.searchsorted(names, have)
        at = at[names[np.minimum(at, len(names) - 1)] == have]
        return owner[ragged_take(begins[at], begins[at + 1] - begins[at])]


def item_blocks(sets: DataFrame, limit: int) -> list[tuple[int, int]]:
    """Hash ranges that hold about ``limit`` shingles each, from one small count."""
    spread = F.pmod(F.xxhash64("item_id", "shingles"), F.lit(1 << 12))
    total = sets.agg(F.sum("n")).first()[0] or 0
    parts = min(1 << 12, max(1, math.ceil(total / limit)))
    edges = [k * (1 << 12) // parts for k in range(parts + 1)]
    return [(spread, a, b) for a, b in zip(edges[:-1], edges[1:])] if total else []


def passes(items: DataFrame, item_id: str, item_text: str, width: int, containment: float, limit: int) -> Iterator[ItemBlock]:
    """The items in blocks of about ``limit`` shingles, one after the other."""
    sets = materialize(item_sets(items, item_id, item_text, width), "items")
    for spread, a, b in item_blocks(sets, limit):
        block = sets.where((spread >= a) & (spread < b)).collect()  # about ``limit`` numbers
        if block:
            yield ItemBlock(block, containment)


def find_items(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", doc_text: str = "text",
    item_id: str = "item_id", item_text: str = "text", width: int = SHINGLE_WORDS,
    containment: float = CONTAINMENT, block_shingles: int = BLOCK_SHINGLES,
) -> DataFrame:
    """One row per document and item whose shingles it holds to at least ``containment``.

    Columns: the document's id, item_id, item_shingles, shared_shingles. Words are
    those of the near-duplicate operator. An item under ``width`` words is one
    sequence, so it is found only in documents of just these words. Items and
    documents without words (null texts as well) match nothing. Repeated rows on
    either side give repeated matches; null ids are carried. Other columns are
    ignored; empty tables give no rows.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).alias("key"), F.col(doc_text).cast("string").alias("text"))
    schema = f"`key` {rows.schema['key'].dataType.simpleString()}, {MATCHES}"

    def one_pass(block: ItemBlock) -> DataFrame:
        held = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            here = held.value
            for batch in batches:
                row, item, shared = [], [], []
                for k, have in enumerate(column_shingle_sets(batch.column("text"), width)):
                    for i, n in here.matches(have):
                        row.append(k), item.append(i), shared.append(n)
                if row:
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("key").take(pa.array(row)),
                            pa.array([here.ids[i] for i in item], type=pa.int64()),
                            pa.array(here.sizes[item]), pa.array(shared, type=pa.int64()),
                        ],
                        names=["key", "item_id", "item_shingles", "shared_shingles"],
                    )

        return rows.mapInArrow(run, schema)

    found = [one_pass(x) for x in passes(items, item_id, item_text, width, containment, block_shingles)]
    if not found:
        return spark.createDataFrame([], schema).withColumnRenamed("key", doc_id)
    return reduce(DataFrame.unionAll, found).withColumnRenamed("key", doc_id)


def drop_contaminated(
    docs: DataFrame, items: DataFrame, doc_text: str = "text", item_id: str = "item_id", item_text: str = "text",
    width: int = SHINGLE_WORDS, containment: float = CONTAINMENT, block_shingles: int = BLOCK_SHINGLES,
) -> DataFrame:
    """The rows of ``docs`` in which ``find_items`` finds nothing; all columns stay. Row-wise, so ids play no part."""
    clean, names = docs, docs.columns
    for block in passes(items, item_id, item_text, width, containment, block_shingles):
        held = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                hit = [bool(held.value.matches(s)) for s in column_shingle_sets(batch.column("__text"), width)]
                yield batch.select(names).filter(pa.array([not x for x in hit], type=pa.bool_()))

        clean = clean.withColumn("__text", F.col(doc_text).cast("string")).mapInArrow(run, docs.schema)
    return clean
