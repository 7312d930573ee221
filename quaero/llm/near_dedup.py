"""Near-duplicate documents by an LSH forest over MinHash signatures.

Each tree of the forest is one order of the same signature, started at another
place. Documents that share the first ``DEPTH`` values of an order are a region;
inside, the order itself says who has the longest common prefix, so a crowded
region is searched at greater depth (see ``linking``). Candidates are confirmed
on the full shingle sets. Two documents at the threshold share no region with
probability (1 - t^4)^20: 4e-7 for t = 0.85, 3e-5 for t = 0.8.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaero.llm import linking
from quaero.llm.common import materialize, ragged_take
from quaero.llm.kernels import SHINGLE_WORDS, column_shingle_sets, mix

TREES = 20
DEPTH = 4
STEP = 6
VALUES = TREES * STEP
#: A candidate may have this much less equal signature values than the threshold: 4 standard deviations or more.
MARGIN = 0.15
_KEEP = 40  # bits of a shingle hash that go into a stored set


def _multipliers(n: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


_MULT = _multipliers(VALUES)
_ADD = mix(_MULT + np.uint64(77))


def signature(shingles: np.ndarray) -> np.ndarray:
    """``VALUES`` MinHash values of 16 bits each."""
    best = np.full(VALUES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for a in range(0, len(shingles), 4096):
        part = shingles[None, a : a + 4096] * _MULT[:, None] + _ADD[:, None]
        best = np.minimum(best, part.min(axis=1))
    return (mix(best) & np.uint64(0xFFFF)).astype(np.uint16)


def regions(sig: np.ndarray) -> np.ndarray:
    """One hash per tree of its first ``DEPTH`` values."""
    h = np.arange(1, TREES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for k in range(DEPTH):
        h = mix(h ^ sig[np.arange(TREES) * STEP + k].astype(np.uint64)) * np.uint64(0xD6E8FEB86659FD93)
    return mix(h).view(np.int64)


def pack_set(shingles: np.ndarray) -> bytes:
    """The hashes cut to ``_KEEP`` bits: low halves, then high bytes."""
    cut = np.sort(shingles >> np.uint64(64 - _KEEP))
    return cut.astype("<u4").tobytes() + (cut >> np.uint64(32)).astype(np.uint8).tobytes()


def unpack_set(raw: pa.Buffer) -> np.ndarray:
    n = len(raw) // 5
    low = np.frombuffer(raw, dtype="<u4", count=n).astype(np.uint64)
    return low | (np.frombuffer(raw, dtype=np.uint8, offset=4 * n).astype(np.uint64) << np.uint64(32))


def describe(docs: DataFrame, width: int) -> DataFrame:
    """(id, n, f1, f2, regions, signature) of documents(id, text): the set's size, fingerprint and forest entries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, f1, f2, trees, sigs = [], [], [], [], []
            for s in column_shingle_sets(batch.column("text"), width):
                sig = signature(s)
                n.append(len(s))
                f1.append(int(mix(s).sum().astype(np.int64)))
                f2.append(int(mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum().astype(np.int64)))
                trees.append(regions(sig) if len(s) else np.zeros(0, dtype=np.int64))
                sigs.append(sig.astype(">u2").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(n, type=pa.int64()), pa.array(f1, type=pa.int64()),
                 pa.array(f2, type=pa.int64()), pa.array(trees, type=pa.list_(pa.int64())),
                 pa.array(sigs, type=pa.binary())],
                names=["id", "n", "f1", "f2", "regions", "signature"],
            )

    return docs.mapInArrow(run, "id long, n long, f1 long, f2 long, regions array<long>, signature binary")


class Similar(linking.Near):
    """Shingle sets with 100 * intersection >= percent * union."""

    def __init__(self, percent: int) -> None:
        self.percent, self.need = percent, int(np.ceil((percent / 100 - MARGIN) * VALUES - 1e-9))

    def rows(self, sig: np.ndarray, n: np.ndarray, other: np.ndarray, m: np.ndarray) -> np.ndarray:
        left = np.ascontiguousarray(sig).view(np.uint16)
        right = np.ascontiguousarray(other).view(np.uint16)
        return self.certain(sig, n, other, m) & (np.count_nonzero(left == right, axis=1) >= self.need)

    def certain(self, sig: np.ndarray, n: np.ndarray, other: np.ndarray, m: np.ndarray) -> np.ndarray:
        return 100 * np.minimum(n, m) >= self.percent * np.maximum(n, m)

    def prepare(self, contents: list[pa.Buffer]) -> Callable[[int, np.ndarray, np.ndarray], np.ndarray]:
        sets = [unpack_set(x) for x in contents]
        sizes = np.array([len(x) for x in sets], dtype=np.int64)
        begins = np.cumsum(sizes) - sizes
        names, number = np.unique(np.concatenate(sets), return_inverse=True)
        mine = np.zeros(len(names), dtype=bool)

        def linked(k: int, at: np.ndarray, group: np.ndarray) -> np.ndarray:
            own = number[begins[k] : begins[k] + sizes[k]]
            mine[own] = True
            heads = np.cumsum(sizes[at]) - sizes[at]
            shared = np.add.reduceat(mine[number[ragged_take(begins[at], sizes[at])]], heads, dtype=np.int64)
            mine[own] = False
            good = 100 * shared >= self.percent * (sizes[at] + sizes[k] - shared)
            return at[good][np.unique(group[good], return_index=True)[1]]

        return linked


def stored_sets(docs: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """(id, content): the packed shingle sets of documents(id, text) among ids(id)."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [pack_set(s) for s in column_shingle_sets(batch.column("text"), width)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(made, type=pa.binary())], names=["id", "content"]
            )

    texts = linking.only_ids(docs, "id", ids)
    return texts.mapInArrow(sets, "id long, content binary").dropDuplicates(["id"])


def confirm(pairs: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets have 100 * intersection >= percent * union."""
    ids = pairs.select(F.col("a").alias("id")).unionAll(pairs.select(F.col("b").alias("id"))).distinct()
    held = materialize(stored_sets(docs, materialize(ids, "involved"), width), "sets")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                x, y = unpack_set(x.as_buffer()), unpack_set(y.as_buffer())
                shared = len(x) + len(y) - len(np.union1d(x, y))
                good.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(good, type=pa.bool_()))

    both = pairs.join(held.select(F.col("id").alias("a"), F.col("content").alias("x")), "a")
    both = both.join(held.select(F.col("id").alias("b"), F.col("content").alias("y")), "b")
    return both.select("a", "b", "x", "y").mapInArrow(compare, "a long, b long")


def near_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE_WORDS, percent: int = 80
) -> DataFrame:
    """One row per document: its id, n_shingles, component_id and kept.

    Documents with equal sets are one class from the start; only the smallest id of
    a class enters the forest. Texts without words (or null) have no shingles and
    link with nothing. Rows of one id are one document: repeated rows repeat in the
    result. Rows with a null id link with nothing, have a null component and are
    kept. Other columns are ignored; an empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    described = materialize(describe(rows, width), "signatures")
    filled = described.where("n > 0 AND id IS NOT NULL")
    classes = filled.groupBy("n", "f1", "f2").agg(
        F.min("id").alias("rep"), F.any_value("regions").alias("regions"), F.any_value("signature").alias("signature")
    )
    classes = materialize(classes, "classes")
    spread = classes.select(F.col("rep").alias("id"), F.posexplode("regions").alias("tree", "region"))
    entries = linking.crowded(spread).withColumnRenamed("id", "rep").join(classes.select("rep", "n", "signature"), "rep")
    turned = F.expr(f"concat(substring(signature, tree * {2 * STEP} + 1), substring(signature, 1, tree * {2 * STEP}))")
    members = materialize(
        entries.select(F.col("rep").alias("id"), "region", "m", "n", turned.alias("signature")), "members"
    )
    groups = linking.link_groups(
        members, Similar(percent), lambda pairs: confirm(pairs, rows, width, percent),
        lambda ids: stored_sets(rows, ids, width),
    )
    named = classes.select("n", "f1", "f2", "rep").join(groups.withColumnRenamed("id", "rep"), "rep", "left")
    named = materialize(named.select("n", "f1", "f2", F.coalesce("group", "rep").alias("component")), "components")
    result = described.select("id", "n", "f1", "f2").join(named, ["n", "f1", "f2"], "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return result.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )


def one_of_each(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE_WORDS, percent: int = 80
) -> DataFrame:
    """The rows of ``docs`` that ``near_groups`` keeps, all columns unchanged."""
    groups = near_groups(docs, id_col, text_col, width, percent)
    gone = materialize(groups.where("NOT kept").select(F.col(id_col).alias("id")).distinct(), "copies")
    return linking.without_ids(docs, id_col, gone)
