"""Exact top-k search over a bit-sliced index.

Every attribute of the quantised vectors is stored as bit slices: bitmaps that
say for each row of a block whether a bit of the attribute is set. The scores of
one query against all rows of a block come from bitmap arithmetic alone: the
multiples of the slices that the query asks for are added by full adders on whole
bitmaps, three addends to two until two are left, which one ripple addition joins.
The best rows are read from the most significant score slice downward; rows that
tie at the boundary are resolved exactly, by the smaller id.

Row blocks and query blocks have bounded sizes and meet in a grid of cells, each
with one row block and a few query blocks. A cell gives at most k rows a query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quaero.llm.common import materialize

SCALE = 64
ROWS = 1 << 14
QUERIES = 256
CELL_QUERY_BLOCKS = 4
#: Quantised components below this have differences within 62 bits; a larger one is an error, not left out.
LARGEST = 1 << 61
_DIGIT = 5  # bits of a query weight that one multiple covers


def quantised(vector: str, scale: float = SCALE) -> Column:
    """floor(scale * x) of every component as a double; null for a vector that takes no part."""
    doubles = F.transform(F.col(vector), lambda x: x.cast("double"))
    infinite = F.lit(float("inf"))
    usable = F.forall(doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < infinite))
    too_large = F.raise_error(F.lit(f"a component times {scale} is not below 2^61")).cast("long")
    whole = lambda x: F.when(F.abs(x * scale) < LARGEST, F.floor(x * scale).cast("long")).otherwise(too_large)
    return F.when(F.coalesce(usable, F.lit(False)), F.transform(doubles, whole))


def _matrix(column: pa.ChunkedArray | pa.Array, dims: int) -> np.ndarray:
    """Rows of lists as int64; missing components at the end count as 0."""
    made = np.zeros((len(column), dims), dtype=np.int64)
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(column)), lengths)
    place = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    made[row, place] = column.flatten().to_numpy(zero_copy_only=False)
    return made


def slice_block(ids: np.ndarray, values: np.ndarray) -> dict:
    """The index entry of one block: ids in order, slices, and the least value of each attribute."""
    order = np.argsort(ids, kind="stable")
    ids, values = ids[order], values[order]
    least = values.min(axis=0)
    above = values - least
    bits = max(1, int(above.max()).bit_length())
    padded = np.zeros((-(-len(ids) // 64) * 64, values.shape[1]), dtype=np.int64)
    padded[: len(ids)] = above
    slices = np.empty((values.shape[1], bits, len(padded) // 64), dtype=np.uint64)
    for b in range(bits):
        on = ((padded >> b) & 1).astype(np.uint8).T
        slices[:, b] = np.ascontiguousarray(np.packbits(on, axis=1, bitorder="little")).view(np.uint64)
    return {"ids": ids.astype("<i8").tobytes(), "least": least.astype("<i8").tobytes(), "bits": bits, "slices": slices.tobytes()}


def _add(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Ripple addition of numbers given as slices along the last axis but one."""
    out, carry = np.empty_like(a), np.zeros_like(a[..., 0, :])
    for k in range(a.shape[-2]):
        x = a[..., k, :] ^ b[..., k, :]
        out[..., k, :] = x ^ carry
        carry = (a[..., k, :] & b[..., k, :]) | (x & carry)
    return out


def _three_to_two(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Full adders: the sums and the carries of three stacks of numbers, one after the other."""
    x = a ^ b
    out = np.zeros((2 * len(a), *a.shape[1:]), dtype=np.uint64)
    np.bitwise_xor(x, c, out=out[: len(a)])
    x &= c
    a = a & b
    np.bitwise_or(x[:, :-1], a[:, :-1], out=out[len(a) :, 1:])
    return out


class Block:
    """Scores and best rows of one index block."""

    def __init__(self, ids: bytes, least: bytes, bits: int, slices: bytes) -> None:
        self.ids = np.frombuffer(ids, dtype="<i8")
        self.least = np.frombuffer(least, dtype="<i8")
        self.slices = np.frombuffer(slices, dtype=np.uint64).reshape(len(self.least), bits, -1)
        self.bits = bits
        words = self.slices.shape[2]
        everyone = np.zeros(words * 64, dtype=np.uint8)
        everyone[: len(self.ids)] = 1
        self.all = np.packbits(everyone, bitorder="little").view(np.uint64)
        # multiples 0 .. 2^_DIGIT - 1 of every attribute
        self.wide = bits + _DIGIT
        unit = np.zeros((len(self.least), self.wide, words), dtype=np.uint64)
        unit[:, :bits] = self.slices
        self.multiples = np.zeros((1 << _DIGIT, *unit.shape), dtype=np.uint64)
        for k in range(1, 1 << _DIGIT):
            self.multiples[k] = _add(self.multiples[k - 1], unit)

    def scores(self, weights: np.ndarray) -> tuple[np.ndarray, int]:
        """(slices of the score in two's complement, what to add to it)."""
        size = np.abs(weights)
        width = (sum(size.tolist()) << self.bits).bit_length() + 2
        width = max(width, self.wide + 1)
        attribute, digit, shift = [], [], []
        for k in range(max(1, -(-int(size.max()).bit_length() // _DIGIT))):
            part = (size >> (_DIGIT * k)) & ((1 << _DIGIT) - 1)
            some = np.flatnonzero(part)
            attribute.append(some), digit.append(part[some]), shift.append(np.full(len(some), _DIGIT * k))
        attribute, digit, shift = np.concatenate(attribute), np.concatenate(digit), np.concatenate(shift)
        width = max(width, self.wide + int(shift.max(initial=0)) + 1)
        numbers = np.zeros((len(attribute), width, self.slices.shape[2]), dtype=np.uint64)
        for k in np.unique(shift).tolist():
            at = shift == k
            numbers[at, k : k + self.wide] = self.multiples[digit[at], attribute[at]]
        minus = weights[attribute] < 0  # -x is the complement of x plus one
        numbers[minus] = ~numbers[minus]
        while len(numbers) > 2:
            third = len(numbers) // 3
            made = _three_to_two(numbers[:third], numbers[third : 2 * third], numbers[2 * third : 3 * third])
            numbers = np.concatenate((made, numbers[3 * third :])) if len(numbers) > 3 * third else made
        if len(numbers) == 2:
            total = _add(numbers[0], numbers[1])
        else:
            total = numbers[0] if len(numbers) else np.zeros((width, self.slices.shape[2]), dtype=np.uint64)
        return total, int(minus.sum()) + sum(w * x for w, x in zip(weights.tolist(), self.least.tolist()))

    def best(self, weights: np.ndarray, k: int, own: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k rows with the highest scores, ties to smaller ids, without ``own``."""
        total, base = self.scores(weights)
        open_rows = self.all.copy()
        at = np.searchsorted(self.ids, own)
        if at < len(self.ids) and self.ids[at] == own:
            open_rows[at // 64] &= ~(np.uint64(1) << np.uint64(at % 64))
        taken = np.zeros_like(open_rows)
        for b in range(len(total) - 1, -1, -1):
            bit = ~total[b] if b == len(total) - 1 else total[b]  # the sign slice counts the other way
            more = taken | (open_rows & bit)
            n = int(np.bitwise_count(more).sum())
            if n > k:
                open_rows &= bit
            else:
                taken = more
                open_rows &= ~bit
                if n == k:
                    break
        rows = np.flatnonzero(np.unpackbits(taken.view(np.uint8), bitorder="little"))
        if len(rows) < k:  # the rest ties: rows stand in the order of ids
            ties = np.flatnonzero(np.unpackbits(open_rows.view(np.uint8), bitorder="little"))
            rows = np.concatenate((rows, ties[: k - len(rows)]))
        on = (total[:, rows // 64] >> (rows % 64).astype(np.uint64)) & np.uint64(1)
        if len(total) < 62 and abs(base) < 1 << 62:
            power = np.int64(1) << np.arange(len(total), dtype=np.int64)
            power[-1] = -power[-1]
            return self.ids[rows], power @ on.astype(np.int64) + base
        power = [1 << b for b in range(len(total) - 1)] + [-1 << (len(total) - 1)]
        scores = [sum(p for p, bit in zip(power, column) if bit) + base for column in on.T.tolist()]
        if any(not -(1 << 63) <= x < 1 << 63 for x in scores):
            raise OverflowError("a score does not fit a long")
        return self.ids[rows], np.array(scores, dtype=np.int64)


def build_index(rows: DataFrame, dims: int, blocks: int) -> DataFrame:
    """(block, ids, least, bits, slices) of rows(id, v), written to the shared folder."""

    def run(part: pa.Table) -> pa.Table:
        made = slice_block(part["id"].to_numpy(), _matrix(part["v"], dims))
        return pa.table({
            "block": pa.array([part["block"][0].as_py()], type=pa.int32()), "ids": [made["ids"]], "least": [made["least"]],
            "bits": pa.array([made["bits"]], type=pa.int32()), "slices": pa.array([made["slices"]], type=pa.binary()),
        })

    spread = rows.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    index = spread.groupBy("block").applyInArrow(run, "block int, ids binary, least binary, bits int, slices binary")
    return materialize(index, "slices")


def query_blocks(queries: DataFrame, dims: int, blocks: int) -> DataFrame:
    def run(part: pa.Table) -> pa.Table:
        part = part.sort_by("id")
        return pa.table({
            "query_block": pa.array([part["query_block"][0].as_py()], type=pa.int32()),
            "query_ids": [part["id"].to_numpy().astype("<i8").tobytes()],
            "weights": pa.array([_matrix(part["v"], dims).astype("<i8").tobytes()], type=pa.binary()),
        })

    spread = queries.withColumn("query_block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    return spread.groupBy("query_block").applyInArrow(run, "query_block int, query_ids binary, weights binary")


def search(
    vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
    scale: float = SCALE, rows_per_block: int = ROWS,
) -> DataFrame:
    """Each query's k best rows: query_id, rank (from 1), the row's id, score.

    Scores are integer inner products of the quantised vectors; ties go to smaller
    ids and a query does not find its own id. Vectors that are null or empty, hold a
    null or a non-finite component, or have a null id take no part. Large components
    only widen the slices; a score beyond a long is an error. Vectors of different lengths are filled with zeros. Of several vectors of
    one id the smallest counts. Other columns are ignored; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), quantised(vector_col, scale).alias("v"), is_query.alias("q"))
    rows = rows.where("id IS NOT NULL AND size(v) > 0").groupBy("id").agg(F.min("v").alias("v"), F.bool_or("q").alias("q"))
    rows = materialize(rows, "quantised")
    n, asked, dims = rows.agg(F.count("*"), F.count_if("q"), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    schema = "query_id long, id long, score long"
    if not n or not asked:
        return spark.createDataFrame([], f"query_id long, rank int, `{id_col}` long, score long")
    blocks, parts = -(-n // rows_per_block), -(-asked // QUERIES)
    index = build_index(rows.select("id", "v"), dims, blocks)
    asked_blocks = query_blocks(rows.where("q").select("id", "v"), dims, parts)
    cells = -(-parts // CELL_QUERY_BLOCKS)
    left = index.withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(cells - 1))))
    right = asked_blocks.withColumn("cell", F.expr(f"query_block div {CELL_QUERY_BLOCKS}").cast("int"))
    right = right.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, name = None, None
        for batch in batches:
            for r in range(batch.num_rows):
                row = {c: batch.column(c)[r] for c in batch.schema.names}
                if name != row["block"].as_py():
                    name = row["block"].as_py()
                    held = Block(*(row[c].as_py() for c in ("ids", "least", "bits", "slices")))
                ids = np.frombuffer(row["query_ids"].as_buffer(), dtype="<i8")
                weights = np.frombuffer(row["weights"].as_buffer(), dtype="<i8").reshape(len(ids), -1)
                found = [held.best(w, k, int(q)) for q, w in zip(ids, weights)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(ids, [len(x) for x, _ in found])),
                        pa.array(np.concatenate([x for x, _ in found])), pa.array(np.concatenate([s for _, s in found])),
                    ],
                    names=["query_id", "id", "score"],
                )

    paired = left.join(right, ["block", "cell"]).select("block", "ids", "least", "bits", "slices", "query_ids", "weights")
    hits = paired.mapInArrow(run, schema)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "id")
    ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias(id_col), "score")
