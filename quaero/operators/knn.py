"""Top-k similarity retrieval as a distributed nearest-neighbour join.

Both tables are split, and no pair table is ever written: a task holds one
bounded block of each side, scores it as a matrix product and keeps only the k
best per question. Two exact routes lead there:

* *scan*: the questions are few enough (checked by count and bytes) to go to
  every executor; the corpus is read in place and never shuffled. More questions
  go in slices of that size, one pass over the corpus each.
* *cells*: each corpus vector is tied to its nearest pivot. The triangle
  inequality bounds how far a question's k-th neighbour can be, so a question
  visits only the cells that can still hold a neighbour. Crowded cells and
  popular cells are cut into blocks on both sides, so neither a cell with a third
  of the corpus nor a cell that every question visits meets a single task.

The cell method follows the pivot-based partitioning of Lu et al., "Efficient
Processing of k Nearest Neighbor Joins using MapReduce" (VLDB 2012).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quaero.session import materialize

DEFAULT_K = 4
SCORE_DIGITS = 10  # ranks compare scores at this precision, then ids
BLOCK_ROWS = 32_768  # corpus vectors in one block at most
QUESTION_BLOCK_ROWS = 32_768  # questions that meet one corpus block at most
BLOCK_BYTES = 64 << 20  # of one side in a task, as doubles; fewer rows where vectors are long
SMALL_BLOCK_ROWS = 2048  # blocks are not cut below this only to use more cores
PACK_BYTES = 256 << 10  # vectors that travel as one row
SLICE_ROWS = 256  # questions per matrix product inside a task
SLICE_CORPUS_ROWS = 2048  # corpus vectors per matrix product
PASSING_ROWS = 4096  # questions that pass a held block of the corpus together
HELD_PAIRS = 4_000_000  # candidate pairs a task holds before it scores them exactly
MAX_PIVOTS = 1024
MAX_BROADCAST_BYTES = 64 << 20
SCAN_PARTITION_BYTES = 32 << 20  # vectors in one corpus partition, estimated low
SCAN_QUESTIONS = 1000  # questions that are collected and sent to the corpus; more meet it block by block
CALIBRATION_ROWS, CALIBRATION_SHARE = 200, 95  # corpus vectors asked, and percent of their neighbours to reach
PAIR_ROWS = 20_000  # candidate pairs scored at a time
_SLACK = 1e-7  # widens every bound relative to the vectors' length, far above rounding error
_TIE = 1e-9  # candidates this close to the limit are compared exactly


@dataclass(frozen=True)
class Metric:
    """How vectors are laid out and what the reported score is."""

    name: str

    @property
    def ascending(self) -> bool:
        return self.name == "l2"

    def prepare(self, rows: pd.Series, dims: int, side: int) -> np.ndarray:
        """Rows as a matrix in which Euclidean distance orders like the metric.

        For cosine the rows become unit vectors. A zero vector scores 0 against
        everything, so it moves to an axis of its own, one per side.
        """
        extra = 2 if self.name == "cosine" else 0
        return self.place(_dense(rows, dims), extra, side)

    def place(self, rows: np.ndarray, extra: int, side: int) -> np.ndarray:
        """``prepare`` for rows that are a matrix already."""
        dims = rows.shape[1]
        matrix = np.zeros((len(rows), dims + extra))
        matrix[:, :dims] = rows
        if extra:
            lengths = np.sqrt(np.square(matrix).sum(axis=1))
            empty = lengths == 0
            matrix[empty, dims + side] = 1.0
            lengths[empty] = 1.0
            matrix /= lengths[:, None]
        return matrix

    def quick(self, rows: np.ndarray) -> np.ndarray:
        """Rows as they enter matrix products: unit vectors in single precision for cosine."""
        if self.name != "cosine":
            return rows.astype(np.float64)
        out = np.empty(rows.shape, dtype=np.float32)
        for start in range(0, len(rows), SLICE_CORPUS_ROWS):
            part = rows[start : start + SLICE_CORPUS_ROWS].astype(np.float64)
            lengths = np.sqrt(np.square(part).sum(axis=1))
            with np.errstate(invalid="ignore"):  # such rows take no part
                out[start : start + SLICE_CORPUS_ROWS] = part / np.where(lengths == 0, 1.0, lengths)[:, None]
        return out

    def margin(self, questions: np.ndarray, corpus: np.ndarray) -> float:
        """How far two values of ``values`` may be apart when the exact scores agree."""
        if self.name == "cosine":  # of a sum of d products of unit vectors, each rounded to 24 bits
            return 2 * (_TIE + (corpus.shape[1] + 8) * 2.0**-23)
        longest = max((np.square(side).sum(axis=1).max() for side in (questions, corpus) if len(side)), default=0.0)
        return 2 * (_TIE + 2e-12 * longest)

    def values(self, questions: np.ndarray, corpus: np.ndarray, out: np.ndarray) -> np.ndarray:
        """One row per question, higher is better; written to ``out``."""
        product = np.matmul(questions, corpus.T, out=out)
        if self.name == "cosine":
            return product
        asked, stored = np.square(questions).sum(axis=1), np.square(corpus).sum(axis=1)
        product *= 2.0
        product -= asked[:, None]
        product -= stored[None, :]
        return product

    def pair_costs(self, questions: np.ndarray, corpus: np.ndarray) -> np.ndarray:
        """Cost of each row pair, at the precision ranks are compared with."""
        if self.name == "cosine":
            cost = -(questions * corpus).sum(axis=1)
        else:
            cost = np.square(questions - corpus).sum(axis=1)
        return np.round(cost, SCORE_DIGITS) + 0.0


METRICS = {"cosine": Metric("cosine"), "l2": Metric("l2")}


def _dense(rows: pd.Series, dims: int) -> np.ndarray:
    """Vectors as a matrix, shorter ones filled with zeros."""
    matrix = np.zeros((len(rows), dims))
    if len(rows) and rows.map(len).max() > dims:
        raise ValueError(f"a vector is longer than the {dims} dimensions given")
    if len(rows) and (rows.map(len) == dims).all():
        matrix[:] = np.stack(rows.to_list())
    else:
        for i, row in enumerate(rows):
            matrix[i, : len(row)] = row
    return matrix

CORPUS, QUESTION = 0, 1


def _distances(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    squares = np.square(rows).sum(axis=1)[:, None] + np.square(pivots).sum(axis=1)[None, :]
    return np.sqrt(np.maximum(squares - 2.0 * rows @ pivots.T, 0.0))


def _best(found: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k cheapest hits of each question, ties by lower id."""
    found = found.sort_values(["question_id", "cost", "corpus_id"], kind="stable")
    return found[found.groupby("question_id").cumcount() < k]


def _codes(ids: np.ndarray) -> np.ndarray:
    """The place of each id in the order of ids, missing ones last."""
    codes, names = pd.factorize(ids, sort=True)
    return np.where(codes < 0, len(names), codes)


def _same(asked: np.ndarray, stored: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of places with the same id."""
    both = pd.factorize(np.concatenate([asked, stored]), use_na_sentinel=asked.dtype != object)[0]
    left, right = both[: len(asked)], both[len(asked) :]
    order = np.argsort(right, kind="stable")
    low, high = (np.searchsorted(right[order], left, side) for side in ("left", "right"))
    n = np.where(left < 0, 0, high - low)
    asks = np.repeat(np.arange(len(left)), n)
    return asks, order[np.repeat(low, n) + np.arange(len(asks)) - np.repeat(np.cumsum(n) - n, n)]


class _Block:
    """Corpus vectors that questions meet, prepared once for all of them."""

    def __init__(self, metric: Metric, k: int, ids: np.ndarray, rows: np.ndarray) -> None:
        self.metric, self.k, self.ids, self.rows = metric, k, ids, rows
        self.good = np.isfinite(rows).all(axis=1)
        self.fast = metric.quick(rows)
        self.sound = self.fast if self.good.all() else self.fast[self.good]
        self.order = _codes(ids)

    def topk(
        self, question_ids: np.ndarray, questions: np.ndarray, skip_same_id: bool,
        visits: list[tuple[np.ndarray, np.ndarray]] | None = None,
    ) -> pd.DataFrame:
        """The k best rows of the block for each question, by ``cost``: lower is better.

        Both sides are plain matrices. Matrix products only select, against the best values a
        question has so far; what is reported is computed pair by pair, so it does not depend
        on the block. ``visits`` lists corpus rows and the questions that may meet them, by
        default all. A vector with a component that is not finite takes no part.
        """
        metric, k, corpus, fast_corpus, order = self.metric, self.k, self.rows, self.fast, self.order
        finite = np.isfinite(questions).all(axis=1)
        asks_all, rows_all = np.flatnonzero(finite), np.flatnonzero(self.good)
        fast_questions = metric.quick(questions)
        margin = metric.margin(fast_questions[finite], self.sound)
        best = np.full((len(questions), k), -np.inf)
        twins = _same(question_ids, self.ids) if skip_same_id else None
        column = np.full(len(corpus), -1)
        line = np.full(len(questions), -1)
        done = pd.DataFrame({"ask": np.zeros(0, int), "row": np.zeros(0, int), "order": np.zeros(0, int), "cost": np.zeros(0)})
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        # products and what passes go to the same memory again: new pages cost as much as half a product
        products, passing = np.empty(SLICE_ROWS * SLICE_CORPUS_ROWS, fast_corpus.dtype), np.zeros(SLICE_ROWS * SLICE_CORPUS_ROWS + 7, bool)

        def settle(done: pd.DataFrame) -> pd.DataFrame:
            """Score what is held exactly, the k best of each question are left."""
            asks, rows, value = (np.concatenate(x) for x in zip(*held)) if held else (np.zeros(0, int),) * 3
            held.clear()
            near = value >= best[asks, -1] - margin
            asks, rows = asks[near], rows[near]
            parts = [done]
            for i in range(0, len(asks), PAIR_ROWS):
                a, r = asks[i : i + PAIR_ROWS], rows[i : i + PAIR_ROWS]
                extra = 2 if metric.name == "cosine" else 0
                cost = metric.pair_costs(metric.place(questions[a], extra, QUESTION), metric.place(corpus[r], extra, CORPUS))
                parts.append(pd.DataFrame({"ask": a, "row": r, "order": order[r], "cost": cost}))
            found = pd.concat(parts).sort_values(["ask", "cost", "order", "row"])
            return found[found.groupby("ask").cumcount() < k]

        for rows_, asks_ in visits if visits is not None else [(rows_all, asks_all)]:
            if visits is not None:
                rows_, asks_ = rows_[self.good[rows_]], asks_[finite[asks_]]
            for at in range(0, len(asks_) if len(rows_) else 0, SLICE_ROWS):
                asks = asks_[at : at + SLICE_ROWS]
                part = fast_questions[asks]
                for start in range(0, len(rows_), SLICE_CORPUS_ROWS):
                    rows = rows_[start : start + SLICE_CORPUS_ROWS]
                    size = len(asks) * len(rows)
                    value = metric.values(
                        part, fast_corpus[rows[0] : rows[-1] + 1] if rows[-1] - rows[0] + 1 == len(rows) else fast_corpus[rows],
                        products[:size].reshape(len(asks), len(rows)),
                    )
                    if twins is not None:
                        line[asks], column[rows] = np.arange(len(asks)), np.arange(len(rows))
                        x, y = line[twins[0]], column[twins[1]]
                        met = (x >= 0) & (y >= 0)
                        value[x[met], y[met]] = -np.inf
                        line[asks], column[rows] = -1, -1
                    limit = best[asks, -1]
                    if len(rows) >= k and np.isneginf(limit).any():
                        limit = np.maximum(limit, np.partition(value, len(rows) - k, axis=1)[:, len(rows) - k])
                    np.greater_equal(
                        value, (limit - margin).astype(value.dtype)[:, None], out=passing[:size].reshape(len(asks), len(rows))
                    )
                    passing[size : size + 7] = False
                    # few pass: eight are looked at together
                    eights = np.flatnonzero(passing[: (size + 7) // 8 * 8].view(np.uint64))
                    places = (8 * eights[:, None] + np.arange(8)).ravel()
                    x, y = np.divmod(places[passing[places]], len(rows))
                    found = value[x, y].astype(float)
                    if twins is not None:
                        real = found > -np.inf
                        x, y, found = x[real], y[real], found[real]
                    if not len(x):
                        continue
                    by_value = np.lexsort((-found, x))
                    xs = x[by_value]
                    nth = np.arange(len(xs)) - np.searchsorted(xs, xs)
                    top = nth < k
                    fresh = np.full((len(asks), k), -np.inf)
                    fresh[xs[top], nth[top]] = found[by_value][top]
                    best[asks] = -np.sort(-np.concatenate([best[asks], fresh], axis=1), axis=1)[:, :k]
                    held.append((asks[x], rows[y], found))
                    if sum(len(h[0]) for h in held) > HELD_PAIRS:
                        done = settle(done)
        done = settle(done)
        return pd.DataFrame({
            "question_id": question_ids[done["ask"].to_numpy()], "corpus_id": self.ids[done["row"].to_numpy()],
            "cost": done["cost"].to_numpy(),
        })


def _block_topk(
    metric: Metric, k: int, corpus_ids: np.ndarray, corpus: np.ndarray,
    question_ids: np.ndarray, questions: np.ndarray, skip_same_id: bool,
    visits: list[tuple[np.ndarray, np.ndarray]] | None = None,
) -> pd.DataFrame:
    """The k best corpus rows of one block for each question (:meth:`_Block.topk`)."""
    return _Block(metric, k, corpus_ids, corpus).topk(question_ids, questions, skip_same_id, visits)


def _as_hits(found: pd.DataFrame, metric: Metric) -> pd.DataFrame:
    sign = 1.0 if metric.ascending else -1.0
    return found.assign(score=sign * found["cost"].astype(float) + 0.0)[list(_HIT_COLUMNS)]


_HIT_COLUMNS = ("question_id", "corpus_id", "score")


def _hit_schema(id_type: T.DataType, corpus_id_type: T.DataType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("question_id", id_type),
            T.StructField("corpus_id", corpus_id_type),
            T.StructField("score", T.DoubleType()),
        ]
    )


def _side(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    return df.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"))


def _longest(df: DataFrame) -> int:
    return df.agg(F.max(F.size("vector"))).first()[0] or 0


def _rank(hits: DataFrame, k: int, metric: Metric, merges: int = 1) -> DataFrame:
    """Merge block results. The rank limit runs before the shuffle as well.

    With ``merges`` above 1 the hits of a question first meet in so many parts, so
    that no task gets k rows from every partition of a large corpus.
    """
    score = F.col("score").asc() if metric.ascending else F.col("score").desc()
    best = lambda keys: F.row_number().over(
        Window.partitionBy(*keys).orderBy(score, F.col("corpus_id").asc())
    )
    if merges > 1:
        parted = hits.withColumn("_part", F.pmod(F.spark_partition_id(), F.lit(merges)))
        hits = parted.withColumn("rank", best(["question_id", "_part"])).where(F.col("rank") <= k).drop("rank", "_part")
    return hits.withColumn("rank", best(["question_id"])).where(F.col("rank") <= k)


def pick_route(n_asked: int, n_stored: int, k: int, dims: int) -> str:
    """One scan of the corpus for few questions, otherwise a grid of question and corpus blocks.

    The grid keeps the questions in the executors. The cells shuffle all vectors as well
    and prune only where the data have few true dimensions, so they run only when asked for.
    """
    few = n_asked <= SCAN_QUESTIONS and n_asked * (dims + 2) * 8 <= MAX_BROADCAST_BYTES
    return "scan" if few else "grid"


def topk(
    questions: DataFrame,
    corpus: DataFrame,
    k: int = DEFAULT_K,
    metric: str = "l2",
    question_id: str = "question_id",
    question_vector: str = "embedding",
    corpus_id: str = "corpus_id",
    corpus_vector: str = "embedding",
    where: Column | None = None,
    skip_same_id: bool = False,
    dims: int | None = None,
    route: str | None = None,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Exact k nearest corpus rows of every question: ``(question_id, corpus_id, score, rank)``.

    ``where`` restricts the corpus before anything is scored. ``dims`` is the
    longest vector on either side; giving it spares a scan of both tables.
    ``route`` forces ``"grid"``, ``"passes"`` or ``"cells"``; by default the checked sizes
    decide, and a forced ``"scan"`` of too many questions is cut into passes as well.
    """
    kind = METRICS[metric]
    if where is not None:
        corpus = corpus.where(where)
    asked = _side(questions, question_id, question_vector)
    stored = _side(corpus, corpus_id, corpus_vector)
    n_asked, n_stored = questions.count(), corpus.count()
    dims = dims or max(_longest(asked), _longest(stored))
    asked, stored = (side.where(F.col("vector").isNotNull()) for side in (asked, stored))
    schema = _hit_schema(questions.schema[question_id].dataType, corpus.schema[corpus_id].dataType)
    if not (n_asked and n_stored and dims):
        empty = questions.sparkSession.createDataFrame([], schema)
        return empty.withColumn("rank", F.lit(1))
    route = route or pick_route(n_asked, n_stored, k, dims)
    if route == "cells":
        return _rank(_cells(asked, n_asked, stored, n_stored, k, kind, dims, schema, skip_same_id), k, kind)
    merges = math.isqrt(1 + n_stored * dims * 4 // SCAN_PARTITION_BYTES)
    if route == "grid":
        return _rank(_grid(asked, n_asked, stored, n_stored, k, kind, dims, schema, skip_same_id), k, kind)
    passes = max(1, math.ceil(n_asked * (dims + 2) * 8 / max_broadcast_bytes))
    slice_no = F.pmod(F.xxhash64("id"), F.lit(passes))
    parts = [
        _scan(asked.where(slice_no == i) if passes > 1 else asked, stored, k, kind, dims, schema, skip_same_id)
        for i in range(passes)
    ]
    return _rank(reduce(DataFrame.unionAll, parts), k, kind, merges)


def _scan(
    asked: DataFrame, stored: DataFrame, k: int, metric: Metric, dims: int,
    schema: T.StructType, skip_same_id: bool,
) -> DataFrame:
    """Score the corpus where it lies against questions of a checked size."""
    local = asked.toPandas()
    shared = asked.sparkSession.sparkContext.broadcast(
        (local["id"].to_numpy(), _dense(local["vector"], dims))
    )

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, matrix = shared.value
        best = None
        for batch in batches:
            if len(batch):
                rows = _dense(batch["vector"], dims)
                found = _block_topk(
                    metric, k, batch["id"].to_numpy(), rows, ids, matrix, skip_same_id
                )
                best = found if best is None else _best(pd.concat([best, found]), k)
        if best is not None:
            yield _as_hits(best, metric)

    return stored.mapInPandas(score, schema)


# --- grid route ------------------------------------------------------------------


def _grid(
    asked: DataFrame, n_asked: int, stored: DataFrame, n_stored: int, k: int, metric: Metric, dims: int,
    schema: T.StructType, skip_same_id: bool,
) -> DataFrame:
    """Cut both sides into blocks; a task holds one of the corpus and lets the questions of another pass.

    What is shuffled is every vector once for each block of the other side, and k hits of a
    question for each block of the corpus. Only one side is held as numbers for matrix
    products, and the packs of both are bytes where they can be, so blocks have twice the rows
    of those of the cells.
    """
    cores = asked.sparkSession.sparkContext.defaultParallelism
    question_blocks = _cut(math.ceil(n_asked / 2), QUESTION_BLOCK_ROWS, dims, 1, 1)
    blocks = _cut(math.ceil(n_stored / 2), BLOCK_ROWS, dims, question_blocks, cores)

    def packed(side: DataFrame, count: int) -> DataFrame:
        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows, dealt = _matrix(batch.column("vector"), dims), batch.column("hash").to_numpy() % count
                for b in np.unique(dealt):
                    for part, number, raw in _packs(rows, np.flatnonzero(dealt == b)):
                        ids = batch.column("id").take(pa.array(part))
                        listed = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([b], pa.int32()), listed, pa.array([number]), pa.array([raw], pa.binary())],
                            names=["own", "ids", "kind", "vectors"],
                        )

        hashed = (F.xxhash64("id") % (1 << 30) + (1 << 30)).alias("hash")  # of a missing id as well
        kind = f"own int, ids array<{side.schema['id'].dataType.simpleString()}>, kind string, vectors binary"
        return side.select("id", "vector", hashed).mapInArrow(pack, kind)

    def score(corpus: pa.Table, questions: pa.Table) -> pa.Table:
        target = pa.schema([
            pa.field("question_id", questions.schema.field("ids").type.value_type),
            pa.field("corpus_id", corpus.schema.field("ids").type.value_type), pa.field("score", pa.float64()),
        ])
        if not (corpus.num_rows and questions.num_rows):
            return target.empty_table()
        block, found = _Block(metric, k, *_unpacked(corpus, dims)), []
        ends = np.cumsum(pc.list_value_length(questions["ids"]).to_numpy())
        at = 0
        while at < len(ends):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PASSING_ROWS, side="right")))
            found.append(block.topk(*_unpacked(questions.slice(at, to - at), dims), skip_same_id))
            at = to
        return pa.concat_tables(pa.Table.from_pandas(_as_hits(x, metric), target, preserve_index=False) for x in found)

    keys, tasks = ("block", "question_block"), min(2 * blocks * question_blocks, 4096)
    left = packed(stored, blocks).withColumnRenamed("own", "block")
    left = left.withColumn("question_block", F.explode(F.sequence(F.lit(0), F.lit(question_blocks - 1))))
    right = packed(asked, question_blocks).withColumnRenamed("own", "question_block")
    right = right.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    left, right = left.repartition(tasks, *keys), right.repartition(tasks, *keys)
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(score, schema)


# --- cell route ------------------------------------------------------------------


def choose_pivots(stored: DataFrame, count: int, metric: Metric, dims: int) -> np.ndarray:
    """``count`` corpus vectors in hash order: spread over the data, the same each run."""
    order = F.md5(F.col("id").cast("string").cast("binary"))
    picked = stored.orderBy(order, "id").limit(count).toPandas()
    return metric.prepare(picked["vector"], dims, CORPUS)


def _with_cell(df: DataFrame, pivots: np.ndarray, metric: Metric, dims: int) -> DataFrame:
    shared = df.sparkSession.sparkContext.broadcast(pivots)

    @F.pandas_udf("cell int, distance double")
    def nearest(vectors: pd.Series) -> pd.DataFrame:
        gaps = np.round(
            _distances(metric.prepare(vectors, dims, CORPUS), shared.value), SCORE_DIGITS
        )
        cells = gaps.argmin(axis=1)
        return pd.DataFrame(
            {"cell": cells.astype(np.int32), "distance": gaps[np.arange(len(cells)), cells]}
        )

    found = df.withColumn("nearest", nearest("vector"))
    return found.select("id", "vector", "nearest.cell", "nearest.distance")


def _cell_limits(placed: DataFrame, k: int) -> pd.DataFrame:
    """Per cell: rows, radius and the k smallest distances. One row per pivot."""
    order = Window.partitionBy("cell").orderBy("distance")
    near = (
        placed.select("cell", "distance")
        .withColumn("rn", F.row_number().over(order))
        .where(F.col("rn") <= k)
        .groupBy("cell")
        .agg(F.array_sort(F.collect_list("distance")).alias("near"))
    )
    size = placed.groupBy("cell").agg(
        F.count(F.lit(1)).alias("n"), F.max("distance").alias("radius")
    )
    return size.join(near, "cell").toPandas()


def _route_exact(pivots: np.ndarray, limits: pd.DataFrame, k: int):
    """Cells that can hold one of a question's k nearest, as a function of its vector."""
    cells = limits["cell"].to_numpy()
    radius = limits["radius"].to_numpy()
    near = np.full((len(cells), k), np.inf)
    for i, row in enumerate(limits["near"]):
        near[i, : len(row)] = row
    own = pivots[cells]
    between = _distances(own, own)
    longest = np.sqrt(np.square(own).sum(axis=1)).max() + radius.max()

    def visit(rows: np.ndarray) -> list[np.ndarray]:
        gaps = _distances(rows, own)
        reach = gaps[:, :, None] + near[None, :, :]
        reach = reach.reshape(len(rows), -1)
        # one more than k, so a question that skips itself still has k left
        wanted = min(k, reach.shape[1]) - 1
        limit = np.partition(reach, wanted, axis=1)[:, wanted]
        home = gaps.argmin(axis=1)
        home_gap = gaps[np.arange(len(rows)), home]
        with np.errstate(divide="ignore", invalid="ignore"):
            plane = (np.square(gaps) - np.square(home_gap)[:, None]) / (2.0 * between[home])
        plane[~np.isfinite(plane)] = 0.0
        floor = np.maximum(gaps - radius[None, :], plane)
        slack = _SLACK * (1.0 + np.sqrt(np.square(rows).sum(axis=1)) + longest)
        open_cells = floor <= (limit + slack)[:, None]
        return [cells[mask] for mask in open_cells]

    return visit


def _route_nearest(pivots: np.ndarray, limits: pd.DataFrame, probes: int):
    """The ``probes`` non-empty cells with the nearest pivots."""
    cells = np.sort(limits["cell"].to_numpy())
    own = pivots[cells]

    def visit(rows: np.ndarray) -> list[np.ndarray]:
        gaps = np.round(_distances(rows, own), SCORE_DIGITS)
        order = np.argsort(gaps, axis=1, kind="stable")[:, :probes]
        return [cells[row] for row in order]

    return visit


def _cells(
    asked: DataFrame, n_asked: int, stored: DataFrame, n_stored: int, k: int, metric: Metric, dims: int,
    schema: T.StructType, skip_same_id: bool,
) -> DataFrame:
    count = min(MAX_PIVOTS, max(1, math.isqrt(n_stored)))
    pivots = choose_pivots(stored, count, metric, dims)
    placed = materialize(_with_cell(stored, pivots, metric, dims), "cells")
    limits = _cell_limits(placed, k + 1)
    visit = _route_exact(pivots, limits, k + 1)
    return _visit_cells(asked, n_asked, placed, limits, visit, k, metric, dims, schema, skip_same_id)


def _matrix(vectors: pa.Array, dims: int) -> np.ndarray:
    """A column of vectors as a matrix."""
    flat, ends = vectors.flatten(), np.asarray(vectors.value_lengths())
    wide = np.float64 if flat.type == pa.float64() else np.float32 if flat.type in (pa.float32(), pa.int8(), pa.int16()) else np.float64
    if (ends == dims).all() and not flat.null_count:
        return flat.to_numpy(zero_copy_only=False).reshape(len(vectors), dims).astype(wide)
    return _dense(vectors.to_pandas(), dims).astype(wide)


def _packs(rows: np.ndarray, picked: np.ndarray) -> Iterator[tuple[np.ndarray, str, bytes]]:
    """Some rows of a matrix cut into packs: (places, kind of number, bytes).

    Rows of whole numbers up to 255 take a byte each, up to 65,535 two, in packs of their own.
    """
    left = picked
    for kind in (np.uint8, np.uint16, rows.dtype):
        mine = rows[left]
        with np.errstate(invalid="ignore"):
            made = mine.astype(kind)
        fits = np.ones(len(made), dtype=bool) if kind is rows.dtype else (made == mine).all(axis=1)
        places, made = left[fits], made[fits]
        left = left[~fits]
        step = max(1, PACK_BYTES // max(1, made.itemsize * made.shape[1]))
        for start in range(0, len(places), step):
            yield places[start : start + step], made.dtype.str, made[start : start + step].tobytes()
        if not len(left):
            break


def _unpacked(packs: pa.Table, dims: int) -> tuple[np.ndarray, np.ndarray]:
    parts = [
        np.frombuffer(raw.as_buffer(), dtype=kind.as_py()).reshape(-1, dims)
        for raw, kind in zip(packs["vectors"], packs["kind"])
    ]
    ids = packs["ids"].combine_chunks().flatten()
    return ids.to_pandas().to_numpy(), np.concatenate(parts)


def _cut(rows: int, most: int, dims: int, others: int, cores: int) -> int:
    """The number of blocks of a side: bounded in rows and bytes, more where cores would idle."""
    most = max(1, min(most, BLOCK_BYTES // (8 * max(1, dims))))
    needed = max(1, math.ceil(rows / most))
    return max(needed, min(math.ceil(3 * cores / others), math.ceil(rows / min(most, SMALL_BLOCK_ROWS))))


def _visit_cells(
    asked: DataFrame, n_asked: int, placed: DataFrame, limits: pd.DataFrame, visit, k: int, metric: Metric,
    dims: int, schema: T.StructType, skip_same_id: bool,
) -> DataFrame:
    """Send questions to cells, cut both sides into blocks and score block by block.

    Small cells share a block, large ones are cut, so a question travels once per block and
    not once per cell; inside a block it meets the rows of the cells it visits. Vectors
    travel in packs.
    """
    cores = asked.sparkSession.sparkContext.defaultParallelism
    question_blocks = _cut(n_asked, QUESTION_BLOCK_ROWS, dims, 1, 1)
    blocks = _cut(int(limits["n"].sum()), BLOCK_ROWS, dims, question_blocks, cores)
    room = math.ceil(limits["n"].sum() / blocks)
    first, parts, used, free = {}, {}, 0, 0  # of each cell: its first block and how many it has
    for cell, n in zip(limits["cell"].astype(int), limits["n"].astype(int)):
        if n > free:
            parts[cell], first[cell] = max(1, math.ceil(n / room)), used
            used += parts[cell]
            free = parts[cell] * room - n if parts[cell] == 1 else 0
        else:
            parts[cell], first[cell] = 1, used - 1
            free -= n
    blocks = used
    lies_in = [sorted(c for c in first if first[c] <= b < first[c] + parts[c]) for b in range(blocks)]
    hashed = (F.xxhash64("id") % (1 << 30) + (1 << 30)).alias("hash")  # of a missing id as well
    kind = "block int, ids array<{}>, kind string, vectors binary, cells array<int>"

    def packed(block: int, batch: pa.RecordBatch, part: np.ndarray, number: str, raw: bytes, cells: np.ndarray):
        ids = batch.column("id").take(pa.array(part))
        offsets = lambda n: pa.array([0, n], pa.int32())
        return [
            pa.array([block], pa.int32()), pa.ListArray.from_arrays(offsets(len(ids)), ids), pa.array([number]),
            pa.array([raw], pa.binary()), pa.ListArray.from_arrays(offsets(len(cells)), pa.array(cells, pa.int32())),
        ]

    names = ["block", "ids", "kind", "vectors", "cells"]

    def pack_corpus(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = batch.column("cell").to_numpy(zero_copy_only=False).astype(int)
            dealt = batch.column("hash").to_numpy()
            block = np.array([first[c] + h % parts[c] for c, h in zip(cells, dealt)], dtype=int)
            rows = _matrix(batch.column("vector"), dims)
            for b in np.unique(block):
                for part, number, raw in _packs(rows, np.flatnonzero(block == b)):
                    yield pa.RecordBatch.from_arrays(packed(b, batch, part, number, raw, cells[part]), names)

    def pack_questions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """``block`` is the block of questions here, ``cells`` holds the corpus blocks a pack goes to."""
        for batch in batches:
            dealt = batch.column("hash").to_numpy() % question_blocks
            rows = _matrix(batch.column("vector"), dims)
            goes_to = [
                np.unique(np.concatenate([np.arange(first[int(c)], first[int(c)] + parts[int(c)]) for c in found]))
                for start in range(0, len(rows), SLICE_ROWS)
                for found in visit(metric.place(rows[start : start + SLICE_ROWS].astype(float), 2 if metric.name == "cosine" else 0, QUESTION))
            ]
            ways: dict[tuple, list[int]] = {}
            for i, found in enumerate(goes_to):
                ways.setdefault((int(dealt[i]), found.tobytes()), []).append(i)
            if len(ways) > blocks * question_blocks:  # few agree in all their blocks: one pack for each block
                ways = {}
                for i, found in enumerate(goes_to):
                    for b in found:
                        ways.setdefault((int(dealt[i]), np.array([b]).tobytes()), []).append(i)
            for (q, to), mine in ways.items():
                to_blocks = np.frombuffer(to, dtype=int)
                for part, number, raw in _packs(rows, np.array(mine)):
                    yield pa.RecordBatch.from_arrays(packed(q, batch, part, number, raw, to_blocks), names)

    types = [side.schema["id"].dataType.simpleString() for side in (placed, asked)]
    left = placed.select("id", "vector", "cell", hashed).mapInArrow(pack_corpus, kind.format(types[0]))
    left = left.withColumn("question_block", F.explode(F.sequence(F.lit(0), F.lit(question_blocks - 1))))
    right = asked.select("id", "vector", hashed).mapInArrow(pack_questions, kind.format(types[1]))
    right = right.select(F.explode("cells").alias("_to"), F.col("block").alias("question_block"), "ids", "kind", "vectors")
    right = right.withColumnRenamed("_to", "block")

    def score(corpus: pa.Table, questions: pa.Table) -> pa.Table:
        target = pa.schema([
            pa.field("question_id", questions.schema.field("ids").type.value_type),
            pa.field("corpus_id", corpus.schema.field("ids").type.value_type), pa.field("score", pa.float64()),
        ])
        if not (corpus.num_rows and questions.num_rows):
            return target.empty_table()
        corpus_ids, rows = _unpacked(corpus, dims)
        question_ids, asks = _unpacked(questions, dims)
        home = corpus["cells"].combine_chunks().flatten().to_numpy()
        placed_rows = metric.place(asks, 2 if metric.name == "cosine" else 0, QUESTION)
        guests: dict[int, list[int]] = {int(c): [] for c in lies_in[corpus["block"][0].as_py()]}
        for start in range(0, len(asks), SLICE_ROWS):
            for i, found in enumerate(visit(placed_rows[start : start + SLICE_ROWS]), start):
                for c in found:
                    if int(c) in guests:
                        guests[int(c)].append(i)
        same: dict[bytes, list[int]] = {}  # cells with the same guests are scored together
        for c, mine in guests.items():
            same.setdefault(np.array(mine, dtype=int).tobytes(), []).append(c)
        visits = [(np.flatnonzero(np.isin(home, cells)), np.frombuffer(mine, dtype=int)) for mine, cells in same.items()]
        found = _block_topk(metric, k, corpus_ids, rows, question_ids, asks, skip_same_id, visits)
        return pa.Table.from_pandas(_as_hits(found, metric), target, preserve_index=False)

    tasks = min(2 * blocks * question_blocks, 4096)
    keys = ("block", "question_block")
    left, right = left.repartition(tasks, *keys), right.repartition(tasks, *keys)
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(score, schema)


def topk_approx(
    questions: DataFrame,
    corpus: DataFrame,
    k: int = DEFAULT_K,
    metric: str = "l2",
    pivots: int = 16,
    probes: int = 4,
    question_id: str = "question_id",
    question_vector: str = "embedding",
    corpus_id: str = "corpus_id",
    corpus_vector: str = "embedding",
    skip_same_id: bool = False,
    dims: int | None = None,
) -> DataFrame:
    """Approximate neighbours: each question visits only its ``probes`` nearest cells.

    Scores inside the visited cells are exact, so a hit is never misreported;
    only neighbours in other cells can be missed.
    """
    if not 1 <= pivots <= MAX_PIVOTS:
        raise ValueError(f"pivots must lie in 1..{MAX_PIVOTS}")
    kind = METRICS[metric]
    asked = _side(questions, question_id, question_vector)
    stored = _side(corpus, corpus_id, corpus_vector)
    dims = dims or max(_longest(asked), _longest(stored))
    asked, stored = (side.where(F.col("vector").isNotNull()) for side in (asked, stored))
    schema = _hit_schema(questions.schema[question_id].dataType, corpus.schema[corpus_id].dataType)
    centres = choose_pivots(stored, pivots, kind, dims)
    placed = materialize(_with_cell(stored, centres, kind, dims), "cells")
    limits = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).toPandas()
    visit = _route_nearest(centres, limits, probes)
    hits = _visit_cells(asked, asked.count(), placed, limits, visit, k, kind, dims, schema, skip_same_id)
    return _rank(hits, k, kind)


def recall(exact: DataFrame, approximate: DataFrame) -> DataFrame:
    """Share of the exact neighbours that the approximate result found."""
    keys = ["question_id", "corpus_id"]
    found = approximate.select(*keys, F.lit(1).alias("found"))
    return exact.join(found, keys, "left").agg(
        F.count(F.lit(1)).alias("exact_hits"),
        F.count("found").alias("found_hits"),
        (F.count("found") / F.count(F.lit(1))).alias("recall"),
    )


# --- stored index ------------------------------------------------------------------


def build_index(
    corpus: DataFrame, path: str, metric: str = "l2", pivots: int | None = None,
    corpus_id: str = "corpus_id", corpus_vector: str = "embedding", dims: int | None = None, k: int = DEFAULT_K,
) -> None:
    """Store the corpus vectors by their nearest pivot, and the pivots, below ``path``.

    The number of pivots grows with the root of the corpus up to ``MAX_PIVOTS``,
    unless it is given. Vectors are written once; every search reopens them. How many
    cells a search visits is measured here (:func:`calibrate`) and stored with the pivots,
    which are written last, so a build that died is simply no index yet.
    """
    kind, stored = METRICS[metric], _side(corpus, corpus_id, corpus_vector).where(F.col("vector").isNotNull())
    dims = dims or _longest(stored)
    count = pivots or min(MAX_PIVOTS, max(1, math.isqrt(stored.count())))
    centres = choose_pivots(stored, count, kind, dims)
    _with_cell(stored, centres, kind, dims).select("id", "vector", "cell").write.mode("overwrite").partitionBy("cell").parquet(f"{path}/cells")
    cells = corpus.sparkSession.read.parquet(f"{path}/cells")
    filled = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    probes = calibrate(cells, centres, filled.toPandas(), metric, dims, k)
    rows = [(i, row.tolist(), dims, metric, probes) for i, row in enumerate(centres)]  # one row per pivot
    table = corpus.sparkSession.createDataFrame(rows, "cell int, pivot array<double>, dims int, metric string, probes int")
    table.join(filled, "cell", "left").coalesce(1).write.mode("overwrite").parquet(f"{path}/pivots")


def calibrate(cells: DataFrame, pivots: np.ndarray, limits: pd.DataFrame, metric: str, dims: int, k: int) -> int:
    """The number of nearest cells in which ``CALIBRATION_SHARE`` percent of the true neighbours lie.

    Measured on the neighbours of ``CALIBRATION_ROWS`` corpus vectors, the last in hash
    order, by exact search over the whole corpus.
    """
    order = F.md5(F.col("id").cast("string").cast("binary"))
    sample = materialize(cells.select("id", "vector").orderBy(order.desc(), F.desc("id")).limit(CALIBRATION_ROWS), "sample")
    hits = topk(
        sample, cells, k, metric, question_id="id", question_vector="vector", corpus_id="id", corpus_vector="vector",
        skip_same_id=True, dims=dims,
    )
    homes = hits.join(cells.select(F.col("id").alias("corpus_id"), "cell"), "corpus_id").select("question_id", "cell").toPandas()
    asked = sample.toPandas()  # at most CALIBRATION_ROWS
    visited = _route_nearest(pivots, limits, len(limits))(METRICS[metric].prepare(asked["vector"], dims, QUESTION))
    place = {(i, int(c)): n + 1 for i, row in zip(asked["id"], visited) for n, c in enumerate(row)}
    places = sorted(place[i, int(c)] for i, c in zip(homes["question_id"], homes["cell"]))
    return places[-(-CALIBRATION_SHARE * len(places) // 100) - 1] if places else 1


class Index:
    """An opened index: the pivots in memory, the vectors where they are stored."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        pivots = spark.read.parquet(f"{path}/pivots").toPandas().sort_values("cell")
        self.cells = spark.read.parquet(f"{path}/cells")
        self.metric, self.dims = METRICS[pivots["metric"].iloc[0]], int(pivots["dims"].iloc[0])
        self.pivots, self.filled = np.stack(pivots["pivot"].to_list()), pivots[pivots["n"].notna()][["cell", "n"]]
        self.probes = int(pivots["probes"].iloc[0])

    def search(
        self, questions: DataFrame, k: int = DEFAULT_K, probes: int | None = None, question_id: str = "question_id",
        question_vector: str = "embedding", skip_same_id: bool = False,
    ) -> DataFrame:
        """The k nearest rows of each question among its ``probes`` nearest cells, by default as calibrated.

        Up to ``SCAN_QUESTIONS`` questions go to the cells where they are stored, nothing
        is written, and only visited cells are read. More meet the cells block by block.
        """
        asked = _side(questions, question_id, question_vector).where(F.col("vector").isNotNull())
        schema = _hit_schema(questions.schema[question_id].dataType, self.cells.schema["id"].dataType)
        visit = _route_nearest(self.pivots, self.filled, probes or self.probes)
        first = asked.limit(SCAN_QUESTIONS + 1).toPandas()
        if len(first) <= SCAN_QUESTIONS:
            return _rank(self._scan(first, visit, k, schema, skip_same_id), k, self.metric)
        hits = _visit_cells(
            asked, asked.count(), self.cells, self.filled, visit, k, self.metric, self.dims, schema, skip_same_id
        )
        return _rank(hits, k, self.metric)

    def _scan(self, local: pd.DataFrame, visit, k: int, schema: T.StructType, skip_same_id: bool) -> DataFrame:
        metric, dims = self.metric, self.dims
        matrix = metric.prepare(local["vector"], dims, QUESTION)
        dense = _dense(local["vector"], dims)
        visited = visit(matrix) if len(matrix) else []
        wanted = sorted({int(c) for cells in visited for c in cells})
        asks = {c: np.array([i for i, cells in enumerate(visited) if c in cells]) for c in wanted}
        shared = self.cells.sparkSession.sparkContext.broadcast((local["id"].to_numpy(), dense, asks))

        def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            ids, questions, by_cell = shared.value
            best = None
            for batch in batches:
                for cell, rows in batch.groupby("cell"):
                    mine = by_cell[cell]
                    found = _block_topk(
                        metric, k, rows["id"].to_numpy(), _dense(rows["vector"], dims),
                        ids[mine], questions[mine], skip_same_id,
                    )
                    best = found if best is None else _best(pd.concat([best, found]), k)
            if best is not None:
                yield _as_hits(best, metric)

        return self.cells.where(F.col("cell").isin(wanted)).mapInPandas(score, schema)
