import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from quaero.functions.vectors import cosine, hash_embed, squared_l2
from quaero.operators import knn


def frame(spark, vectors, name):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, f"{name} bigint, embedding array<double>").repartition(4)


def brute(questions, corpus, k, metric, skip=False):
    out = set()
    for q, a in enumerate(questions):
        scored = []
        for c, b in enumerate(corpus):
            if skip and q == c:
                continue
            if metric == "l2":
                scored.append((round(float(np.square(np.subtract(a, b)).sum()), 10), c))
            else:
                size = np.linalg.norm(a) * np.linalg.norm(b)
                scored.append((-round(float(np.dot(a, b) / size), 10) if size else 0.0, c))
        out |= {(q, c, rank) for rank, (_, c) in enumerate(sorted(scored)[:k], 1)}
    return out


def found(df):
    return {(r.question_id, r.corpus_id, r["rank"]) for r in df.collect()}


def crowded(seed, n=300, dims=6):
    """A third of the vectors sit in one spot, some of them equal; some are zero."""
    rng = np.random.default_rng(seed)
    vectors = np.round(rng.normal(size=(n, dims)), 3)
    vectors[: n // 3] = np.round([1, 2, 3, 0, 0, 0] + rng.normal(scale=0.01, size=(n // 3, dims)), 2)
    vectors[5:12] = vectors[4]
    vectors[[n // 2, n - 1]] = 0
    return vectors


@pytest.mark.parametrize("metric", ["cosine", "l2"])
@pytest.mark.parametrize("route", ["scan", "cells"])
def test_both_routes_are_exact(spark, monkeypatch, metric, route):
    monkeypatch.setattr(knn, "BLOCK_ROWS", 40)
    monkeypatch.setattr(knn, "QUESTION_BLOCK_ROWS", 30)
    corpus, questions = crowded(1), crowded(2, 90)
    got = knn.topk(frame(spark, questions, "question_id"), frame(spark, corpus, "corpus_id"), 4, metric, route=route)
    assert found(got) == brute(questions, corpus, 4, metric)


@pytest.mark.parametrize("route", ["scan", "cells"])
def test_self_join_skips_the_question(spark, route):
    vectors = crowded(3, 120)
    got = knn.topk(
        frame(spark, vectors, "question_id"), frame(spark, vectors, "corpus_id"), 3, "cosine",
        skip_same_id=True, route=route,
    )
    assert found(got) == brute(vectors, vectors, 3, "cosine", skip=True)


def test_fewer_rows_than_k_and_empty_sides(spark):
    questions, corpus = frame(spark, [[1, 0]], "question_id"), frame(spark, [[0, 1], [1, 1]], "corpus_id")
    assert [(r.corpus_id, r["rank"]) for r in knn.topk(questions, corpus, 5, "l2").orderBy("rank").collect()] == [(0 + 1, 1), (0, 2)]
    assert knn.topk(questions, corpus.limit(0), 5).isEmpty()
    assert knn.topk(questions.limit(0), corpus, 5).isEmpty()


def test_filter_comes_before_scoring(spark):
    corpus = frame(spark, crowded(4), "corpus_id").withColumn("label", F.col("corpus_id") % 5)
    got = knn.topk(frame(spark, crowded(5, 20), "question_id"), corpus, 4, "cosine", where=F.col("label") == 2)
    assert {c % 5 for _, c, _ in found(got)} == {2} and got.count() == 80


def test_cells_are_pruned_on_clustered_data(spark):
    rng = np.random.default_rng(0)
    centres = rng.normal(scale=50, size=(20, 4))
    corpus = np.concatenate([c + rng.normal(scale=0.1, size=(50, 4)) for c in centres])
    side = knn._side(frame(spark, corpus, "corpus_id"), "corpus_id", "embedding")
    metric = knn.METRICS["l2"]
    pivots = knn.choose_pivots(side, 31, metric, 4)
    limits = knn._cell_limits(knn._with_cell(side, pivots, metric, 4), 4)
    visited = knn._route_exact(pivots, limits, 4)(corpus)
    # a question reaches the cells of its own cluster, not all 31
    assert np.mean([len(v) for v in visited]) < 6


def test_approximate_hits_are_true_scores(spark):
    vectors = crowded(6)
    questions, corpus = frame(spark, vectors, "question_id"), frame(spark, vectors, "corpus_id")
    exact = knn.topk(questions, corpus, 4, "l2", skip_same_id=True)
    rough = knn.topk_approx(questions, corpus, 4, "l2", pivots=8, probes=2, skip_same_id=True)
    rate = knn.recall(exact, rough).first().recall
    assert 0.5 < rate <= 1.0
    everything = knn.topk_approx(questions, corpus, 4, "l2", pivots=8, probes=8, skip_same_id=True)
    assert found(everything) == found(exact)


def test_too_long_vectors_are_refused(spark):
    from pyspark.errors import PySparkException

    pair = frame(spark, [[1, 2, 3]], "question_id"), frame(spark, [[1, 2, 3]], "corpus_id")
    with pytest.raises((PySparkException, ValueError)):
        knn.topk(*pair, 1, dims=2).collect()


def test_cosine_expression(spark):
    df = spark.createDataFrame([([1.0, 0.0], [1.0, 1.0]), ([0.0, 0.0], [1.0, 2.0]), ([1.0], [2.0, 9.0]), ([-1.0], [1.0])], "a array<float>, b array<float>")
    got = [r[0] for r in df.select(cosine(F.col("a"), F.col("b"))).collect()]
    assert got == pytest.approx([2**-0.5, 0.0, 2 / 85**0.5, -1.0])
    assert df.select(squared_l2(F.col("a"), F.col("b"))).first()[0] == 1.0


def test_hash_embedding(spark):
    import hashlib

    text = "Sepse sepse em IDOSOS"
    expected = [0.0] * 16
    for token in text.lower().split():
        expected[int(hashlib.md5(token.encode()).hexdigest()[:8], 16) % 16] += 1
    df = spark.createDataFrame([(text,), ("",), (None,)], "t string")
    rows = [r[0] for r in df.select(hash_embed(F.col("t"), 16)).collect()]
    assert rows == [expected, [0.0] * 16, [0.0] * 16]
    unit = df.select(hash_embed(F.col("t"), 16, normalize=True)).first()[0]
    assert sum(x * x for x in unit) == pytest.approx(1.0)


@pytest.mark.parametrize("asked, stored, route", [
    (100, 10**11, "scan"),        # a few questions never move the corpus
    (1_000, 10**11, "scan"),
    (100_000, 10**11, "grid"),
    (10**7, 10**6, "grid"),       # the questions stay in the executors
    (2000, 2000, "grid"),
])
def test_route_follows_the_sizes(asked, stored, route):
    assert knn.pick_route(asked, stored, 4, 64) == route


@pytest.mark.parametrize("metric", ["cosine", "l2"])
def test_passes_are_exact_and_move_no_vectors(spark, metric):
    rng = np.random.default_rng(12)
    corpus, questions = rng.normal(size=(300, 8)), rng.normal(size=(60, 8))
    got = knn.topk(
        frame(spark, questions, "question_id"), frame(spark, corpus, "corpus_id"), 4, metric, max_broadcast_bytes=800
    )
    assert found(got) == brute(questions, corpus, 4, metric)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInPandas") > 4
    assert not [line for line in plan.splitlines() if "Exchange" in line and "vector" in line]


@pytest.mark.parametrize("metric", ["cosine", "l2"])
def test_grid_is_exact_in_blocks(spark, monkeypatch, metric):
    monkeypatch.setattr(knn, "BLOCK_ROWS", 70)
    monkeypatch.setattr(knn, "QUESTION_BLOCK_ROWS", 25)
    rng = np.random.default_rng(14)
    corpus, questions = rng.normal(size=(300, 8)), rng.normal(size=(60, 8))
    corpus[5], corpus[6] = corpus[7], 0
    asked = frame(spark, questions, "question_id")
    calls = []
    monkeypatch.setattr(type(asked), "toPandas", lambda df: calls.append(df.columns))
    got = knn.topk(asked, frame(spark, corpus, "corpus_id"), 4, metric, route="grid")
    assert found(got) == brute(questions, corpus, 4, metric)
    assert not calls  # no vector goes through the driver


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_index_reaches_nine_tenths(spark, tmp_path, sf):
    rows = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet").withColumnRenamed("vec_id", "question_id")
    knn.build_index(rows, str(tmp_path / sf), "cosine", 16, corpus_id="question_id")
    rough = knn.Index(spark, str(tmp_path / sf)).search(rows, skip_same_id=True)
    corpus = rows.withColumnRenamed("question_id", "corpus_id")
    exact = knn.topk(rows, corpus, 4, "cosine", skip_same_id=True)
    assert knn.recall(exact, rough).first().recall >= 0.9


@pytest.mark.parametrize("route", ["scan", "cells", "grid"])
def test_copies_of_long_vectors_tie_exactly(spark, route):
    rng = np.random.default_rng(8)
    corpus = np.round(1e4 + rng.normal(size=(200, 16)), 2)
    corpus[100:] = corpus[:100]
    questions = corpus[:40]
    got = knn.topk(frame(spark, questions, "question_id"), frame(spark, corpus, "corpus_id"), 3, "l2", route=route)
    assert found(got) == brute(questions, corpus, 3, "l2")


def test_stored_index(spark, tmp_path):
    rng = np.random.default_rng(21)
    corpus, questions = rng.normal(size=(400, 8)), rng.normal(size=(9, 8))
    asked, path = frame(spark, questions, "question_id"), str(tmp_path / "index")
    knn.build_index(frame(spark, corpus, "corpus_id"), path, "cosine", pivots=16)
    index = knn.Index(spark, path)
    files = sorted(os.listdir(f"{path}/cells"))
    everything = index.search(asked, 4, probes=16)
    assert found(everything) == brute(questions, corpus, 4, "cosine")
    one = index.search(asked.where("question_id = 3"), 4, probes=2)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [cell" in plan
    assert one.count() == 4 and sorted(os.listdir(f"{path}/cells")) == files


@pytest.mark.parametrize("route", ["cells", "grid"])
def test_questions_are_not_written_once_per_cell(spark, monkeypatch, route):
    """Blocks bound how often a vector travels, and vectors travel in packs."""
    written = []
    real = knn.materialize
    monkeypatch.setattr(knn, "materialize", lambda df, label: written.append(label) or real(df, label))
    vectors = crowded(9)
    asked, stored = frame(spark, vectors, "question_id"), frame(spark, vectors, "corpus_id")
    got = knn.topk(asked, stored, 4, "cosine", route=route, skip_same_id=True)
    assert found(got) == brute(vectors, vectors, 4, "cosine", skip=True)
    assert written == (["cells"] if route == "cells" else [])
    assert "FlatMapCoGroupsInArrow" in got._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("metric", ["cosine", "l2"])
def test_a_block_settles_ties_as_it_goes(monkeypatch, metric):
    """Copies, empty vectors and missing numbers, with next to no room for candidates."""
    monkeypatch.setattr(knn, "HELD_PAIRS", 50)
    monkeypatch.setattr(knn, "SLICE_ROWS", 7)
    monkeypatch.setattr(knn, "SLICE_CORPUS_ROWS", 11)
    corpus, questions = crowded(10, 150), crowded(11, 40)
    corpus[20:90] = corpus[3]
    questions[::5] = corpus[3]
    expected = brute(questions, corpus, 4, metric)
    holes = np.concatenate([corpus, [[np.nan] + [1.0] * 5, [np.inf] * 6]])
    hits = knn._block_topk(knn.METRICS[metric], 4, np.arange(152), holes, np.arange(40), questions, False)
    hits = hits.sort_values(["question_id", "cost", "corpus_id"])
    ranks = hits.groupby("question_id").cumcount() + 1
    assert set(zip(hits["question_id"], hits["corpus_id"], ranks)) == expected


def test_blocks_are_bounded_on_both_sides():
    assert knn._cut(3_000_000, knn.BLOCK_ROWS, 256, 26, 12) == -(-3_000_000 // knn.BLOCK_ROWS)
    rows = -(-1_000_000 // knn._cut(1_000_000, knn.BLOCK_ROWS, 8192, 1, 1))
    assert rows * 8192 * 8 <= knn.BLOCK_BYTES


def test_a_large_component_widens_its_own_row_only():
    """Packs of whole numbers take a byte a number, rows with larger ones go to packs of their own."""
    rows = np.ones((50, 8), dtype=np.float32)
    rows[3, 2], rows[4, 2], rows[5, 2], rows[6, 2], rows[7, 2] = 300, 0.5, -1, np.nan, 70_000
    packs = {kind: (part.tolist(), np.frombuffer(raw, kind).reshape(-1, 8)) for part, kind, raw in knn._packs(rows, np.arange(50))}
    assert packs["|u1"][0] == [0, 1, 2, *range(8, 50)] and packs["<u2"][0] == [3] and packs["<f4"][0] == [4, 5, 6, 7]
    for part, values in packs.values():
        assert np.array_equal(values, rows[part], equal_nan=True)


@pytest.mark.parametrize("metric", ["cosine", "l2"])
def test_questions_pass_a_block_in_slices(spark, monkeypatch, metric):
    monkeypatch.setattr(knn, "PACK_BYTES", 200)
    monkeypatch.setattr(knn, "PASSING_ROWS", 7)
    vectors = crowded(21, 90)
    vectors[3], vectors[4] = vectors[3] * 1000, np.round(np.abs(vectors[4]) * 1000)
    asked, stored = frame(spark, vectors, "question_id"), frame(spark, vectors, "corpus_id")
    got = knn.topk(asked, stored, 4, metric, route="grid", skip_same_id=True)
    assert found(got) == brute(vectors, vectors, 4, metric, skip=True)
