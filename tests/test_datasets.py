import collections

import pytest
from pyspark.sql import functions as F

from quaero.operators import evaluate, split
from quaero.sources.collection import read_fold, write_folds


def labelled(spark, **sizes):
    rows = [(f"{label}{i}", label) for label, n in sizes.items() for i in range(n)]
    return spark.createDataFrame(rows, "pmid string, label string").repartition(5)


def sizes(df):
    return [n for _, n in sorted((r[0], r[1]) for r in df.groupBy("fold").count().collect())]


@pytest.mark.parametrize("bucket", [100_000, 7])
def test_fold_sizes(spark, bucket):
    df = labelled(spark, yes=276, no=169, maybe=55)
    raw = split.stratified_folds(df, "pmid", "label", 10, rebalance=False, rows_per_bucket=bucket)
    assert sizes(raw) == [51] * 9 + [41]
    even = split.stratified_folds(df, "pmid", "label", 10, rows_per_bucket=bucket)
    assert sizes(even) == [50] * 10
    assert even.select("pmid").distinct().count() == 500
    yes = dict(even.where("label = 'yes'").groupBy("fold").count().collect())
    # 28 per fold before one row of any label leaves; the last has 24 and gains nine rows
    assert all(yes[i] in (27, 28) for i in range(9)) and 24 <= yes[9] <= 33


def test_bucketed_rank_is_the_sorted_rank(spark):
    df = labelled(spark, a=900, b=40)
    ranked = split.stratum_rank(df, "pmid", "label", 3, rows_per_bucket=10)
    by_label = collections.defaultdict(list)
    for r in ranked.withColumn("h", split.hash_order(F.col("pmid"), 3)).collect():
        by_label[r.label].append((r["rank"], r.h))
    for rows in by_label.values():
        rows.sort()
        assert [n for n, _ in rows] == list(range(1, len(rows) + 1))
        assert [h for _, h in rows] == sorted(h for _, h in rows)


def test_equal_folds_are_left_alone(spark):
    df = labelled(spark, yes=40, no=20)
    assert sizes(split.stratified_folds(df, "pmid", "label", 10)) == [6] * 10


def test_small_labels_leave_empty_folds(spark):
    df = labelled(spark, yes=3)
    folded = split.stratified_folds(df, "pmid", "label", 5)
    assert folded.count() == 3 and folded.where("fold = 4").count() == 3


def test_nested_folds_and_leave_one_out(spark, tmp_path):
    df = labelled(spark, yes=552, no=338, maybe=110)
    nested = split.nested_folds(df, "pmid", "label")
    assert {r["role"]: r["count"] for r in nested.groupBy("role").count().collect()} == {"cv": 500, "test": 500}
    runs = split.fold_roles(nested.where("role = 'cv'"))
    counts = {(r["run"], r["role"]): r["count"] for r in runs.groupBy("run", "role").count().collect()}
    assert all(counts[(i, "dev")] + counts[(i, "train")] == 500 for i in range(10))
    write_folds(nested, str(tmp_path / "folds"))
    ids = lambda role: {r.pmid for r in read_fold(spark, str(tmp_path / "folds"), 2, role).collect()}
    assert not ids("dev") & ids("train") and len(ids("dev") | ids("train")) == 500 and len(ids("test")) == 500


@pytest.mark.parametrize("wanted", [0, 1, 37, 999, 1000, 5000])
def test_random_split_is_exact(spark, monkeypatch, wanted):
    monkeypatch.setattr(split, "_SMALL", 3)
    monkeypatch.setattr(split, "_DIGITS", 1)
    df = spark.range(1000)
    out = split.random_split(df, "id", wanted, seed=5)
    order = [r.id for r in df.orderBy(split.hash_order(F.col("id"), 5), "id").collect()]
    train = {r.id for r in out.where("role = 'train'").collect()}
    assert train == set(order[:wanted]) and out.count() == 1000


def test_majority_baseline_figures(spark):
    df = labelled(spark, yes=276, no=169, maybe=55).withColumnRenamed("label", "truth")
    for label in ("yes", None):
        row = evaluate.majority_baseline(df, label=label).first()
        assert row.n == 500 and row.accuracy == pytest.approx(0.552) and row.macro_f1 == pytest.approx(0.237113, abs=1e-6)


def test_class_only_in_predictions_counts(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("c", "c")], "truth string, pred string")
    row = evaluate.scores(df).first()
    # a = 2/3, b = 0, c = 1
    assert row.accuracy == pytest.approx(2 / 3) and row.macro_f1 == pytest.approx((2 / 3 + 0 + 1) / 3)


def test_raters(spark):
    df = spark.createDataFrame([("yes", "yes", "no"), ("no", "yes", "no"), ("no", "no", "no")], "t string, r1 string, r2 string")
    got = {r.rater: r.accuracy for r in evaluate.compare_raters(df, "t", {"m": F.lit("yes"), "one": "r1", "two": "r2"}).collect()}
    assert got == pytest.approx({"m": 1 / 3, "one": 2 / 3, "two": 2 / 3})


def test_ids_must_agree(spark):
    truth = spark.createDataFrame([("1", "yes"), ("2", "no")], "id string, label string")
    assert evaluate.align_predictions(truth, truth).count() == 2
    other = spark.createDataFrame([("1", "yes"), ("3", "no")], "id string, label string")
    row = evaluate.id_mismatches(truth, other).first()
    assert (row.only_truth, row.only_pred) == (1, 1)
    with pytest.raises(ValueError, match="ids differ"):
        evaluate.align_predictions(truth, other)
