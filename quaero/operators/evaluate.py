"""Accuracy and macro-F1 of predicted labels, for one or several raters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAJORITY_LABEL = "yes"


def scores(df: DataFrame, truth: str = "truth", pred: str = "pred", by: Sequence[str] = ()) -> DataFrame:
    """``n``, ``accuracy`` and ``macro_f1`` for each group of ``by``.

    One pass over the data builds the confusion counts, a table of labels squared;
    everything after it is tiny. Labels are the union of truth and prediction, and
    a label that is never right has F1 = 0.
    """
    counts = df.groupBy(*by, truth, pred).agg(F.count(F.lit(1)).alias("n"))
    same = F.col(truth) == F.col(pred)
    marks = F.when(
        same, F.array(F.struct(F.col(truth).alias("label"), F.lit(2).alias("hit"), F.lit(2).alias("seen")))
    ).otherwise(
        F.array(
            F.struct(F.col(truth).alias("label"), F.lit(0).alias("hit"), F.lit(1).alias("seen")),
            F.struct(F.col(pred).alias("label"), F.lit(0).alias("hit"), F.lit(1).alias("seen")),
        )
    )
    labels = (
        counts.select(*by, F.col("n").alias("rows"), F.explode(marks).alias("m"))
        .groupBy(*by, "m.label")
        .agg(
            F.sum(F.col("rows") * F.col("m.hit")).alias("hits"),
            F.sum(F.col("rows") * F.col("m.seen")).alias("seen"),
        )
    )
    # a right row counts 2 for its label, a wrong one 1 for each of its two labels
    return labels.groupBy(*by).agg(
        (F.sum("seen") / 2).cast("bigint").alias("n"),
        (F.sum("hits") / F.sum("seen")).alias("accuracy"),
        F.avg(F.col("hits") / F.col("seen")).alias("macro_f1"),
    )


def compare_raters(df: DataFrame, truth: str, raters: Mapping[str, str | Column]) -> DataFrame:
    """The scores of every rater, a name and its prediction column, in one pass."""
    picks = [
        F.struct(
            F.lit(name).alias("rater"),
            (F.col(pred) if isinstance(pred, str) else pred).cast("string").alias("pred"),
        )
        for name, pred in raters.items()
    ]
    long = df.select(F.col(truth).cast("string").alias("truth"), F.explode(F.array(*picks)).alias("r"))
    return scores(long.select("truth", "r.rater", "r.pred"), by=["rater"])


def majority_baseline(df: DataFrame, truth: str = "truth", label: str | None = MAJORITY_LABEL) -> DataFrame:
    """Scores of always predicting ``label``, or the most frequent label when it is None."""
    if label is None:
        counts = df.groupBy(truth).agg(F.count(F.lit(1)).alias("n"))
        label = counts.agg(F.max_by(truth, F.struct("n", truth)).alias("top")).first()["top"]
    return scores(df.select(truth, F.lit(label).alias("pred")), truth)


def id_mismatches(truth: DataFrame, pred: DataFrame, id_col: str = "id") -> DataFrame:
    """One row: ids only in ``truth`` and ids only in ``pred``."""
    left = truth.select(F.col(id_col), F.lit(1).alias("_t")).dropDuplicates([id_col])
    right = pred.select(F.col(id_col), F.lit(1).alias("_p")).dropDuplicates([id_col])
    return left.join(right, id_col, "full").agg(
        F.count(F.when(F.col("_p").isNull(), 1)).alias("only_truth"),
        F.count(F.when(F.col("_t").isNull(), 1)).alias("only_pred"),
    )


def align_predictions(truth: DataFrame, pred: DataFrame, id_col: str = "id") -> DataFrame:
    """``(id, truth, pred)``; raises unless both sides hold exactly the same ids."""
    row = id_mismatches(truth, pred, id_col).first()
    if row["only_truth"] or row["only_pred"]:
        raise ValueError(
            f"ids differ: {row['only_truth']} without a prediction, {row['only_pred']} without a truth"
        )
    return truth.select(id_col, F.col("label").alias("truth")).join(
        pred.select(id_col, F.col("label").alias("pred")), id_col
    )
