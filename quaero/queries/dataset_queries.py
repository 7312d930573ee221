"""Splitting and scoring of labelled tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quaero.functions.language import identify_language
from quaero.operators import evaluate, split
from quaero.queries.common import scratch, spread, table
from quaero.queries.text_queries import _SQL_LANGUAGE
from quaero.sources.collection import read_fold, write_folds, write_roles

SEED = 7


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "lang")


def stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    folded = split.stratified_folds(_docs(spark, sf_dir), "doc_id", "lang", split.FOLDS, SEED)
    return folded.select("doc_id", "lang", F.col("fold").cast("bigint").alias("fold"))


def _sql_hash(seed: str) -> str:
    return f"md5('{seed}:' || doc_id)"


def _sql_folds(name: str, source: str, k: int, seed: str) -> str:
    """``name(doc_id, lang, fold)``."""
    return f"""
{name}_raw AS (
  SELECT doc_id, lang,
    least((row_number() OVER (PARTITION BY lang ORDER BY {_sql_hash(seed)}, doc_id) - 1)
          // ceil(count(*) OVER (PARTITION BY lang) / {k})::BIGINT, {k - 1}) AS fold FROM {source}),
{name}_uneven AS (
  SELECT count(*) FILTER (fold = 0) <> count(*) FILTER (fold = {k - 1}) AS uneven FROM {name}_raw),
{name} AS (
  SELECT doc_id, lang, CASE WHEN uneven AND fold < {k - 1} AND nth = 1 THEN {k - 1} ELSE fold END::BIGINT AS fold
  FROM (SELECT *, row_number() OVER (PARTITION BY fold ORDER BY {_sql_hash(seed + '-move')}, doc_id) AS nth
        FROM {name}_raw), {name}_uneven)"""


SQL_STRATIFIED = f"WITH {_sql_folds('folds', 'documents', 10, str(SEED))} SELECT * FROM folds"


def nested_cv(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = split.nested_folds(_docs(spark, sf_dir), "doc_id", "lang", seed=SEED)
    return nested.select("doc_id", "lang", "role", F.col("fold").cast("bigint").alias("fold"))


_SQL_NESTED = f"""
{_sql_folds('halves', 'documents', 2, f'{SEED}-half')},
cv_rows AS (SELECT doc_id, lang FROM halves WHERE fold = 0),
{_sql_folds('cv', 'cv_rows', 10, f'{SEED}-cv')},
nested AS (
  SELECT doc_id, lang, 'cv' AS role, fold FROM cv
  UNION ALL SELECT doc_id, lang, 'test', NULL FROM halves WHERE fold = 1)"""
SQL_NESTED = f"WITH {_SQL_NESTED} SELECT * FROM nested"


def leave_one_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every run's training and dev rows, counted by language."""
    nested = split.nested_folds(_docs(spark, sf_dir), "doc_id", "lang", seed=SEED)
    runs = split.fold_roles(nested.where("role = 'cv'"))
    return runs.groupBy(F.col("run").cast("bigint").alias("run"), "role", "lang").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("doc_id").alias("id_sum")
    )


SQL_LEAVE_ONE_OUT = f"""
WITH {_SQL_NESTED}
SELECT run, CASE WHEN fold = run THEN 'dev' ELSE 'train' END AS role, lang, count(*) AS rows,
       sum(doc_id)::BIGINT AS id_sum
FROM nested, (SELECT unnest(range(10)) AS run) WHERE role = 'cv' GROUP BY ALL"""


def stored_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training rows of one run, read back from the stored folds."""
    path = scratch(spark, "folds")
    write_folds(split.nested_folds(_docs(spark, sf_dir), "doc_id", "lang", seed=SEED), path)
    return read_fold(spark, path, 3, "train")


SQL_STORED_FOLDS = f"WITH {_SQL_NESTED} SELECT doc_id, lang FROM nested WHERE role = 'cv' AND fold <> 3"

TRAIN_ROWS = 6000


def random_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(F.col("event_id").alias("doc_id"))
    path = scratch(spark, "roles")
    write_roles(split.random_split(events, "doc_id", TRAIN_ROWS, SEED), path)
    return spark.read.parquet(path).select(F.col("doc_id").alias("event_id"), "role")


SQL_RANDOM = f"""
SELECT event_id, CASE WHEN row_number() OVER (ORDER BY md5('{SEED}:' || event_id), event_id) <= {TRAIN_ROWS}
                      THEN 'train' ELSE 'dev' END AS role FROM events"""


def id_set_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"))
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"))
    return evaluate.id_mismatches(docs, labels)


SQL_ID_SETS = """
SELECT count(*) FILTER (l.doc_id IS NULL) AS only_truth, count(*) FILTER (d.doc_id IS NULL) AS only_pred
FROM documents d FULL JOIN (SELECT DISTINCT doc_id FROM labels) l ON l.doc_id = d.doc_id"""


def _rounded(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(
        *keys, "n", F.round("accuracy", 8).alias("accuracy"), F.round("macro_f1", 8).alias("macro_f1")
    )


def accuracy_f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two-way language rule scored against the given language code."""
    docs = spread(table(spark, sf_dir, "documents").select("text", "lang"))
    pairs = docs.select(
        F.col("lang").alias("truth"), identify_language(F.col("text"), F.col("lang")).alias("pred")
    )
    return _rounded(evaluate.scores(pairs))


def _sql_scores(source: str, keys: str = "") -> str:
    """Scores of ``source(truth, pred)`` per ``keys``, class by class."""
    lead = f"{keys}, " if keys else ""
    using = f"JOIN per_class USING ({keys})" if keys else "CROSS JOIN per_class"
    return f"""
marked AS (
  SELECT {lead}label, count(*) FILTER (truth = label AND pred = label) AS tp,
         count(*) FILTER (truth <> label AND pred = label) AS fp,
         count(*) FILTER (truth = label AND pred <> label) AS fn
  FROM (SELECT *, unnest(list_distinct([truth, pred])) AS label FROM {source}) GROUP BY {lead}label),
per_class AS (SELECT {lead}avg(2 * tp / (2 * tp + fp + fn)) AS f1 FROM marked {'GROUP BY ' + keys if keys else ''}),
total AS (
  SELECT {lead}count(*) AS n, avg((truth = pred)::INT) AS acc FROM {source} {'GROUP BY ' + keys if keys else ''})
SELECT {lead}n, round(acc, 8) AS accuracy, round(f1, 8) AS macro_f1 FROM total {using}"""


SQL_ACCURACY = f"""
WITH pairs AS (SELECT lang AS truth, {_SQL_LANGUAGE} AS pred FROM documents), {_sql_scores('pairs')}"""


def _decision(flag: Column) -> Column:
    return F.when(flag == 1, "yes").otherwise("no")


def majority_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select(_decision(F.col("quality")).alias("truth"))
    return _rounded(evaluate.majority_baseline(labels))


SQL_MAJORITY = f"""
WITH pairs AS (SELECT CASE WHEN quality = 1 THEN 'yes' ELSE 'no' END AS truth, 'yes' AS pred FROM labels),
{_sql_scores('pairs')}"""


def rater_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Constant yes, the toxicity label and the language as raters of quality."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    rated = table(spark, sf_dir, "labels").join(docs, "doc_id").select(
        _decision(F.col("quality")).alias("final_decision"),
        _decision(1 - F.col("toxic")).alias("reasoning_free_pred"),
        F.when(F.col("lang") == "en", "yes").when(F.col("lang") == "fr", "maybe").otherwise("no")
        .alias("reasoning_required_pred"),
    )
    raters = {
        "majority": F.lit("yes"),
        "reasoning_free": "reasoning_free_pred",
        "reasoning_required": "reasoning_required_pred",
    }
    return _rounded(evaluate.compare_raters(rated, "final_decision", raters), "rater")


SQL_RATERS = f"""
WITH rated AS (
  SELECT CASE WHEN quality = 1 THEN 'yes' ELSE 'no' END AS truth,
         CASE WHEN toxic = 0 THEN 'yes' ELSE 'no' END AS free,
         CASE lang WHEN 'en' THEN 'yes' WHEN 'fr' THEN 'maybe' ELSE 'no' END AS required
  FROM labels JOIN documents USING (doc_id)),
pairs AS (
  SELECT 'majority' AS rater, truth, 'yes' AS pred FROM rated
  UNION ALL SELECT 'reasoning_free', truth, free FROM rated
  UNION ALL SELECT 'reasoning_required', truth, required FROM rated),
{_sql_scores('pairs', 'rater')}"""

QUERIES = {
    "stratified_split": (stratified_split, SQL_STRATIFIED),
    "nested_cv": (nested_cv, SQL_NESTED),
    "leave_one_out": (leave_one_out, SQL_LEAVE_ONE_OUT),
    "stored_folds": (stored_folds, SQL_STORED_FOLDS),
    "random_split": (random_split, SQL_RANDOM),
    "id_set_check": (id_set_check, SQL_ID_SETS),
    "accuracy_f1": (accuracy_f1, SQL_ACCURACY),
    "majority_baseline": (majority_baseline, SQL_MAJORITY),
    "rater_compare": (rater_compare, SQL_RATERS),
}
