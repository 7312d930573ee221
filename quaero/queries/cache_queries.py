"""The expiring answer cache over conversations and the event log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaero.functions import text as tx
from quaero.operators import cache
from quaero.queries.common import SQL_ANSWERS, SQL_QUESTIONS, answers, table, user_questions


def cache_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key and stored value of every answered question."""
    pairs = user_questions(spark, sf_dir).join(answers(spark, sf_dir), "question_id")
    return pairs.select(
        "question_id", tx.cache_key(F.col("question")).alias("cache_key"),
        tx.cache_value(F.array("question"), F.col("generation")).alias("cache_value"),
    )


SQL_KEYS = f"""
WITH {SQL_QUESTIONS}, {SQL_ANSWERS}
SELECT id AS question_id, 'medical_response:' || md5(lower(q.text)) AS cache_key,
       json_object('documents', [q.text], 'generation', generation)::VARCHAR AS cache_value
FROM questions q JOIN answers USING (id)"""


def _written(spark: SparkSession, sf_dir: str, *kinds: str) -> DataFrame:
    """Events of some types as cache writes of their user."""
    events = table(spark, sf_dir, "events").where(F.col("event_type").isin(*kinds))
    return events.select(
        tx.cache_key(F.col("user_id").cast("string")).alias("cache_key"),
        F.col("ts").alias("written_at"), "event_id", "value",
    )


def _entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cache.upsert(
        _written(spark, sf_dir, "signup"), _written(spark, sf_dir, "purchase", "view"), tie="event_id"
    )


def cache_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _entries(spark, sf_dir).drop("written_at")


_SQL_ENTRIES = """
entries AS (
  SELECT * FROM (
    SELECT 'medical_response:' || md5(user_id::VARCHAR) AS cache_key, ts AS written_at, event_id, value,
           row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS nth
    FROM events WHERE event_type IN ('signup', 'purchase', 'view')) WHERE nth = 1)"""
SQL_UPSERT = f"WITH {_SQL_ENTRIES} SELECT cache_key, event_id, value FROM entries"


def cache_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event asks for its user's entry."""
    asks = table(spark, sf_dir, "events").select(
        tx.cache_key(F.col("user_id").cast("string")).alias("cache_key"),
        F.col("ts").alias("asked_at"), F.col("event_id").alias("ask_id"),
    )
    found = cache.lookup(asks, _entries(spark, sf_dir))
    return found.select("ask_id", "hit", "event_id", "value")


SQL_LOOKUP = f"""
WITH {_SQL_ENTRIES}, asks AS (
  SELECT a.event_id AS ask_id, e.event_id, e.value,
         coalesce(a.ts >= written_at AND a.ts < written_at + INTERVAL 3600 SECOND, false) AS hit
  FROM events a LEFT JOIN entries e ON e.cache_key = 'medical_response:' || md5(a.user_id::VARCHAR))
SELECT ask_id, hit, CASE WHEN hit THEN event_id END AS event_id, CASE WHEN hit THEN value END AS value FROM asks"""

PATTERN = "[a-c4]?*"


def cache_invalidate(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept, removed = cache.invalidate(_entries(spark, sf_dir), PATTERN)
    left = kept.agg(F.count(F.lit(1)).alias("n")).select(F.lit("kept").alias("outcome"), "n")
    return left.unionByName(removed.select(F.lit("removed").alias("outcome"), F.col("removed").alias("n")))


SQL_INVALIDATE = f"""
WITH {_SQL_ENTRIES}, marked AS (
  SELECT regexp_full_match(cache_key, 'medical_response:[abc4]..*') AS gone FROM entries)
SELECT 'kept' AS outcome, count(*) FILTER (NOT gone) AS n FROM marked
UNION ALL SELECT 'removed', count(*) FILTER (gone) FROM marked"""


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.concat_ws(":", F.col("user_id").cast("string"), "event_type").alias("cache_key"),
        F.col("ts").alias("asked_at"), F.col("event_id").alias("ask_id"),
    )


def cache_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cache.replay(request_log(spark, sf_dir)).select("ask_id", "cache_key", "hit")


def cache_replay_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same log with every repeated key treated as hot, one key per user."""
    log = table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("cache_key"),
        F.col("ts").alias("asked_at"), F.col("event_id").alias("ask_id"),
    )
    return cache.replay(log, hot_key_rows=1).select("ask_id", "cache_key", "hit")


def _sql_replay(key: str) -> str:
    return f"""
WITH RECURSIVE log AS (SELECT event_id, ts, {key} AS k FROM events),
misses AS (
  SELECT k, ts, event_id FROM (
    SELECT *, row_number() OVER (PARTITION BY k ORDER BY ts, event_id) AS nth FROM log) WHERE nth = 1
  UNION ALL
  SELECT k, ts, event_id FROM (
    SELECT l.k, l.ts, l.event_id, row_number() OVER (PARTITION BY l.k ORDER BY l.ts, l.event_id) AS nth
    FROM log l JOIN misses m ON l.k = m.k AND l.ts >= m.ts + INTERVAL 3600 SECOND) WHERE nth = 1)
SELECT event_id AS ask_id, k AS cache_key, event_id NOT IN (SELECT event_id FROM misses) AS hit FROM log"""


SQL_REPLAY = _sql_replay("user_id || ':' || event_type")
SQL_REPLAY_HOT = _sql_replay("user_id::VARCHAR")

QUERIES = {
    "cache_keys": (cache_keys, SQL_KEYS),
    "cache_upsert": (cache_upsert, SQL_UPSERT),
    "cache_lookup": (cache_lookup, SQL_LOOKUP),
    "cache_invalidate": (cache_invalidate, SQL_INVALIDATE),
    "cache_replay": (cache_replay, SQL_REPLAY),
    "cache_replay_hot": (cache_replay_hot, SQL_REPLAY_HOT),
}
