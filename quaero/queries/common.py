"""Tables, derived inputs and SQL fragments the registered queries share.

No hosted model is called: its outputs are tables. The driver's tables stand in
for them: the assistant turn after a user turn is the generated answer, and the
quality label with the number of a conversation is the relevance reply.
"""

from __future__ import annotations

import hashlib
import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quaero.functions.vectors import DEFAULT_DIMS, hash_embed
from quaero.session import shared_folder
from quaero.sources.collection import open_or_build

# A question's id is its conversation and turn in one 64-bit number: 32 bits each.
TURNS_PER_CONVERSATION = 1 << 32


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Use all cores on an input of very few partitions; large inputs stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder below the shared one."""
    return os.path.join(shared_folder(spark), "quaero", f"{label}-{uuid.uuid4().hex}")


def question_id() -> Column:
    return F.col("conv_id") * TURNS_PER_CONVERSATION + F.col("turn")


def user_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").where("role = 'user'")
    return turns.select(question_id().alias("question_id"), F.col("text").alias("question"), "conv_id")


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The assistant turn right after a user turn, under the id of that turn."""
    turns = table(spark, sf_dir, "conversations").where("role = 'assistant'")
    return turns.select((question_id() - 1).alias("question_id"), F.col("text").alias("generation"))


def replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One relevance reply per distinct question."""
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("conv_id"), "quality")
    asked = user_questions(spark, sf_dir).select(
        F.regexp_replace("question", r"^\s+|\s+$", "").alias("question"), "conv_id"
    )
    return asked.join(labels, "conv_id").groupBy("question").agg(
        F.when(F.max("quality") == 1, "Sim.").otherwise("Não").alias("reply")
    )


def named_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as a corpus; the source names the single document."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("corpus_id"),
        F.concat_ws("/", "source", F.col("doc_id").cast("string")).alias("source"),
        F.col("text").alias("page_content"),
    )


def document_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents with their embedding: built once per application, then reopened."""

    def build() -> DataFrame:
        docs = spread(named_documents(spark, sf_dir))
        return docs.withColumn("embedding", hash_embed(F.col("page_content")))

    name = hashlib.md5(os.path.abspath(sf_dir).encode()).hexdigest()
    path = os.path.join(
        shared_folder(spark), "quaero", f"collection-{spark.sparkContext.applicationId}-{name}"
    )
    return open_or_build(spark, path, build)


# --- SQL fragments -------------------------------------------------------------------


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sql_strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def sql_tokens(x: str) -> str:
    return rf"[t for t in string_split_regex(lower({x}), '\s+') if t <> '']"


SQL_QUESTIONS = f"""
questions AS (
  SELECT conv_id * {TURNS_PER_CONVERSATION} + turn AS id, conv_id, text
  FROM conversations WHERE role = 'user')"""

SQL_ANSWERS = f"""
answers AS (
  SELECT conv_id * {TURNS_PER_CONVERSATION} + turn - 1 AS id, text AS generation
  FROM conversations WHERE role = 'assistant')"""

SQL_REPLIES = f"""
replies AS (
  SELECT {sql_strip('q.text')} AS question,
         CASE WHEN max(l.quality) = 1 THEN 'Sim.' ELSE 'Não' END AS reply
  FROM questions q JOIN labels l ON l.doc_id = q.conv_id GROUP BY 1)"""


def sql_vectors(name: str, source: str, text: str = "text", dims: int = DEFAULT_DIMS) -> str:
    """``name(id, b, w)``: token counts per bucket, and ``name_len(id, len)``."""
    return f"""
{name} AS (
  SELECT id, ('0x' || substr(md5(t), 1, 8))::BIGINT % {dims} AS b, count(*)::DOUBLE AS w
  FROM (SELECT id, unnest({sql_tokens(text)}) AS t FROM {source}) GROUP BY 1, 2),
{name}_len AS (SELECT id, sqrt(sum(w * w)) AS len FROM {name} GROUP BY 1)"""


def sql_hits(name: str, asked: str, k: int = 4) -> str:
    """``name(question_id, corpus_id, score, rank)`` for ``asked(id, text)`` over the documents."""
    return f"""
docs AS (SELECT doc_id AS id, text, source || '/' || doc_id AS source FROM documents),
{sql_vectors('dv', 'docs')},
{sql_vectors('qv', asked)},
dots AS (
  SELECT qv.id AS q, dv.id AS d, sum(qv.w * dv.w) AS dot FROM qv JOIN dv USING (b) GROUP BY 1, 2),
scored AS (
  SELECT q.id AS question_id, d.id AS corpus_id,
         coalesce(round(dot / (ql.len * dl.len), 10), 0.0) AS score
  FROM {asked} q CROSS JOIN docs d
  LEFT JOIN dots ON dots.q = q.id AND dots.d = d.id
  LEFT JOIN qv_len ql ON ql.id = q.id LEFT JOIN dv_len dl ON dl.id = d.id),
{name} AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY score DESC, corpus_id) AS rank
    FROM scored) WHERE rank <= {k})"""


def sql_overlap(question: str, document: str) -> str:
    q, d = sql_tokens(question), sql_tokens(document)
    return (
        f"len(list_intersect(list_distinct({q}), list_distinct({d})))"
        f" / greatest(len(list_distinct({q})), 1)"
    )


def sql_graded(name: str, hits: str, asked: str) -> str:
    """``name``: graded hits with the document's text, renumbered by ``pos``."""
    return f"""
{name}_all AS (
  SELECT h.question_id, h.corpus_id, h.rank, h.score, q.text AS question, d.text AS page_content, d.source,
         {sql_overlap('q.text', 'd.text')} AS overlap
  FROM {hits} h JOIN {asked} q ON q.id = h.question_id JOIN docs d ON d.id = h.corpus_id),
{name} AS (
  SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY rank) AS pos
  FROM (SELECT *, bool_or(overlap > 0.05) OVER (PARTITION BY question_id) AS any_pass FROM {name}_all)
  WHERE overlap > 0.05 OR NOT any_pass)"""
