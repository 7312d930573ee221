"""Embedding, neighbours, grading, context, grounding and the whole flow."""

from __future__ import annotations

import hashlib
import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaero.functions import text as tx
from quaero.functions.vectors import DEFAULT_DIMS, cosine, hash_embed
from quaero.operators import documents as docs
from quaero.operators import grounding as gr
from quaero.operators import knn
from quaero.operators import translation as tr
from quaero.operators.screening import REFUSAL_MESSAGE
from quaero.plans.answer import answer_batch, check_answers
from quaero.queries.common import (
    SQL_ANSWERS, SQL_QUESTIONS, SQL_REPLIES, answers, document_collection, quote, replies, scratch, spread,
    sql_graded, sql_hits, sql_strip, sql_vectors, table, user_questions,
)
from quaero.queries.text_queries import _SQL_LANGUAGE, _sql_masked, _sql_screen
from quaero.session import materialize, shared_folder
from quaero.sources.collection import append_audit
from quaero.streaming.feed import audit_rows


def embed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts per bucket, one row for each bucket in use."""
    source = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    vectors = source.select("doc_id", F.posexplode(hash_embed(F.col("text"))).alias("bucket", "tf"))
    return vectors.where("tf > 0").select(
        "doc_id", F.col("bucket").cast("bigint").alias("bucket"), F.col("tf").cast("bigint").alias("tf")
    )


SQL_EMBED = f"""
WITH src AS (SELECT doc_id AS id, text FROM documents), {sql_vectors('v', 'src')}
SELECT id AS doc_id, b AS bucket, w::BIGINT AS tf FROM v"""


# --- neighbours among the given vectors -------------------------------------------------


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "embeddings"))


def _neighbours(spark: SparkSession, sf_dir: str, metric: str, **options) -> DataFrame:
    """The nearest other vectors of every vector."""
    vectors = _vectors(spark, sf_dir)
    return knn.topk(
        vectors, vectors, metric=metric, question_id="vec_id", corpus_id="vec_id",
        skip_same_id=True, **options,
    )


def topk_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ranked(_neighbours(spark, sf_dir, "cosine"))


def topk_l2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ranked(_neighbours(spark, sf_dir, "l2"))


def topk_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same result by the route for large question tables."""
    return _ranked(_neighbours(spark, sf_dir, "cosine", route="cells"))


def topk_multipass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same result when the questions go to the executors in slices of 128 KB."""
    return _ranked(_neighbours(spark, sf_dir, "cosine", max_broadcast_bytes=1 << 17))


def topk_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only vectors with certain labels may be found."""
    return _ranked(_neighbours(spark, sf_dir, "cosine", where=F.col("label") >= 5))


def _ranked(hits: DataFrame) -> DataFrame:
    return hits.select("question_id", "corpus_id", "score", F.col("rank").cast("bigint").alias("rank"))


_SQL_COSINE = (
    "list_inner_product(q.v, c.v) / (sqrt(list_inner_product(q.v, q.v)) * sqrt(list_inner_product(c.v, c.v)))"
)
_SQL_L2 = "list_sum(list_transform(list_zip(q.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
_SQL_VECTORS = "e AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v, label FROM embeddings)"


def _sql_neighbours(score: str, order: str, where: str = "true") -> str:
    return f"""
WITH {_SQL_VECTORS}
SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY score {order}, corpus_id) AS rank
  FROM (SELECT q.id AS question_id, c.id AS corpus_id, round({score}, 10) AS score
        FROM e q JOIN e c ON q.id <> c.id WHERE {where}))
WHERE rank <= 4"""


SQL_COSINE = _sql_neighbours(_SQL_COSINE, "DESC")
SQL_L2 = _sql_neighbours(_SQL_L2, "ASC")
SQL_FILTERED = _sql_neighbours(_SQL_COSINE, "DESC", "c.label >= 5")

PIVOTS = 16


def _index(spark: SparkSession, sf_dir: str) -> knn.Index:
    """The index over the given vectors: stored once per application, then reopened."""
    name = hashlib.md5(os.path.abspath(sf_dir).encode()).hexdigest()
    path = os.path.join(shared_folder(spark), "quaero", f"index-{spark.sparkContext.applicationId}-{name}")
    try:
        return knn.Index(spark, path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    knn.build_index(_vectors(spark, sf_dir), path, "cosine", PIVOTS, corpus_id="vec_id")
    return knn.Index(spark, path)


def _approximate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _index(spark, sf_dir).search(
        _vectors(spark, sf_dir), question_id="vec_id", skip_same_id=True
    )


def topk_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ranked(_approximate(spark, sf_dir))


def topk_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knn.recall(_neighbours(spark, sf_dir, "cosine"), _approximate(spark, sf_dir))


_SQL_APPROX = f"""
{_SQL_VECTORS},
u AS (SELECT id, list_transform(v, lambda x: x / sqrt(list_inner_product(v, v))) AS v FROM e),
pivots AS (
  SELECT row_number() OVER (ORDER BY md5(id::VARCHAR), id) AS cell, v
  FROM (SELECT * FROM u ORDER BY md5(id::VARCHAR), id LIMIT {PIVOTS})),
gaps AS (
  SELECT q.id, c.cell, row_number() OVER (
    PARTITION BY q.id ORDER BY round(sqrt(greatest({_SQL_L2}, 0)), 10), c.cell) AS nth
  FROM u q CROSS JOIN pivots c),
exact AS ({SQL_COSINE}),
asked AS (SELECT id FROM e ORDER BY md5(id::VARCHAR) DESC, id DESC LIMIT {knn.CALIBRATION_ROWS}),
places AS (
  SELECT visit.nth, row_number() OVER (ORDER BY visit.nth) AS rn, count(*) OVER () AS total
  FROM exact x JOIN asked ON asked.id = x.question_id JOIN gaps home ON home.id = x.corpus_id AND home.nth = 1
  JOIN gaps visit ON visit.id = x.question_id AND visit.cell = home.cell),
probes AS (SELECT max(nth) AS probes FROM places WHERE rn = ({knn.CALIBRATION_SHARE} * total + 99) // 100),
hits AS (
  SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY score DESC, corpus_id) AS rank
  FROM (
    SELECT q.id AS question_id, c.id AS corpus_id, round({_SQL_COSINE}, 10) AS score
    FROM e q JOIN gaps visit ON visit.id = q.id AND visit.nth <= (SELECT probes FROM probes)
    JOIN gaps home ON home.cell = visit.cell AND home.nth = 1 JOIN e c ON c.id = home.id
    WHERE q.id <> c.id) QUALIFY rank <= 4)"""
SQL_APPROX = f"WITH {_SQL_APPROX} SELECT * FROM hits"
SQL_RECALL = f"""
WITH {_SQL_APPROX}
SELECT count(*) AS exact_hits, count(h.rank) AS found_hits, count(h.rank) / count(*) AS recall
FROM exact x LEFT JOIN hits h ON h.question_id = x.question_id AND h.corpus_id = x.corpus_id"""


def vector_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cosine and squared distance of every vector to its nearest one, by expression."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    nearest = _neighbours(spark, sf_dir, "cosine", k=1)
    left = vectors.select(F.col("vec_id").alias("question_id"), F.col("embedding").alias("a"))
    right = vectors.select(F.col("vec_id").alias("corpus_id"), F.col("embedding").alias("b"))
    return nearest.join(left, "question_id").join(right, "corpus_id").select(
        "question_id", "corpus_id", F.round(cosine(F.col("a"), F.col("b")), 8).alias("cosine")
    )


SQL_PAIRS = f"""
WITH {_SQL_VECTORS}, best AS ({_sql_neighbours(_SQL_COSINE, 'DESC')})
SELECT question_id, corpus_id, round({_SQL_COSINE}, 8) AS cosine
FROM best JOIN e q ON q.id = question_id JOIN e c ON c.id = corpus_id WHERE rank = 1"""


def semantic_grounding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each vector as an answer, its nearest allowed vectors as the documents."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    found = _neighbours(spark, sf_dir, "cosine", where=F.col("label") >= 5)
    texts = vectors.select(F.col("vec_id").alias("corpus_id"), "embedding")
    given = vectors.select(
        F.col("vec_id").alias("question_id"), F.col("embedding").alias("answer_embedding")
    )
    judged = gr.semantic_grounding(given, found.join(texts, "corpus_id"))
    return judged.select(
        "question_id", F.round("max_similarity", 8).alias("max_similarity"), "semantic_ok"
    )


SQL_SEMANTIC = f"""
WITH {_SQL_VECTORS}, best AS ({SQL_FILTERED})
SELECT question_id, round(greatest(max({_SQL_COSINE}), 0.0), 8) AS max_similarity,
       greatest(max({_SQL_COSINE}), 0.0) >= 0.4 AS semantic_ok
FROM best JOIN e q ON q.id = question_id JOIN e c ON c.id = corpus_id WHERE rank <= 3 GROUP BY 1"""


# --- retrieval over texts -----------------------------------------------------------------


def _benchmark_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("question_id"), F.col("text").alias("question")
    )


def _hits(questions: DataFrame, collection: DataFrame) -> DataFrame:
    asked = materialize(
        questions.select("question_id", hash_embed(F.col("question")).alias("embedding")), "asked"
    )
    return knn.topk(asked, collection, metric="cosine", dims=DEFAULT_DIMS)


def _retrieved(questions: DataFrame, collection: DataFrame) -> DataFrame:
    return docs.attach_documents(questions, _hits(questions, collection), collection)


def sparse_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = _hits(_benchmark_questions(spark, sf_dir), document_collection(spark, sf_dir))
    return _ranked(hits)


_SQL_BENCHMARK = "asked AS (SELECT item_id AS id, text FROM benchmark)"
SQL_SPARSE = f"""
WITH {_SQL_BENCHMARK}, {sql_hits('hits', 'asked')}
SELECT question_id, corpus_id, score, rank FROM hits"""


def grade_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = user_questions(spark, sf_dir).select("question_id", "question")
    graded = docs.grade_documents(_retrieved(asked, document_collection(spark, sf_dir)))
    # the outer form, since the inner one would filter on the graded array and grade twice
    kept = graded.select("question_id", "question", F.inline_outer("documents"))
    return kept.where(F.col("rank").isNotNull()).select(
        "question_id", F.col("rank").cast("bigint").alias("rank"), "source",
        F.round(tx.token_overlap(F.col("question"), F.col("page_content")), 8).alias("overlap"),
    )


SQL_GRADE = f"""
WITH {SQL_QUESTIONS}, {sql_hits('hits', 'questions')}, {sql_graded('graded', 'hits', 'questions')}
SELECT question_id, rank, source, round(overlap, 8) AS overlap FROM graded"""


def context_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _retrieved(_benchmark_questions(spark, sf_dir), document_collection(spark, sf_dir))
    return found.select("question_id", docs.context(F.col("documents")).alias("context"))


def _sql_context(rows: str, number: str) -> str:
    """``(question_id, context, sources)`` per question of ``rows``."""
    entry = (
        f"{number} || '. **' || source || '**' || chr(10) || substr(page_content, 1, 500) "
        f"|| '...' || chr(10) || chr(10)"
    )
    return f"""
SELECT question_id, {quote(docs.CONTEXT_HEADER)} || string_agg({entry}, '' ORDER BY rank) AS context,
       string_agg(source, '|' ORDER BY rank) FILTER ({number} <= 3) AS sources
FROM {rows} GROUP BY question_id"""


_SQL_FOUND = f"""
{_SQL_BENCHMARK}, {sql_hits('hits', 'asked')},
found AS (
  SELECT h.*, d.text AS page_content, d.source, q.text AS question
  FROM hits h JOIN docs d ON d.id = h.corpus_id JOIN asked q ON q.id = h.question_id)"""
SQL_CONTEXT = f"WITH {_SQL_FOUND} SELECT question_id, context FROM ({_sql_context('found', 'rank')})"


def prompt_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _retrieved(_benchmark_questions(spark, sf_dir), document_collection(spark, sf_dir))
    return found.select("question_id", docs.prompt(F.col("question"), F.col("documents")).alias("prompt"))


def _sql_prompt(question: str) -> str:
    return (
        f"{quote(docs.SYSTEM_WITH_DOCUMENTS + docs.PROMPT_CONTEXT)} || context || "
        f"{quote(docs.PROMPT_QUESTION)} || {question} || {quote(docs.PROMPT_END)}"
    )


SQL_PROMPT = f"""
WITH {_SQL_FOUND}, blocks AS ({_sql_context('found', 'rank')})
SELECT question_id, {_sql_prompt('q.text')} AS prompt
FROM blocks JOIN asked q ON q.id = question_id"""


def cited_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _retrieved(_benchmark_questions(spark, sf_dir), document_collection(spark, sf_dir))
    return found.select(
        "question_id", F.array_join(docs.cited_sources(F.col("documents")), "|").alias("sources")
    )


SQL_SOURCES = f"WITH {_SQL_FOUND} SELECT question_id, sources FROM ({_sql_context('found', 'rank')})"


def _answered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions with their graded documents and the given answer, where there is one."""
    asked = user_questions(spark, sf_dir).select("question_id", "question")
    graded = docs.grade_documents(_retrieved(asked, document_collection(spark, sf_dir)))
    return graded.join(answers(spark, sf_dir), "question_id")


def keyword_grounding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gr.with_term_share(_answered(spark, sf_dir)).select(
        "question_id", F.round("term_share", 8).alias("term_share"),
        (F.col("term_share") >= gr.MIN_TERM_SHARE).alias("keyword_ok"),
    )


def _sql_terms(x: str) -> str:
    return (
        rf"[lower(w) for w in string_split_regex({x}, '\s+') "
        rf"if length(w) >= 4 AND regexp_full_match(w, '[\p{{L}}\p{{N}}]+')][1:20]"
    )


_SQL_SHARE = f"""
shares AS (
  SELECT question_id, coalesce(len([t for t in terms if contains(lower(generation), t)]) / nullif(len(terms), 0), 0) AS share
  FROM (SELECT question_id, list_distinct(flatten(list({_sql_terms('page_content')}))) AS terms
        FROM graded GROUP BY 1) JOIN answers a ON a.id = question_id)"""
_SQL_ANSWERED = f"""
{SQL_QUESTIONS}, {SQL_ANSWERS}, {sql_hits('hits', 'questions')},
{sql_graded('graded', 'hits', 'questions')}, {_SQL_SHARE}"""
SQL_KEYWORD = f"""
WITH {_SQL_ANSWERED}
SELECT question_id, round(share, 8) AS term_share, share >= 0.1 AS keyword_ok FROM shares"""


def grounding_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = check_answers(_answered(spark, sf_dir))
    return checked.select(
        "question_id", "hallucination_check", "status", F.array_join("sources", "|").alias("sources")
    )


_SQL_REFUSAL = " OR ".join(f"contains(lower(generation), {quote(p)})" for p in tx.REFUSAL_PHRASES)
_SQL_VERDICT = f"""
first3 AS (
  SELECT question_id * 10 + pos AS id, question_id, substr(page_content, 1, 500) AS text
  FROM graded WHERE pos <= 3),
{sql_vectors('fv', 'first3')},
{sql_vectors('av', 'answers', 'generation')},
closest AS (
  SELECT question_id, max(cos) AS best FROM (
    SELECT f.question_id, f.id, sum(fv.w * av.w) / (any_value(fl.len) * any_value(al.len)) AS cos
    FROM first3 f JOIN fv ON fv.id = f.id JOIN av ON av.id = f.question_id AND av.b = fv.b
    JOIN fv_len fl ON fl.id = f.id JOIN av_len al ON al.id = f.question_id GROUP BY 1, 2) GROUP BY 1),
verdicts AS (
  SELECT a.id AS question_id, generation,
    CASE WHEN {_SQL_REFUSAL} THEN 'valid_rejection' WHEN coalesce(best, 0) >= 0.4 THEN 'valid'
         WHEN share >= 0.1 THEN 'valid_keywords' ELSE 'possible_hallucination' END AS hallucination_check
  FROM answers a JOIN shares s ON s.question_id = a.id LEFT JOIN closest m ON m.question_id = a.id)"""
_SQL_STATUS = (
    "CASE hallucination_check "
    + " ".join(f"WHEN '{k}' THEN {quote(v)}" for k, v in gr.STATUS_LABELS.items())
    + " ELSE '' END"
)
SQL_VERDICT = f"""
WITH {_SQL_ANSWERED}, {_SQL_VERDICT}, blocks AS ({_sql_context('graded', 'pos')})
SELECT question_id, hallucination_check, {_SQL_STATUS} AS status, sources
FROM verdicts JOIN blocks USING (question_id)"""


def flow_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents loaded, retrieved for all questions, and kept by grading."""
    collection = document_collection(spark, sf_dir)
    asked = user_questions(spark, sf_dir).select("question_id", "question")
    graded = docs.grade_documents(_retrieved(asked, collection))
    totals = graded.agg(F.sum("retrieved").alias("retrieved"), F.sum("kept").alias("kept")).select(
        F.inline(F.array(
            F.struct(F.lit("retrieved").alias("counter"), F.col("retrieved").alias("n")),
            F.struct(F.lit("kept").alias("counter"), F.col("kept").alias("n")),
        ))
    )
    return totals.unionByName(
        collection.agg(F.count(F.lit(1)).alias("n")).select(F.lit("documents").alias("counter"), "n")
    )


SQL_COUNTERS = f"""
WITH {SQL_QUESTIONS}, {sql_hits('hits', 'questions')}, {sql_graded('graded', 'hits', 'questions')}
SELECT 'documents' AS counter, count(*) AS n FROM documents
UNION ALL SELECT 'retrieved', count(*) FROM hits UNION ALL SELECT 'kept', count(*) FROM graded"""


def status_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = check_answers(_answered(spark, sf_dir))
    icon = gr.status_icon(F.col("hallucination_check")).alias("icon")
    return checked.groupBy("hallucination_check", icon, "status").agg(F.count(F.lit(1)).alias("answers"))


_SQL_ICON = (
    "CASE hallucination_check "
    + " ".join(f"WHEN '{k}' THEN {quote(v)}" for k, v in gr.STATUS_ICONS.items())
    + f" ELSE {quote(gr.OTHER_ICON)} END"
)
SQL_STATUS = f"""
WITH {_SQL_ANSWERED}, {_SQL_VERDICT}
SELECT hallucination_check, {_SQL_ICON} AS icon, {_SQL_STATUS} AS status, count(*) AS answers
FROM verdicts GROUP BY 1, 2, 3"""


def answer_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole flow: every user turn against all documents."""
    result = answer_batch(
        user_questions(spark, sf_dir).select("question_id", "question"),
        document_collection(spark, sf_dir), answers(spark, sf_dir), replies(spark, sf_dir),
    )
    return result.select(
        "question_id", "is_safe", "screening.reason", "prompt", "answer", "hallucination_check",
        "status", F.array_join("sources", "|").alias("sources"),
    )


SQL_ANSWER = f"""
WITH {_SQL_ANSWERED}, {_SQL_VERDICT}, {SQL_REPLIES}, blocks AS ({_sql_context('graded', 'pos')}),
cleaned AS (
  SELECT q.id, {sql_strip('q.text')} AS text, r.reply FROM questions q
  LEFT JOIN replies r ON r.question = {sql_strip('q.text')}
  WHERE {sql_strip('q.text')} <> '' AND lower({sql_strip('q.text')}) NOT IN ('sair', 'exit', 'quit', 'q')),
screened AS (SELECT * FROM ({_sql_screen('cleaned', 'id, text')}))
SELECT id AS question_id, is_safe, reason,
  CASE WHEN is_safe THEN {_sql_prompt('text')} END AS prompt,
  CASE WHEN is_safe THEN v.generation ELSE {quote(REFUSAL_MESSAGE)} END AS answer,
  CASE WHEN is_safe THEN coalesce(hallucination_check, 'validation_error') END AS hallucination_check,
  CASE WHEN is_safe THEN coalesce({_SQL_STATUS}, '') END AS status,
  CASE WHEN is_safe THEN sources END AS sources
FROM screened LEFT JOIN verdicts v ON v.question_id = id LEFT JOIN blocks b ON b.question_id = id"""


def _finished_translations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finished translations of well labelled conversations: of a question the document with its number,
    of an answer the answer itself with a mark."""
    good = table(spark, sf_dir, "labels").where("quality = 1").select(F.col("doc_id").alias("conv_id")).distinct()
    texts = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("conv_id"), F.col("text").alias("translated"))
    asked = user_questions(spark, sf_dir).join(good, "conv_id", "left_semi").select(
        "conv_id", tr.text_key(tx.strip(F.col("question"))).alias("text_key")
    )
    asked = materialize(asked, "asked")
    if asked.count() * 64 <= docs.MAX_BROADCAST_BYTES:  # a key and a number each; the texts are read where they lie
        asked = F.broadcast(asked)
    asked = texts.join(asked, "conv_id").select("text_key", F.lit("pt_en").alias("direction"), "translated")
    said = table(spark, sf_dir, "conversations").where("role = 'assistant'").join(good, "conv_id", "left_semi").select(
        tr.text_key(F.col("text")).alias("text_key"), F.lit("en_pt").alias("direction"),
        F.concat(F.lit("[en_pt] "), "text").alias("translated"),
    )
    found = asked.unionByName(said).groupBy("text_key", "direction").agg(F.min("translated").alias("translated"))
    return materialize(found, "translations")  # questions and answers are looked up in it


def answer_translated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole flow with a detected language, translations both ways and the masked question.

    The language of the document with a conversation's number is the detected one;
    the tables have no Portuguese, so Spanish stands in for it.
    """
    spoken = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("conv_id"),
        F.when(F.col("lang") == "es", "pt").otherwise(F.col("lang")).alias("primary_language"),
    )
    asked = user_questions(spark, sf_dir).join(spoken, "conv_id", "left")
    result = answer_batch(
        asked.select("question_id", "question", "primary_language"), document_collection(spark, sf_dir),
        answers(spark, sf_dir), replies(spark, sf_dir), _finished_translations(spark, sf_dir),
    )
    return result.select(
        "question_id", "language", tx.mask_pii(F.col("question")).alias("masked_question"), "question_en", "is_safe",
        "screening.reason", "prompt", "answer", "hallucination_check", "status",
        F.array_join("sources", "|").alias("sources"),
    )


SQL_TRANSLATED = f"""
WITH {SQL_QUESTIONS}, {SQL_ANSWERS}, {SQL_REPLIES},
good AS (SELECT DISTINCT doc_id FROM labels WHERE quality = 1),
spoken AS (
  SELECT *, {_SQL_LANGUAGE} AS language FROM (
    SELECT q.id, q.conv_id, {sql_strip('q.text')} AS text, CASE WHEN d.lang = 'es' THEN 'pt' ELSE d.lang END AS lang
    FROM questions q LEFT JOIN documents d ON d.doc_id = q.conv_id)),
asked_in_english AS (
  SELECT s.text, {sql_strip('min(d.text)')} AS translated FROM spoken s
  JOIN good g ON g.doc_id = s.conv_id JOIN documents d ON d.doc_id = s.conv_id GROUP BY 1),
said AS (
  SELECT DISTINCT text FROM conversations WHERE role = 'assistant' AND conv_id IN (SELECT doc_id FROM good)),
searched AS (
  SELECT s.id, s.language, s.text AS question,
    coalesce(CASE WHEN s.language = 'pt' AND length(s.text) >= 2 THEN t.translated END, s.text) AS text
  FROM spoken s LEFT JOIN asked_in_english t ON t.text = s.text),
{sql_hits('hits', 'searched')}, {sql_graded('graded', 'hits', 'questions')}, {_SQL_SHARE}, {_SQL_VERDICT},
blocks AS ({_sql_context('graded', 'pos')}),
cleaned AS (
  SELECT s.id, s.language, s.question AS text, s.text AS question_en, r.reply FROM searched s
  LEFT JOIN replies r ON r.question = s.question
  WHERE s.question <> '' AND lower(s.question) NOT IN ('sair', 'exit', 'quit', 'q')),
screened AS (SELECT * FROM ({_sql_screen('cleaned', 'id, language, question_en, text')}))
SELECT s.id AS question_id, language, {_sql_masked('s.text')} AS masked_question, question_en, is_safe, reason,
  CASE WHEN is_safe THEN {_sql_prompt('s.text')} END AS prompt,
  CASE WHEN NOT is_safe THEN {quote(REFUSAL_MESSAGE)}
       WHEN language = 'pt' AND length(v.generation) >= 2 AND said.text IS NOT NULL
       THEN {sql_strip("'[en_pt] ' || v.generation")} ELSE v.generation END AS answer,
  CASE WHEN is_safe THEN coalesce(hallucination_check, 'validation_error') END AS hallucination_check,
  CASE WHEN is_safe THEN coalesce({_SQL_STATUS}, '') END AS status,
  CASE WHEN is_safe THEN sources END AS sources
FROM screened s LEFT JOIN verdicts v ON v.question_id = s.id LEFT JOIN blocks b ON b.question_id = s.id
LEFT JOIN said ON said.text = v.generation"""


def audit_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers appended to the audit log with their sources, then counted from it."""
    path = scratch(spark, "audit")
    result = answer_batch(
        user_questions(spark, sf_dir).select("question_id", "question"),
        document_collection(spark, sf_dir), answers(spark, sf_dir), replies(spark, sf_dir),
    )
    append_audit(audit_rows(result), path)
    logged = spark.read.parquet(path)
    return logged.groupBy(F.coalesce("hallucination_check", F.lit("rejected")).alias("verdict")).agg(
        F.count(F.lit(1)).alias("answers"),
        F.sum(F.coalesce(F.size("sources"), F.lit(0))).alias("sources"),
    )


SQL_AUDIT = f"""
SELECT coalesce(hallucination_check, 'rejected') AS verdict, count(*) AS answers,
       sum(coalesce(len(string_split(sources, '|')), 0))::BIGINT AS sources
FROM ({SQL_ANSWER}) GROUP BY 1"""

QUERIES = {
    "hash_embed": (embed_documents, SQL_EMBED),
    "topk_cosine": (topk_cosine, SQL_COSINE),
    "topk_cells": (topk_cells, SQL_COSINE),
    "topk_multipass": (topk_multipass, SQL_COSINE),
    "topk_l2": (topk_l2, SQL_L2),
    "topk_filtered": (topk_filtered, SQL_FILTERED),
    "topk_approx": (topk_approx, SQL_APPROX),
    "topk_recall": (topk_recall, SQL_RECALL),
    "vector_pairs": (vector_pairs, SQL_PAIRS),
    "semantic_grounding": (semantic_grounding, SQL_SEMANTIC),
    "sparse_topk": (sparse_topk, SQL_SPARSE),
    "grade_fallback": (grade_fallback, SQL_GRADE),
    "context_block": (context_block, SQL_CONTEXT),
    "prompt_render": (prompt_render, SQL_PROMPT),
    "cited_sources": (cited_sources, SQL_SOURCES),
    "keyword_grounding": (keyword_grounding, SQL_KEYWORD),
    "grounding_verdict": (grounding_verdict, SQL_VERDICT),
    "status_labels": (status_labels, SQL_STATUS),
    "flow_counters": (flow_counters, SQL_COUNTERS),
    "answer_batch": (answer_all, SQL_ANSWER),
    "answer_translated": (answer_translated, SQL_TRANSLATED),
    "audit_log": (audit_log, SQL_AUDIT),
}
