"""Questions, personal data, screening, language and translation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaero.functions import language as lang
from quaero.functions import text as tx
from quaero.operators import queues as qs
from quaero.operators import screening as sc
from quaero.operators import translation as tr
from quaero.queries.common import (
    SQL_QUESTIONS, SQL_REPLIES, quote, replies, spread, sql_strip, table, user_questions,
)


def question_cleanup(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return sc.clean_questions(turns.select("conv_id", "turn", F.col("text").alias("question")))


SQL_CLEANUP = f"""
SELECT conv_id, turn, {sql_strip('text')} AS question FROM conversations
WHERE {sql_strip('text')} <> '' AND lower({sql_strip('text')}) NOT IN ('sair', 'exit', 'quit', 'q')"""


def length_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return turns.select(
        "conv_id", "turn",
        F.char_length(tx.strip(F.col("text"))).cast("bigint").alias("n_chars"),
        tx.length_ok(F.col("text")).alias("length_ok"),
    )


SQL_LENGTH = f"""
SELECT conv_id, turn, length({sql_strip('text')})::BIGINT AS n_chars,
       length({sql_strip('text')}) BETWEEN 5 AND 500 AS length_ok FROM conversations"""


def _sql_match(kind: str, x: str = "text") -> str:
    return f"regexp_matches({x}, {quote(tx.PII_PATTERNS[kind])})"


def _sql_first_pii(x: str = "text") -> str:
    cases = " ".join(f"WHEN {_sql_match(k, x)} THEN '{k}'" for k in tx.PII_PATTERNS)
    return f"CASE {cases} END"


def pii_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    flags = tx.pii_flags(F.col("text"))
    found = docs.select("doc_id", *[hit.alias(f"has_{kind}") for kind, hit in flags.items()])
    first = F.coalesce(*[F.when(F.col(f"has_{kind}"), F.lit(kind)) for kind in flags])
    return found.withColumn("first_pii", first)


SQL_PII_DETECT = (
    "SELECT doc_id, "
    + ", ".join(f"{_sql_match(k)} AS has_{k}" for k in tx.PII_PATTERNS)
    + f", {_sql_first_pii()} AS first_pii FROM documents"
)


def _sql_masked(x: str = "text") -> str:
    for kind, pattern in tx.MASK_PATTERNS.items():
        x = f"regexp_replace({x}, {quote(pattern)}, '[{kind}]', 'g')"
    return x


def pii_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", tx.mask_pii(F.col("text")).alias("masked"))


SQL_PII_MASK = f"SELECT doc_id, {_sql_masked()} AS masked FROM documents"


def pii_type_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents").select("text"))
    counts = tx.mask_counts(F.col("text"))
    totals = docs.select(*[n.alias(kind) for kind, n in counts.items()]).agg(
        *[F.sum(kind).alias(f"{kind}_matches") for kind in counts],
        *[F.count_if(F.col(kind) > 0).alias(f"{kind}_documents") for kind in counts],
    )
    rows = F.array(*[
        F.struct(
            F.lit(kind).alias("kind"), F.col(f"{kind}_matches").alias("matches"),
            F.col(f"{kind}_documents").alias("documents"),
        )
        for kind in counts
    ])
    return totals.select(F.inline(rows))


SQL_PII_COUNTS = " UNION ALL ".join(
    f"SELECT '{kind}' AS kind, sum(len(regexp_extract_all(text, {quote(p)})))::BIGINT AS matches, "
    f"count(*) FILTER (regexp_matches(text, {quote(p)})) AS documents FROM documents"
    for kind, p in tx.MASK_PATTERNS.items()
)


def screen_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as questions; the quality label is the relevance reply, if there is one."""
    labels = table(spark, sf_dir, "labels").select(
        "doc_id", F.when(F.col("quality") == 1, "Sim, é.").otherwise("Não").alias("reply")
    )
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("question")))
    screened = sc.screen(docs.join(labels, "doc_id", "left"), reply="reply")
    return screened.select("doc_id", "screening.*", "is_safe", "generation")


def _sql_screen(source: str, columns: str) -> str:
    """Verdict columns for ``source(text, reply)``."""
    yes = "coalesce(lower(reply) LIKE '%sim%' OR lower(reply) LIKE '%yes%', true)"
    return f"""
SELECT {columns}, step = 'ok' AS is_valid,
  CASE step WHEN 'length' THEN {quote(sc.LENGTH_REASON)}
            WHEN 'pii' THEN {quote(sc.PII_REASON_START)} || pii || {quote(sc.PII_REASON_END)}
            WHEN 'topic' THEN {quote(sc.RELEVANCE_REASON)} END AS reason,
  step = 'pii' AS has_pii, step <> 'topic' AS is_medical_relevant, step = 'ok' AS is_safe,
  CASE WHEN step <> 'ok' THEN {quote(sc.REFUSAL_MESSAGE)} END AS generation
FROM (
  SELECT *, CASE WHEN length({sql_strip('text')}) NOT BETWEEN 5 AND 500 THEN 'length'
                 WHEN pii IS NOT NULL THEN 'pii'
                 WHEN NOT {yes} THEN 'topic' ELSE 'ok' END AS step
  FROM (SELECT *, {_sql_first_pii()} AS pii FROM {source}))"""


SQL_SCREEN = f"""
WITH asked AS (
  SELECT d.doc_id, d.text, CASE WHEN quality = 1 THEN 'Sim, é.' WHEN quality = 0 THEN 'Não' END AS reply
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)
{_sql_screen('asked', 'doc_id')}"""


def screen_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts counted over all questions, each distinct question judged once."""
    asked = sc.clean_questions(user_questions(spark, sf_dir))
    known = replies(spark, sf_dir)
    judged = sc.once_per_distinct(
        asked, ["question"],
        lambda q: sc.screen(q.join(known, "question", "left"), reply="reply").drop("reply"),
    )
    return judged.groupBy(F.coalesce("screening.reason", F.lit("")).alias("reason")).agg(
        F.count(F.lit(1)).alias("questions"), F.count_if("is_safe").alias("safe")
    )


SQL_SCREEN_SUMMARY = f"""
WITH {SQL_QUESTIONS}, {SQL_REPLIES},
asked AS (
  SELECT q.id, {sql_strip('q.text')} AS text, r.reply FROM questions q
  LEFT JOIN replies r ON r.question = {sql_strip('q.text')}
  WHERE {sql_strip('q.text')} <> '' AND lower({sql_strip('q.text')}) NOT IN ('sair', 'exit', 'quit', 'q'))
SELECT coalesce(reason, '') AS reason, count(*) AS questions, count(*) FILTER (is_safe) AS safe
FROM ({_sql_screen('asked', 'id')}) GROUP BY 1"""


def _scores(text: str = "text"):
    return (
        lang.keyword_score(F.col(text), lang.PORTUGUESE_KEYWORDS),
        lang.keyword_score(F.col(text), lang.ENGLISH_KEYWORDS),
    )


def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    pt, en = _scores()
    return docs.select(
        "doc_id", pt.alias("pt_score"), en.alias("en_score"),
        lang.identify_language(F.col("text"), F.col("lang")).alias("language"),
    )


def _sql_score(words: tuple[str, ...]) -> str:
    listed = ", ".join(quote(w) for w in words)
    return rf"len([t for t in string_split_regex(lower(text), '\s+') if t IN ({listed})])::BIGINT"


_SQL_PT, _SQL_EN = _sql_score(lang.PORTUGUESE_KEYWORDS), _sql_score(lang.ENGLISH_KEYWORDS)
_SQL_LANGUAGE = (
    "CASE WHEN length(text) < 3 OR lang IS NULL OR lang IN ('en', 'en-US', 'en-GB') THEN 'en' "
    f"WHEN lang IN ('pt', 'pt-BR', 'pt-PT') THEN 'pt' WHEN {_SQL_PT} > {_SQL_EN} THEN 'pt' ELSE 'en' END"
)
SQL_LANGUAGE = (
    f"SELECT doc_id, {_SQL_PT} AS pt_score, {_SQL_EN} AS en_score, {_SQL_LANGUAGE} AS language FROM documents"
)


def translation_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Route every document to the other language; labelled good texts have a translation."""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    good = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    finished = (
        docs.join(good, "doc_id", "left_semi")
        .select(
            tr.text_key(F.col("text")).alias("text_key"), "text",
            F.explode(F.array(F.lit("pt_en"), F.lit("en_pt"))).alias("direction"),
        )
        .groupBy("text_key", "direction")
        .agg(F.concat(F.lit("["), F.col("direction"), F.lit("] "), F.min("text")).alias("translated"))
    )
    identified = docs.withColumn("language", lang.identify_language(F.col("text"), F.col("lang")))
    target = F.when(F.col("lang") == "en", "pt").otherwise("en")
    routed = tr.route_translation(identified.withColumn("target", target), finished)
    return routed.select("doc_id", "language", "target", "direction", "translated")


SQL_TRANSLATION = f"""
WITH routed AS (
  SELECT doc_id, text, language, target,
    CASE WHEN length(text) >= 2 AND language = 'pt' AND target = 'en' THEN 'pt_en'
         WHEN length(text) >= 2 AND language = 'en' AND target = 'pt' THEN 'en_pt' END AS direction
  FROM (SELECT doc_id, text, {_SQL_LANGUAGE} AS language,
               CASE WHEN lang = 'en' THEN 'pt' ELSE 'en' END AS target FROM documents)),
finished AS (
  SELECT DISTINCT text FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1))
SELECT doc_id, language, target, direction,
  CASE WHEN direction IS NULL OR f.text IS NULL THEN r.text
       ELSE {sql_strip("'[' || direction || '] ' || r.text")} END AS translated
FROM routed r LEFT JOIN finished f ON f.text = r.text"""



def relevance_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions that still need a relevance reply."""
    asked = sc.clean_questions(user_questions(spark, sf_dir))
    return qs.relevance_queue(asked, replies(spark, sf_dir))


SQL_RELEVANCE_QUEUE = f"""
WITH {SQL_QUESTIONS}, {SQL_REPLIES},
asked AS (SELECT DISTINCT {sql_strip('text')} AS text FROM questions)
SELECT text AS question, {quote(qs.RELEVANCE_START)} || text || {quote(qs.RELEVANCE_END)} AS prompt FROM asked
WHERE length(text) BETWEEN 5 AND 500 AND {_sql_first_pii()} IS NULL
  AND lower(text) NOT IN ('sair', 'exit', 'quit', 'q') AND text NOT IN (SELECT question FROM replies)"""


def translation_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without a translation, where the labelled good ones have one."""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    good = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    finished = docs.join(good, "doc_id", "left_semi").select(
        tr.text_key(F.col("text")).alias("text_key"),
        F.explode(F.array(F.lit("pt_en"), F.lit("en_pt"))).alias("direction"),
    )
    language = lang.identify_language(F.col("text"), F.col("lang"))
    target = F.when(F.col("lang") == "en", "pt").otherwise("en")
    return qs.translation_queue(docs, finished, "text", language, target)


SQL_TRANSLATION_QUEUE = f"""
WITH routed AS (
  SELECT DISTINCT text,
    CASE WHEN length(text) >= 2 AND language = 'pt' AND target = 'en' THEN 'pt_en'
         WHEN length(text) >= 2 AND language = 'en' AND target = 'pt' THEN 'en_pt' END AS direction
  FROM (SELECT text, {_SQL_LANGUAGE} AS language,
               CASE WHEN lang = 'en' THEN 'pt' ELSE 'en' END AS target FROM documents))
SELECT md5(text) AS text_key, direction,
  CASE direction WHEN 'pt_en' THEN {quote(qs.TRANSLATION_START['pt_en'])} ELSE {quote(qs.TRANSLATION_START['en_pt'])} END
  || text ||
  CASE direction WHEN 'pt_en' THEN {quote(qs.TRANSLATION_END['pt_en'])} ELSE {quote(qs.TRANSLATION_END['en_pt'])} END AS prompt
FROM routed WHERE direction IS NOT NULL
  AND text NOT IN (SELECT text FROM documents JOIN labels USING (doc_id) WHERE quality = 1)"""

QUERIES = {
    "question_cleanup": (question_cleanup, SQL_CLEANUP),
    "length_gate": (length_gate, SQL_LENGTH),
    "pii_detect": (pii_detect, SQL_PII_DETECT),
    "pii_mask": (pii_mask, SQL_PII_MASK),
    "pii_type_counts": (pii_type_counts, SQL_PII_COUNTS),
    "screen_verdict": (screen_verdict, SQL_SCREEN),
    "screen_summary": (screen_summary, SQL_SCREEN_SUMMARY),
    "language_id": (language_id, SQL_LANGUAGE),
    "translation_route": (translation_route, SQL_TRANSLATION),
    "relevance_queue": (relevance_queue, SQL_RELEVANCE_QUEUE),
    "translation_queue": (translation_queue, SQL_TRANSLATION_QUEUE),
}
