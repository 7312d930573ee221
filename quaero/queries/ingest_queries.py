"""Corpus assembly, chunking, stored collections and readers over files Spark derives."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quaero.functions import text as tx
from quaero.operators.catalogue import corpus_catalogue
from quaero.operators.chunking import chunk_documents
from quaero.plans.ingest import build_collection
from quaero.queries.common import (
    SQL_ANSWERS, SQL_QUESTIONS, answers, named_documents, quote, scratch, spread, table, user_questions,
)
from quaero.sources import collection as store
from quaero.sources import corpus as src

FOCUS = "General Health"
POINTER = "Conteúdo protegido por copyright. Consulte a fonte oficial: "


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every user turn with the next assistant turn, or no answer."""
    asked = user_questions(spark, sf_dir)
    url = F.concat(F.lit("conversation/"), F.col("conv_id").cast("string"))
    return asked.join(answers(spark, sf_dir), "question_id", "left").select(
        "question_id", "question", F.coalesce("generation", F.lit("")).alias("answer"), url.alias("url")
    )


def qa_assemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    answer = tx.answer_or_pointer(F.col("answer"), F.col("url"))
    text = tx.qa_text(F.lit(FOCUS), F.col("question"), answer, F.col("url"))
    return _pairs(spark, sf_dir).select("question_id", text.alias("page_content"))


_SQL_PAIRS = f"""
{SQL_QUESTIONS}, {SQL_ANSWERS}, pairs AS (
  SELECT q.id, q.text AS question, coalesce(a.generation, '') AS answer, 'conversation/' || conv_id AS url
  FROM questions q LEFT JOIN answers a USING (id))"""
_SQL_QA_TEXT = (
    f"'Topic: {FOCUS}' || chr(10) || 'Question: ' || question || chr(10) || 'Answer: ' || "
    rf"CASE WHEN regexp_full_match(answer, '\s*') THEN {quote(POINTER)} || url ELSE answer END "
    "|| chr(10) || 'Source URL: ' || url"
)
SQL_QA = f"WITH {_SQL_PAIRS} SELECT id AS question_id, {_SQL_QA_TEXT} AS page_content FROM pairs"


def _write_qa_xml(spark: SparkSession, sf_dir: str, path: str) -> None:
    pair = F.struct(
        F.col("question_id").cast("string").alias("_pid"),
        F.struct(F.col("question").alias("_VALUE"), F.lit("information").alias("_qtype")).alias("Question"),
        F.col("answer").alias("Answer"),
    )
    files = _pairs(spark, sf_dir).select(
        F.col("question_id").cast("string").alias("_id"), F.col("url").alias("_url"),
        F.lit(FOCUS).alias("Focus"), F.struct(F.array(pair).alias("QAPair")).alias("QAPairs"),
    )
    files.write.option("rowTag", "Document").option("rootTag", "Documents").xml(path)


def qa_xml_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pairs written as QA XML files, then read, exploded and assembled by the reader."""
    path = scratch(spark, "qa-xml")
    _write_qa_xml(spark, sf_dir, path)
    good, _ = src.read_qa_xml(spark, path)
    return src.qa_documents(src.explode_qa(good)).select(
        F.col("original_id").cast("bigint").alias("question_id"), "page_content", "focus", "type", "qtype"
    )


SQL_QA_XML = f"""
WITH {_SQL_PAIRS}
SELECT id AS question_id, {_SQL_QA_TEXT} AS page_content, '{FOCUS}' AS focus, 'medquad_xml' AS type,
       'information' AS qtype FROM pairs"""


def _write_protocol_xml(spark: SparkSession, sf_dir: str, path: str) -> None:
    section = F.struct(F.col("lang").alias("Name"), F.col("text").alias("Text"))
    files = spread(table(spark, sf_dir, "documents")).select(
        F.struct(
            F.col("doc_id").cast("string").alias("ID"), F.col("source").alias("Title"),
            F.col("lang").alias("Specialty"), F.lit("1.0").alias("Version"),
            F.concat_ws(", ", "lang", "source").alias("Keywords"),
        ).alias("Metadata"),
        F.struct(F.array(section).alias("Section")).alias("Content"),
    )
    files.write.option("rowTag", "Protocol").option("rootTag", "Protocols").xml(path)


def protocol_xml_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as protocol XML, then read back as one row per section."""
    path = scratch(spark, "protocol-xml")
    _write_protocol_xml(spark, sf_dir, path)
    sections, _ = src.read_protocol_xml(spark, path)
    return sections.select(
        F.col("protocol_id").cast("bigint").alias("doc_id"), "title", "specialty", "section", "text",
        F.array_join("keywords", "|").alias("keywords"),
    )


SQL_PROTOCOL = """
SELECT doc_id, source AS title, lang AS specialty, lang AS section, text, lang || '|' || source AS keywords
FROM documents"""


def keyed_json_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "props")
    good, _ = src.explode_keyed(events, "props")
    return good.select("event_id", "key", F.try_variant_get("record", "$", "string").alias("value"))


SQL_KEYED = """
SELECT event_id, key, json_extract_string(props, '$.' || key) AS value
FROM (SELECT event_id, props, unnest(json_keys(props)) AS key FROM events)"""


def abstract_assemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs written as keyed JSON records, parsed and assembled as abstracts."""
    record = F.struct(
        F.col("question").alias("QUESTION"), F.array("url", "answer").alias("CONTEXTS"),
        F.col("answer").alias("LONG_ANSWER"),
    )
    value = F.to_json(F.create_map(F.col("question_id").cast("string"), record))
    keyed, _ = src.explode_keyed(_pairs(spark, sf_dir).select(value.alias("value"), F.col("url").alias("path"), F.col("url").alias("source")))
    documents = src.abstract_documents(src.abstract_records(keyed))
    return documents.select(F.col("pubmed_id").cast("bigint").alias("question_id"), "source", "page_content")


SQL_ABSTRACT = f"""
WITH {_SQL_PAIRS}
SELECT id AS question_id, url AS source,
  'Context: ' || url || chr(10) || answer || chr(10) || 'Question: ' || question || chr(10)
  || 'Expert Answer: ' || answer AS page_content FROM pairs"""


def corpus_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, pages and conversations in one layout."""
    pages = table(spark, sf_dir, "pages").select(
        F.col("html").alias("page_content"), F.col("url").alias("source"), F.lit("page").alias("type")
    )
    turns = table(spark, sf_dir, "conversations").select(
        F.col("text").alias("page_content"), F.col("conv_id").cast("string").alias("source"),
        F.lit("conversation").alias("type"), F.col("role").alias("focus"),
    )
    documents = table(spark, sf_dir, "documents").select(
        F.col("text").alias("page_content"), "source", F.lit("document").alias("type"),
        F.col("lang").alias("focus"), F.col("doc_id").cast("string").alias("original_id"),
    )
    both = documents.unionByName(turns, allowMissingColumns=True)
    return both.unionByName(pages, allowMissingColumns=True)


SQL_UNION = """
SELECT text AS page_content, source, 'document' AS type, lang AS focus, doc_id::VARCHAR AS original_id FROM documents
UNION ALL SELECT text, conv_id::VARCHAR, 'conversation', role, NULL FROM conversations
UNION ALL SELECT html, url, 'page', NULL, NULL FROM pages"""


def chunk_recursive(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return chunk_documents(docs, "text")


def chunk_chars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last step of the ladder alone: chunks of 1,000 characters that repeat 200."""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    chunks = chunk_documents(docs, "text", separators=("",))
    return chunks.select("doc_id", F.col("chunk_no").cast("bigint").alias("chunk_no"), F.md5("text").alias("chunk_md5"))


SQL_CHUNK_CHARS = rf"""
WITH cut AS (
  SELECT doc_id, i, regexp_replace(substr(text, 1 + 800 * i, 1000), '^\s+|\s+$', '', 'g') AS chunk
  FROM (SELECT doc_id, text, unnest(range(1 + greatest(0, (length(text) - 1000 + 799) // 800))) AS i FROM documents))
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS chunk_no, md5(chunk) AS chunk_md5
FROM cut WHERE chunk <> ''"""


def chunk_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, chunks and chunk sizes per language and source."""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text"))
    chunks = chunk_documents(docs, "text")
    # chunk 0 exists once per document, so documents need no distinct count
    return chunks.groupBy("lang", "source").agg(
        F.count_if(F.col("chunk_no") == 0).alias("documents"), F.count(F.lit(1)).alias("chunks"),
        F.avg(F.char_length("text")).alias("mean_chars"), F.max(F.char_length("text")).alias("max_chars"),
    )


def collection_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mask, chunk, embed, store and reopen the whole document table."""
    path = scratch(spark, "collection")
    return store.open_or_build(
        spark, path, lambda: build_collection(store.lay_out(named_documents(spark, sf_dir)))
    )


def collection_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One source out of a stored collection that was reset once."""
    path = scratch(spark, "lookup")
    docs = store.lay_out(table(spark, sf_dir, "documents").select("doc_id", "source", "text")).select(
        "doc_id", "source", tx.mask_pii(F.col("text")).alias("page_content")
    )
    store.write_collection(docs.limit(0), path)
    return store.find_source(store.reset_collection(docs, path), "src3")


def _sql_masked(x: str) -> str:
    for kind, pattern in tx.MASK_PATTERNS.items():
        x = f"regexp_replace({x}, {quote(pattern)}, '[{kind}]', 'g')"
    return x


SQL_LOOKUP = f"SELECT doc_id, source, {_sql_masked('text')} AS page_content FROM documents WHERE source = 'src3'"


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("lang", "source", "text")
    counted = corpus_catalogue(docs, ["lang", "source"], "text")
    return counted.select(
        "lang", "source", "documents", F.round("mean_chars", 6).alias("mean_chars"),
        F.col("level").cast("bigint").alias("level"),
    )


SQL_CATALOGUE = """
SELECT lang, source, count(*) AS documents, round(avg(length(text)), 6) AS mean_chars,
       grouping(lang, source)::BIGINT AS level
FROM documents GROUP BY ROLLUP (lang, source)"""

def load_corpus_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder tree of both kinds of XML, with pages as extracted texts, loaded in one layout."""
    root = scratch(spark, "corpus")
    _write_qa_xml(spark, sf_dir, f"{root}/qa")
    _write_protocol_xml(spark, sf_dir, f"{root}/protocols")
    pages = table(spark, sf_dir, "pages").select(
        F.col("html").alias("page_content"), F.col("url").alias("original_id"), F.lit("page").alias("type")
    )
    documents, _ = src.load_corpus(spark, root, pages)
    return documents.select("type", "focus", "original_id", F.md5("page_content").alias("content_md5"))


SQL_LOAD = f"""
WITH {_SQL_PAIRS}
SELECT 'medquad_xml' AS type, '{FOCUS}' AS focus, id::VARCHAR AS original_id, md5({_SQL_QA_TEXT}) AS content_md5 FROM pairs
UNION ALL SELECT 'protocol_xml', lang, doc_id::VARCHAR,
  md5('Topic: ' || source || chr(10) || 'Section: ' || lang || chr(10) || text) FROM documents
UNION ALL SELECT 'page', NULL, url, md5(html) FROM pages"""


def _write_json(spark: SparkSession, sf_dir: str, path: str, value: Column, broken: bool = False) -> None:
    """The labels as JSON objects by id, one file for every remainder of the id; with ``broken`` one file is cut off."""
    rows = table(spark, sf_dir, "labels").withColumn("part", F.col("doc_id") % 7)
    entry = F.struct(F.col("doc_id").cast("string"), value)
    objects = rows.groupBy("part").agg(F.to_json(F.map_from_entries(F.collect_list(entry))).alias("value"))
    if broken:
        cut = F.expr("substring(value, 1, length(value) - 1)")
        objects = objects.withColumn("value", F.when(F.col("part") == 3, cut).otherwise(F.col("value")))
    objects.write.partitionBy("part").text(path)


def label_map_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "label-map")
    _write_json(spark, sf_dir, path, _label("quality"))
    return src.read_label_map(spark, path, "*.txt")


def _label(column: str) -> Column:
    return F.when(F.col(column) == 1, "yes").otherwise("no")


SQL_LABEL_MAP = "SELECT doc_id::VARCHAR AS id, CASE WHEN quality = 1 THEN 'yes' ELSE 'no' END AS label FROM labels"


def labelled_set_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with some fields missing."""
    path = scratch(spark, "labelled-set")
    record = F.struct(
        _label("quality").alias("final_decision"),
        F.when(F.col("toxic") == 1, "maybe").alias("reasoning_free_pred"),
    )
    _write_json(spark, sf_dir, path, record)
    return src.read_labelled_set(spark, path, "*.txt")


SQL_LABELLED_SET = """
SELECT doc_id::VARCHAR AS id, CASE WHEN quality = 1 THEN 'yes' ELSE 'no' END AS final_decision,
       CASE WHEN toxic = 1 THEN 'maybe' END AS reasoning_free_pred, NULL::VARCHAR AS reasoning_required_pred
FROM labels"""


def quarantine_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels read from files of which one is cut off in each of two folders: both are named, the rest is read."""
    root = scratch(spark, "broken")
    for name in ("a", "b"):
        _write_json(spark, sf_dir, f"{root}/{name}", _label("quality"), broken=True)
    read = src.read_label_map(spark, root, "*.txt").agg(F.count(F.lit(1)).alias("n"))
    named = src.json_quarantine(spark, root, "*.txt").agg(F.count_distinct("path").alias("n"))
    return read.select(F.lit("read").alias("outcome"), "n").unionByName(
        named.select(F.lit("quarantined").alias("outcome"), "n")
    )


SQL_QUARANTINE = """
SELECT 'read' AS outcome, 2 * count(*) FILTER (doc_id % 7 <> 3) AS n FROM labels
UNION ALL SELECT 'quarantined', 2 * count(DISTINCT doc_id % 7) FILTER (doc_id % 7 = 3) FROM labels"""

QUERIES = {
    "load_corpus_files": (load_corpus_files, SQL_LOAD),
    "label_map_files": (label_map_files, SQL_LABEL_MAP),
    "labelled_set_files": (labelled_set_files, SQL_LABELLED_SET),
    "quarantine_files": (quarantine_files, SQL_QUARANTINE),
    "qa_assemble": (qa_assemble, SQL_QA),
    "qa_xml_files": (qa_xml_files, SQL_QA_XML),
    "protocol_xml_files": (protocol_xml_files, SQL_PROTOCOL),
    "keyed_json_explode": (keyed_json_explode, SQL_KEYED),
    "abstract_assemble": (abstract_assemble, SQL_ABSTRACT),
    "corpus_union": (corpus_union, SQL_UNION),
    "chunk_recursive": (chunk_recursive, None),
    "chunk_chars": (chunk_chars, SQL_CHUNK_CHARS),
    "chunk_stats": (chunk_stats, None),
    "collection_build": (collection_build, None),
    "collection_lookup": (collection_lookup, SQL_LOOKUP),
    "corpus_catalogue": (catalogue, SQL_CATALOGUE),
}
