"""Readers for question-and-answer corpora: XML, keyed JSON and mixed folders.

Every reader takes an explicit schema, keeps going over broken files and reports
them in a quarantine table.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quaero.functions import text as tx
from quaero.session import materialize

QA_XML_SCHEMA = """
_id STRING, _source STRING, _url STRING, Focus STRING,
FocusAnnotations STRUCT<UMLS: STRUCT<
  CUIs: STRUCT<CUI: ARRAY<STRING>>,
  SemanticTypes: STRUCT<SemanticType: ARRAY<STRING>>,
  SemanticGroup: STRING>>,
QAPairs STRUCT<QAPair: ARRAY<STRUCT<
  _pid: STRING,
  Question: STRUCT<_VALUE: STRING, _qid: STRING, _qtype: STRING>,
  Answer: STRING>>>,
_corrupt_record STRING
"""

PROTOCOL_XML_SCHEMA = """
Metadata STRUCT<ID: STRING, Title: STRING, Specialty: STRING, Version: STRING,
  LastUpdated: DATE, Authority: STRING, Keywords: STRING>,
Content STRUCT<Section: ARRAY<STRUCT<Name: STRING, Text: STRING>>>,
_corrupt_record STRING
"""

QUARANTINE_SCHEMA = "path STRING, source STRING, record STRING"

# Defaults and tags of indexed documents.
DEFAULT_FOCUS = "General Health"
DEFAULT_URL = "URL não informada"
DEFAULT_PAIR_ID = "unknown"
QA_TYPE = "medquad_xml"
ABSTRACT_TYPE = "pubmed_qa"
PROTOCOL_TYPE = "protocol_xml"
CORPUS_JSON_NAMES = ("pqal", "ground_truth")

CORPUS_SCHEMA = """
doc_key STRING, page_content STRING, source STRING, type STRING, focus STRING, original_id STRING,
pubmed_id STRING, qid STRING, qtype STRING, semantic_group STRING, cuis ARRAY<STRING>
"""


def _read(spark: SparkSession, fmt: str, path: str, schema: str, glob: str, **options) -> DataFrame:
    """Read a folder tree; a missing root reads as an empty table."""
    full = T.StructType.fromDDL(schema).add("path", "string").add("source", "string").add("modified_at", "timestamp")
    reader = spark.read.format(fmt).schema(schema).options(
        recursiveFileLookup=True, pathGlobFilter=glob, **options
    )
    try:
        return reader.load(path).select(
            "*",
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_name").alias("source"),
            F.col("_metadata.file_modification_time").alias("modified_at"),
        )
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], full)


def _read_xml(
    spark: SparkSession, path: str, schema: str, row_tag: str, label: str
) -> tuple[DataFrame, DataFrame]:
    """Parse XML once into a table; return its good rows and the broken files.

    Surrounding white space belongs to a text and is kept.
    """
    raw = _read(
        spark, "xml", path, schema, "*.xml", rowTag=row_tag, mode="PERMISSIVE",
        columnNameOfCorruptRecord="_corrupt_record", ignoreSurroundingSpaces=False,
    )
    df = materialize(raw, label)
    broken = F.col("_corrupt_record").isNotNull()
    return (
        df.where(~broken).drop("_corrupt_record"),
        df.where(broken).select("path", "source", F.col("_corrupt_record").alias("record")),
    )


def read_qa_xml(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """One row per QA file, and the quarantine of files that do not parse."""
    return _read_xml(spark, path, QA_XML_SCHEMA, "Document", "qa-xml")


def explode_qa(files: DataFrame) -> DataFrame:
    """One row per question-and-answer pair, with defaults for missing parts.

    The pair's ids, question type and the file's annotations are kept as columns.
    """
    pair = files.select(
        "path", "source", "modified_at",
        F.coalesce("Focus", F.lit(DEFAULT_FOCUS)).alias("focus"),
        F.coalesce("_url", F.lit(DEFAULT_URL)).alias("url"),
        F.col("FocusAnnotations.UMLS.SemanticGroup").alias("semantic_group"),
        F.col("FocusAnnotations.UMLS.CUIs.CUI").alias("cuis"),
        F.posexplode("QAPairs.QAPair").alias("pair_no", "pair"),
    )
    return pair.select(
        "path", "source", "modified_at", "pair_no", "focus", "url", "semantic_group", "cuis",
        F.coalesce("pair._pid", F.lit(DEFAULT_PAIR_ID)).alias("original_id"),
        F.col("pair.Question._qid").alias("qid"),
        F.col("pair.Question._qtype").alias("qtype"),
        F.coalesce("pair.Question._VALUE", F.lit("")).alias("question"),
        F.coalesce("pair.Answer", F.lit("")).alias("answer"),
    )


def doc_key(path: str, part: str) -> Column:
    """Unique name of one record: the file and its place in it."""
    return F.concat_ws("#", path, F.col(part).cast("string")).alias("doc_key")


def qa_documents(pairs: DataFrame) -> DataFrame:
    """Pairs as indexable documents."""
    return pairs.select(
        doc_key("path", "pair_no"),
        tx.qa_text(
            F.col("focus"), F.col("question"),
            tx.answer_or_pointer(F.col("answer"), F.col("url")), F.col("url"),
        ).alias("page_content"),
        "source", F.lit(QA_TYPE).alias("type"), "focus", "original_id",
        "qid", "qtype", "semantic_group", "cuis",
    )


def read_protocol_xml(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """One row per section of a protocol file, and the quarantine."""
    good, broken = _read_xml(spark, path, PROTOCOL_XML_SCHEMA, "Protocol", "protocol-xml")
    sections = good.select(
        "path", "source", "modified_at", "Metadata.*", F.posexplode("Content.Section").alias("section_no", "section")
    )
    return (
        sections.select(
            "path", "source", "modified_at", F.col("ID").alias("protocol_id"), F.col("Title").alias("title"),
            F.col("Specialty").alias("specialty"), F.col("Version").alias("version"),
            F.col("LastUpdated").alias("last_updated"), F.col("Authority").alias("authority"),
            F.split("Keywords", r"\s*,\s*").alias("keywords"),
            "section_no", F.col("section.Name").alias("section"), F.col("section.Text").alias("text"),
        ),
        broken,
    )


def protocol_documents(sections: DataFrame) -> DataFrame:
    text = F.concat(
        F.lit("Topic: "), F.coalesce("title", F.lit(DEFAULT_FOCUS)),
        F.lit("\nSection: "), F.coalesce("section", F.lit("")),
        F.lit("\n"), F.coalesce("text", F.lit("")),
    )
    return sections.select(
        doc_key("path", "section_no"), text.alias("page_content"), "source", F.lit(PROTOCOL_TYPE).alias("type"),
        F.coalesce("specialty", F.lit(DEFAULT_FOCUS)).alias("focus"),
        F.col("protocol_id").alias("original_id"),
    )


# --- keyed JSON ---------------------------------------------------------------------


def read_json_files(spark: SparkSession, path: str, glob: str = "*.json") -> DataFrame:
    """One row per JSON file: ``value``, ``path`` and ``source``. The format is one object per file."""
    return _read(spark, "text", path, "value STRING", glob, wholetext=True)


def explode_keyed(df: DataFrame, json: str = "value") -> tuple[DataFrame, DataFrame]:
    """Split ``{key: record}`` texts into rows ``key``, ``record`` (VARIANT), plus the broken ones."""
    parsed = df.withColumn("_doc", F.try_parse_json(json))
    is_object = F.coalesce(F.schema_of_variant("_doc").startswith("OBJECT"), F.lit(False))
    carried = [c for c in df.columns if c != json]
    fields = df.sparkSession.tvf.variant_explode(F.col("_doc").outer())
    good = (
        parsed.where(is_object).drop(json).lateralJoin(fields)
        .select(*carried, "key", F.col("value").alias("record"))
    )
    return good, parsed.where(~is_object).select(*carried, F.col(json).alias("record"))


def _field(record: str, name: str, kind: str = "string") -> Column:
    return F.try_variant_get(record, f"$.{name}", kind)


def _is_object(record: str) -> Column:
    return F.coalesce(F.schema_of_variant(record).startswith("OBJECT"), F.lit(False))


def abstract_records(keyed: DataFrame) -> DataFrame:
    """Question, contexts and long answer per id; values that are not objects are skipped.

    Contexts come as a list or as one scalar; both end up as one text.
    """
    listed = F.try_variant_get("record", "$.CONTEXTS", "array<string>")
    scalar = _field("record", "CONTEXTS")
    return keyed.where(_is_object("record")).select(
        "path", "source", F.col("key").alias("pubmed_id"),
        F.coalesce(_field("record", "QUESTION"), F.lit("")).alias("question"),
        F.coalesce(F.array_join(listed, "\n"), scalar, F.lit("")).alias("context"),
        F.coalesce(_field("record", "LONG_ANSWER"), F.lit("")).alias("long_answer"),
    )


def abstract_documents(records: DataFrame) -> DataFrame:
    return records.select(
        doc_key("path", "pubmed_id"),
        tx.abstract_text(F.col("context"), F.col("question"), F.col("long_answer")).alias("page_content"),
        "source", F.lit(ABSTRACT_TYPE).alias("type"), "pubmed_id",
    )


def is_corpus_json(file_name: Column) -> Column:
    hit = F.lit(False)
    for part in CORPUS_JSON_NAMES:
        hit = hit | file_name.contains(part)
    return hit


def read_keyed_json(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Keyed records of all corpus JSON files under ``path``, chosen by file name first."""
    files = read_json_files(spark, path).where(is_corpus_json(F.col("source")))
    return explode_keyed(files.select("value", "path", "source"))


def read_label_map(spark: SparkSession, path: str, glob: str = "*.json") -> DataFrame:
    """``{id: label}`` files as ``(id, label)``; see :func:`json_quarantine` for files that are no object."""
    keyed, _ = explode_keyed(read_json_files(spark, path, glob).select("value", "path", "source"))
    return keyed.select(F.col("key").alias("id"), F.try_variant_get("record", "$", "string").alias("label"))


def read_labelled_set(spark: SparkSession, path: str, glob: str = "*.json") -> DataFrame:
    """``{id: {final_decision, ...}}`` files as one row per id with three label columns."""
    keyed, _ = explode_keyed(read_json_files(spark, path, glob).select("value", "path", "source"))
    return keyed.where(_is_object("record")).select(
        F.col("key").alias("id"),
        *[
            _field("record", name).alias(name)
            for name in ("final_decision", "reasoning_free_pred", "reasoning_required_pred")
        ],
    )


def json_quarantine(spark: SparkSession, path: str, glob: str = "*.json") -> DataFrame:
    """One row per JSON file under ``path`` that does not hold an object."""
    files = read_json_files(spark, path, glob).select("path", "source", "value")
    return explode_keyed(files)[1].select("path", "source", "record")


# --- mixed folders ------------------------------------------------------------------


def load_corpus(
    spark: SparkSession, root: str, extra: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """All documents under ``root`` in one layout, and one quarantine row per broken file.

    ``extra`` adds documents extracted elsewhere, such as page texts: any subset
    of the corpus columns.
    """
    files, broken_qa = read_qa_xml(spark, root)
    sections, broken_protocol = read_protocol_xml(spark, root)
    keyed, broken_json = read_keyed_json(spark, root)
    documents = spark.createDataFrame([], CORPUS_SCHEMA)
    parts = [
        qa_documents(explode_qa(files)),
        protocol_documents(sections),
        abstract_documents(abstract_records(keyed)),
        *([extra] if extra is not None else []),
    ]
    for part in parts:
        documents = documents.unionByName(part, allowMissingColumns=True)
    broken = broken_qa.unionByName(broken_protocol).unionByName(broken_json.select("path", "source", "record"))
    return documents, broken.dropDuplicates(["path"])
