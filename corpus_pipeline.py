"""The corpus pipeline: documents in, packed training pieces out.

Stages in order; each works on all its predecessor kept, and its decisions take
effect there. Up to the last, stages return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaero.llm import decontaminate, line_dedup, near_dedup, packing, quality
from quaero.llm.common import bounded_batches, materialize, table
from quaero.llm.queries import BYTE_BPE, tokenizer
from quaero.session import ship_package

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is under one half go. Empty texts are scored like any other."""
    ship_package(spark)
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).where("score >= 0.5").select(*COLUMNS)


def line_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go, all but the first; a document that has no line left goes with them."""
    ship_package(spark)
    bounded_batches(spark)
    done = line_dedup.dedup_lines(docs)
    cut = F.size("removed_lines") > 0
    left = done.where(~(cut & (F.size("removed_lines") == F.col("n_lines"))))
    n_chars = F.when(cut, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return left.withColumn("n_chars", n_chars).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates, linked at a similarity of 0.8, the smallest id stays."""
    ship_package(spark)
    bounded_batches(spark)
    return near_dedup.one_of_each(docs).select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item to 0.8 of its shingles go."""
    ship_package(spark)
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of fixed windows over all remaining documents."""
    ship_package(spark)
    bounded_batches(spark)
    return packing.pack(docs, tokenizer(BYTE_BPE))


STAGES = [
    ("quality classifier", quality_filter),
    ("line dedup", line_filter),
    ("near-duplicates", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("packing", pack),
]

#: Trained scores, edit distances and token ids have no SQL form; a brute-force version tests the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, "stage")
    return docs
