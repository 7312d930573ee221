"""What the physical plans must and must not hold."""

import re

import pytest
from pyspark.sql import functions as F

from quaero.operators import cache, evaluate, split
from quaero.operators.chunking import chunk_documents
from quaero.operators.screening import screen
from quaero.plans.answer import prepare_questions
from quaero.plans.ingest import build_collection
from quaero.queries.common import table
from quaero.sources import collection as store


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    return table(spark, sf_dir, "documents")


def test_row_wise_steps_do_not_shuffle(spark, documents):
    docs = documents.select("doc_id", F.col("text").alias("page_content"))
    for df in (build_collection(docs), chunk_documents(docs), screen(docs, "page_content")):
        assert "Exchange" not in plan(df)
    asked = documents.select(F.col("doc_id").alias("question_id"), F.col("text").alias("question"))
    assert "Exchange" not in plan(prepare_questions(asked))


def test_scans_read_only_what_is_used(spark, documents):
    shown = plan(documents.select(F.char_length("lang")))
    assert "ReadSchema: struct<lang:string>" in shown


def test_source_lookup_is_pushed_down(spark, documents, tmp_path):
    path = str(tmp_path / "store")
    store.write_collection(store.lay_out(documents), path)
    found = store.find_source(store.open_collection(spark, path), "src3")
    assert "EqualTo(source,src3)" in plan(found)


def test_fold_reads_skip_folders(spark, documents, tmp_path):
    path = str(tmp_path / "folds")
    store.write_folds(split.nested_folds(documents.select("doc_id", "lang"), "doc_id", "lang"), path)
    dev = store.read_fold(spark, path, 1, "dev")
    assert "PartitionFilters: [isnotnull(role" in plan(dev) and "fold" in plan(dev)


def test_aggregates_combine_before_the_shuffle(spark, documents):
    pairs = documents.select(F.col("lang").alias("truth"), F.col("source").alias("pred"))
    assert "partial_count" in plan(evaluate.scores(pairs))
    entries = documents.select(
        F.col("source").alias("cache_key"), F.current_timestamp().alias("written_at"), "doc_id"
    )
    assert "partial_max_by" in plan(cache.upsert(entries, entries.limit(1)))


def test_texts_are_cut_and_counted_in_slices(spark):
    """The Python functions get Arrow columns, of which they hold a slice as objects, and not whole batches."""
    from pyspark.util import PythonEvalType
    from quaero.functions.vectors import hash_embed
    from quaero.operators.chunking import split_text

    texts = spark.range(0, 700, numPartitions=1).select("id", F.concat(F.lit("word "), F.repeat(F.lit("a b. "), F.col("id").cast("int"))).alias("t"))
    chunked = chunk_documents(texts, "t", 100, 20)
    embedded = texts.select("id", "t", hash_embed(F.col("t"), 8).alias("v"))
    for df in (chunked, embedded):
        assert re.search(rf"ArrowEvalPython.*, {PythonEvalType.SQL_SCALAR_ARROW_UDF}\b", plan(df))
    got = {}
    for r in chunked.orderBy("id", "chunk_no").collect():
        got.setdefault(r.id, []).append(r.t)
    for r in embedded.collect():
        assert got[r.id] == split_text(r.t, 100, 20) and sum(r.v) == len(r.t.split())
