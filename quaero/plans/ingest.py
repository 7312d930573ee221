"""From documents to a searchable collection."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaero.functions import text as tx
from quaero.functions.vectors import DEFAULT_DIMS, hash_embed
from quaero.operators.chunking import CHUNK_OVERLAP, CHUNK_SIZE, chunk_documents
from quaero.sources.collection import lay_out, open_or_build
from quaero.sources.corpus import load_corpus


def build_collection(
    documents: DataFrame,
    text: str = "page_content",
    size: int = CHUNK_SIZE,
    overlap: int = CHUNK_OVERLAP,
    dims: int = DEFAULT_DIMS,
    mask: Mapping[str, str] | None = tx.MASK_PATTERNS,
) -> DataFrame:
    """Mask, chunk and embed. All three work row by row, so nothing is shuffled.

    Masking comes first: personal data must neither be stored nor embedded. Chunks
    of documents with a ``doc_key`` get a ``corpus_id`` to be retrieved by.
    """
    if mask is not None:
        documents = documents.withColumn(text, tx.mask_pii(F.col(text), mask))
    chunks = chunk_documents(documents, text, size, overlap)
    if "doc_key" in chunks.columns:
        chunks = chunks.withColumn("corpus_id", F.concat_ws("#", "doc_key", F.col("chunk_no").cast("string")))
    return chunks.withColumn("embedding", hash_embed(F.col(text), dims))


def open_corpus(spark: SparkSession, root: str, path: str, **options) -> DataFrame:
    """The collection stored at ``path``; built from the files under ``root`` the first time."""

    def build() -> DataFrame:
        documents, _ = load_corpus(spark, root)
        return build_collection(lay_out(documents), **options)

    return open_or_build(spark, path, build)
