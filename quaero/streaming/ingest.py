"""Documents that keep arriving: an append-only chunk log with latest-wins reading."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quaero.plans.ingest import build_collection
from quaero.sources.collection import lay_out


def ingest_batch(documents: DataFrame, root: str, batch_id: int, key: str = "doc_key", **options) -> None:
    """Chunk, embed and store one batch under its own folders; a retry overwrites only those.

    ``key`` names the document: a later version has the same key. Nothing stored
    earlier is rewritten: a changed document appears again with a later
    ``modified_at`` (if the table has it) or a higher batch number. Of several
    versions in one batch the latest counts; of equal ones, one.
    """
    dated = F.col("modified_at").cast("timestamp") if "modified_at" in documents.columns else F.lit(None).cast("timestamp")
    rest = [c for c in documents.columns if c != key]
    newest = documents.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(dated.alias("m"), F.xxhash64(*rest))).alias("_d"))
    newest = newest.select(key, "_d.*")
    build_collection(lay_out(newest), **options).write.mode("overwrite").parquet(f"{root}/chunks/batch_id={batch_id}")
    log = documents.groupBy(key).agg(F.max(dated).alias("modified_at"))
    log.write.mode("overwrite").parquet(f"{root}/documents/batch_id={batch_id}")


def ingest_stream(
    documents: DataFrame, root: str, checkpoint: str, key: str = "doc_key", **options
) -> StreamingQuery:
    """Make new documents searchable as they arrive."""

    def store(batch: DataFrame, batch_id: int) -> None:
        ingest_batch(batch, root, batch_id, key, **options)

    return (
        documents.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def current_chunks(
    spark: SparkSession, root: str, listing: DataFrame | None = None, key: str = "doc_key"
) -> DataFrame:
    """Chunks of the latest version of every document.

    With ``listing``, a table of the keys that still exist, removed documents are
    left out. The right sides have one row per document, so a document with very
    many chunks is a skewed left side, which AQE splits.
    """
    log = spark.read.parquet(f"{root}/documents")
    latest = log.groupBy(key).agg(F.max_by("batch_id", F.struct("modified_at", "batch_id")).alias("batch_id"))
    if listing is not None:
        latest = latest.join(listing.select(key).distinct(), key, "left_semi")
    return spark.read.parquet(f"{root}/chunks").join(latest, [key, "batch_id"]).drop("batch_id")


def new_or_changed(files: DataFrame, known: DataFrame) -> DataFrame:
    """Files whose ``(source, modified_at)`` is not among the known ones."""
    return files.join(known.select("source", "modified_at"), ["source", "modified_at"], "left_anti")
