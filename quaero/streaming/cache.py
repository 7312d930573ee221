"""The expiring cache over a request stream, the same for any cut into micro-batches.

A micro-batch keeps requests that later arrivals may still precede, judges those
the watermark has passed with the batch operator, and stores what the next batch
needs: the requests still open and each live key's last miss. Requests that arrive
behind the watermark are not judged; they go to a table of their own.
"""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from quaero.operators.cache import TTL_SECONDS, micros, replay

FINAL = "final"


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


class CacheStream:
    """Folders of one stream: ``hits``, ``late``, ``open``, ``misses`` and ``clock``, a part per batch."""

    def __init__(
        self, spark: SparkSession, root: str, key: str = "cache_key", asked_at: str = "asked_at",
        order_id: str = "ask_id", ttl_seconds: int = TTL_SECONDS, lateness_seconds: int = 600,
    ) -> None:
        self.spark, self.root = spark, root
        self.key, self.asked_at, self.order_id = key, asked_at, order_id
        self.ttl, self.lateness = ttl_seconds, lateness_seconds * 1_000_000

    def path(self, name: str, part: object) -> str:
        return os.path.join(self.root, name, f"part={part}")

    def _clock(self, part: int) -> int | None:
        """The watermark after a batch, in microseconds; None before any dated request."""
        if part < 0:
            return None
        return _read(self.spark, self.path("clock", part), T.StructType.fromDDL("w long")).agg(F.max("w")).first()[0]

    def _kept(self, name: str, part: int, schema: T.StructType) -> DataFrame:
        if part < 0:
            return self.spark.createDataFrame([], schema)
        return _read(self.spark, self.path(name, part), schema)

    def batch(self, asks: DataFrame, part: int) -> None:
        """Judges what batch ``part`` closes. A repeated batch overwrites only its own parts."""
        asks = asks.select(self.key, self.asked_at, self.order_id)
        time, closed = self._time(asks.schema), self._clock(part - 1)
        if closed is not None:
            # a request without a time is never late
            late = F.coalesce(time <= closed, F.lit(False))
            asks.where(late).write.mode("overwrite").parquet(self.path("late", part))
            asks = asks.where(~late)
        waiting = self._kept("open", part - 1, asks.schema).unionByName(asks)
        newest = waiting.agg(F.max(time)).first()[0]
        mark = max([x for x in (closed, None if newest is None else newest - self.lateness) if x is not None], default=None)
        due = F.lit(False) if mark is None else F.coalesce(time <= mark, F.lit(True))
        self._judge(waiting.where(due), part - 1, part, mark)
        waiting.where(~due).write.mode("overwrite").parquet(self.path("open", part))
        self.spark.createDataFrame([(mark,)], "w long").write.mode("overwrite").parquet(self.path("clock", part))

    def finish(self, last: int, schema: T.StructType) -> None:
        """Judges the requests still open after batch ``last``, when the stream has ended."""
        fields = [schema[c] for c in (self.key, self.asked_at, self.order_id)]
        self._judge(self._kept("open", last, T.StructType(fields)), last, FINAL, None)

    def _time(self, schema: T.StructType) -> Column:
        return micros(F.col(self.asked_at), isinstance(schema[self.asked_at].dataType, T.TimestampNTZType))

    def _judge(self, due: DataFrame, before: int, part: object, mark: int | None) -> None:
        """Replays ``due`` after the last misses of ``before``; a key's last miss is its first request here."""
        old = self._kept("misses", before, T.StructType([f for f in due.schema.fields if f.name != self.order_id]))
        seeded = old.withColumn("_seed", F.lit(True)).unionByName(
            due.withColumn("_seed", F.lit(False)), allowMissingColumns=True
        )
        judged = replay(seeded.select(*due.columns, "_seed"), self.key, self.asked_at, self.order_id, self.ttl, first="_seed")
        fresh = judged.where("NOT _seed").drop("_seed")
        fresh.write.mode("overwrite").parquet(self.path("hits", part))
        missed = self.spark.read.schema(fresh.schema).parquet(self.path("hits", part)).where("NOT hit")
        last = missed.select(self.key, self.asked_at).unionByName(old).groupBy(self.key).agg(
            F.max(self.asked_at).alias(self.asked_at)
        )
        live = F.lit(True) if mark is None else self._time(due.schema) + self.ttl * 1_000_000 > mark
        last.where(live).write.mode("overwrite").parquet(self.path("misses", part))


def replay_stream(
    asks: DataFrame, stream: CacheStream, checkpoint: str, finish: bool = True, allow_late: bool = True
) -> StreamingQuery:
    """Works off the requests that are there; with ``finish`` the open ones are judged at the end.

    Without ``allow_late`` a request behind the watermark is an error.

    Read the result with :func:`judged` and what came too late with :func:`late`.
    """
    last = [-1]

    def run(batch: DataFrame, batch_id: int) -> None:
        stream.batch(batch, batch_id)
        last[0] = batch_id

    query = (
        asks.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    if finish and last[0] >= 0:
        stream.finish(last[0], asks.schema)
    if not allow_late:
        behind = late(asks.sparkSession, stream.root, asks.schema).count()
        if behind:
            raise RuntimeError(f"{behind} requests came behind the watermark")
    return query


def judged(spark: SparkSession, root: str) -> DataFrame:
    """Every judged request with ``hit``."""
    return spark.read.parquet(os.path.join(root, "hits")).drop("part")


def late(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """The requests that arrived behind the watermark."""
    return _read(spark, os.path.join(root, "late"), schema)
