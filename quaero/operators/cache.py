"""The expiring answer cache as tables: look up, store, invalidate and replay."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quaero.functions.text import CACHE_KEY_PREFIX
from quaero.session import materialize

TTL_SECONDS = 3600
HOT_KEY_ROWS = 1_000_000


def _ttl(seconds: int) -> Column:
    return F.make_dt_interval(secs=F.lit(seconds))


def upsert(entries: DataFrame, new: DataFrame, tie: str | None = None) -> DataFrame:
    """The latest entry of each key. ``tie`` orders entries written at the same time.

    The maximum combines before the shuffle, so a hot key costs one row per task.
    """
    both = entries.unionByName(new)
    rest = [c for c in both.columns if c != "cache_key"]
    order = F.struct("written_at", *([tie] if tie else []))
    latest = both.groupBy("cache_key").agg(F.max_by(F.struct(*rest), order).alias("_entry"))
    return latest.select("cache_key", *[F.col(f"_entry.{c}").alias(c) for c in rest])


def lookup(asks: DataFrame, entries: DataFrame, ttl_seconds: int = TTL_SECONDS) -> DataFrame:
    """Add ``hit`` and the stored columns; they are NULL once an entry has expired.

    ``entries`` has one row per key. An ask at exactly write time + ttl is a miss.
    """
    stored = [c for c in entries.columns if c != "cache_key"]
    joined = asks.join(entries, "cache_key", "left")
    live = (F.col("asked_at") >= F.col("written_at")) & (
        F.col("asked_at") < F.col("written_at") + _ttl(ttl_seconds)
    )
    hit = F.coalesce(live, F.lit(False))
    return joined.select(
        *asks.columns, hit.alias("hit"), *[F.when(hit, F.col(c)).alias(c) for c in stored]
    )


def glob_to_regex(pattern: str) -> str:
    """A key glob as an anchored regex: ``* ? [set] [^set]`` and backslash escapes."""
    special = r"\.^$|()[]{}*+?-&~#"
    out = []
    i = 0
    while i < len(pattern):
        c = pattern[i]
        close = pattern.find("]", i + 1)
        if c == "\\" and i + 1 < len(pattern):
            i += 1
            out.append(("\\" if pattern[i] in special else "") + pattern[i])
        elif c == "*":
            out.append(".*")
        elif c == "?":
            out.append(".")
        elif c == "[" and close > 0:
            body = pattern[i + 1 : close]
            negated = body.startswith("^")
            body = body[negated:]
            escaped = "".join("\\" + b if b in r"\^[&~" else b for b in body)
            if escaped:
                out.append(f"[{'^' if negated else ''}{escaped}]")
            else:  # an empty set holds nothing, its complement everything
                out.append("." if negated else r"[^\s\S]")
            i = close
        else:
            out.append(("\\" if c in special else "") + c)
        i += 1
    return r"(?s)\A" + "".join(out) + r"\z"


def matches_glob(key: Column, pattern: str = "*", prefix: str = CACHE_KEY_PREFIX) -> Column:
    return key.rlike(glob_to_regex(prefix + pattern))


def invalidate(entries: DataFrame, pattern: str = "*") -> tuple[DataFrame, DataFrame]:
    """The entries that stay, and a one-row table with the number ``removed``."""
    gone = matches_glob(F.col("cache_key"), pattern)
    return entries.where(~gone), entries.where(gone).agg(F.count(F.lit(1)).alias("removed"))


# --- replay ------------------------------------------------------------------------


def micros(ts: Column, is_ntz: bool) -> Column:
    """Microseconds since 1970, independent of the session zone for zone-less input."""
    if not is_ntz:
        return F.unix_micros(ts)
    since = ts - F.expr("timestamp_ntz'1970-01-01 00:00:00'")
    return (since.cast("interval second").cast("decimal(20,6)") * 1_000_000).cast("bigint")


def replay(
    log: DataFrame,
    key: str = "cache_key",
    asked_at: str = "asked_at",
    order_id: str = "ask_id",
    ttl_seconds: int = TTL_SECONDS,
    hot_key_rows: int = HOT_KEY_ROWS,
    first: str | None = None,
) -> DataFrame:
    """Add ``hit`` to each request of a log, as an initially empty cache would answer.

    A miss stores the answer for ``ttl_seconds``; a hit does not extend it.
    Requests of one time are ordered by ``order_id``, NULL ids first; rows that agree
    in both are told apart, so only one of them can be the miss. A request without a
    time is a miss and stores nothing. NULL keys are one key. Of equal times the rows
    with the flag ``first`` come before the others.

    Ordinary keys are walked in time order, one pass with constant memory. A key
    with more than ``hot_key_rows`` requests would keep one task busy, so such
    keys go through :func:`_replay_hot`, which spreads one key over all tasks.
    """
    ntz = isinstance(log.schema[asked_at].dataType, T.TimestampNTZType)
    timed = log.withColumn("_t", micros(F.col(asked_at), ntz)).withColumn(
        "_k", F.coalesce(F.concat(F.lit("k"), F.col(key).cast("string")), F.lit("n"))
    ).withColumn("_first", F.lit(0) if first is None else F.when(F.col(first), 0).otherwise(1))
    # at most rows / hot_key_rows keys can be hot
    hot_keys = materialize(
        timed.groupBy("_k").count().where(F.col("count") > hot_key_rows).select("_k"), "hot-keys"
    )
    if hot_keys.isEmpty():
        return _replay_walk(timed, order_id, ttl_seconds).drop("_t", "_k", "_first")
    cold = _replay_walk(timed.join(hot_keys, "_k", "left_anti"), order_id, ttl_seconds)
    hot = _replay_hot(timed.join(hot_keys, "_k", "left_semi"), order_id, ttl_seconds)
    return cold.unionByName(hot).drop("_t", "_k", "_first")


def _replay_walk(timed: DataFrame, order_id: str, ttl_seconds: int) -> DataFrame:
    ttl = ttl_seconds * 1_000_000
    schema = T.StructType([*timed.schema.fields, T.StructField("hit", T.BooleanType())])

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, expires = None, -math.inf
        for batch in batches:
            keys, times = batch["_k"].to_numpy(), batch["_t"].to_numpy(dtype=float, na_value=math.nan)
            exact = batch["_t"].to_numpy(dtype="int64", na_value=0)
            hits = np.zeros(len(batch), dtype=bool)
            heads = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(batch) else []
            for a, b in zip(heads, [*heads[1:], len(batch)]):
                if keys[a] != current:
                    current, expires = keys[a], -math.inf
                at = a + int(np.isnan(times[a:b]).sum())  # requests without a time stand first
                hits[at:b] = True
                at += int(np.searchsorted(exact[at:b], expires))
                while at < b:  # from miss to miss
                    hits[at] = False
                    expires = int(exact[at]) + ttl
                    at += int(np.searchsorted(exact[at:b], expires))
            yield batch.assign(hit=hits)

    return timed.repartition("_k").sortWithinPartitions("_k", "_t", "_first", order_id).mapInPandas(walk, schema)


def _successors(points: DataFrame, key: str, ttl: int) -> DataFrame:
    """For each distinct request time the first one at or after time + ttl: ``(key, t, nxt)``.

    Time is cut into buckets of one ttl, so the widest window holds one key for one bucket;
    where the target's bucket has no later request, the next filled bucket gives
    its first one.
    """
    width = max(1_000_000, ttl)
    bucket = F.floor(F.col("target") / width)
    stored = points.select(key, F.col("t").alias("target"), F.col("t").alias("node"),
                           F.lit(None).cast("bigint").alias("origin"))
    probes = points.select(key, (F.col("t") + ttl).alias("target"),
                           F.lit(None).cast("bigint").alias("node"), F.col("t").alias("origin"))
    marks = stored.unionByName(probes).withColumn("bucket", bucket)
    from_here = (
        Window.partitionBy(key, "bucket").orderBy(F.col("target").desc())
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    inside = marks.withColumn("inside", F.min("node").over(from_here)).where(
        F.col("origin").isNotNull()
    )
    later = Window.partitionBy(key).orderBy(F.col("bucket").desc()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    firsts = (
        marks.groupBy(key, "bucket").agg(F.min("node").alias("first"))
        .withColumn("after", F.min("first").over(later))
        .select(key, "bucket", "after")
    )
    return inside.join(firsts, [key, "bucket"]).select(
        key, F.col("origin").alias("t"), F.coalesce("inside", "after").alias("nxt")
    )


def _replay_hot(timed: DataFrame, order_id: str, ttl_seconds: int) -> DataFrame:
    """Replay without walking: follow all miss-to-next-miss links at once.

    Every request time links to the miss that would follow if it were a miss
    itself. The misses are the times reachable from a key's first one. Links are
    doubled until none is left, then replayed from the longest down. All joins
    are on (key, time), which is unique, so a single key spreads evenly.
    """
    points = timed.where("_t IS NOT NULL").select("_k", F.col("_t").alias("t")).distinct()
    points = materialize(points, "points")
    links = [
        materialize(
            _successors(points, "_k", ttl_seconds * 1_000_000).where(F.col("nxt").isNotNull()),
            "links",
        )
    ]
    while not links[-1].isEmpty():
        near = links[-1].alias("near")
        far = links[-1].select("_k", F.col("t").alias("nxt"), F.col("nxt").alias("end"))
        doubled = near.join(far, ["_k", "nxt"]).select("_k", "t", F.col("end").alias("nxt"))
        links.append(materialize(doubled, "links"))
    missed = points.groupBy("_k").agg(F.min("t").alias("t"))
    for jump in reversed(links[:-1]):
        reached = missed.join(jump, ["_k", "t"]).select("_k", F.col("nxt").alias("t"))
        missed = materialize(missed.unionByName(reached), "missed")
    missed = missed.select("_k", F.col("t").alias("_t"), F.lit(True).alias("_missed"))
    one_time = Window.partitionBy("_k", "_t").orderBy("_first", order_id)
    ranked = timed.join(missed, ["_k", "_t"], "left").withColumn("_nth", F.row_number().over(one_time))
    miss = F.col("_t").isNull() | (F.coalesce("_missed", F.lit(False)) & (F.col("_nth") == 1))
    return ranked.select(*timed.columns, (~miss).alias("hit"))
