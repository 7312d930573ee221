"""The expiring cache and the removal of repeated deliveries on Spark's state store.

The state of a key is its last miss and the requests the watermark has not passed yet.
Keys share a state row by their hash, so a micro-batch costs a call per row and not one
per key; an event-time timer wakes a row when it may judge the next of its requests, or
when a last miss has expired, which is then evicted. So the state holds live keys and
open requests only, a restarted stream goes on from its checkpoint, and the cut into
micro-batches and the order of arrival within the lateness do not change a result.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from quaero.operators.cache import TTL_SECONDS, micros

_NEVER = -(1 << 62)
#: an Arrow table of (key, time in microseconds, id, seen): last misses, which are seen, and open requests
_STATE = "rows binary"
_ROWS = ["name", "at", "id", "seen"]
STATE_ROWS = 1024  # rows of the state store that the keys share


def _judge(times: np.ndarray, last: int, ttl: int) -> tuple[np.ndarray, int]:
    """``hit`` of each request in order, and the last miss. Jumps from miss to miss."""
    hit, at = np.ones(len(times), dtype=bool), 0
    while at < len(times):
        if times[at] >= last + ttl or last == _NEVER:
            hit[at], last = False, int(times[at])
        at = int(np.searchsorted(times, last + ttl, side="left"))
    return hit, last


def _judge_keys(rows: pd.DataFrame, passed: int, ttl: int) -> tuple[pd.DataFrame, pd.DataFrame]:
    """What a state row holds, judged up to the time ``passed``: the judged requests with ``hit``, and what stays."""
    codes = pd.factorize(rows["name"])[0]
    at, seen = rows["at"].to_numpy(), rows["seen"].to_numpy()
    order = np.lexsort((rows["id"].to_numpy(), at, ~seen, codes))  # the last miss of a key before its requests
    codes, at, seen = codes[order], at[order], seen[order]
    due = ~seen & (at <= passed)
    hit, stays = np.zeros(len(order), dtype=bool), ~due
    heads = np.flatnonzero(np.append(True, codes[1:] != codes[:-1])) if len(order) else []
    lasts = []
    for start, end in zip(heads, [*heads[1:], len(order)]):
        first = start + int(seen[start])
        until = first + int(np.count_nonzero(due[first:end]))  # in the order of time
        hit[first:until], last = _judge(at[first:until], int(at[start]) if seen[start] else _NEVER, ttl)
        stays[start:first] = False
        if last != _NEVER and last + ttl > passed:
            lasts.append((start, last))
    sorted_rows = rows.iloc[order]
    live = sorted_rows.iloc[[i for i, _ in lasts]].assign(at=np.array([t for _, t in lasts], dtype=np.int64), id=0, seen=True)
    judged = sorted_rows[due][["name", "id"]].assign(hit=hit[due])
    return judged, pd.concat([live, sorted_rows[stays]], ignore_index=True)


def _packed(rows: pd.DataFrame) -> bytes:
    sink = pa.BufferOutputStream()
    batch = pa.RecordBatch.from_pandas(rows[_ROWS], preserve_index=False)
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpacked(raw: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(raw).read_pandas()


def replay_keyed(
    asks: DataFrame, key: str = "cache_key", asked_at: str = "asked_at", order_id: str = "ask_id",
    ttl_seconds: int = TTL_SECONDS, lateness_seconds: int = 600, state_rows: int = STATE_ROWS,
) -> DataFrame:
    """(key, ``order_id``, hit) of a stream of requests, as ``cache.replay`` judges them.

    A request comes out once the watermark has passed it. Those behind the watermark on
    arrival are left out by Spark and counted in the query's progress
    (:func:`rows_behind`); a request without a time counts as such. Ids are numbers; a
    null key is a key of its own. Requests of one key at one time go by id. The keys are
    dealt to ``state_rows`` rows of the state; a checkpoint belongs to that number.
    """
    ttl = ttl_seconds * 1_000_000
    at = micros(F.col(asked_at), isinstance(asks.schema[asked_at].dataType, T.TimestampNTZType))
    name = F.coalesce(F.concat(F.lit("k"), F.col(key).cast("string")), F.lit("n"))
    rows = asks.select(
        name.alias("name"), F.col(order_id).cast("long").alias("id"), at.alias("at"), F.timestamp_micros(at).alias("when"),
    ).where("at IS NOT NULL").withWatermark("when", f"{lateness_seconds} seconds")
    rows = rows.withColumn("slot", F.pmod(F.xxhash64("name"), F.lit(state_rows)))

    def run(_: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = [_unpacked(bytes(state.get[0]))] if state.exists else []
        if not state.hasTimedOut:
            held += [part[["name", "at", "id"]].assign(seen=False) for part in parts]
        passed = state.getCurrentWatermarkMs() * 1000
        judged, stays = _judge_keys(pd.concat(held, ignore_index=True), passed, ttl)
        if len(stays):
            state.update((_packed(stays),))
            wake = int((stays["at"] + np.where(stays["seen"], ttl, 0)).min())
            state.setTimeoutTimestamp(max(wake, passed) // 1000 + 1)
        elif state.exists:
            state.remove()
        if len(judged):
            yield judged

    found = rows.groupBy("slot").applyInPandasWithState(
        run, "name string, id long, hit boolean", _STATE, "append", GroupStateTimeout.EventTimeTimeout
    )
    of_key = F.when(F.col("name") != "n", F.expr("substr(name, 2)")).cast(asks.schema[key].dataType)
    return found.select(of_key.alias(key), F.col("id").alias(order_id), "hit")


def drop_redelivered(rows: DataFrame, keys: list[str], at: str, lateness_seconds: int = 600) -> DataFrame:
    """The first delivery of each row of a stream that may bring a row again within the lateness.

    Rows are told apart by ``keys``; the state forgets a row once the watermark is the
    lateness beyond its time, so a copy that comes later than that is behind the watermark
    too and is counted by :func:`rows_behind`.
    """
    time = micros(F.col(at), isinstance(rows.schema[at].dataType, T.TimestampNTZType))
    timed = rows.withColumn("_when", F.timestamp_micros(time)).withWatermark("_when", f"{lateness_seconds} seconds")
    return timed.dropDuplicatesWithinWatermark(keys).drop("_when")


def rows_behind(query: StreamingQuery) -> int:
    """How many rows the finished query left out because they came behind the watermark."""
    return sum(
        operator.numRowsDroppedByWatermark for progress in query.recentProgress for operator in progress.stateOperators
    )


def closing_tick(last: dt.datetime, lateness_seconds: int, ttl_seconds: int = TTL_SECONDS) -> dt.datetime:
    """A time for a last row that lets the watermark pass everything up to ``last``."""
    return last + dt.timedelta(seconds=2 * lateness_seconds + ttl_seconds + 1)
