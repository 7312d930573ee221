"""Repeated byte strings across documents, by external suffix sorting of shards.

A byte goes when it lies in a string of ``width`` bytes that also starts anywhere
else, in the same document or another. What must meet to be compared is dealt to
shards by content: every window of ``width`` bytes has a least hash of its 32-byte
grams, and equal windows have the same. The windows of a text with the same least
hash, one after the other, are a segment. Segments whose hash occurs once cannot hold
a repeat and stay where they are. Equal segments become one row with its number of
copies; those that share a hash with different ones are cut out of their texts, go
to the shard of the hash and, but for those that cannot share a window with another
(``may_repeat``), are suffix-sorted there (``suffixes``): a window repeats when it has
``width`` bytes in common with a neighbour in the sorted order.

A hash under which more than ``HOT`` different segments meet (the rim of a passage
that very many texts share) would make one shard large; the windows of those segments
are compared by digests of 128 bits instead, spread over all tasks.

Equal texts are handled once. Texts move to cut the candidates out of them and to cut
the repeats; everything else is keyed by digests.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quaero.llm.common import materialize, new_folder
from quaero.llm.kernels import SLICE_BYTES, mix, slices, text_bytes
from quaero.llm.suffixes import Scratch, neighbours

WIDTH = 200
GRAM = 32
HOT = 1024
#: ranges of the offset of a gram in its window; segments of more than so many widths are not looked at
PARTS, LONG = 4, 8
SHARD_BYTES = 2 << 20
BROADCAST_TEXTS, BROADCAST_VALUES = 1_000_000, 1_000_000

_MULT = np.uint64(0x9E3779B97F4A7C15)


def rolling(data: np.ndarray, width: int, seed: int = 1) -> np.ndarray:
    """A hash of every ``width`` bytes, by doubling."""
    step, size, mult = data.astype(np.uint64) + np.uint64(seed), 1, _MULT
    made, done = None, 0
    count = len(data) - width + 1
    while True:
        if width & size:
            part = step[done : done + count]
            made = part if made is None else mix(made) + part
            done += size
        if 2 * size > width:
            return mix(made)
        step = step[:-size] * mult + step[size:]
        with np.errstate(over="ignore"):
            mult = mult * mult + np.uint64(seed - 1)
        size *= 2


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    size, made = 1, values
    while 2 * size <= width:
        made = np.minimum(made[:-size], made[size:])
        size *= 2
    count = len(values) - width + 1
    return np.minimum(made[:count], made[width - size : width - size + count])


def window_runs(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """(start, count, value, repeats) of the runs of windows with one least gram hash.

    Windows do not cross the bounds ``offsets``. ``repeats``: the gram of that hash
    stands more than once in the run, so that the run may repeat itself.
    """
    nothing = np.zeros(0, dtype=np.int64)
    if len(data) < width:
        return nothing, nothing, nothing, nothing.astype(bool)
    gram = min(GRAM, width)
    grams, reach = rolling(data, gram), width - gram + 1
    value = sliding_least(grams, reach)
    end = np.repeat(offsets[1:], np.diff(offsets))[: len(value)]
    first = np.append(True, value[1:] != value[:-1])
    heads = offsets[:-1]
    first[heads[heads < len(value)]] = True
    start = np.flatnonzero(first & (np.arange(len(value)) + width <= end))
    if not len(start):
        return nothing, nothing, nothing, nothing.astype(bool)
    bounds = np.append(np.flatnonzero(first), len(value))
    stop = np.minimum(bounds[np.searchsorted(bounds, start, side="right")], end[start] - width + 1)
    mine = value[start]
    enters = np.append(0, np.cumsum(grams[reach - 1 :] == value))  # the last gram of a window is its least
    anchors = enters[stop] - enters[start + 1]
    for a in range(0, len(start), 4096):
        some = grams[start[a : a + 4096, None] + np.arange(reach)]
        anchors[a : a + 4096] += (some == mine[a : a + 4096, None]).sum(axis=1)
    return start, stop - start, mine.view(np.int64), anchors > 1


def text_runs(data: np.ndarray, offsets: np.ndarray, width: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(row, start in the text, count, value, repeats), a bounded slice of the texts at a time."""
    for a, b in slices(offsets):
        low, high = int(offsets[a]), int(offsets[b])
        if high - low <= 2 * SLICE_BYTES:
            start, count, value, repeats = window_runs(data[low:high], offsets[a : b + 1] - low, width)
            row = np.searchsorted(offsets, start + low, side="right") - 1
            yield row, start + low - offsets[row], count, value, repeats
            continue
        for at in range(low, high - width + 1, SLICE_BYTES):  # one long text
            part = data[at : min(high, at + SLICE_BYTES + width - 1)]
            start, count, value, repeats = window_runs(part, np.array([0, len(part)]), width)
            yield np.full(len(start), a), start + at - low, count, value, repeats


RUN = "struct<start:int,count:int,value:long,repeats:boolean>"


def describe(docs: DataFrame, width: int) -> DataFrame:
    """(id, n, digest, runs) of docs(id, digest, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            parts = [x for x in text_runs(data, offsets, width)]
            row, start, count, value, repeats = (
                (np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, dtype=np.int64) for _ in range(5))
            )
            bounds = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=batch.num_rows)))).astype(np.int32)
            runs = pa.StructArray.from_arrays(
                [pa.array(start.astype(np.int32)), pa.array(count.astype(np.int32)), pa.array(value),
                 pa.array(repeats.astype(bool))], names=["start", "count", "value", "repeats"],
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(np.diff(offsets)), batch.column("digest"),
                 pa.ListArray.from_arrays(pa.array(bounds), runs)], names=["id", "n", "digest", "runs"],
            )

    return docs.mapInArrow(run, f"id long, n long, digest binary, runs array<{RUN}>")


def cut_segments(texts: DataFrame, width: int) -> DataFrame:
    """(digest, copies, start, count, value, repeats, segment, content) of texts(digest, copies, runs, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                data, runs = batch.column("text")[k].as_buffer(), batch.column("runs")[k].values
                start, count = runs.field("start"), runs.field("count")
                pieces = [
                    data[s : s + c + width - 1].to_pybytes() for s, c in zip(start.to_pylist(), count.to_pylist())
                ]
                n = len(pieces)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column("digest")[k].as_py()] * n, type=pa.binary()),
                     pa.array([batch.column("copies")[k].as_py()] * n, type=pa.int64()),
                     start, count, runs.field("value"), runs.field("repeats"),
                     pa.array([hashlib.md5(x).digest() for x in pieces], type=pa.binary()),
                     pa.array(pieces, type=pa.binary())],
                    names=["digest", "copies", "start", "count", "value", "repeats", "segment", "content"],
                )

    schema = "digest binary, copies long, start int, count int, value long, repeats boolean, segment binary, content binary"
    return texts.select("digest", "copies", "runs", "text").mapInArrow(run, schema)


def covered(starts: np.ndarray, width: int) -> tuple[list[int], list[int]]:
    """The spans of bytes that windows at the sorted ``starts`` cover."""
    if not len(starts):
        return [], []
    new = np.flatnonzero(np.append(True, starts[1:] > starts[:-1] + width))
    return starts[new].tolist(), (starts[np.append(new[1:], len(starts)) - 1] + width).tolist()


SPANS = "array<struct<begin:int,end:int>>"
SPAN_TYPE = T.ArrayType(T.StructType([T.StructField(c, T.IntegerType()) for c in ("begin", "end")]))


def _span_batch(names: list[bytes], spans: list[tuple[list[int], list[int]]]) -> pa.RecordBatch:
    made = [[{"begin": a, "end": b} for a, b in zip(*x)] for x in spans]
    kind = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))
    return pa.RecordBatch.from_arrays(
        [pa.array(names, type=pa.binary()), pa.array(made, type=kind)], names=["segment", "spans"]
    )


def sort_shard(path: str, names: list[bytes], ends: list[int], width: int, folder: str) -> Iterator[pa.RecordBatch]:
    """(segment, spans) of the segments that lie one after the other in the file, each closed by a 1, at last a 0."""
    text = np.memmap(path, dtype=np.uint16, mode="r")
    if len(text) <= 2 * SHARD_BYTES:
        text = np.array(text)
    scratch = Scratch(folder)
    marks = scratch.array(len(text), np.bool_)
    for one, other, common in neighbours(text, 258, width, scratch):
        same = common >= width
        marks[one[same]] = True
        marks[other[same]] = True
    found, spans, begin = [], [], 0
    for name, end in zip(names, ends):
        last = end - width  # windows that begin later hold the separator
        starts = np.flatnonzero(marks[begin:last])
        if len(starts):
            found.append(name), spans.append(covered(starts, width))
        begin = end
        if len(found) == 4096:
            yield _span_batch(found, spans)
            found, spans = [], []
    yield _span_batch(found, spans)


def may_repeat(values: list[int], contents: list[pa.Buffer], width: int) -> np.ndarray:
    """Which of the segments, with all others of their least gram hash, can have a window that stands twice.

    The gram of that hash stands at one offset of both windows, and what is around it is
    equal. With the offsets in ``PARTS`` ranges, the bytes that every window of a range has
    around its gram are a key; segments none of whose keys stands twice have no repeat.
    Where a segment of a hash is long, which its own repeats make it, all of that hash stay.
    """
    size = np.array([len(x) for x in contents], dtype=np.int64)
    value, end = np.array(values, dtype=np.int64), np.cumsum(size)
    long = np.isin(value, value[size > LONG * width])
    data, gram = np.frombuffer(b"".join(contents), dtype=np.uint8), min(GRAM, width)
    owner = np.repeat(np.arange(len(size)), size)
    grams = rolling(data, gram).view(np.int64)
    at = np.flatnonzero(grams == value[owner[: len(grams)]])
    at = at[(at + gram <= end[owner[at]]) & ~long[owner[at]]]
    part = -(-(width - gram + 1) // PARTS)
    inside = width - part + 1
    hashes = rolling(data, inside)
    keys, owners = [], []
    for t in range(PARTS):
        begin = at - t * part
        mine = owner[at]
        good = (begin >= end[mine] - size[mine]) & (begin + inside <= end[mine])
        keys.append(mix(hashes[begin[good]] + mix(value[mine[good]].view(np.uint64) + np.uint64(t)))), owners.append(mine[good])
    _, key, counts = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
    keep = long
    keep[np.concatenate(owners)[counts[key] > 1]] = True
    return keep


def sorted_repeats(segments: DataFrame, width: int, shards: int) -> DataFrame:
    """(segment, spans): the repeated bytes of the segments(segment, value, content), all different."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((v, s, c) for x in batches for v, s, c in zip(
            x.column("value").to_pylist(), x.column("segment").to_pylist(), x.column("content")))
        ahead = next(rows, None)
        while ahead is not None:
            with tempfile.TemporaryDirectory(prefix="suffixes-") as folder:
                names, ends, size = [], [], 0
                with open(f"{folder}/text", "wb") as out:
                    while ahead is not None and size < SHARD_BYTES:
                        some, held = [], 0
                        while ahead is not None and (held < SLICE_BYTES or ahead[0] == some[-1][0]):
                            some.append((*ahead[:2], ahead[2].as_buffer()))
                            held += len(some[-1][2])
                            ahead = next(rows, None)
                        values, segment, contents = zip(*some)
                        for k in np.flatnonzero(may_repeat(values, contents, width)).tolist():
                            data = np.frombuffer(contents[k], dtype=np.uint8).astype(np.uint16) + np.uint16(2)
                            out.write(data.tobytes() + b"\1\0")
                            size += len(data) + 1
                            names.append(segment[k]), ends.append(size)
                    out.write(b"\0\0")
                if names:
                    yield from sort_shard(f"{folder}/text", names, ends, width, folder)

    dealt = segments.select("value", "segment", "content").repartition(shards, "value").sortWithinPartitions("value")
    return dealt.mapInArrow(run, f"segment binary, spans {SPANS}")


PAIR = [("x", np.int64), ("y", np.int64)]


def _digests(data: np.ndarray, width: int) -> np.ndarray:
    """Two 64-bit hashes of every window, as one value."""
    pair = np.stack([rolling(data, width, seed).view(np.int64) for seed in (1, 3)], axis=1)
    return pair.view(PAIR).ravel()


def hot_repeats(segments: DataFrame, width: int, windows: int) -> DataFrame:
    """As ``sorted_repeats``, by counting digests of single windows; ``windows`` is their number.

    A task counts its windows and sends them packed by buckets of their digest, so what
    a bucket merges is bounded. The digests that repeat are few where many segments share
    them, and are broadcast up to ``BROADCAST_VALUES`` of 16 bytes; more are joined.
    """
    buckets = 64 + windows // (1 << 21)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def packed() -> pa.RecordBatch:
            found, counts = np.unique(np.concatenate(held), return_counts=True)
            bucket = (found["x"].view(np.uint64) % np.uint64(buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            names, starts = np.unique(bucket[order], return_index=True)
            ends = [*starts[1:].tolist(), len(order)]
            rows = [(order[a:b]) for a, b in zip(starts.tolist(), ends)]
            return pa.RecordBatch.from_arrays(
                [pa.array(names), pa.array([found[r].tobytes() for r in rows], type=pa.binary()),
                 pa.array([counts[r].astype(np.int64).tobytes() for r in rows], type=pa.binary())],
                names=["bucket", "digests", "counts"],
            )

        for batch in batches:
            for content in batch.column("content"):
                data = np.frombuffer(content.as_buffer(), dtype=np.uint8)
                for at in range(0, len(data) - width + 1, SLICE_BYTES):
                    held.append(_digests(data[at : at + SLICE_BYTES + width - 1], width))
                    size += len(held[-1])
                if size > 1 << 20:
                    yield packed()
                    held, size = [], 0
        if held:
            yield packed()

    def merge(part: pa.Table) -> pa.Table:
        found = np.frombuffer(b"".join(part["digests"].to_pylist()), dtype=PAIR)
        counts = np.frombuffer(b"".join(part["counts"].to_pylist()), dtype=np.int64)
        names, place = np.unique(found, return_inverse=True)
        again = names[np.bincount(place, weights=counts) > 1]
        return pa.table({"x": again["x"], "y": again["y"]})

    counted = segments.select("content").mapInArrow(count, "bucket int, digests binary, counts binary")
    twice = materialize(counted.groupBy("bucket").applyInArrow(merge, "x long, y long"), "repeated_windows")
    if twice.count() <= BROADCAST_VALUES:
        return _spans_of_windows(segments, twice, width)

    def single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("segment").to_pylist(), batch.column("content")):
                data = np.frombuffer(content.as_buffer(), dtype=np.uint8)
                for at in range(0, len(data) - width + 1, SLICE_BYTES):
                    pair = _digests(data[at : at + SLICE_BYTES + width - 1], width)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(pair), type=pa.binary()), pa.array(np.arange(at, at + len(pair), dtype=np.int32)),
                         pa.array(pair["x"].copy()), pa.array(pair["y"].copy())], names=["segment", "at", "x", "y"],
                    )

    found = segments.select("segment", "content").mapInArrow(single, "segment binary, at int, x long, y long")
    found = found.join(twice, ["x", "y"], "left_semi").groupBy("segment").agg(F.array_sort(F.collect_list("at")).alias("at"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            starts = [np.array(x) for x in batch.column("at").to_pylist()]
            yield _span_batch(batch.column("segment").to_pylist(), [covered(x, width) for x in starts])

    return found.mapInArrow(run, f"segment binary, spans {SPANS}")


def _spans_of_windows(segments: DataFrame, twice: DataFrame, width: int) -> DataFrame:
    """(segment, spans) by the windows whose digests are among ``twice(x, y)``, a counted number."""
    pairs = np.ascontiguousarray(twice.toPandas().to_numpy(dtype=np.int64))
    known = np.sort(pairs.view(PAIR).ravel())
    shared = segments.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed = shared.value
        for batch in batches:
            spans = []
            for content in batch.column("content"):
                data, starts = np.frombuffer(content.as_buffer(), dtype=np.uint8), []
                for at in range(0, len(data) - width + 1 if len(listed) else 0, SLICE_BYTES):
                    pair = _digests(data[at : at + SLICE_BYTES + width - 1], width)
                    place = np.minimum(np.searchsorted(listed, pair), len(listed) - 1)
                    starts.append(at + np.flatnonzero(listed[place] == pair))
                spans.append(covered(np.concatenate(starts) if starts else np.zeros(0, dtype=np.int64), width))
            yield _span_batch(batch.column("segment").to_pylist(), spans)

    return segments.select("segment", "content").mapInArrow(run, f"segment binary, spans {SPANS}")


def _stored_small(df: DataFrame, label: str) -> DataFrame:
    """As ``materialize``, for rows that overlap their neighbours."""
    path = new_folder(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _digest(text: Column) -> Column:
    """128 bits of the SHA-256 of a text."""
    return F.unhex(F.substring(F.sha2(text, 256), 1, 32))


def repeated_spans(docs: DataFrame, width: int) -> tuple[DataFrame, DataFrame]:
    """For docs(id, digest, text): (digest, copies, n) of all texts; (digest, spans) of those that occur once."""
    texts = describe(docs, width).groupBy("digest").agg(
        F.count("*").alias("copies"), F.min("id").alias("id"), F.any_value("n").alias("n"), F.any_value("runs").alias("runs")
    )
    texts = materialize(texts, "texts")
    runs = texts.select("digest", F.explode("runs").alias("run")).select("digest", "run.*")
    values = runs.groupBy("value").agg(F.count("*").alias("c"), F.max("repeats").alias("r")).where("c > 1 OR r").select("value")
    values = materialize(values, "values")
    wanted = runs.join(F.broadcast(values) if values.count() <= BROADCAST_VALUES else values, "value").groupBy("digest").agg(
        F.collect_list(F.struct("start", "count", "value", "repeats")).alias("runs")
    )
    wanted = materialize(wanted.join(texts.select("digest", "copies", "id"), "digest"), "candidates")
    listed = wanted.select("digest")
    near = docs.join(F.broadcast(listed) if listed.count() <= BROADCAST_TEXTS else listed, "digest", "left_semi")
    right = wanted.withColumnRenamed("id", "first")
    held = near.join(right, "digest").where(F.col("id").eqNullSafe(F.col("first")))
    cut = _stored_small(cut_segments(held, width), "segments")

    # what repeats as a whole, and what must be compared
    kinds = cut.groupBy("segment", "value", "count").agg(F.sum("copies").alias("copies"), F.max("repeats").alias("repeats"))
    kinds = materialize(kinds, "kinds")
    groups = kinds.groupBy("value").agg(
        F.count("*").alias("kinds"), F.max(F.expr("repeats AND copies = 1")).alias("alone"), F.sum("count").alias("size")
    ).where("kinds > 1 OR alone")
    groups = materialize(groups, "groups")
    different = cut.join(groups.select("value", "kinds"), "value").groupBy("segment").agg(
        F.any_value("value").alias("value"), F.any_value("kinds").alias("kinds"), F.any_value("content").alias("content")
    )
    size = groups.where(f"kinds <= {HOT}").agg(F.sum(F.expr(f"size + {width} * kinds"))).first()[0] or 0
    shards = max(docs.sparkSession.sparkContext.defaultParallelism, int(size) // SHARD_BYTES + 1)
    whole = kinds.where("copies > 1").select(
        "segment", F.array(F.struct(F.lit(0).alias("begin"), (F.col("count") + width - 1).cast("int").alias("end"))).alias("spans")
    )
    found = sorted_repeats(different.where(f"kinds <= {HOT}"), width, shards)
    crowd = groups.where(f"kinds > {HOT}").agg(F.sum("size")).first()[0]
    if crowd:
        hot = materialize(different.where(f"kinds > {HOT}"), "hot_segments")
        found = found.unionAll(hot_repeats(hot, width, int(crowd)))
    found = materialize(whole.unionAll(found.where("size(spans) > 0")), "segment_spans")
    once = cut.where("copies = 1").select("digest", "start", "segment").join(found, "segment")
    shifted = F.transform("spans", lambda s: F.struct((s.begin + F.col("start")).alias("begin"), (s.end + F.col("start")).alias("end")))
    spans = once.select("digest", shifted.alias("spans")).groupBy("digest").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    return texts.select("digest", "copies", "n"), materialize(spans, "text_spans")


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH
) -> DataFrame:
    """``docs`` with n_bytes, removed_spans and kept (binary): the UTF-8 bytes left when repeats go.

    ``removed_spans`` lists the maximal runs (begin, end) of bytes, in order, that lie in
    a string of ``width`` bytes which also starts elsewhere; strings are judged on the
    input. Null texts count as empty; a text shorter than ``width`` stays whole. Rows of
    one id are judged one by one, and repeated rows repeat each other. Null ids are ids
    like others. An empty table stays empty. Columns that bear the new names are replaced.
    """
    new = ("n_bytes", "removed_spans", "kept")
    columns = [c for c in docs.columns if c not in new]
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), _digest(text).alias("digest"), text.alias("text"))
    texts, spans = repeated_spans(rows, width)
    whole = texts.where(f"copies > 1 AND n >= {width}").select(
        "digest", F.array(F.struct(F.lit(0).alias("begin"), F.col("n").cast("int").alias("end"))).alias("spans")
    )
    known = materialize(spans.unionAll(whole), "known_spans")
    known = known.select(F.col("digest").alias("__digest"), F.col("spans").alias("__spans"))
    joined = docs.select(*columns, _digest(text).alias("__own")).join(known, F.col("__own") == F.col("__digest"), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, spans = [], []
            column = batch.column("__bytes")
            for k, listed in enumerate(batch.column("__spans")):
                data = column[k].as_buffer()
                if not listed.is_valid:
                    kept.append(data.to_pybytes()), spans.append([])
                    continue
                flat = listed.values
                begin, end = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("begin", "end"))
                order = np.argsort(begin, kind="stable")
                begin, end = begin[order], np.maximum.accumulate(end[order])
                heads = np.flatnonzero(np.append(True, begin[1:] > end[:-1]))
                begin, end = begin[heads].tolist(), end[np.append(heads[1:], len(end)) - 1].tolist()
                at = [0, *end]
                kept.append(b"".join(data[a:b].to_pybytes() for a, b in zip(at, [*begin, len(data)])))
                spans.append([{"begin": a, "end": b} for a, b in zip(begin, end)])
            kind = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))
            rest = [batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays(
                [*rest, pa.array([len(x.as_buffer()) for x in column], type=pa.int64()),
                 pa.array(spans, type=kind), pa.array(kept, type=pa.binary())], names=[*columns, *new],
            )

    schema = T.StructType([docs.schema[c] for c in columns])
    schema = schema.add("n_bytes", "long").add("removed_spans", SPAN_TYPE).add("kept", "binary")
    return joined.select(*columns, text.cast("binary").alias("__bytes"), "__spans").mapInArrow(run, schema)
