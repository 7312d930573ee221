"""Merkle manifest of a dataset: a tree of three per source, and one over the sources.

Every row is a leaf, the SHA-256 of its fields. Inside a source leaves stand in the
order of their ids; every three neighbours become one node until one is left, the
subroot. The subroots, in the order of their sources, make the root the same way.

Nodes are content-addressed: the store holds digest -> children, kept in segments of
``LEVELS`` levels under the digest of their top node. A request for leaves starts at
the root with their ranks. In each segment the base-3 digits of a rank say which child
to follow, the children not chosen are the siblings, and the segment hands its bottom
nodes on as tops of the next ones, with the path so far. A leaf's proof is the path
segments put together from the leaf upwards.

A segment has at most ``3 ** LEVELS`` nodes at its bottom, so one task's group is
bounded however large a source is, and rows that share a digest only share a lookup.
Ranks come from a range sort: per partition only counts go to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaero.llm.common import materialize

WAYS = 3
LEVELS = 6

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<left:string,right:string>>"
_PATH_TYPE = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
RECORDS = "array<struct<digest:binary,children:array<binary>>>"
_RECORDS_TYPE = pa.list_(pa.struct([("digest", pa.binary()), ("children", pa.list_(pa.binary()))]))


def leaf_digest(fields: list[Column]) -> Column:
    """SHA-256 (hex) of the fields: ``-`` for a null, else UTF-8 byte count, ``:`` and the value."""
    parts = []
    for field in fields:
        value = field.cast("string")
        parts.append(F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)))
    return F.sha2(F.concat(*parts), 256)


def parent(children: list[bytes]) -> bytes:
    return sha256("".join(x.hex() for x in children).encode()).digest()


def height(nodes: int) -> int:
    levels = 0
    while nodes > 1:
        nodes, levels = -(-nodes // WAYS), levels + 1
    return levels


def ranked(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with ``group_no`` and ``pos``: the rank of its group, and of the row inside, both from 0.

    ``order`` starts with the group, makes rows distinct and is not null in it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, number, count = TaskContext.get().partitionId(), None, -1, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            names = batch.column(group)
            new = np.ones(n, dtype=bool)
            new[1:] = pc.not_equal(names.slice(1), names.slice(0, n - 1)).to_numpy(zero_copy_only=False)
            new[0] = names[0].as_py() != last
            begins = np.maximum.accumulate(np.where(new, np.arange(n), -count))  # a group that goes on began before
            pos = np.arange(n) - begins
            numbers = number + np.cumsum(new)
            last, number, count = names[n - 1].as_py(), int(numbers[-1]), int(pos[-1]) + 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(n, part, dtype=np.int32)), pa.array(numbers), pa.array(pos)],
                names=[*batch.schema.names, "part", "local_group", "local_pos"],
            )

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    cut = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    cut = materialize(cut.mapInArrow(run, schema + ", part int, local_group long, local_pos long"), "ranked")
    ends = cut.groupBy("part").agg(
        F.min_by(group, "local_group").alias("first"), F.max_by(group, "local_group").alias("last"),
        F.max(F.struct("local_group", "local_pos")).alias("end"),
    )
    offsets, groups, open_group, open_count = [], 0, None, 0
    for r in sorted(ends.collect(), key=lambda r: r.part):  # one row a partition
        goes_on = r.first == open_group and groups > 0
        offsets.append((r.part, groups - goes_on, open_count if goes_on else 0))
        open_count = r.end.local_pos + 1 + (open_count if goes_on and r.end.local_group == 0 else 0)
        groups, open_group = groups - goes_on + r.end.local_group + 1, r.last
    known = cut.sparkSession.createDataFrame(offsets, "part int, g long, p long")
    placed = cut.join(F.broadcast(known), "part")
    first = F.when(F.col("local_group") == 0, F.col("p")).otherwise(0)
    return placed.select(
        *rows.columns, (F.col("local_group") + F.col("g")).alias("group_no"), (F.col("local_pos") + first).alias("pos")
    )


def chunked(nodes: DataFrame, levels: int, *carried: str) -> DataFrame:
    """(group_no, m, chunk, nodes): the nodes(group_no, pos, digest, ...) in runs that end up in one segment."""
    sizes = materialize(nodes.groupBy("group_no").agg(F.count("*").alias("m")), "sizes")
    chunks = nodes.groupBy("group_no", F.expr(f"pos div {WAYS**levels}").alias("chunk")).agg(
        F.collect_list(F.struct("pos", "digest", *carried)).alias("nodes")
    )
    return materialize(chunks.join(sizes, "group_no").select("group_no", "m", "chunk", "nodes"), "chunks")


def build_segments(chunks: DataFrame, levels: int) -> DataFrame:
    """(group_no, m, chunk, top, records): each run of nodes joined level by level."""
    span = WAYS**levels

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tops, stored = [], []
            for m, listed in zip(batch.column("m").to_pylist(), batch.column("nodes")):
                fields = listed.values
                order = np.argsort(fields.field("pos").to_numpy(), kind="stable")
                level, records = [fields.field("digest")[int(k)].as_py() for k in order], []
                for _ in range(height(m) if m <= span else levels):
                    runs = [level[k : k + WAYS] for k in range(0, len(level), WAYS)]
                    level = [parent(x) for x in runs]
                    records += [{"digest": d, "children": x} for d, x in zip(level, runs)]
                tops.append(level[0]), stored.append(records)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("group_no", "m", "chunk")), pa.array(tops, type=pa.binary()),
                 pa.array(stored, type=_RECORDS_TYPE)], names=["group_no", "m", "chunk", "top", "records"],
            )

    return chunks.mapInArrow(run, f"group_no long, m long, chunk long, top binary, records {RECORDS}")


class Store:
    """The segments of one forest, pass by pass from the leaves up, and its roots(group_no, size, digest)."""

    def __init__(self, chunks: DataFrame, levels: int) -> None:
        self.levels, self.span = levels, WAYS**levels
        self.passes: list[DataFrame] = []
        self.roots: DataFrame | None = None
        sizes = chunks.select("group_no", F.col("m").alias("size")).distinct()
        while True:
            made = materialize(build_segments(chunks, levels), "segments")
            self.passes.append(made)
            done = made.where(f"m <= {self.span}").select("group_no", F.col("top").alias("digest"))
            self.roots = done if self.roots is None else self.roots.unionAll(done)
            rest = made.where(f"m > {self.span}").select("group_no", F.col("chunk").alias("pos"), F.col("top").alias("digest"))
            if rest.isEmpty():
                break
            chunks = chunked(rest, levels)
        self.roots = materialize(self.roots.join(sizes, "group_no"), "roots")

    def lookup(self, level: int) -> DataFrame:
        """(digest, records) of one pass; equal digests have equal records."""
        return self.passes[level].groupBy(F.col("top").alias("digest")).agg(F.any_value("records").alias("records"))


def siblings(records: dict[bytes, list[bytes]], top: bytes, levels: int, rank: int) -> tuple[bytes, list[dict[str, str]]]:
    """The digest at ``rank`` below ``top``, and the children not chosen, from the bottom up."""
    path = []
    for level in range(levels - 1, -1, -1):
        children, digit = records[top], rank // WAYS**level % WAYS
        path.append({
            "left": "".join(x.hex() for x in children[:digit]), "right": "".join(x.hex() for x in children[digit + 1 :]),
        })
        top = children[digit]
    return top, path[::-1]


def _records(column: pa.ListScalar) -> dict[bytes, list[bytes]]:
    return {r["digest"]: r["children"] for r in column.as_py()}


def nodes_at(size: int, level: int, span: int) -> int:
    """The nodes of a group of ``size`` leaves at the bottom of pass ``level``."""
    for _ in range(level):
        size = -(-size // span)
    return size


def descend(tops: DataFrame, store: Store) -> DataFrame:
    """(group_no, chunk, size, digest, above, root, subroot) of the segments that hold leaves.

    ``tops``: the same of the groups' roots, without chunk; ``above`` is the path from there up.
    """
    depth, span, levels = len(store.passes), store.span, store.levels
    size = F.col("size")
    level_of = F.lit(0)
    for k in range(1, depth):
        level_of = F.when(size > span**k, F.lit(k)).otherwise(level_of)
    tops = tops.withColumn("level", level_of).withColumn("chunk", F.lit(0).cast("long"))
    names = ["group_no", "chunk", "size", "digest", "above", "root", "subroot"]
    now = tops.where(F.col("level") == depth - 1).select(*names)
    for level in range(depth - 1, 0, -1):

        def run(batches: Iterator[pa.RecordBatch], level: int = level) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                made = {c: [] for c in names}
                for row, stored in zip(batch.select(names).to_pylist(), batch.column("records")):
                    records, m = _records(stored), nodes_at(row["size"], level, span)
                    first = row["chunk"] * span
                    steps = height(m) if m <= span else levels
                    for rank in range(min(span, m - first)):
                        digest, path = siblings(records, row["digest"], steps, rank)
                        below = {**row, "chunk": first + rank, "digest": digest, "above": path + row["above"]}
                        for c in names:
                            made[c].append(below[c])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(made[c], type=batch.schema.field(c).type) for c in names], names=names
                )

        schema = f"group_no long, chunk long, size long, digest binary, above {PATH}, root binary, subroot binary"
        below = now.join(store.lookup(level), "digest").mapInArrow(run, schema)
        now = materialize(below.unionAll(tops.where(F.col("level") == level - 1).select(*names)), "descent")
    return now


def fold(leaf: str, path: list[dict[str, str]]) -> str:
    """The root that a leaf and its siblings give."""
    for step in path:
        leaf = sha256((step["left"] + leaf + step["right"]).encode()).hexdigest()
    return leaf


def prove(tops: DataFrame, store: Store, chunks: DataFrame) -> DataFrame:
    """(id, leaf, subroot, root, proof, folded_root) of every leaf; chunks of nodes(pos, digest, id, tampered)."""
    below = descend(tops, store).join(store.lookup(0), "digest").join(chunks.drop("m"), ["group_no", "chunk"])
    span, levels = store.span, store.levels

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "leaf", "subroot", "root", "proof", "folded_root"]
        for batch in batches:
            for k in range(batch.num_rows):
                size, top, chunk = (batch.column(c)[k].as_py() for c in ("size", "digest", "chunk"))
                above, records = batch.column("above")[k].as_py(), _records(batch.column("records")[k])
                root, subroot = (batch.column(c)[k].as_py().hex() for c in ("root", "subroot"))
                steps, made = height(size) if size <= span else levels, []
                for node in batch.column("nodes")[k].as_py():
                    reached, path = siblings(records, top, steps, node["pos"] - chunk * span)
                    if reached != node["digest"]:
                        raise ValueError(f"the store does not lead to leaf {node['digest'].hex()}")
                    path += above
                    leaf, changed = reached.hex(), node["tampered"]
                    made.append((
                        node["id"], leaf, subroot, root, "".join(x["left"] + x["right"] for x in path),
                        fold(leaf if changed is None else changed.hex(), path),
                    ))
                columns = [list(x) for x in zip(*made)]
                types = [pa.int64()] + [pa.string()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(x, type=t) for x, t in zip(columns, types)], names=names)

    wanted = ["chunk", "size", "digest", "above", "root", "subroot", "records", "nodes"]
    schema = "id long, leaf string, subroot string, root string, proof string, folded_root string"
    return below.select(*wanted).mapInArrow(run, schema)


def manifest(
    docs: DataFrame, tampered: dict[str, Column] | None = None, when: Column | None = None,
    fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id", group_col: str = "source", levels: int = LEVELS,
) -> DataFrame:
    """(``id_col``, leaf, subroot, root, proof, folded_root, verified) of every row, digests in hex.

    ``proof`` holds the siblings from the leaf to the root, left to right. ``folded_root``
    is computed from the siblings and the leaf; where ``when`` holds, from the leaf the row
    would have with the fields ``tampered``. A row without a proof that leads to the root
    is not verified. Nulls are values like others and come first; rows of one id stand in
    the order of their leaves, and repeated rows are leaves of their own. Other columns are
    ignored. An empty table gives no rows.
    """
    columns = [F.col(c) for c in fields]
    changed = [(tampered or {}).get(c, F.col(c)) for c in fields]
    altered = F.lit(None).cast("binary") if when is None else F.when(when, F.unhex(leaf_digest(changed)))
    rows = docs.select(
        F.coalesce(F.concat(F.lit("1"), F.col(group_col).cast("string")), F.lit("0")).alias("group"),
        F.col(id_col).cast("long").alias("id"), F.unhex(leaf_digest(columns)).alias("digest"),
        altered.alias("tampered"), F.monotonically_increasing_id().alias("row"),
    )
    rows = materialize(rows, "leaves")
    chunks = chunked(ranked(rows, "group", ["group", "id", "digest", "row"]).drop("group", "row"), levels, "id", "tampered")
    forest = Store(chunks, levels)
    subroots = forest.roots.select(F.lit(0).cast("long").alias("group_no"), F.col("group_no").alias("pos"), "digest")
    source_chunks = chunked(materialize(subroots, "subroots"), levels)
    sources = Store(source_chunks, levels)
    start = sources.roots.select(
        "group_no", "size", "digest", F.array().cast(PATH).alias("above"), F.col("digest").alias("root"), F.col("digest").alias("subroot")
    )
    tops = materialize(_subroot_paths(start, sources, source_chunks), "subroot_paths")
    tops = tops.join(forest.roots.select("group_no", "size"), "group_no")
    proven = prove(tops, forest, chunks)
    return proven.withColumnRenamed("id", id_col).withColumn("verified", F.col("folded_root") == F.col("root"))


def _subroot_paths(start: DataFrame, sources: Store, chunks: DataFrame) -> DataFrame:
    """(group_no, digest, subroot, above, root) of every source."""
    below = descend(start, sources).join(sources.lookup(0), "digest").join(chunks.drop("m"), ["group_no", "chunk"])
    span, levels = sources.span, sources.levels

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for row in batch.to_pylist():
                records = {r["digest"]: r["children"] for r in row["records"]}
                steps = height(row["size"]) if row["size"] <= span else levels
                for node in row["nodes"]:
                    digest, path = siblings(records, row["digest"], steps, node["pos"] - row["chunk"] * span)
                    made.append((node["pos"], digest, digest, path + row["above"], row["root"]))
            types = [pa.int64(), pa.binary(), pa.binary(), _PATH_TYPE, pa.binary()]
            columns = [list(x) for x in zip(*made)] or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, type=t) for x, t in zip(columns, types)], names=["group_no", "digest", "subroot", "above", "root"]
            )

    wanted = ["chunk", "size", "digest", "above", "root", "records", "nodes"]
    return below.select(*wanted).mapInArrow(
        run, f"group_no long, digest binary, subroot binary, above {PATH}, root binary"
    )
