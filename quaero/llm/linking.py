"""Links between rows that share regions, and their connected groups.

Shared by the near-duplicate operators. A region is what rows have in common that
may be near (a prefix of a signature, a block of a SimHash). The search inside
regions has two steps, so that a large region costs no quadratic output and loses
no link that would join two groups:

1. Each region is kept in the order of its full signatures, and a row meets the
   ``WINDOW`` rows after it, those with the longest common prefixes. Regions of up
   to ``WINDOW`` + 1 rows stay whole, so all their rows meet; range partitioning
   splits a larger one at deeper prefixes, over many tasks.
2. The verified links give groups. Only regions that step 1 did not cover and that
   still hold rows of several groups are searched whole, in blocks of bounded rows
   and content, and only for pairs between different groups. Here the full contents come
   to the blocks, so that pairs are decided where they are found and only links
   that join two groups leave a task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaero.llm.common import materialize, whole_groups

WINDOW = 12
BLOCK_ROWS = 1024
#: sum of the sizes ``n`` (shingles, characters) a block holds, but for a row that is larger alone
BLOCK_SIZE = 1 << 19
BROADCAST_IDS = 4_000_000
#: pairs of rows that are decided together, and that a block lists at once
PAIRS, BLOCK_PAIRS = 65536, 1 << 17
#: tasks a core that compare the blocks of crowded regions
TASKS = 4

Verify = Callable[[DataFrame], DataFrame]
Contents = Callable[[DataFrame], DataFrame]


class Near:
    """What a link asks of two rows, in the three forms the search needs.

    ``rows``: cheap test of two lists of rows by signature and size, true for every
    link but for a stated chance. ``certain``: the same without any chance of a miss.
    ``prepare``: takes the contents of a block and returns ``linked(k, at, group)``:
    of the rows ``at``, which belong to the groups ``group``, one of each group that
    row ``k`` has a link to, by the exact test. Where ``together`` is set, ``decide`` takes the
    contents of several blocks instead and returns whether each pair of rows ``(i, j)`` is a
    link: it is called for about ``PAIRS`` of them at once.
    Its ``rows`` must not miss a link then.
    """

    together = False

    def rows(self, sig: np.ndarray, n: np.ndarray, other: np.ndarray, m: np.ndarray) -> np.ndarray:
        raise NotImplementedError

    def certain(self, sig: np.ndarray, n: np.ndarray, other: np.ndarray, m: np.ndarray) -> np.ndarray:
        return self.rows(sig, n, other, m)

    def prepare(self, contents: list[pa.Buffer]) -> Callable[[int, np.ndarray, np.ndarray], np.ndarray]:
        raise NotImplementedError

    def decide(self, contents: list[pa.Buffer]) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
        raise NotImplementedError


def _signatures(column: pa.Array) -> np.ndarray:
    width = len(column[0].as_buffer()) if len(column) else 0
    flat = b"".join(x.as_buffer() for x in column)
    return np.frombuffer(flat, dtype=np.uint8).reshape(len(column), width)


def neighbour_pairs(members: DataFrame, near: Near, window: int = WINDOW) -> DataFrame:
    """(a, b), a < b: rows of a region at most ``window`` apart in its order, and near."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            now = (
                batch.column("id").to_numpy(), batch.column("region").to_numpy(), batch.column("n").to_numpy(),
                _signatures(batch.column("signature")),
            )
            old = 0 if held is None else len(held[0])
            ids, region, n, sig = now if held is None else tuple(np.concatenate(x) for x in zip(held, now))
            found = []
            for k in range(1, min(window, len(ids) - 1) + 1):
                i = np.flatnonzero(region[:-k] == region[k:])
                i = i[i + k >= old]  # the second row is new
                i = i[near.rows(sig[i], n[i], sig[i + k], n[i + k])] if len(i) else i
                found.append((ids[i], ids[i + k]))
            a, b = (np.concatenate(x) for x in zip(*found)) if found else (ids[:0], ids[:0])
            differ = a != b
            a, b = a[differ], b[differ]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])
            held = tuple(x[-window:] for x in (ids, region, n, sig))

    rows = members.select("id", "region", "n", "signature")
    # a range bound may split a region; only those that mixed_regions covers may be split
    whole = rows.where(members["m"] <= window + 1).repartition("region")
    split = rows.where(members["m"] > window + 1).repartitionByRange("region", "signature")
    pairs = [x.sortWithinPartitions("region", "signature").mapInArrow(run, "a long, b long") for x in (whole, split)]
    return pairs[0].unionAll(pairs[1]).distinct()


def mixed_regions(members: DataFrame, groups: DataFrame, window: int) -> DataFrame:
    """The rows, with their group, of regions too large for ``neighbour_pairs`` that hold several groups."""
    wide = members.where(F.col("m") > window + 1).select("id", "region", "n", "m", "signature")
    wide = wide.join(groups, "id", "left").withColumn("group", F.coalesce("group", "id"))
    mixed = wide.groupBy("region").agg(
        F.min("group").alias("x"), F.max("group").alias("y"), F.sum("n").alias("size")
    ).where("x <> y")
    return wide.join(mixed.select("region", "size"), "region")


def regions_before(members: DataFrame, ids: DataFrame, window: int) -> DataFrame:
    """(id, whole, split): of listed ids(id) the regions ``neighbour_pairs`` has kept whole, and the others."""
    whole = F.col("m") <= window + 1
    return members.join(ids, "id", "left_semi").groupBy("id").agg(
        F.collect_list(F.when(whole, F.col("region"))).alias("whole"),
        F.collect_list(F.when(~whole, F.col("region"))).alias("split"),
    )


def joining_links(
    mixed: DataFrame, contents: DataFrame, near: Near, block: int, before: DataFrame | None = None
) -> DataFrame:
    """Links (a, b) that join different groups of a region; contents(id, content).

    With ``before`` (``regions_before``), pairs are left out that have met in a region that was kept
    whole, and of several regions in common only the smallest decides a pair.
    """
    blocks = F.greatest(F.ceil(F.col("m") / block), F.ceil(F.col("size") / BLOCK_SIZE)).cast("int")
    rows = mixed.join(contents, "id").withColumn("blocks", blocks)
    rows = rows.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select(
        "region", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        "block", "id", "n", "group", "signature", "content",
    )

    if near.together:
        none = F.array().cast("array<long>")
        if before is None:
            rows = rows.withColumn("before", none)
        else:
            rows = rows.join(before, "id", "left")
            smaller = F.filter("split", lambda x: x < F.col("region"))
            rows = rows.withColumn("before", F.coalesce(F.concat("whole", smaller), none)).drop("whole", "split")

        def many(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in whole_groups(batches, "region", "i", "j"):
                yield from links_of_blocks(part, near, PAIRS).to_batches()

        # few bytes, many pairs: by their bytes too few tasks would be made of them
        tasks = TASKS * rows.sparkSession.sparkContext.defaultParallelism
        rows = rows.repartition(tasks, "region", "i", "j").sortWithinPartitions("region", "i", "j")
        return rows.mapInArrow(many, "a long, b long").distinct()

    def run(part: pa.Table) -> pa.Table:
        part = part.take(pa.array(np.argsort(part["id"].to_numpy(), kind="stable")))
        ids, n, group, side = (part[c].to_numpy() for c in ("id", "n", "group", "block"))
        names, root, counts = np.unique(group, return_inverse=True, return_counts=True)
        root = root.copy()
        main = root == counts.argmax()
        a, b = [], []
        if len(names) > 1:
            cross = part["i"][0].as_py() != part["j"][0].as_py()
            sig = _signatures(part["signature"].combine_chunks())
            linked = near.prepare([x.as_buffer() for x in part["content"]])
            place = np.arange(len(ids))
            for k in np.flatnonzero(~main).tolist():
                at = (root != root[k]) & (main | (place > k))
                if cross:
                    at &= side != side[k]
                at = np.flatnonzero(at)
                at = at[near.certain(sig[at], n[at], sig[k][None, :], n[k])] if len(at) else at
                for x in linked(k, at, root[at]).tolist() if len(at) else []:
                    a.append(int(ids[k])), b.append(int(ids[x]))
                    root[root == root[x]] = root[k]
        a, b = np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return rows.groupBy("region", "i", "j").applyInArrow(run, "a long, b long").distinct()


def links_of_blocks(part: pa.Table, near: Near, pairs: int = PAIRS) -> pa.Table:
    """Links (a, b) that join different groups within the blocks (region, i, j) of sorted rows, ``pairs`` decided at once.

    Rows that have one of the regions ``before`` in common are not compared.
    """
    ids, n, group, side = (part[c].to_numpy() for c in ("id", "n", "group", "block"))
    region, first, second = (part[c].to_numpy() for c in ("region", "i", "j"))
    sig = _signatures(part["signature"].combine_chunks())
    decide = near.decide([x.as_buffer() for x in part["content"]])
    before = part["before"].combine_chunks()
    before = before.combine_chunks() if isinstance(before, pa.ChunkedArray) else before
    ends, regions = before.offsets.to_numpy().tolist(), before.values.to_numpy()
    sets = [frozenset(regions[x:y].tolist()) for x, y in zip(ends[:-1], ends[1:])]
    number = np.unique(group, return_inverse=True)[1]
    root = np.arange(int(number.max(initial=0)) + 1)
    a, b, waiting = [], [], []

    def settle() -> None:
        i, j = (np.concatenate(x) for x in zip(*waiting))
        waiting.clear()
        apart = root[number[i]] != root[number[j]]  # groups may have been joined since
        i, j = i[apart], j[apart]
        good = decide(i, j)
        for k, x in zip(i[good].tolist(), j[good].tolist()):
            p, q = root[number[k]], root[number[x]]
            if p != q:
                a.append(int(ids[k])), b.append(int(ids[x]))
                root[root == q] = p

    head = (region[1:] != region[:-1]) | (first[1:] != first[:-1]) | (second[1:] != second[:-1])
    bounds = [0, *(np.flatnonzero(head) + 1).tolist(), len(ids)]
    for begin, end in zip(bounds[:-1], bounds[1:]):
        mine, place = root[number[begin:end]], np.arange(begin, end)
        names, of, counts = np.unique(mine, return_inverse=True, return_counts=True)
        main = of == counts.argmax()
        rest = place[~main]
        step = max(1, BLOCK_PAIRS // (end - begin))
        for at in range(0, len(rest), step):
            some = rest[at : at + step]
            # a row of another group than the largest meets that one's and the rows after it
            apart = (mine[some - begin][:, None] != mine) & (main | (place > some[:, None]))
            if first[begin] != second[begin]:
                apart &= side[some][:, None] != side[begin:end]
            i, j = np.nonzero(apart)
            i, j = some[i], j + begin
            good = near.certain(sig[i], n[i], sig[j], n[j])
            i, j = i[good], j[good]
            new = np.array([sets[k].isdisjoint(sets[x]) for k, x in zip(i.tolist(), j.tolist())], dtype=bool)
            waiting.append((i[new], j[new]))
            if sum(len(x) for x, _ in waiting) >= pairs:
                settle()
    if waiting:
        settle()
    a, b = np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)
    return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})


def components(links: DataFrame) -> DataFrame:
    """(id, group) for every id in ``links(a, b)``; the group is the smallest id reachable.

    Alternates the two star operations until nothing changes; each round is written
    to the shared folder. The number of rounds grows with the logarithm of the size.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()
    edges, before = materialize(edges, "edges"), None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(20,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
        both = edges.unionAll(edges.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
        least = both.groupBy("hi").agg(F.least("hi", F.min("lo")).alias("m"))
        large = both.join(least, "hi").where("lo > hi").select(F.col("lo").alias("hi"), F.col("m").alias("lo")).distinct()
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(least, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        small = small.unionAll(least.select("hi", F.col("m").alias("lo")))
        edges = materialize(small.distinct(), "edges")
    roots = edges.select(F.col("lo").alias("id"), F.col("lo").alias("group")).distinct()
    return edges.select(F.col("hi").alias("id"), F.col("lo").alias("group")).unionAll(roots)


def link_groups(
    members: DataFrame, near: Near, verify: Verify, contents: Contents, window: int = WINDOW, block: int = BLOCK_ROWS
) -> DataFrame:
    """(id, group) of linked rows, for members(id, region, m, n, signature).

    ``m`` is the number of rows of the region and ``n`` the row's size; ids are not
    null. ``verify`` keeps of candidate pairs (a, b) the true links, or as many as
    connect the same rows; ``contents`` gives (id, content) for listed ids(id).
    """
    links = materialize(verify(materialize(neighbour_pairs(members, near, window), "candidates")), "links")
    groups = materialize(components(links), "groups")
    mixed = materialize(mixed_regions(members, groups, window), "mixed")
    if mixed.isEmpty():
        return groups
    ids = materialize(mixed.select("id").distinct(), "involved")
    before = regions_before(members, ids, window) if near.together else None
    more = joining_links(mixed, materialize(contents(ids), "contents"), near, block, before)
    spanning = groups.select(F.col("id").alias("a"), F.col("group").alias("b")).unionAll(more)
    return materialize(components(spanning), "groups")


def crowded(spread: DataFrame) -> DataFrame:
    """The rows of ``spread(id, region, ...)`` whose region has at least two rows, with their number ``m``."""
    sizes = spread.groupBy("region").agg(F.count("*").alias("m")).where("m > 1")
    return spread.join(materialize(sizes, "regions"), "region")


def _listed(column: str, ids: DataFrame) -> DataFrame:
    """``ids(id)`` under the name of the column; broadcast only up to a counted limit."""
    listed = ids.select(F.col("id").alias(column))
    return F.broadcast(listed) if ids.count() <= BROADCAST_IDS else listed


def only_ids(rows: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """The rows whose ``column`` is among ``ids(id)``."""
    return rows.join(_listed(column, ids), column, "left_semi")


def without_ids(rows: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """The rows whose ``column`` is not among ``ids(id)``; a null is not."""
    return rows.join(_listed(column, ids), column, "left_anti")
