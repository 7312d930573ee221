"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Keys hash to cells of a ring, and each shard owns many places on it. A key belongs
to the next place clockwise; when that shard is full, it continues clockwise to
the next shard with room. Since full shards take no more, balance is guaranteed,
and since all other keys stay at their place, a change of the shard count moves few.

Which key goes where follows from the number of keys per cell alone. These counts
(one per cell, a fixed number) go to the driver, which walks the ring once. It
returns for each cell runs of ranks with a shard and a first slot. Rows are ranked
inside their cell only, so no group is larger than a cell. The rest is DataFrame
functions; the texts are read once and never shuffled.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CELL_BITS = 14
PLACES = 256

Run = tuple[int, int, int, int, int]


def ring(shards: int, places: int = PLACES, cell_bits: int = CELL_BITS) -> list[tuple[int, int]]:
    """(cell, shard) of all virtual nodes, clockwise. A shard's places do not depend on the others."""
    nodes = []
    for shard in range(shards):
        for place in range(places):
            h = int.from_bytes(hashlib.md5(f"{shard}/{place}".encode()).digest()[:8], "big")
            nodes.append((h, shard))
    return [(h >> (64 - cell_bits), shard) for h, shard in sorted(nodes)]


def capacities(total: int, shards: int, slack: float) -> list[int]:
    """Most rows of each shard. Without slack the sum is the total, so that counts differ by one at most."""
    if slack:
        return [math.ceil((1 + slack) * total / shards)] * shards
    return [total // shards + (k < total % shards) for k in range(shards)]


def walk(counts: dict[int, int], shards: int, slack: float = 0.0, places: int = PLACES, cell_bits: int = CELL_BITS) -> list[Run]:
    """(cell, first rank, rank after the last, shard, first slot) for all keys.

    Every key first asks its own place; only then the overflow moves on, one place
    a round, so a shard fills with its own keys before it takes others.
    """
    nodes = ring(shards, places, cell_bits)
    room = capacities(sum(counts.values()), shards, slack)
    filled, runs = [0] * shards, []
    pending, at = [], 0
    for cell in sorted(counts):
        while at < len(nodes) and nodes[at][0] < cell:
            at += 1
        pending.append((cell, 0, counts[cell], at % len(nodes)))
    while pending:
        overflow = []
        for cell, first, end, node in pending:
            shard = nodes[node][1]
            taken = min(room[shard] - filled[shard], end - first)
            if taken:
                runs.append((cell, first, first + taken, shard, filled[shard]))
                filled[shard] += taken
            if first + taken < end:
                overflow.append((cell, first + taken, end, (node + 1) % len(nodes)))
        pending = overflow
    return runs


def ring_hash(id_col: str, text_col: str) -> Column:
    """The key's place on the ring: of the id, or of the text where the id is null."""
    return F.when(F.col(id_col).isNotNull(), F.xxhash64(id_col)).otherwise(F.xxhash64(text_col))


def shard(
    docs: DataFrame, shards: int = 16, slack: float = 0.0, id_col: str = "doc_id", text_col: str = "text",
    places: int = PLACES, cell_bits: int = CELL_BITS,
) -> DataFrame:
    """Every row with its shard: the id, size, text_crc32, shard and slot.

    ``size`` is the text's UTF-8 bytes (null: none) plus 1 and ``text_crc32`` their
    checksum; ``slot`` counts from 0 without gaps in each shard. A shard holds at
    most its capacity: with ``slack`` 0 counts differ by one at most, otherwise
    (1 + slack) times the mean. Repeated rows are placed one by one. Rows with a
    null id are placed by their text. Other columns are ignored; an empty table
    gives no rows.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    cell = F.shiftrightunsigned(ring_hash(id_col, text_col), 64 - cell_bits).cast("int")
    counts = {r.cell: r.n for r in docs.select(cell.alias("cell")).groupBy("cell").agg(F.count("*").alias("n")).collect()}
    runs = docs.sparkSession.createDataFrame(
        walk(counts, shards, slack, places, cell_bits), "cell int, first long, after long, shard int, slot0 long"
    )
    rows = docs.select(
        F.col(id_col).alias("key"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), ring_hash(id_col, text_col).alias("h"), cell.alias("cell"),
    )
    order = Window.partitionBy("cell").orderBy("h", "key", "size", "text_crc32")
    ranked = rows.withColumn("place", (F.row_number().over(order) - 1).cast("long"))
    # the runs are a few per cell, a number fixed by the parameters
    placed = ranked.join(F.broadcast(runs), "cell").where("place >= first AND place < after")
    return placed.select(
        F.col("key").alias(id_col), "size", "text_crc32", "shard", (F.col("slot0") + F.col("place") - F.col("first")).alias("slot")
    )
