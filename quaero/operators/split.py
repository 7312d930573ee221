"""Stratified folds and exact-size random splits in a reproducible hash order.

No step sorts or moves rows. The boundaries between folds are places in the hash
order; counts of hash prefixes find them, and row-wise expressions compare with them.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_BUCKET = 100_000
FOLDS = 10
TRAIN_ROWS = 200_000
_DIGITS = 4  # hex digits refined per step of the boundary search
_SMALL = 10_000


def hash_order(id_col: Column, seed: int | str) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), id_col.cast("string")).cast("binary"))


def stratum_rank(
    df: DataFrame, id_col: str, stratum: str, seed: int | str = 0, rows_per_bucket: int = ROWS_PER_BUCKET
) -> DataFrame:
    """Add ``rank`` (from 1, in hash order) and ``stratum_size`` within each stratum.

    Rows are dealt into hash buckets; a rank is the bucket's offset (a sum over
    counts) plus the rank inside the bucket, so no task gets a whole stratum.
    """
    buckets = max(1, math.ceil(df.count() / rows_per_bucket))
    leading = F.conv(F.substring("_h", 1, 8), 16, 10).cast("bigint")
    placed = df.withColumn("_h", hash_order(F.col(id_col), seed)).withColumn(
        "_bucket", F.floor(leading * buckets / F.lit(1 << 32)).cast("int")
    )
    by_stratum = Window.partitionBy(stratum)
    before = by_stratum.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(stratum, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
        .select(
            stratum, "_bucket",
            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
            F.sum("_n").over(by_stratum).alias("stratum_size"),
        )
    )
    inside = Window.partitionBy(stratum, "_bucket").orderBy("_h", id_col)
    return (
        placed.withColumn("_rn", F.row_number().over(inside))
        .join(offsets, [stratum, "_bucket"])
        .withColumn("rank", F.col("_rn") + F.col("_offset"))
        .drop("_h", "_bucket", "_rn", "_offset")
    )


def _edges(
    df: DataFrame, id_col: str, stratum: str, ranks: Callable[[int], list[int]], seed: int | str, few: int
) -> dict[object, list[tuple[str, object]]]:
    """For each stratum the (hash, id) of the rows at the given ranks (from 0) of its hash order.

    ``ranks`` gives the wanted ranks for a stratum's size. Each step counts hash
    prefixes, at most 65,536 per stratum and open boundary; rows never move. Once at
    most ``few`` rows share a prefix, they are fetched.
    """
    hashed = df.select(
        F.col(stratum).alias("s"), F.col(id_col).alias("id"), hash_order(F.col(id_col), seed).alias("h")
    )
    sizes = {r.s: r["count"] for r in hashed.groupBy("s").count().collect()}
    # open boundaries: (stratum, place among its ranks) -> prefix so far, rank inside it, rows with it
    open_at = {
        (s, i): ("", rank, n) for s, n in sizes.items() for i, rank in enumerate(ranks(n)) if rank < n
    }
    done: dict[tuple[object, int], tuple[str, object]] = {}
    while open_at:
        length = len(next(iter(open_at.values()))[0])
        wanted = sorted({p for p, _, _ in open_at.values()})
        inside = hashed.where(F.substring("h", 1, length).isin(wanted)) if length else hashed
        if length >= 32 or all(n <= few for _, _, n in open_at.values()):
            rows: dict[tuple[object, str], list] = {}
            for r in inside.collect():  # at most ``few`` rows per boundary
                rows.setdefault((r.s, r.h[:length]), []).append((r.h, r.id))
            for (s, i), (prefix, rank, _) in open_at.items():
                done[s, i] = sorted(rows[s, prefix])[rank]
            break
        counts: dict[object, list] = {}
        for r in inside.groupBy("s", F.substring("h", 1, length + _DIGITS).alias("p")).count().collect():
            counts.setdefault(r.s, []).append((r.p, r["count"]))
        for key, (prefix, rank, _) in open_at.items():
            for p, n in sorted(x for x in counts[key[0]] if x[0].startswith(prefix)):
                if rank < n:
                    open_at[key] = (p, rank, n)
                    break
                rank -= n
    return {s: [done[s, i] for i in range(len(ranks(n))) if (s, i) in done] for s, n in sizes.items()}


def stratified_folds(
    df: DataFrame, id_col: str, label: str, k: int, seed: int | str = 0,
    rebalance: bool = True, rows_per_bucket: int = _SMALL,
) -> DataFrame:
    """Add ``fold`` (0..k-1). Each label is cut into k consecutive blocks of equal size.

    Blocks hold ceil(n / k) rows and the last one the rest. If the last fold then
    differs in size from the first, one row of each other fold moves to the last.
    Labels are few, as in classification; the boundaries between their blocks are
    found by counting, and an expression says on which side a row lies. So the
    rows are neither shuffled nor copied.
    """
    edges = _edges(df, id_col, label, lambda n: [j * math.ceil(n / k) for j in range(1, k)], seed, rows_per_bucket)
    here = F.struct(hash_order(F.col(id_col), seed).alias("h"), F.col(id_col).alias("id"))
    fold = F.lit(0)
    for value, rows in edges.items():
        passed = F.lit(0)
        for h, row_id in rows:
            edge = F.struct(F.lit(h).alias("h"), F.lit(row_id).cast(df.schema[id_col].dataType).alias("id"))
            passed = passed + (here >= edge).cast("int")
        fold = F.when(F.col(label).eqNullSafe(F.lit(value)), passed).otherwise(fold)
    folded = df.withColumn("fold", fold.cast("int"))
    if not rebalance:
        return folded
    # k rows: the size of each fold and its lowest row in a second hash order
    pick = F.struct(hash_order(F.col(id_col), f"{seed}-move"), F.col(id_col))
    summary = folded.groupBy("fold").agg(
        F.count(F.lit(1)).alias("rows"), F.min(pick).alias("pick")
    ).collect()
    sizes = {r["fold"]: r["rows"] for r in summary}
    if sizes.get(0, 0) == sizes.get(k - 1, 0):
        return folded
    moving = [r["pick"][id_col] for r in summary if r["fold"] != k - 1]
    return folded.withColumn(
        "fold", F.when(F.col(id_col).isin(moving), F.lit(k - 1)).otherwise(F.col("fold"))
    )


def nested_folds(
    df: DataFrame, id_col: str, label: str, k: int = FOLDS, seed: int | str = 0
) -> DataFrame:
    """Half of each label is the test set; the other half is cut into k folds.

    Adds ``role`` (``test`` or ``cv``) and ``fold`` (NULL for the test set).
    """
    halves = stratified_folds(df, id_col, label, 2, f"{seed}-half")
    test = halves.where(F.col("fold") == 1).withColumn("fold", F.lit(None).cast("int"))
    cv = stratified_folds(halves.where(F.col("fold") == 0).drop("fold"), id_col, label, k, f"{seed}-cv")
    return test.withColumn("role", F.lit("test")).unionByName(cv.withColumn("role", F.lit("cv")))


def fold_roles(folded: DataFrame, k: int = FOLDS, fold: int | None = None) -> DataFrame:
    """Leave-one-fold-out view: per ``run`` the ``dev`` fold, all others ``train``.

    With ``fold`` only that run is built. The view repeats rows by expression, so
    the k training sets are never stored.
    """
    runs = F.array(*[F.lit(i) for i in ([fold] if fold is not None else range(k))])
    return folded.withColumn("run", F.explode(runs)).withColumn(
        "role", F.when(F.col("fold") == F.col("run"), "dev").otherwise("train")
    )


def random_split(
    df: DataFrame, id_col: str, train_rows: int = TRAIN_ROWS, seed: int | str = 0
) -> DataFrame:
    """Add ``role``: exactly ``train_rows`` rows (or all, if fewer) are ``train``, the rest ``dev``.

    The boundary in hash order is found by counting hash prefixes, at most 65,536
    counts a step; one filter then labels both sides, with no sort of the table.
    """
    hashed = df.select(F.col(id_col), hash_order(F.col(id_col), seed).alias("_h"))
    prefix, wanted = "", train_rows
    inside = hashed
    while True:
        digits = F.substring("_h", 1, len(prefix) + _DIGITS)
        counts = sorted(inside.groupBy(digits.alias("p")).count().collect())
        for p, n in counts:
            if wanted < n:
                prefix, size = p, n
                break
            wanted -= n
        else:
            return df.withColumn("role", F.lit("train"))
        inside = hashed.where(F.col("_h").startswith(prefix))
        if size <= _SMALL or len(prefix) >= 32:
            break
    # the first row that is not in the training set
    edge = inside.orderBy("_h", id_col).limit(wanted + 1).agg(F.max(F.struct("_h", id_col))).first()[0]
    h = hash_order(F.col(id_col), seed)
    before = (h < edge["_h"]) | ((h == edge["_h"]) & (F.col(id_col) < F.lit(edge[id_col])))
    return df.withColumn("role", F.when(before, "train").otherwise("dev"))
