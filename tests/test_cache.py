import datetime as dt
import fnmatch
import random

import pytest
from pyspark.sql import functions as F

from quaero.operators import cache

T0 = dt.datetime(2024, 1, 1)


def log(spark, rows, kind="timestamp_ntz"):
    data = [(key, T0 + dt.timedelta(seconds=s), i) for i, (key, s) in enumerate(rows)]
    return spark.createDataFrame(data, f"cache_key string, asked_at {kind}, ask_id bigint")


def walk(rows, ttl):
    """The rule in plain Python: a miss stores, a hit does not extend."""
    expires, out = {}, {}
    for i in sorted(range(len(rows)), key=lambda i: (rows[i][1], i)):
        key, t = rows[i]
        out[i] = key in expires and t < expires[key]
        if not out[i]:
            expires[key] = t + ttl
    return out


def hits(df):
    return {r.ask_id: r.hit for r in df.collect()}


@pytest.mark.parametrize("hot", [1_000_000, 0])
@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
def test_hit_does_not_extend(spark, hot, kind):
    rows = [("k", 1), ("k", 1000), ("k", 4000)]
    assert hits(cache.replay(log(spark, rows, kind), hot_key_rows=hot)) == {0: False, 1: True, 2: False}


@pytest.mark.parametrize("hot", [1_000_000, 0])
def test_expiry_is_exclusive(spark, hot):
    rows = [("k", 0), ("k", 3599.999999), ("k", 3600), ("k", 3600)]
    assert hits(cache.replay(log(spark, rows), hot_key_rows=hot)) == {0: False, 1: True, 2: False, 3: True}


@pytest.mark.parametrize("seed", range(3))
def test_hot_keys_give_the_same_result(spark, seed):
    rng = random.Random(seed)
    # one key holds more than a third of all requests, with equal times among them
    rows = [("hot", rng.randrange(4000) / 2) for _ in range(700)]
    rows += [(f"k{rng.randrange(30)}", float(rng.randrange(20_000))) for _ in range(900)]
    expected = walk(rows, 60)
    df = log(spark, rows)
    assert hits(cache.replay(df, ttl_seconds=60)) == expected
    assert hits(cache.replay(df, ttl_seconds=60, hot_key_rows=500)) == expected
    assert hits(cache.replay(df, ttl_seconds=60, hot_key_rows=0)) == expected


def entries(spark, rows):
    return spark.createDataFrame([(k, T0 + dt.timedelta(seconds=s), g) for k, s, g in rows], "cache_key string, written_at timestamp, generation string")


def test_lookup_and_upsert(spark):
    stored = cache.upsert(entries(spark, [("a", 0, "old"), ("b", 5, "b")]), entries(spark, [("a", 10, "new"), ("a", 3, "late")]))
    assert {(r.cache_key, r.generation) for r in stored.collect()} == {("a", "new"), ("b", "b")}
    asks = spark.createDataFrame(
        [(i, k, T0 + dt.timedelta(seconds=s)) for i, (k, s) in enumerate([("a", 10), ("a", 3609), ("a", 3610), ("a", 9), ("c", 1)])],
        "ask_id int, cache_key string, asked_at timestamp",
    )
    got = {r.ask_id: (r.hit, r.generation) for r in cache.lookup(asks, stored).collect()}
    assert got == {0: (True, "new"), 1: (True, "new"), 2: (False, None), 3: (False, None), 4: (False, None)}


def test_invalidate_counts(spark):
    keys = ["medical_response:" + k for k in ("abc", "abd", "xbc", "a*c")] + ["other:abc"]
    df = entries(spark, [(k, 0, "g") for k in keys])
    kept, removed = cache.invalidate(df, "ab?")
    assert removed.first().removed == 2 and kept.count() == 3
    assert cache.invalidate(df)[1].first().removed == 4
    assert cache.invalidate(df, r"a\*c")[1].first().removed == 1


@pytest.mark.parametrize("pattern", ["*", "a*", "?b*", "[ab]*", "a.c", "x+", "*[0-9]", "[a-c]?", "(a)|b"])
def test_globs_match_as_expected(spark, pattern):
    keys = ["abc", "a.c", "bbc", "x+", "xx", "a9", "c1", "(a)|b", "b", ""]
    df = spark.createDataFrame([(k,) for k in keys], "cache_key string")
    got = {r[0] for r in df.where(cache.matches_glob(F.col("cache_key"), pattern, "")).collect()}
    assert got == {k for k in keys if fnmatch.fnmatchcase(k, pattern)}


def test_negated_set(spark):
    df = spark.createDataFrame([("ab",), ("cb",)], "cache_key string")
    assert [r[0] for r in df.where(cache.matches_glob(F.col("cache_key"), "[^a]b", "")).collect()] == ["cb"]


def test_both_routes_agree_on_nulls_and_repeats(spark):
    at = lambda s: None if s is None else T0 + dt.timedelta(seconds=s)
    rows = [("k", at(5), 5), ("k", at(5), 5), ("k", at(5), None), ("k", None, 1), ("k", None, None), (None, at(1), 1)]
    rows += [(None, at(2), 2), (None, at(1), 1), ("k", at(3700), 7), ("k", at(3700), 7)]
    df = spark.createDataFrame(rows, "cache_key string, asked_at timestamp, ask_id bigint")
    ways = [
        sorted(map(str, cache.replay(df, hot_key_rows=hot).collect())) for hot in (1_000_000, 0)
    ]
    assert ways[0] == ways[1]
    missed = [tuple(r) for r in cache.replay(df).where("NOT hit").collect()]
    expected = [("k", None, 1), ("k", None, None), ("k", at(5), None), ("k", at(3700), 7), (None, at(1), 1)]
    assert sorted(map(str, [m[:3] for m in missed])) == sorted(map(str, expected))


def test_a_wrong_date_does_not_widen_windows(spark):
    rows = [("k", float(s)) for s in range(0, 9000, 30)] + [("k", 3e9)]
    assert hits(cache.replay(log(spark, rows), ttl_seconds=60, hot_key_rows=0)) == walk(rows, 60)
