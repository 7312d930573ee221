import datetime as dt
import random

import pytest

from pyspark.sql import functions as F

from quaero.functions.vectors import hash_embed
from quaero.operators import cache
from quaero.plans.answer import prepare_questions
from quaero.streaming import feed, ingest
from quaero.streaming import state as keyed
from quaero.streaming.cache import CacheStream, judged, late, replay_stream

T0 = dt.datetime(2024, 1, 1)


def files(spark, df, folder, parts):
    """One file per slice, in order, so that each becomes its own micro-batch."""
    for i in range(parts):
        df.where(F.col("part") == i).drop("part").coalesce(1).write.mode("append").parquet(f"{folder}/{i}")
    return f"{folder}/*"


def feed_of(spark, rows, kind, folder, per_batch):
    """Ten files in the order of the rows, ``per_batch`` of them in a micro-batch."""
    size = -(-len(rows) // 10)
    df = spark.createDataFrame([(*r, i // size) for i, r in enumerate(rows)], f"{kind}, part int")
    glob = files(spark, df, folder, 10)
    return spark.readStream.schema(df.drop("part").schema).option("maxFilesPerTrigger", per_batch).parquet(glob)


ASKS = "cache_key string, asked_at timestamp, ask_id bigint"


@pytest.mark.parametrize("per_batch, shuffled", [(1, True), (4, True), (100, True), (1, False)])
def test_cache_stream_equals_batch(spark, tmp_path, per_batch, shuffled):
    rng = random.Random(4)
    seconds = sorted(rng.randrange(30_000) for _ in range(300))
    rows = [(f"k{rng.randrange(6)}", T0 + dt.timedelta(seconds=s), i) for i, s in enumerate(seconds)]
    if shuffled:  # arrival up to 500 s late, within the lateness of 600 s
        rows.sort(key=lambda r: r[1] + dt.timedelta(seconds=rng.randrange(500)))
    stream = CacheStream(spark, str(tmp_path / "out"))
    replay_stream(feed_of(spark, rows, ASKS, str(tmp_path / "in"), per_batch), stream, str(tmp_path / "progress"))
    batch = cache.replay(spark.createDataFrame(rows, ASKS))
    got = {r.ask_id: r.hit for r in judged(spark, stream.root).collect()}
    assert got == {r.ask_id: r.hit for r in batch.collect()} and {True, False} == set(got.values())
    assert late(spark, stream.root, batch.drop("hit").schema).count() == 0


def test_late_requests_are_kept_apart(spark, tmp_path):
    at = lambda s: T0 + dt.timedelta(seconds=s)
    rows = [("k", at(10_000), 0)] * 1 + [("k", at(20_000), 1), ("k", at(100), 2), ("k", at(20_001), 3), ("j", at(50), 4)]
    stream = CacheStream(spark, str(tmp_path / "out"))
    feed_ = feed_of(spark, rows * 1, ASKS, str(tmp_path / "in"), 1)
    replay_stream(feed_, stream, str(tmp_path / "progress"))
    assert {(r.ask_id, r.hit) for r in judged(spark, stream.root).collect()} == {(0, False), (1, False), (3, True)}
    schema = spark.createDataFrame([], ASKS).schema
    assert {r.ask_id for r in late(spark, stream.root, schema).collect()} == {2, 4}
    # a batch that is run again changes nothing
    again = spark.createDataFrame(rows[2:3], ASKS)
    before = judged(spark, stream.root).count()
    stream.batch(again, 2)
    assert judged(spark, stream.root).count() == before


def test_screening_stream_equals_batch(spark, tmp_path):
    rows = [(1, " febre alta ", 0), (2, "oi", 0), (3, "exit", 1), (4, "ligue 11 98765-4321", 1), (5, "qual o tratamento?", 1)]
    df = spark.createDataFrame(rows, "question_id bigint, question string, part int")
    glob = files(spark, df, str(tmp_path / "in"), 2)
    stream = spark.readStream.schema(df.drop("part").schema).option("maxFilesPerTrigger", 1).parquet(glob)
    feed.write_rows(feed.screen_stream(stream), str(tmp_path / "out"), str(tmp_path / "progress")).awaitTermination()
    got = {(r.question_id, r.is_safe) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {(r.question_id, r.is_safe) for r in prepare_questions(df.drop("part")).collect()}
    assert got == {(1, True), (2, False), (4, False), (5, True)}


def test_answers_are_written_once_per_batch(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a.xml", "febre alta em idosos")], "corpus_id bigint, source string, page_content string")
    docs = docs.withColumn("embedding", hash_embed(F.col("page_content")))
    df = spark.createDataFrame([(1, "febre em idosos", 0), (2, "idosos com febre", 1)], "question_id bigint, question string, part int")
    glob = files(spark, df, str(tmp_path / "in"), 2)
    stream = spark.readStream.schema(df.drop("part").schema).option("maxFilesPerTrigger", 1).parquet(glob)
    generations = spark.createDataFrame([(1, "febre alta")], "question_id bigint, generation string")
    feed.answer_stream(stream, docs, generations, str(tmp_path / "out"), str(tmp_path / "progress")).awaitTermination()
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert {(r.question_id, r.hallucination_check) for r in rows} == {(1, "valid"), (2, "validation_error")}


@pytest.mark.parametrize("per_batch", [1, 2, 100])
def test_repeated_questions_are_dropped(spark, tmp_path, per_batch):
    rng = random.Random(7)
    rows = [(f"q{rng.randrange(5)}", T0 + dt.timedelta(seconds=200 * i), i) for i in range(60)]
    kind = "question_id string, asked_at timestamp, ask_id bigint"
    stream = feed_of(spark, rows, kind, str(tmp_path / "in"), per_batch)
    kept = feed.drop_repeats(stream, str(tmp_path / "out"), str(tmp_path / "progress"))
    last, expected = {}, set()
    for key, t, i in rows:
        if key not in last or t - last[key] >= dt.timedelta(hours=1):
            last[key] = t
            expected.add(i)
    assert {r.ask_id for r in kept.collect()} == expected


@pytest.mark.parametrize("per_batch", [1, 2])
def test_changed_and_removed_documents(spark, tmp_path, per_batch):
    root = str(tmp_path / "chunks")
    # two documents share a source; b changes later but its older version arrives last
    rows = [("a/1", "1.xml", "first text of a", 0, 0), ("b/1", "1.xml", "text of b " * 200, 5, 0)]
    rows += [("a/1", "1.xml", "second text of a", 1, 1), ("c", "c", "c", 0, 1), ("b/1", "1.xml", "older b", 3, 1)]
    rows = [(k, s, t, T0 + dt.timedelta(days=d), p) for k, s, t, d, p in rows]
    df = spark.createDataFrame(rows, "doc_key string, source string, page_content string, modified_at timestamp, part int")
    glob = files(spark, df, str(tmp_path / "in"), 2)
    stream = spark.readStream.schema(df.drop("part").schema).option("maxFilesPerTrigger", per_batch).parquet(glob)
    ingest.ingest_stream(stream, root, str(tmp_path / "progress")).awaitTermination()
    now = ingest.current_chunks(spark, root)
    assert {r.page_content for r in now.where("doc_key = 'a/1'").collect()} == {"second text of a"}
    assert now.where("doc_key = 'b/1'").count() > 1
    listing = spark.createDataFrame([("a/1",), ("c",)], "doc_key string")
    assert {r.doc_key for r in ingest.current_chunks(spark, root, listing).collect()} == {"a/1", "c"}
    if per_batch == 1:  # a repeated batch leaves no duplicates
        before = now.count()
        ingest.ingest_batch(df.where("part = 1").drop("part"), root, 1)
        assert ingest.current_chunks(spark, root).count() == before


def test_new_or_changed_files(spark):
    kind = "source string, modified_at timestamp"
    files_now = spark.createDataFrame([("a", T0), ("b", T0), ("c", T0)], kind)
    known = spark.createDataFrame([("a", T0), ("b", T0 - dt.timedelta(days=1))], kind)
    assert {r.source for r in ingest.new_or_changed(files_now, known).collect()} == {"b", "c"}


# --- state store ---------------------------------------------------------------------


def run_keyed(stream, out, lateness=600):
    query = feed.write_rows(keyed.replay_keyed(stream, lateness_seconds=lateness), out, f"{out}-progress")
    query.awaitTermination()
    return query


@pytest.mark.parametrize("per_batch, shuffled", [(3, True), (100, True)])
def test_keyed_state_equals_batch(spark, tmp_path, per_batch, shuffled):
    rng = random.Random(6)
    seconds = sorted(rng.randrange(30_000) for _ in range(300))
    # one key holds half of all requests; some stand at the same time
    rows = [(rng.choice(["hot", f"k{rng.randrange(6)}"]), T0 + dt.timedelta(seconds=s // 3 * 3), i) for i, s in enumerate(seconds)]
    if shuffled:
        rows.sort(key=lambda r: r[1] + dt.timedelta(seconds=rng.randrange(500)))
    batch = {r.ask_id: r.hit for r in cache.replay(spark.createDataFrame(rows, ASKS)).collect()}
    tick = ("tick", keyed.closing_tick(max(r[1] for r in rows), 600), -1)
    stream = feed_of(spark, rows + [tick] * -(-len(rows) // 9), ASKS, str(tmp_path / "in"), per_batch)
    query = run_keyed(stream, str(tmp_path / "out"))
    got = {r.ask_id: r.hit for r in spark.read.parquet(str(tmp_path / "out")).collect() if r.ask_id >= 0}
    assert got == batch and keyed.rows_behind(query) == 0
    # expired keys have left the state: the tick is all that is open
    assert query.recentProgress[-1].stateOperators[0].numRowsTotal <= 1


def test_keyed_state_goes_on_after_a_restart(spark, tmp_path):
    at = lambda s: T0 + dt.timedelta(seconds=s)
    parts = [[("k", at(1), 0)], [("k", at(1000), 1), ("k", at(5000), 2)], [("tick", at(90_000), -1)]]
    got = set()
    for i, part in enumerate(parts):  # each part is seen by a new query on the same checkpoint
        spark.createDataFrame(part, ASKS).coalesce(1).write.parquet(str(tmp_path / f"in/{i}"))
        stream = spark.readStream.schema(ASKS).parquet(str(tmp_path / "in/*"))
        run_keyed(stream, str(tmp_path / "out"))
        got = {(r.ask_id, r.hit) for r in spark.read.schema("cache_key string, ask_id bigint, hit boolean").parquet(str(tmp_path / "out")).collect()}
    assert got - {(-1, False)} == {(0, False), (1, True), (2, False)}


def test_keys_share_rows_of_the_state(spark, tmp_path):
    """More keys than state rows, a missing key among them; the calls a batch makes do not grow with its keys."""
    rng = random.Random(9)
    rows = [(rng.choice([None, "", "n", *(f"k{i}" for i in range(60))]), T0 + dt.timedelta(seconds=20 * i), i) for i in range(700)]
    last, expected = {}, {}
    for name, t, i in rows:
        expected[i] = name in last and t - last[name] < dt.timedelta(hours=1)
        last[name] = last[name] if expected[i] else t
    tick = ("tick", keyed.closing_tick(rows[-1][1], 600), -1)
    stream = feed_of(spark, rows + [tick] * 78, ASKS, str(tmp_path / "in"), 3)
    asked = keyed.replay_keyed(stream, state_rows=5)
    query = feed.write_rows(asked, str(tmp_path / "out"), str(tmp_path / "progress"))
    query.awaitTermination()
    got = {r.ask_id: (r.cache_key, r.hit) for r in spark.read.parquet(str(tmp_path / "out")).collect() if r.ask_id >= 0}
    assert got == {i: (name, expected[i]) for name, _, i in rows}
    assert max(p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators) <= 5


def test_rows_behind_the_watermark_are_counted(spark, tmp_path):
    at = lambda s: T0 + dt.timedelta(seconds=s)
    rows = [("k", at(10_000), 0), ("k", at(20_000), 1), ("k", at(100), 2), ("j", at(20_001), 3), ("j", at(90_000), -1)]
    query = run_keyed(feed_of(spark, rows, ASKS, str(tmp_path / "in"), 1), str(tmp_path / "out"))
    got = {r.ask_id for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got - {-1} == {0, 1, 3} and keyed.rows_behind(query) == 1


def test_redelivered_rows_come_once(spark, tmp_path):
    rows = [(f"k{i % 7}", T0 + dt.timedelta(seconds=i), i // 2) for i in range(400)]
    rows = [(k, T0 + dt.timedelta(seconds=2 * (i // 2)), i) for k, _, i in rows]
    stream = feed_of(spark, rows, ASKS, str(tmp_path / "in"), 1)
    query = feed.write_rows(keyed.drop_redelivered(stream, ["ask_id"], "asked_at"), str(tmp_path / "out"), str(tmp_path / "p"))
    query.awaitTermination()
    ids = [r.ask_id for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert sorted(ids) == list(range(200)) and keyed.rows_behind(query) == 0


def test_files_are_read_in_the_order_of_a_column(spark, tmp_path):
    rows = spark.range(1000).withColumn("v", F.lit(999) - F.col("id"))
    for part in (rows.where("v < 600"), rows.where("v >= 600")):
        feed.write_in_order(part, str(tmp_path / "in"), 4, "v")
    seen = []
    stream = feed.read_stream(spark, str(tmp_path / "in"), rows.schema, "*.parquet", max_files=1)
    query = stream.writeStream.foreachBatch(lambda b, i: seen.append(b.agg(F.min("v"), F.max("v")).first())).trigger(
        availableNow=True
    ).option("checkpointLocation", str(tmp_path / "p")).start()
    query.awaitTermination()
    assert len(seen) == 8 and all(a[1] < b[0] for a, b in zip(seen, seen[1:]))
