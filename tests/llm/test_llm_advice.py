"""Whole results where parts of them once went missing."""

import random

import pytest
from pyspark.sql import functions as F

from quaero.llm import bitsliced, line_dedup, linking, warc


def test_lines_equal_but_for_unicode_case_and_marks(spark):
    pairs = [
        ("ÜBER ÖDE ÄCKER", "über öde äcker"), ("ПРИВЕТ МИР", "привет мир"), ("ΟΔΟΣ ΑΘΗΝΑ", "οδος αθηνα"),
        ("a\u201cb\u201d \u2014 c", "a b c"), ("x\u00a0y\u3000z", "x y z"), ("n \u0663\u0664", "N 12"),
    ]
    rows = [(2 * k + j, line) for k, pair in enumerate(pairs) for j, line in enumerate(pair)] + [(90, "\u2014 \u201c\u201d"), (91, "\u2014 \u201c\u201d")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    gone = {r.doc_id for r in line_dedup.dedup_lines(table).where(F.size("removed_lines") > 0).collect()}
    assert gone == {2 * k + 1 for k in range(len(pairs))}


@pytest.mark.parametrize("words, changed", [(10, 1), (20, 1), (50, 5)])
def test_edit_similarity_alone_decides(spark, words, changed):
    """Of lines with some words replaced, those of edit similarity 0.8 are found but for a stated share."""
    rng, rows, similar = random.Random(words), [], 0
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randrange(3, 9)))
    for k in range(200):
        line = [word() for _ in range(words)]
        other = list(line)
        for at in rng.sample(range(words), changed):
            other[at] = word()
        similar += line_dedup.similar(" ".join(line), " ".join(other), 0.8)
        rows += [(2 * k, " ".join(line)), (2 * k + 1, " ".join(other))]
    done = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    found = done.where("size(removed_lines) > 0").count()
    assert similar > 180 and 0.9 * similar <= found <= similar


def test_small_regions_are_never_split(spark):
    class All(linking.Near):
        def rows(self, sig, n, other, m):
            return n == m

    rows = [(100 * r + k, r, 10, 5, bytes([k])) for r in range(3) for k in range(10)]
    members = spark.createDataFrame(rows, "id long, region long, m long, n long, signature binary")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert linking.neighbour_pairs(members, All()).count() == 3 * 45
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_page_with_an_url_over_64_kb(spark):
    url = "http://h/" + " " * 30_000
    pages = spark.createDataFrame([(1, url, "<p>x</p>"), (2, "http://h/2", "<p>y</p>")], "page_id long, url string, html string")
    assert sorted(r.page_id for r in warc.archive_round_trip(pages).collect()) == [1, 2]
    data = warc.record_bytes(1, url, b"<p>x</p>")
    headers, _, length = warc.parse_record(memoryview(data))
    assert length == len(data) and len(headers["warc-target-uri"]) > 1 << 16


def test_one_member_of_many_records():
    import gzip
    import re

    plain = [warc.record_bytes(k, "http://x/%d" % k, random.Random(k).randbytes(900)) for k in range(300)]
    whole = b"".join(plain)
    ids = lambda found: [int(h["warc-record-id"].split(":")[-1][:-1]) for *_, records in found for h, _ in records]
    begin = sum(map(len, plain[:7]))
    inner = bytearray(whole)
    inner[begin + 500] ^= 1  # one bad record in an intact member
    data = gzip.compress(bytes(inner), mtime=0)
    found = list(warc.salvage(data))
    assert ids(found) == [k for k in range(300) if k != 7] and sum(x[1] for x in found) == len(data)
    assert [(x[0], re.findall(r"bytes (\d+) to (\d+)", x[2])) for x in found if x[2]] == [(0, [(str(begin), str(begin + len(plain[7])))])]
    for place in (len(data) // 2, len(data) - 6):  # a bad byte in the stream, a bad checksum
        broken = bytearray(gzip.compress(whole, mtime=0))
        broken[place] ^= 0x55
        tail = gzip.compress(warc.record_bytes(900, "u", b"z"), mtime=0)
        found = list(warc.salvage(bytes(broken) + tail))
        got = ids(found)
        assert got == sorted(set(got)) and len(got) >= (300 if place > len(data) - 9 else 140) and got[-1] == 900
        assert sum(x[1] for x in found) == len(broken) + len(tail) and any(x[2] for x in found)


def test_large_components_take_part(spark):
    vectors = [(k, [k / 8, 1.0 - k, 0.25]) for k in range(40)] + [(100, [3e5, 0.0, 1.0]), (120, [-5e8, 2.0, 4e9]), (101, [7e13, 0.0, 0.0])]
    table = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    known = {k: [int(64 * x // 1) for x in v] for k, v in vectors}
    expected = []
    for q in (0, 20):
        found = sorted((-sum(a * b for a, b in zip(known[q], v)), k) for k, v in known.items() if k != q)[:20]
        expected += [(q, r + 1, k, -s) for r, (s, k) in enumerate(found)]
    got = bitsliced.search(table, F.col("vec_id").isin(0, 20))
    assert sorted(map(tuple, got.collect())) == sorted(expected)
    with pytest.raises(Exception, match="fit a long"):
        bitsliced.search(table.unionAll(spark.createDataFrame([(102, [7e13, 0.0, 0.0])], table.schema)), F.col("vec_id") == 101).collect()
