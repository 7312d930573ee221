import random

import pytest
from pyspark.sql import functions as F

from quaero.operators.chunking import chunk_documents, split_text


def test_short_text_is_one_chunk():
    assert split_text("one short text") == ["one short text"]
    assert split_text("   \n ") == [] and split_text("") == []


def test_words_with_overlap():
    # pieces "aaa", " bbb", " ccc", " ddd": three fit; two (8 characters) may carry over
    assert split_text("aaa bbb ccc ddd", 12, 8) == ["aaa bbb ccc", "bbb ccc ddd"]
    # with size 11 both would not leave room for the next piece, so one carries over
    assert split_text("aaa bbb ccc ddd", 11, 8) == ["aaa bbb ccc", "ccc ddd"]
    assert split_text("aaa bbb ccc ddd", 11, 0) == ["aaa bbb ccc", "ddd"]


def test_coarse_separator_first():
    text = "aa bb\n\ncc dd\n\nee ff"
    assert split_text(text, 8, 0) == ["aa bb", "cc dd", "ee ff"]
    assert split_text(text, 12, 0) == ["aa bb\n\ncc dd", "ee ff"]


def test_falls_through_to_characters():
    assert split_text("abcdefghij", 4, 1) == ["abcd", "defg", "ghij"]


def test_separator_stays_with_the_next_piece():
    assert split_text("ab.cd.ef", 5, 0) == ["ab.cd", ".ef"]


@pytest.mark.parametrize("seed", range(20))
def test_invariants(seed):
    rng = random.Random(seed)
    text = "".join(rng.choice(["ab", "c", " ", " ", ".", "\n", "\n\n", "é", "word"]) for _ in range(800))
    size = rng.choice([10, 50, 120])
    overlap = rng.choice([0, size // 5])
    chunks = split_text(text, size, overlap)
    assert all(0 < len(c) <= size and c == c.strip() for c in chunks)
    # chunks come in text order and together hold every visible character
    at = 0
    covered = set()
    for chunk in chunks:
        start = text.index(chunk, max(0, at))
        covered |= set(range(start, start + len(chunk)))
        at = max(at, start - overlap)
    if not overlap:
        assert "".join(chunks).replace("\n", "").replace(" ", "") == text.replace("\n", "").replace(" ", "")


def test_chunks_carry_the_other_columns(spark):
    df = spark.createDataFrame([("s1", "x " * 900, 7), ("s2", None, 8), ("s3", "tiny", 9)], "source string, page_content string, n int")
    rows = chunk_documents(df).orderBy("source", "chunk_no").collect()
    assert [(r.source, r.chunk_no, r.n) for r in rows] == [("s1", 0, 7), ("s1", 1, 7), ("s1", 2, 7), ("s3", 0, 9)]
    assert rows[-1].page_content == "tiny"


def test_long_text_is_cut_whole(spark):
    text = " ".join(str(i) for i in range(30_000))
    chunks = chunk_documents(spark.createDataFrame([(text,)], "page_content string"), size=1000, overlap=0)
    words = chunks.select(F.explode(F.split("page_content", " ")).alias("w"))
    assert words.count() == 30_000
    assert words.agg(F.sum(F.col("w").cast("bigint"))).first()[0] == sum(range(30_000))
