"""Operators on Spark against brute force: nulls, empty and very long texts, ties, repeats, empty tables, clashing columns."""

import os
import random
import sys
import zlib
from itertools import combinations

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402
from test_llm_kernels import plain_shingles  # noqa: E402

from quaero.llm import (  # noqa: E402
    bitsliced, chat, decontaminate, line_dedup, linking, near_dedup, packing, quality, sharding, token_counts, warc,
)

DOCS = "doc_id long, text string, lang string, source string, n_chars long, id long, n long, score double, node string"


def vary(rng, words, k):
    words = list(words)
    for _ in range(k):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def documents():
    """Copies, near copies in a dense group, shared passages, and every odd row."""
    rng = random.Random(11)
    vocab = [f"w{k}" for k in range(400)]
    prose = lambda n: [rng.choice(vocab) for _ in range(n)]
    base, texts = prose(120), []
    texts += [vary(rng, base, rng.randrange(0, 5)) for _ in range(40)]
    texts += [" ".join(base)] * 6
    for _ in range(15):
        one = prose(rng.randrange(20, 90))
        texts += [" ".join(one), vary(rng, one, 1), vary(rng, one, 2)]
    passage = " ".join(prose(55))
    texts += [passage + "\n" + " ".join(prose(30)) for _ in range(5)]
    texts += [None, "", " \n\t", "one", "one two three", "One TWO three", "one two three four five", "x " * 30_000, "é" * 50_000]
    rows = [(k, t, "en", "s", len(t or ""), 7, 1, 0.5, "z") for k, t in enumerate(texts)]
    rng.shuffle(rows)
    return rows + rows[:2] + [(None, "one two three", None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(documents(), DOCS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def brute_groups(links, ids):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("percent", [80, 85])
def test_near_groups(docs, percent):
    sets = {r[0]: plain_shingles(r[1]) for r in documents() if r[0] is not None}
    links = [
        (a, b) for a, b in combinations(sets, 2)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    groups = brute_groups(links, sets)
    got = near_dedup.near_groups(docs, percent=percent).collect()
    assert len(got) == len(documents())
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept and r.n_shingles == 1
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (
                len(sets[r.doc_id]), groups[r.doc_id], groups[r.doc_id] == r.doc_id
            )


def test_near_groups_in_crowded_regions(spark, docs, monkeypatch):
    """With a window of 1 and blocks of 4 rows nearly all pairs come from the search between groups."""
    whole = {r.doc_id: r.component_id for r in near_dedup.near_groups(docs).collect()}
    link = linking.link_groups
    monkeypatch.setattr(linking, "link_groups", lambda m, n, v, c: link(m, n, v, c, window=1, block=4))
    assert {r.doc_id: r.component_id for r in near_dedup.near_groups(docs).collect()} == whole


def test_one_of_each(docs, empty):
    kept = near_dedup.one_of_each(docs)
    assert kept.columns == docs.columns
    groups = near_dedup.near_groups(docs).where("kept").count()
    assert kept.count() == groups
    assert near_dedup.one_of_each(empty).count() == 0


def test_components(spark):
    rng = random.Random(4)
    links = [(k, k + 1) for k in range(60)] + [(100, 200 + k) for k in range(50)]
    links += [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(70)] + [(5, 5)]
    rng.shuffle(links)
    got = {r.id: r.group for r in linking.components(spark.createDataFrame(links, "a long, b long")).collect()}
    ids = {x for pair in links if pair[0] != pair[1] for x in pair}
    assert got == brute_groups(links, ids)
    assert linking.components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- lines ---------------------------------------------------------------------------


def plain_form(line):
    import unicodedata

    kinds = ((c, unicodedata.category(c)[0]) for c in line)
    made = "".join("0" if k == "N" else c.lower()[0] if k in "LM" else " " for c, k in kinds)
    return " ".join(made.replace("\u03c2", "\u03c3").split())


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def brute_lines(rows):
    """The lines to remove per document, by comparing every pair of normal forms by edit similarity alone."""
    seen = {}
    for doc, text in rows:
        for k, line in enumerate((text or "").split("\n")):
            if plain_form(line):
                seen.setdefault(plain_form(line), []).append((doc, k))
    forms = sorted(seen, key=len)
    sizes = np.array([len(f) for f in forms])
    bags = np.array([np.bincount([ord(c) % 64 for c in f], minlength=64) for f in forms])
    links = []
    for a in range(len(forms)):
        b = np.arange(a + 1, np.searchsorted(sizes, sizes[a] * 1.25 + 1, side="right"))
        gap = bags[b] - bags[a]  # each edit takes at most one character away and adds one
        least = np.maximum(np.maximum(gap, 0).sum(axis=1), np.maximum(-gap, 0).sum(axis=1))
        for k in b[least <= (0.2 * sizes[b] + 1e-9).astype(int)].tolist():
            if line_dedup.edit_distance(forms[a], forms[k]) <= int(0.2 * sizes[k] + 1e-9):
                links.append((a, k))
    groups, first = brute_groups(links, range(len(forms))), {}
    for k, form in enumerate(forms):
        first[groups[k]] = min([first.get(groups[k], min(seen[form])), min(seen[form])])
    gone = {}
    for k, form in enumerate(forms):
        for doc, line in seen[form]:
            if (doc, line) != first[groups[k]]:
                gone.setdefault(doc, set()).add(line)
    return gone, len(links)


def test_bit_parallel_edit_distance():
    rng = random.Random(9)
    for _ in range(300):
        a, b = ("".join(rng.choices("abé", k=rng.randrange(0, 12))) for _ in "xy")
        assert line_dedup.edit_distance(a, b) == edit_distance(a, b)


def test_shared_grams_lose_no_link():
    """The count of common 3-grams rules out no pair within the similarity; one link of each group comes back."""
    rng = random.Random(3)
    for turn in range(40):
        letters = "ab " if turn % 2 else "abcdefghij é"
        forms = ["".join(rng.choices(letters, k=rng.choice([5, 8, 20, 60, 200]))) for _ in range(4)]
        for base in forms[:4]:
            for share in (0.05, 0.15, 0.25):
                forms.append("".join(rng.choice(["", c + "x", "y"]) if rng.random() < share else c for c in base))
        forms += ["", "a"]
        at = np.arange(len(forms))
        grams = line_dedup.Grams(forms)
        grams.STEP = rng.choice([1, 50, 1 << 20])
        linked = line_dedup.Edits(0.8).prepare([pa.py_buffer(x.encode()) for x in forms])
        for k, form in enumerate(forms):
            true = np.array([edit_distance(form, x) <= int(0.2 * max(len(form), len(x)) + 1e-9) for x in forms])
            assert (grams.spare(k, at, 0.8)[true] >= 0).all()
            got = linked(k, at, at % 5)
            assert true[got].all() and sorted(got % 5) == sorted(set(at[true] % 5))


def test_blocks_of_bounded_content(spark, docs, monkeypatch):
    """Blocks cut by the size of their contents, down to single rows, give the same groups."""
    whole = {r.doc_id: r.component_id for r in near_dedup.near_groups(docs).collect()}
    link = linking.link_groups
    monkeypatch.setattr(linking, "link_groups", lambda m, n, v, c: link(m, n, v, c, window=1))
    monkeypatch.setattr(linking, "BLOCK_SIZE", 40)
    assert {r.doc_id: r.component_id for r in near_dedup.near_groups(docs).collect()} == whole


@pytest.mark.parametrize("window", [linking.WINDOW, 1])
def test_dedup_lines(spark, empty, monkeypatch, window):
    link = linking.link_groups
    monkeypatch.setattr(linking, "link_groups", lambda m, n, v, c: link(m, n, v, c, window=window, block=4))
    rng = random.Random(8)
    line = [f"w{rng.randrange(300)}" for _ in range(160)]
    lines = [vary(rng, line, 1) for _ in range(12)] + [f"Page {k} of 10!" for k in range(8)]
    lines += [" ".join(f"v{rng.randrange(500)}" for _ in range(12)) for _ in range(10)] + ["---", "", "Ünïted — Çase", "ünïted çase"]
    rows = [(k, "\n".join(rng.choices(lines, k=rng.randrange(1, 7)))) for k in range(40)]
    rows += [(50, None), (51, ""), (52, "\n\n"), (53, "only once here"), (54, lines[0])]
    table = spark.createDataFrame(rows + [rows[3]], "doc_id long, text string").withColumn("line", F.lit(9)).withColumn("id", F.lit(1))
    gone, links = brute_lines(rows)
    assert links > 5
    done = line_dedup.dedup_lines(table)
    assert done.columns == ["doc_id", "text", "line", "id", "n_lines", "removed_lines"]
    got = done.collect()
    assert len(got) == len(rows) + 1
    texts = dict(rows)
    for r in got:
        expected = sorted(gone.get(r.doc_id, ()))
        assert r.removed_lines == expected
        before = texts[r.doc_id]
        assert r.n_lines == (0 if before is None else before.count("\n") + 1)
        after = None if before is None else "\n".join(x for k, x in enumerate(before.split("\n")) if k not in expected)
        assert r.text == after
    assert line_dedup.dedup_lines(empty).count() == 0


# --- benchmark -----------------------------------------------------------------------


def test_find_items(spark, docs, empty):
    rows = documents()
    texts = [r[1] for r in rows if r[1]]
    items = [(k, " ".join(t.split()[3:25])) for k, t in enumerate(texts[:12])] + [(20, "nothing of this is found here at all")]
    items += [(21, None), (22, ""), (23, "one two three"), (24, texts[5].upper()), (24, texts[5].upper()), (None, texts[6])]
    table = spark.createDataFrame(items, "item_id long, text string")
    expected = []
    for r in rows:
        have = plain_shingles(r[1])
        for item, text in items:
            want = plain_shingles(text)
            if want and 10 * len(want & have) >= 8 * len(want):
                expected.append((r[0], item, len(want), len(want & have)))
    key = lambda x: tuple((v is not None, v) for v in x)
    for block in (1 << 20, 40):  # one pass, and many
        got = decontaminate.find_items(docs, table, block_shingles=block).collect()
        assert sorted(map(tuple, got), key=key) == sorted(expected, key=key)
    dirty = {(e[0]) for e in expected}
    clean = decontaminate.drop_contaminated(docs, table, block_shingles=200)
    assert clean.columns == docs.columns
    assert sorted(map(str, (r.doc_id for r in clean.collect()))) == sorted(str(r[0]) for r in rows if r[0] not in dirty)
    assert decontaminate.find_items(docs, table.where("false")).count() == 0
    assert decontaminate.drop_contaminated(docs, table.where("false")).count() == len(rows)
    assert decontaminate.find_items(empty, table).count() == 0


# --- tokens --------------------------------------------------------------------------


def test_count_tokens(docs, empty):
    from sentencepiece import SentencePieceProcessor

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = SentencePieceProcessor(model_file=path)
    table = docs.withColumn("n_tokens", F.lit("old"))
    got = token_counts.count_tokens(table, path, limit=50).collect()
    assert len(got) == len(documents())
    by_text = {r[0]: r[1] or "" for r in documents()}
    for r in got:
        n = len(model.encode(by_text[r.doc_id]))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(by_text[r.doc_id].encode()), n, n > 50)
    assert token_counts.count_tokens(empty, path).count() == 0


def check_pieces(pieces, texts, path, window):
    """Every id lies in exactly one piece, sequences have no gaps, and only the last is short."""
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    ids = {k: [*model.encode(t or "", add_special_tokens=False).ids, 0] for k, t in texts.items()}
    assert sorted({p.doc_id for p in pieces}, key=str) == sorted(ids, key=str)
    parts, sequences = {}, {}
    for p in pieces:
        assert p.doc_tokens == len(ids[p.doc_id])
        run = ids[p.doc_id][p.start : p.start + p.length]
        assert len(run) == p.length > 0 and zlib.crc32(np.array(run, dtype="<u4").tobytes()) == p.ids_crc32
        parts.setdefault(p.doc_id, []).append((p.start, p.length))
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for k, runs in [*parts.items(), *sequences.items()]:
        at = 0
        for start, length in sorted(runs):
            assert start == at
            at += length
    for k, runs in parts.items():
        assert sum(n for _, n in runs) == len(ids[k])
    sizes = [sum(n for _, n in sequences[s]) for s in range(len(sequences))]
    assert all(n == window for n in sizes[:-1]) and 0 < sizes[-1] <= window


def test_pack(spark, docs, empty):
    path = public_tokenizers.path("byte_bpe_50k.json")
    unique = spark.createDataFrame([r[:2] for r in documents()[:-3]], "doc_id long, text string").repartition(4)
    texts = {r[0]: r[1] for r in documents()[:-3]}
    check_pieces(packing.pack(unique, path, window=64).collect(), texts, path, 64)
    check_pieces(packing.pack(unique.coalesce(1), path).collect(), texts, path, 1024)
    whole = packing.pack(docs, path, window=64)  # repeated rows and a null id
    n = packing.pack(unique, path).selectExpr("sum(length)").first()[0]
    assert whole.selectExpr("sum(length)").first()[0] > n
    assert whole.where("doc_id IS NULL").count() >= 1
    assert packing.pack(empty, path).count() == 0


# --- quality -------------------------------------------------------------------------


def test_quality(spark, docs, empty):
    rng = random.Random(3)
    rows, labels = [], []
    for k in range(300):
        words = [f"w{rng.randrange(200)}" for _ in range(40)]
        rows.append((k, " ".join(words if k % 2 else [w + "!!" for w in words])))
        labels.append((k, k % 2))
    table = spark.createDataFrame(rows + [(900, None), (901, ""), (None, "a b")], "doc_id long, text string").withColumn("score", F.lit("x"))
    # held-out rows have wrong labels: nothing may be learned from them
    held = {k for k in range(300) if zlib.crc32(str(k).encode()) % 3 == 1}
    wrong = [(k, 1 - q if k in held else q) for k, q in labels] + [(None, 0), (7, None)]
    known = spark.createDataFrame(wrong, "doc_id long, quality int")
    model = quality.fit(table, known)
    got = {r.doc_id: r.score for r in quality.score(table, model).collect()}
    assert len(got) == 303 and all(0 <= s <= 1 for s in got.values())
    assert np.mean([(got[k] >= 0.5) == q for k, q in labels if k in held]) > 0.95
    folds = table.where("doc_id < 300").select("doc_id", quality.fold().alias("f")).collect()
    assert {r.doc_id for r in folds if r.f == 1} == held
    nothing = quality.fit(table, known.where("false"))
    assert {r.score for r in quality.score(table, nothing).collect()} == {0.5}
    assert quality.score(empty, model).count() == 0


# --- search --------------------------------------------------------------------------


def test_search(spark):
    rng = np.random.default_rng(6)
    vectors = [(k, (rng.integers(-9, 10, 8) / 64).tolist()) for k in range(300)]
    vectors += [(k, vectors[40][1]) for k in range(400, 460)]  # ties
    odd = [(500, None), (501, [None] * 8), (502, [float("nan")] * 8), (503, [float("inf")] + [0.0] * 7), (504, []), (None, [0.1] * 8)]
    short = [(520, [0.5, 0.25]), (540, [-0.3])]
    table = spark.createDataFrame(vectors + odd + short + vectors[:5], "vec_id long, embedding array<double>")
    table = table.withColumn("id", F.lit(3)).withColumn("score", F.lit(1)).repartition(5)
    known = {k: [int(np.floor(64 * x)) for x in v] + [0] * (8 - len(v)) for k, v in vectors + short}
    expected = []
    for q in known:
        if q % 20 == 0:
            found = sorted((-sum(a * b for a, b in zip(known[q], v)), k) for k, v in known.items() if k != q)[:20]
            expected += [(q, r + 1, k, -s) for r, (s, k) in enumerate(found)]
    for rows in (1 << 14, 64):
        got = bitsliced.search(table, F.col("vec_id") % 20 == 0, rows_per_block=rows)
        assert got.columns == ["query_id", "rank", "vec_id", "score"]
        assert sorted(map(tuple, got.collect())) == sorted(expected)
    assert bitsliced.search(table.where("vec_id = 20"), F.col("vec_id") % 20 == 0).count() == 0
    assert bitsliced.search(table.where("false"), F.col("vec_id") % 20 == 0).count() == 0


# --- archives ------------------------------------------------------------------------


def test_archives(spark, tmp_path):
    rows = [(k, f"http://h/{k}", f"<p>{k % 7}</p>" * (k % 5)) for k in range(60)]
    rows += [(70, None, None), (71, "http://a b\n", ""), (None, "u", "<p>1</p>"), (72, "u", "é" * 300_000), rows[3]]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("refers_to", F.lit("x")).withColumn("n", F.lit(1))
    got = warc.archive_round_trip(pages).collect()
    assert len(got) == len(rows)
    top = {}
    for k, _, html in rows:
        if k is not None:
            top[html or ""] = max(top.get(html or "", k), k)
    html = {k: h or "" for k, _, h in rows}
    for r in got:
        raw = html[r.page_id].encode()
        assert (r.payload_bytes, r.payload_digest) == (len(raw), warc.base32_sha1(raw))
        main = r.page_id is None or top[html[r.page_id]] == r.page_id
        assert (r.record_type, r.refers_to) == (("response", None) if main else ("revisit", top[html[r.page_id]]))
    few = warc.archive_round_trip(pages, min_bytes=20).where("record_type = 'revisit'").collect()
    assert few and all(r.payload_bytes >= 20 for r in few)
    assert warc.archive_round_trip(pages.where("false")).count() == 0
    # damage one archive: the other records come back and the gap is logged
    folder = str(tmp_path / "a")
    warc.write_archives(pages.where("page_id < 60").coalesce(1), folder)
    name = next(os.path.join(folder, n) for n in os.listdir(folder) if n.startswith("part-"))
    raw = bytearray(open(name, "rb").read())
    raw[len(raw) // 2] ^= 0x55
    os.remove(os.path.join(folder, "." + os.path.basename(name) + ".crc"))
    open(name, "wb").write(bytes(raw))
    read = warc.read_archives(spark, folder)
    assert read.where("kind = 'gap'").count() == 1 and read.where("kind = 'record'").count() == 60  # 61 rows
    assert read.where("warc_type = 'response' AND payload IS NULL").count() == 0


# --- chat ----------------------------------------------------------------------------


def test_chat_trees(spark):
    # tree a: two branches; b: a chain of 19; c: an orphan and a cycle
    rows = [("a", 1, None, "user", "hi", 0.0), ("a", 2, 1, "assistant", "bad", 0.1), ("a", 3, 1, "assistant", "good </turn>\n\\", 0.9)]
    rows += [("a", 4, 3, None, None, None), ("a", 5, 2, "user", "why", 0.2)]
    rows += [("b", k, k - 1 if k else None, "assistant" if k % 2 else "user", f"t{k} <turn:text>", 1.0) for k in range(19)]
    rows += [("c", 1, 99, "user", "orphan", 0.0), ("c", 2, 3, "user", "x", 0.0), ("c", 3, 2, "user", "y", 0.0)]
    table = spark.createDataFrame(rows, "tree string, node long, parent long, role string, text string, score double").repartition(3)
    got = chat.format_paths(table, branches=2).withColumn("turns", chat.read_turns(F.col("formatted")))
    got = {(r.tree, r.branch): r for r in got.withColumn("mask", chat.masked_text(F.col("formatted"), F.col("loss_spans"))).collect()}
    assert sorted(got) == [("a", 1), ("a", 2), ("b", 1), ("c", 1)]
    assert [tuple(t) for t in got["a", 1].turns] == [("user", "hi"), ("assistant", "good </turn>\n\\"), ("", "")]
    assert got["a", 1].mask == "good </turn>\n\\" and abs(got["a", 1].score - 0.9) < 1e-9 and got["a", 1].leaf == 4
    assert [t.text for t in got["a", 2].turns] == ["hi", "bad", "why"]
    assert [t.text for t in got["b", 1].turns] == [f"t{k} <turn:text>" for k in range(19)]
    assert got["b", 1].mask == "".join(f"t{k} <turn:text>" for k in range(1, 19, 2))
    assert chat.format_paths(table.where("false")).count() == 0


@pytest.mark.parametrize("text", ["", "\\", "<turn", "</turn>", "\\<turn>\\\\</turn>\n", "<turn:text>", "a\nb\\n<", "<\\turn", "é€😀\\"])
def test_escape_round_trip(spark, text):
    row = spark.createDataFrame([(text,)], "t string").select("t", chat.escape(F.col("t")).alias("e"))
    row = row.withColumn("u", chat.unescape(F.col("e"))).first()
    assert row.u == text and "<turn" not in row.e and "</turn" not in row.e


# --- shards --------------------------------------------------------------------------


def test_shard(spark, docs, empty):
    got = sharding.shard(docs, 5).collect()
    texts = {r[0]: r[1] or "" for r in documents()}
    assert len(got) == len(documents())
    slots = {}
    for r in got:
        raw = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32) == (len(raw) + 1, zlib.crc32(raw))
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots.get(k, ())) for k in range(5)]
    assert max(sizes) - min(sizes) <= 1
    assert sorted(map(str, got)) == sorted(map(str, sharding.shard(docs.repartition(7), 5).collect()))
    assert sharding.shard(empty, 5).count() == 0
