"""Fill-in-the-middle, substring dedup and the Merkle manifest against brute force, odd rows included."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quaero.llm import infill, merkle, substring_dedup, suffixes

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, kept int, row string, digest long"


def row(doc, text, source="s", lang="en"):
    return (doc, source, lang, None if text is None else len(text), text, 1, "x", 5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# --- suffixes ------------------------------------------------------------------------


def common(t, i, j, cap):
    k = 0
    while k < cap and max(i, j) + k < len(t) and t[i + k] == t[j + k]:
        k += 1
    return k


@pytest.mark.parametrize("block, limit, memory", [(3, 5, 0), (7, 50, 1000), (1 << 18, 1 << 20, 1 << 30)])
def test_suffix_order_and_common_prefixes(tmp_path, monkeypatch, block, limit, memory):
    """Tiny blocks, queues and memory send everything through the files."""
    monkeypatch.setattr(suffixes, "BLOCK", block)
    rng = random.Random(1)
    for case in range(60):
        sigma = rng.choice([2, 3, 5, 50])
        text = [rng.randrange(1, max(sigma, 2)) for _ in range(rng.randrange(2, 250))]
        if case % 2:
            cut = rng.randrange(len(text))
            text += text[cut : cut + 50] + [1] * rng.randrange(30) + text[:20]
        text.append(0)
        folder = tmp_path / str(case)
        folder.mkdir()
        scratch, order = suffixes.Scratch(str(folder), memory), sorted(range(len(text)), key=lambda i: text[i:])
        assert suffixes.sort_names(np.array(text), sigma, scratch, limit).tolist() == order
        best, want = Counter(), Counter()
        for one, other, prefix in suffixes.neighbours(np.array(text, dtype=np.uint16), sigma, 20, scratch, limit):
            for i, j, n in zip(one.tolist(), other.tolist(), prefix.tolist()):
                assert n == common(text, i, j, 20)
                best[i], best[j] = max(best[i], n), max(best[j], n)
        for i, j in zip(order[1:], order[2:]):
            n = common(text, i, j, 20)
            want[i], want[j] = max(want[i], n), max(want[j], n)
        assert +best == +want


# --- substrings ----------------------------------------------------------------------


def brute_spans(texts, width):
    seen = Counter(t[i : i + width] for t in texts for i in range(len(t) - width + 1))
    made = []
    for t in texts:
        spans = []
        for i in range(len(t) - width + 1):
            if seen[t[i : i + width]] > 1:
                if spans and i <= spans[-1][1]:
                    spans[-1][1] = i + width
                else:
                    spans.append([i, i + width])
        made.append([tuple(s) for s in spans])
    return made


@pytest.mark.parametrize("hot, listed", [(substring_dedup.HOT, 10**6), (4, 10**6), (4, 1)])
def test_remove_repeats(spark, empty, monkeypatch, hot, listed):
    """With ``hot`` of 4 the rims of the shared passage are compared by digests of windows, listed or joined."""
    monkeypatch.setattr(substring_dedup, "HOT", hot)
    monkeypatch.setattr(substring_dedup, "BROADCAST_VALUES", listed)
    rng = random.Random(3)
    prose = lambda n: " ".join(f"w{rng.randrange(300)}" for _ in range(n))
    passage = prose(80)
    texts = [prose(rng.randrange(5, 200)) for _ in range(40)]
    texts += [texts[0]] * 3 + [texts[1][:400] + prose(50), passage + prose(3), prose(4) + passage]
    texts += ["a" * 350, "b" + "a" * 200, "a" * 200 + "b", "ab" * 300, None, "", "é" * 500, "x " * 20_000, "short", "short"]
    texts += [prose(8) + passage[:260] + prose(8) for _ in range(60)]
    rows = [row(None if k == 5 else k // 2 if k < 8 else k, t) for k, t in enumerate(texts)]
    expected = brute_spans([(t or "").encode() for t in texts], 200)
    done = substring_dedup.remove_repeats(spark.createDataFrame(rows, SCHEMA))
    assert done.columns == ["doc_id", "source", "lang", "n_chars", "text", "row", "digest", "n_bytes", "removed_spans", "kept"]
    got = Counter((r.doc_id, r.text, r.n_bytes, tuple((s[0], s[1]) for s in r.removed_spans), bytes(r.kept)) for r in done.collect())
    want = Counter()
    for r, spans in zip(rows, expected):
        data, at = (r[4] or "").encode(), [0, *(b for _, b in spans)]
        kept = b"".join(data[a:b] for a, b in zip(at, [*(a for a, _ in spans), len(data)]))
        want[(r[0], r[4], len(data), tuple(spans), kept)] += 1
    assert got == want and sum(bool(s) for s in expected) > 60
    assert substring_dedup.remove_repeats(empty).count() == 0


def test_windows_of_long_texts_are_taken_in_pieces(monkeypatch):
    monkeypatch.setattr(substring_dedup, "SLICE_BYTES", 1000)
    data = np.frombuffer(bytes(random.Random(2).randrange(97, 123) for _ in range(5000)), dtype=np.uint8)
    parts = list(substring_dedup.text_runs(data, np.array([0, 5000]), 200))
    covered = sorted(s + k for _, start, count, _, _ in parts for s, c in zip(start, count) for k in range(c))
    assert covered == list(range(5000 - 199))


# --- fill in the middle --------------------------------------------------------------


def plain_output(doc, text):
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(lines)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")):
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = ("".join(x) for x in (lines[:a], lines[a:b], lines[b:]))
    if h[3] % 100 < 50:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_fill_in_middle(spark, empty, monkeypatch):
    rng = random.Random(5)
    texts = ["\n".join("é<P" * rng.randrange(4) + ">x" * rng.randrange(5) for _ in range(rng.randrange(1, 12))) for _ in range(60)]
    texts = [t for t in texts if "<P>" not in t] + [None, "", "\n", "\n\n\n", "has <M> inside", "<", "<S", "a<\n", "no newline\r\x0b"]
    texts += ["long line " * 30_000 + "\nend", "".join(f"line {k}\n" for k in range(40_000)), texts[0], texts[0]]
    rows = [row(None if k == 3 else k, t) for k, t in enumerate(texts)]
    rows += [rows[1]]
    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = Counter(map(tuple, infill.fill_in_middle(table).collect()))
    want, outputs = Counter(), {}
    for r in rows:
        *fields, output = plain_output(r[0], r[4] or "")
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (output, r[4] or "")]
        want[(r[0], *fields, *sha)] += 1
        outputs[r[0]] = output
    assert got == want
    assert {x[2] for x in want} == {"plain", "psm", "spm"}
    assert infill.fill_in_middle(empty).count() == 0
    pieces = {}
    for p in infill.outputs(table).orderBy("row", "seq").collect():
        pieces.setdefault((p.row, p.id), []).append(infill.piece_text(p.piece))
    assert all(b"".join(x).decode() == outputs[name] for (_, name), x in pieces.items())
    assert max(len(x) for x in pieces.values()) > 4  # long texts travel in several pieces


# --- manifest ------------------------------------------------------------------------


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(r, text):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r[0], r[1], r[2], r[3], text)))


def brute_tree(leaves):
    """(root, path of each leaf as (left, right) strings)."""
    paths, level, spans = [[] for _ in leaves], list(leaves), [[k] for k in range(len(leaves))]
    while len(level) > 1:
        new, new_spans = [], []
        for k in range(0, len(level), 3):
            run = level[k : k + 3]
            for j in range(len(run)):
                for leaf in spans[k + j]:
                    paths[leaf].append(("".join(run[:j]), "".join(run[j + 1 :])))
            new.append(sha("".join(run)))
            new_spans.append(sum(spans[k : k + 3], []))
        level, spans = new, new_spans
    return level[0], paths


@pytest.mark.parametrize("levels", [1, 2, merkle.LEVELS])
def test_manifest(spark, empty, levels):
    rng = random.Random(9)
    rows = []
    for source, n in (("hot", 41), (None, 4), ("", 1), ("é", 9), ("z", 3), ("-", 10)):
        rows += [row(rng.randrange(10**6) - 500, rng.choice(["a\nb", "plain", "é\n\n", "", None]), source) for _ in range(n)]
    rows += [rows[0], rows[0], rows[1], row(None, "x\ny", "hot"), row(None, None, None, None)]
    table = spark.createDataFrame(rows, SCHEMA).repartition(4)
    changed = {"text": F.replace("text", F.lit("\n"), F.lit(""))}
    chosen = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    done = merkle.manifest(table, changed, chosen, levels=levels)
    assert "BroadcastNestedLoopJoin" not in done._jdf.queryExecution().executedPlan().toString()
    got = Counter(map(tuple, done.select("doc_id", "leaf", "subroot", "root", "proof", "folded_root", "verified").collect()))
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    made = []
    for name in names:
        mine = sorted(groups[name], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r, r[4])))
        made.append((mine, *brute_tree([leaf_of(r, r[4]) for r in mine])))
    root, tops = brute_tree([subroot for _, subroot, _ in made])
    want = Counter()
    for (mine, subroot, paths), top in zip(made, tops):
        for r, path in zip(mine, paths):
            path, tampered = path + top, r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
            folded = leaf_of(r, r[4].replace("\n", "") if tampered and r[4] is not None else r[4])
            for left, right in path:
                folded = sha(left + folded + right)
            want[(r[0], leaf_of(r, r[4]), subroot, root, "".join(a + b for a, b in path), folded, folded == root)] += 1
    assert got == want and {x[-1] for x in want} == {True, False}
    assert merkle.manifest(empty, levels=levels).count() == 0


def test_manifest_of_one_row(spark):
    done = merkle.manifest(spark.createDataFrame([row(1, "x")], SCHEMA)).first()
    assert done.leaf == done.subroot == done.root == done.folded_root and done.proof == "" and done.verified
