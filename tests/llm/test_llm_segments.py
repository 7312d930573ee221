"""Which segments of one least gram hash go into the suffix sort."""

import random

import numpy as np
import pyarrow as pa
import pytest

from quaero.llm import substring_dedup


def segments_of(texts, width):
    """(value, content) of all segments."""
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    offsets = np.cumsum([0, *(len(x) for x in texts)])
    made = []
    start, count, value, _ = substring_dedup.window_runs(data, offsets, width)
    for s, c, v in zip(start.tolist(), count.tolist(), value.tolist()):
        made.append((v, data[s : s + c + width - 1].tobytes()))
    return sorted(made)


@pytest.mark.parametrize("width", [200, 45, 33, 12])
def test_no_segment_with_a_repeated_window_is_left_out(width):
    rng = random.Random(width)
    texts = []
    for turn in range(60):
        letters = rng.choice([b"ab", b"abcdefghijklmnop "])
        passage = bytes(rng.choices(letters, k=2 * width))
        for _ in range(3):
            a = rng.randrange(2 * width)
            part = passage[a : a + rng.randrange(width // 2, 2 * width)]
            texts.append(bytes(rng.choices(letters, k=rng.randrange(width))) + part + bytes(rng.choices(letters, k=rng.randrange(width))))
    texts += [b"x" * 20 * width, b"x" * width, b"abc" * width]
    made = segments_of(texts, width)
    values, contents = zip(*made)
    keep = substring_dedup.may_repeat(list(values), [pa.py_buffer(x) for x in contents], width)
    seen = {}
    for k, x in enumerate(contents):
        for at in range(len(x) - width + 1):
            seen.setdefault((values[k], x[at : at + width]), []).append(k)
    repeat = {k for found in seen.values() if len(found) > 1 for k in found}
    assert repeat and set(np.flatnonzero(keep).tolist()) >= repeat


def test_segments_that_share_only_a_gram_are_not_sorted():
    rng = random.Random(1)
    gram = b"this sentence stands in all texts"
    value = int(substring_dedup.rolling(np.frombuffer(gram[:32], dtype=np.uint8), 32).view(np.int64)[0])
    noise = lambda n: bytes(rng.choices(b"abcdefghijklmnopqrstuvwxyz ", k=n))
    contents = [noise(120) + gram + noise(120) for _ in range(50)]
    contents += [contents[0][40:250]]  # 210 bytes in common with the first
    keep = substring_dedup.may_repeat([value] * 51, [pa.py_buffer(x) for x in contents], 200)
    assert np.flatnonzero(keep).tolist() == [0, 50]
