"""Quality classifier: supervised subword embeddings.

A document is the mean of learned vectors of its hashed features: words, pairs of
neighbouring words, and runs of ``GRAMS`` bytes of the text (case and marks kept).
A pair of equal words is one feature of its own, so that repetition can be
learned. A softmax over the two classes sits on the mean. Vectors and softmax are
trained together by stochastic gradient descent in numpy, on a bounded sample of
labelled documents; the score of every document is then a mean of one number per
feature, taken over its whole text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaero.llm.kernels import mix, segment_hashes, slices, text_bytes

BUCKET_BITS = 16
GRAMS = (3, 4)
DIMS = 8
EPOCHS = 4
RATE = 10.0
#: Most labelled documents the model learns from, the first by a hash of the id.
SAMPLE_DOCS = 4000


def _buckets(h: np.ndarray) -> np.ndarray:
    return (mix(h) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, row) of every feature occurrence of a slice of texts."""
    n = len(offsets) - 1
    rows = np.repeat(np.arange(n), np.diff(offsets))
    found, owner = [], []
    wide = data.astype(np.uint64)
    for size in GRAMS:
        if len(data) >= size:
            h = np.full(len(data) - size + 1, size, dtype=np.uint64)
            for k in range(size):
                h = (h << np.uint64(8)) | wide[k : len(data) - size + 1 + k]
            inside = rows[: len(h)] == rows[size - 1 :]
            found.append(_buckets(h[inside])), owner.append(rows[: len(h)][inside])
    words, row = _cased_words(data, offsets)
    found.append(_buckets(words)), owner.append(row)
    if len(words) > 1:
        pair = words[:-1] * np.uint64(0xD6E8FEB86659FD93) + words[1:]
        pair = np.where(words[:-1] == words[1:], np.uint64(1), pair)
        inside = row[:-1] == row[1:]
        found.append(_buckets(pair[inside] ^ np.uint64(0xA5A5A5A5A5A5A5A5))), owner.append(row[:-1][inside])
    return np.concatenate(found), np.concatenate(owner)


def _cased_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keep = (data != 32) & ((data < 9) | (data > 13))
    start = keep.copy()
    start[1:] &= ~keep[:-1]
    heads = offsets[:-1][offsets[:-1] < len(data)]
    start[heads] = keep[heads]
    if not start.any():
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    row = np.searchsorted(offsets, np.flatnonzero(start), side="right") - 1
    return segment_hashes(data[keep], start[keep])[2], row


class Model:
    """``weight`` of each bucket and ``bias``; score = logistic(mean weight + bias)."""

    def __init__(self, weight: np.ndarray, bias: float) -> None:
        self.weight, self.bias = weight.astype(np.float64), float(bias)

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        n = len(offsets) - 1
        bucket, row = features(data, offsets)
        total = np.bincount(row, minlength=n)
        sums = np.bincount(row, weights=self.weight[bucket], minlength=n)
        return 1.0 / (1.0 + np.exp(-np.clip(sums / np.maximum(total, 1) + self.bias, -30, 30)))


def train(docs: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, seed: int = 7) -> Model:
    """Learns from (buckets, shares) of documents; without two classes the score is the prior."""
    rng = np.random.default_rng(seed)
    share = float(labels.mean()) if len(labels) else 0.5
    if share in (0.0, 1.0) or not len(labels):
        return Model(np.zeros(1 << BUCKET_BITS), np.log((share * len(labels) + 1) / ((1 - share) * len(labels) + 1)))
    vectors = rng.uniform(-1 / DIMS, 1 / DIMS, (1 << BUCKET_BITS, DIMS)).astype(np.float32)
    out, bias = np.zeros((DIMS, 2), dtype=np.float32), np.log(np.array([1 - share, share], dtype=np.float32))
    steps, done = EPOCHS * len(docs), 0
    for _ in range(EPOCHS):
        for k in rng.permutation(len(docs)).tolist():
            rate, done = RATE * (1 - done / steps), done + 1
            bucket, part = docs[k]
            mean = part @ vectors[bucket]
            z = mean @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[labels[k]] -= 1
            pull = out @ p
            out -= rate * 0.1 * np.outer(mean, p)
            bias -= rate * 0.01 * p
            vectors[bucket] -= (rate * part)[:, None] * pull[None, :]
    return Model(vectors @ (out[:, 1] - out[:, 0]), bias[1] - bias[0])


def compact(data: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each text its distinct buckets and their shares of all its features."""
    bucket, row = features(data, offsets)
    key, counts = np.unique((row << BUCKET_BITS) | bucket, return_counts=True)
    ends = np.searchsorted(key, np.arange(len(offsets)) << BUCKET_BITS)
    mask = (1 << BUCKET_BITS) - 1
    made = []
    for a, b in zip(ends[:-1], ends[1:]):
        made.append(((key[a:b] & mask).astype(np.int64), (counts[a:b] / max(counts[a:b].sum(), 1)).astype(np.float32)))
    return made


def fold(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 3; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 3


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    sample_docs: int = SAMPLE_DOCS,
) -> Model:
    """A model learned from at most ``sample_docs`` documents with a 0/1 label, outside fold 1.

    The sample does not depend on the size or order of the tables beyond the ids in
    it: the smallest hashes of ids come first. Of several labels of an id the larger
    counts, of several texts the first in order; null labels and ids do not.
    """
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & (fold(id_col) != 1))
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("label"))
    chosen = known.orderBy(F.xxhash64("id"), "id").limit(sample_docs)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            made = []
            for a, b in slices(offsets):
                made += compact(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").cast(pa.int64()), batch.column("label"),
                    pa.array([x.astype("<u2" if BUCKET_BITS <= 16 else "<u4").tobytes() for x, _ in made], type=pa.binary()),
                    pa.array([y.tobytes() for _, y in made], type=pa.binary()),
                ],
                names=["id", "label", "buckets", "shares"],
            )

    # one text of each id, so that repeated rows do not reach the driver
    sampled = rows.join(F.broadcast(chosen), "id").groupBy("id").agg(
        F.max("label").alias("label"), F.min("text").alias("text")
    )
    found = sampled.mapInArrow(run, "id long, label int, buckets binary, shares binary").collect()
    found.sort(key=lambda r: (r.id, r.label, r.buckets))
    kind = "<u2" if BUCKET_BITS <= 16 else "<u4"
    examples = [(np.frombuffer(r.buckets, dtype=kind).astype(np.int64), np.frombuffer(r.shares, dtype=np.float32)) for r in found]
    return train(examples, np.array([r.label for r in found], dtype=np.int64))


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with a column ``score``, from the text alone; row-wise, no shuffle.

    A null or empty text gets the score of no features, the learned bias. Repeated
    rows and null ids pass through; an empty table stays empty. A column that
    already bears the new name is replaced.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)  # one number per bucket, a fixed size
    kept = [f for f in docs.schema.fields if f.name != "score"]
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("__text"))
            parts = [
                held.value.scores(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]) for a, b in slices(offsets)
            ]
            scores = np.concatenate(parts) if parts else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.select(names).columns, pa.array(scores)], names=[*names, "score"])

    fields = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "score double"])
    return docs.select(*names, F.col(text_col).cast("string").alias("__text")).mapInArrow(run, fields)
