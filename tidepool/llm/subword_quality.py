"""Operator 4: quality classifier with supervised subword embeddings.

A document is the average of the vectors of its hashed features - words,
pairs of neighbouring words (a word that follows itself is one fixed
feature, whatever the word), and character n-grams over the UTF-8 bytes of
the text as written - followed by a softmax over the two classes. Vectors
and output weights are learned together by stochastic gradient descent in
numpy on the driver, from a bounded sample (``PER_CLASS`` documents a class).

The softmax of two classes depends on the difference of the two outputs
only, which is the mean over the features of one number each, so scoring
broadcasts one float a bucket (1 MB, whatever the corpus) and reads every
whole text once, without any shuffle.

Defined cases: a null or empty text has no features and gets the score of
the bias alone; without any labelled row all scores are 0.5; with one class
only, training sees just that class. Labels, language, source and id are
never read when scoring. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm import textkernel as tk
from tidepool.llm.labelled import PER_CLASS, fetch, labelled_sample
from tidepool.llm.shared import with_scores

BITS, DIM, EPOCHS, RATE, SEED = 18, 16, 6, 0.3, 3
CHAR_NGRAMS = (2, 3, 4)
_U = np.uint64
_U32 = np.uint32


def _char_buckets(data: np.ndarray, n: int, bits: int) -> np.ndarray:
    """Bucket of the n bytes from each position on."""
    code = data[:len(data) - n + 1].astype(np.uint32)
    for j in range(1, n):
        code = (code << _U32(8)) | data[j:len(data) - n + 1 + j]
    code *= _U32(0x9E3779B1)
    code ^= code >> _U32(15)
    code *= _U32((0x85EBCA6B + 2 * n * 0x1000193) & 0xFFFFFFFF | 1)
    return code >> _U32(32 - bits)


def _word_buckets(w: np.ndarray, off: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of words and word pairs, with the row of each."""
    rows = tk.row_ids(off)
    shift = _U(64 - bits)
    one = tk.mix(w) >> shift
    if len(w) < 2:
        return one.astype(np.int64), rows
    same = w[1:] == w[:-1]
    two = np.where(same, _U(0x5A5A5A5A5A5A5A5A), w[:-1] * _U(3) + w[1:] * _U(0x9E3779B97F4A7C15))
    inside = rows[1:] == rows[:-1]
    two = (tk.mix(two) >> shift)[inside]
    return np.concatenate([one, two]).astype(np.int64), np.concatenate([rows, rows[1:][inside]])


def _features(col, bits: int):
    """(first row, rows, buckets, row of each bucket) of slices of the texts."""
    raw = tk.as_text(col)
    for lo, hi, w, off in tk.word_slices(raw):
        parts, at = [], []
        b, r = _word_buckets(w, off, bits)
        parts.append(b)
        at.append(r)
        data, doff = tk.buffers(raw.slice(lo, hi - lo))
        rows = tk.row_ids(doff)
        for n in CHAR_NGRAMS:
            if len(data) >= n:
                inside = rows[:len(data) - n + 1] == rows[n - 1:]
                parts.append(_char_buckets(data, n, bits)[inside].astype(np.int64))
                at.append(rows[:len(data) - n + 1][inside])
        yield lo, hi - lo, np.concatenate(parts), np.concatenate(at)


def hashed_counts(docs: DataFrame, bits: int = BITS) -> DataFrame:
    """(doc_id, label, buckets, counts) with int32 arrays as binary."""
    def run(batches):
        for batch in batches:
            ids, labels = batch.column("doc_id"), batch.column("label")
            for lo, n, b, r in _features(batch.column("text"), bits):
                key, count = np.unique((r << bits) + b, return_counts=True)
                cut = np.searchsorted(key >> bits, np.arange(n + 1))
                key, count = (key & ((1 << bits) - 1)).astype(np.int32), count.astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, n), labels.slice(lo, n),
                     pa.array([key[a:z].tobytes() for a, z in zip(cut, cut[1:], strict=False)], pa.binary()),
                     pa.array([count[a:z].tobytes() for a, z in zip(cut, cut[1:], strict=False)], pa.binary())],
                    names=["doc_id", "label", "buckets", "counts"])
    return (docs.select("doc_id", "label", "text")
            .mapInArrow(run, "doc_id long, label int, buckets binary, counts binary"))


def train(rows: list[tuple[int, np.ndarray, np.ndarray]], bits: int = BITS, dim: int = DIM, epochs: int = EPOCHS,
          rate: float = RATE, seed: int = SEED) -> tuple[np.ndarray, float]:
    """(score of each bucket, bias) from (label, buckets, counts) rows.

    Steps on the vectors are divided by the squared length of the averaging
    weights, so that a document moves its own average equally far whether it
    has ten features or ten thousand."""
    rng = np.random.Generator(np.random.PCG64(seed))
    vectors = rng.random((1 << bits, dim), np.float32)
    vectors -= 0.5
    vectors *= 2 / dim
    out = np.zeros((2, dim), np.float32)
    bias = np.zeros(2, np.float32)
    rows = [r for r in rows if len(r[1])]
    if rows:
        share = np.array([1 + sum(y == k for y, _, _ in rows) for k in (0, 1)], float)
        bias[:] = np.log(share / share.sum())
        out[:] = rng.normal(0, 0.1, out.shape)
    total, done = max(1, epochs * len(rows)), 0
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            y, b, c = rows[i]
            w = c.astype(np.float32) / np.float32(c.sum())
            step = rate * (1 - done / total)
            done += 1
            h = w @ vectors[b]
            z = out @ h + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            back = p @ out
            out -= step * np.outer(p, h)
            bias -= 0.1 * step * p
            vectors[b] -= (step / float(w @ w)) * w[:, None] * back
    return (vectors @ (out[1] - out[0])).astype(np.float32), float(bias[1] - bias[0])


def fit_quality(docs: DataFrame, labels: DataFrame, label_col: str = "quality", usable=None, id_col: str = "doc_id",
                text_col: str = "text", per_class: int = PER_CLASS) -> tuple[np.ndarray, float]:
    """Model from at most ``per_class`` labelled documents of each class."""
    return train(training_rows(docs, labels, label_col, usable, id_col, text_col, per_class))


def training_rows(docs: DataFrame, labels: DataFrame, label_col: str = "quality", usable=None, id_col: str = "doc_id",
                  text_col: str = "text", per_class: int = PER_CLASS) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(label, buckets, counts) of the sample ``fit_quality`` trains on."""
    usable = usable or (lambda key: F.lit(True))
    sample = hashed_counts(labelled_sample(docs, labels, label_col, usable, id_col, text_col, per_class))
    return fetch(sample, {"buckets": np.int32, "counts": np.int32})


def score_quality(docs: DataFrame, model: tuple[np.ndarray, float], text_col: str = "text", score_col: str = "score",
                  bits: int = BITS) -> DataFrame:
    """``docs`` with the probability of class 1 of every row as ``score_col``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # 2^bits floats

    def score(col):
        table, bias = sent.value
        for lo, n, total, count in _sums(tk.as_text(col), table, bits):
            z = np.divide(total, count, out=np.zeros(n), where=count > 0) + bias
            yield lo, n, 1 / (1 + np.exp(-np.clip(z, -700, 700)))

    return with_scores(docs, text_col, score_col, score)


def _sums(raw: pa.Array, table: np.ndarray, bits: int):
    """Sum of the bucket scores and number of features by row."""
    for lo, hi, w, off in tk.word_slices(raw):
        n = hi - lo
        b, r = _word_buckets(w, off, bits)
        total, count = np.bincount(r, table[b], n), np.bincount(r, minlength=n).astype(np.float64)
        data, doff = tk.buffers(raw.slice(lo, n))
        size = np.diff(doff)
        for k in CHAR_NGRAMS:
            has = np.flatnonzero(size >= k)
            if not len(has):
                continue
            score = np.concatenate([[0.0], np.cumsum(table[_char_buckets(data, k, bits)], dtype=np.float64)])
            total[has] += score[doff[has + 1] - k + 1] - score[doff[has]]
            count[has] += size[has] - k + 1
        yield lo, n, total, count
