"""Operator 8: toxicity by FTRL-proximal logistic regression.

Features are hashed words, neighbouring word pairs and skip-grams (a word
and the next but one), each counted once a document. Weights are learned by
FTRL-proximal with a learning rate for each coordinate and L1, which leaves
a few hundred or thousand non-zero weights: they travel as two sorted arrays.
Training runs in numpy on the driver over a bounded sample (``PER_CLASS``
documents a class); scoring reads every whole text once without a shuffle.

The hash space has 2^40 buckets, so that a very long text does not hit the
few weighted buckets by chance. Features seen in fewer than ``MIN_DOCS``
sample documents have no weight (they could only memorise). Toxic documents
are the rarer class: their gradients count ``POSITIVE`` times (this and L1
were chosen by two-fold validation inside the training part).

Defined cases: null and empty texts have no features and get the score of
the bias; without labelled rows all scores are 0.5. Extra columns are ignored;
labels, language, source and id are never read when scoring.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm import textkernel as tk
from tidepool.llm.labelled import PER_CLASS, fetch, labelled_sample
from tidepool.llm.shared import with_scores

BITS, MIN_DOCS, EPOCHS = 40, 3, 10
ALPHA, BETA, L1, L2, POSITIVE = 3.0, 1.0, 9.0, 0.0, 2.0
_U = np.uint64


def _grams(w: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature hashes and the row of each: words, pairs, skip-grams."""
    rows = tk.row_ids(off)
    out, at = [w], [rows]
    for gap, salt in ((1, 0x632BE59BD9B4E019), (2, 0x9E3779B97F4A7C15)):
        if len(w) > gap:
            inside = rows[gap:] == rows[:-gap]
            out.append((w[:-gap] * _U(salt) + (w[gap:] ^ _U(salt >> 1)) * _U(0xD6E8FEB86659FD93))[inside])
            at.append(rows[gap:][inside])
    return tk.mix(np.concatenate(out)) >> _U(64 - BITS), np.concatenate(at)


def hashed_features(docs: DataFrame) -> DataFrame:
    """(doc_id, label, features): sorted distinct features as binary uint64."""
    def run(batches):
        for batch in batches:
            ids, labels = batch.column("doc_id"), batch.column("label")
            for lo, hi, w, off in tk.word_slices(batch.column("text")):
                n = hi - lo
                f, r = _grams(w, off)
                order = np.argsort(r, kind="stable")
                f, cut = f[order], np.searchsorted(r[order], np.arange(n + 1))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, n), labels.slice(lo, n),
                     pa.array([np.unique(f[a:b]).tobytes() for a, b in zip(cut, cut[1:], strict=False)], pa.binary())],
                    names=["doc_id", "label", "features"])
    return docs.select("doc_id", "label", "text").mapInArrow(run, "doc_id long, label int, features binary")


def train_ftrl(rows: list[tuple[int, np.ndarray]], epochs: int = EPOCHS, alpha: float = ALPHA, beta: float = BETA,
               l1: float = L1, l2: float = L2, positive: float = POSITIVE, min_docs: int = MIN_DOCS,
               seed: int = 4) -> tuple[np.ndarray, np.ndarray, float]:
    """(sorted features, their weights, bias) from (label, features) rows."""
    if not rows:
        return np.zeros(0, np.uint64), np.zeros(0, np.float32), 0.0
    every = np.concatenate([f for _, f in rows])
    every.sort()
    first = np.flatnonzero(np.append(True, every[1:] != every[:-1])) if len(every) else np.zeros(0, np.int64)
    names = every[first[np.diff(np.append(first, len(every))) >= min_docs]]
    del every, first
    index, cut = np.empty(sum(len(f) for _, f in rows), np.int32), [0]
    for _, f in rows:
        at = np.minimum(np.searchsorted(names, f), max(len(names) - 1, 0))
        at = at[names[at] == f] if len(names) else at[:0]
        index[cut[-1]:cut[-1] + len(at)] = at
        cut.append(cut[-1] + len(at))
    label = [y for y, _ in rows]
    n_f = len(names) + 1  # the last coordinate is the bias, without L1
    z, n = np.zeros(n_f), np.zeros(n_f)
    pull = np.full(n_f, l1)
    pull[-1] = 0

    def weights(i):
        zi = z[i]
        return np.where(np.abs(zi) <= pull[i], 0.0,
                        -(zi - np.sign(zi) * pull[i]) / ((beta + np.sqrt(n[i])) / alpha + l2))

    rng = np.random.Generator(np.random.PCG64(seed))
    for _ in range(epochs):
        for k in rng.permutation(len(label)):
            i = np.append(index[cut[k]:cut[k + 1]], n_f - 1)
            w = weights(i)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label[k]
            g *= positive if label[k] else 1.0
            sigma = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / alpha
            z[i] += g - sigma * w
            n[i] += g * g
    w = weights(np.arange(n_f))
    used = np.flatnonzero(w[:-1])
    return names[used], w[used].astype(np.float32), float(w[-1])


def fit_toxicity(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", usable=None, id_col: str = "doc_id",
                 text_col: str = "text", per_class: int = PER_CLASS):
    """Model from at most ``per_class`` labelled documents of each class."""
    usable = usable or (lambda key: F.lit(True))
    sample = hashed_features(labelled_sample(docs, labels, label_col, usable, id_col, text_col, per_class))
    return train_ftrl(fetch(sample, {"features": np.uint64}))


def score_toxicity(docs: DataFrame, model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with the probability of class 1 of every row as ``score_col``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # the non-zero weights, bounded by the sample

    def score(col):
        names, weight, bias = sent.value
        door = np.zeros(1 << 16, bool)
        door[(names & _U(0xFFFF)).astype(np.int64)] = True
        for lo, hi, w, off in tk.word_slices(col):
            z = np.full(hi - lo, bias)
            if len(names):
                f, r = _grams(w, off)
                maybe = door[(f & _U(0xFFFF)).astype(np.int64)]
                f, r = f[maybe], r[maybe]
                at = np.minimum(np.searchsorted(names, f), len(names) - 1)
                hit = names[at] == f
                pair = np.unique(r[hit] * len(names) + at[hit])  # once a document
                z += np.bincount(pair // len(names), weight[pair % len(names)], hi - lo)
            yield lo, hi - lo, 1 / (1 + np.exp(-np.clip(z, -700, 700)))

    return with_scores(docs, text_col, score_col, score)
