"""Operator 6: near-duplicate join on word shingles with Bayesian pruning.

Texts are compared as sets of five-word shingles by Jaccard similarity.

1. One pass over the texts gives each document 128 MinHash values and an
   order-free key of its shingle set. Documents with equal sets form one
   class (partial aggregation, so a hot group of copies is combined before
   the shuffle); only the class with its number of copies goes on.
2. 32 bands of 4 values propose candidates: a pair with similarity 0.8
   shares no band with probability 5e-8. Buckets with equal membership are
   looked at once. Large buckets are cut into pairs of blocks.
3. Inside a bucket the MinHash values of a pair are compared step by step.
   With a uniform prior, the similarity after m matches in n is
   Beta(m + 1, n - m + 1); a pair goes as soon as the posterior probability
   of reaching the threshold is below the tolerance (BayesLSH). The pairs
   left give a spanning forest, never a list of pairs.
4. Within each component of that forest the sets of shingles are built again
   from the texts (of these documents only), pairs are pruned the same way
   and the rest are verified exactly. Links are counted, not listed: the
   output grows with the documents, also for a group of thousands of
   mutually similar texts.

Defined cases: null or wordless texts have no shingles and link with
nothing; a text of one to four words has one shingle of all its words;
repeated rows of one doc_id are the same document (its texts share one
node); a null doc_id links with nothing and has null class and component.
An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm import textkernel as tk
from tidepool.llm.graph import components, sized_components
from tidepool.llm.grouped import by_group, forest
from tidepool.llm.shared import block_pairs, pick, semi_join, written

HASHES, BAND_ROWS, STEP = 128, 4, 32
FIRST_LOOK = 64  # MinHash values that travel with a bucket member
BLOCK = 512


def least_matches(n: int, threshold: float, tolerance: float) -> int:
    """Fewest equal values among n with which a pair is still kept: the
    posterior P(J >= t) after m matches is P(Bin(n + 1, t) <= m)."""
    below = 0.0
    for m in range(n + 1):
        below += comb(n + 1, m) * threshold**m * (1 - threshold)**(n + 1 - m)
        if below >= tolerance:
            return m
    return n


def steps(n: int, threshold: float, tolerance: float) -> list[tuple[int, int, int]]:
    return [(a, min(a + STEP, n), least_matches(min(a + STEP, n), threshold, tolerance))
            for a in range(0, n, STEP)]


def signatures(docs: DataFrame, shingle: int = 5, seed: int = 1) -> DataFrame:
    """(doc_id, k1, k2, sig) of every row; keys and signature are null where
    the text has no word."""
    def run(batches):
        for batch in batches:
            ids = batch.column("doc_id")
            for lo, hi, w, off in tk.word_slices(batch.column("text")):
                h, off = tk.unique_rows(*tk.shingles(w, off, shingle))
                k1, k2 = tk.set_keys(h, off)
                sig = tk.minhash(h, off, HASHES, seed)
                none = np.diff(off) == 0
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, hi - lo), pa.array(k1, mask=none), pa.array(k2, mask=none),
                     pa.array([None if x else s.tobytes() for s, x in zip(sig, none, strict=True)], pa.binary())],
                    names=["doc_id", "k1", "k2", "sig"])
    return docs.mapInArrow(run, "doc_id long, k1 long, k2 long, sig binary")


def _bands(reps: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            sig = _matrix(batch.column("sig"))
            keys = tk.band_keys(sig, BAND_ROWS)
            ids = np.repeat(np.asarray(batch.column("class_id")), keys.shape[1])
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(ids)], names=["key", "class_id"])
    return reps.select("class_id", "sig").mapInArrow(run, "key long, class_id long")


def _matrix(col, dtype=np.uint32) -> np.ndarray:
    raw = [x.as_buffer() for x in col]
    return np.stack([np.frombuffer(b, dtype) for b in raw]) if raw else np.zeros((0, HASHES), dtype)


def _candidate_edges(buckets: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    plan = steps(FIRST_LOOK, threshold, tolerance)

    def one(group: pa.Table):
        sig = _matrix(group.column("sig"))
        ids = np.asarray(group.column("class_id"))

        def linked(i, others):
            alive, got = np.arange(len(others)), np.zeros(len(others), np.int64)
            for a, b, least in plan:
                got[alive] += (sig[others[alive], a:b] == sig[i, a:b]).sum(1)
                alive = alive[got[alive] >= least]
            hit = np.zeros(len(others), bool)
            hit[alive] = True
            return hit

        e = forest(len(ids), linked)
        if e:
            e = np.array(e)
            yield pa.RecordBatch.from_arrays([pa.array(ids[e[:, 0]]), pa.array(ids[e[:, 1]])], names=["u", "v"])

    return by_group(buckets, ["key", "_bi", "_bj"], one, "u long, v long")


def _sets(docs: DataFrame, shingle: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for lo, hi, w, off in tk.word_slices(batch.column("text")):
                h, off = tk.unique_rows(*tk.shingles(w, off, shingle))
                rest = [batch.column(c).slice(lo, hi - lo) for c in ("class_id", "root", "size", "copies")]
                yield pa.RecordBatch.from_arrays(
                    [*rest, pa.array([h[a:b].tobytes() for a, b in zip(off, off[1:], strict=False)], pa.binary())],
                    names=["class_id", "root", "size", "copies", "shingles"])
    return (docs.select("class_id", "root", "size", "copies", "text")
            .mapInArrow(run, "class_id long, root long, size long, copies long, shingles binary"))


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, from slabs of the incidence matrix of the
    shingles that more than one set has (exact: counts are below 2^24)."""
    n = len(sets)
    rows = np.repeat(np.arange(n), [len(s) for s in sets])
    vals, col, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    keep = count[col] > 1
    rows, col = rows[keep], np.unique(col[keep], return_inverse=True)[1]
    out, width = np.zeros((n, n)), 4096
    order = np.argsort(col, kind="stable")
    rows, col = rows[order], col[order]
    for lo in range(0, int(col[-1]) + 1 if len(col) else 0, width):
        a, b = np.searchsorted(col, [lo, lo + width])
        m = np.zeros((n, width), np.float32)
        m[rows[a:b], col[a:b] - lo] = 1
        out += m @ m.T
    return out


def _verified(members: DataFrame, threshold: float, tolerance: float, seed: int) -> DataFrame:
    plan = steps(HASHES, threshold, tolerance)

    def one(group: pa.Table):
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in group.column("shingles")]
        ids, copies, own = (np.asarray(group.column(c)) for c in ("class_id", "copies", "_b"))
        n = len(ids)
        size = np.array([len(s) for s in sets])
        off = np.concatenate([[0], np.cumsum(size)])
        sig = tk.minhash(np.concatenate(sets), off, HASHES, seed)
        bi, bj = group.column("_bi")[0].as_py(), group.column("_bj")[0].as_py()
        near = np.triu(np.ones((n, n), bool), 1)
        if bi != bj:
            near &= own[:, None] != own[None, :]
        x, y = np.nonzero(near)
        got = np.zeros(len(x), np.int64)
        for a, b, least in plan:
            for lo in range(0, len(x), 1 << 15):
                s = slice(lo, lo + (1 << 15))
                got[s] += (sig[x[s], a:b] == sig[y[s], a:b]).sum(1)
            alive = got >= least
            x, y, got = x[alive], y[alive], got[alive]
        if len(x) > 8 * n:
            both = shared_counts(sets)[x, y]
        else:
            both = np.array([len(np.intersect1d(sets[i], sets[j], assume_unique=True)) for i, j in zip(x, y, strict=False)], float)
        yes = (size[x] + size[y] > both) & (both >= threshold * (size[x] + size[y] - both) - 1e-9)
        link = np.zeros((n, n), bool)
        link[x[yes], y[yes]] = link[y[yes], x[yes]] = True
        root = ids.copy()
        for r, j in forest(n, lambda i, others: link[i, others]):
            root[j] = ids[r]
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(link @ copies), pa.array(root)],
                                         names=["class_id", "weight", "root"])

    return by_group(members, ["group", "_bi", "_bj"], one, "class_id long, weight long, root long")


def ngram_jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8,
                       tolerance: float = 1e-6, shingle: int = 5, block: int = BLOCK, seed: int = 1) -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id (smallest doc_id with the
    same shingle set), n_links (other documents with similarity of at least
    ``threshold``, copies included), component_id (smallest doc_id reachable
    by links), kept (doc_id = component_id)."""
    base = pick(docs, {"doc_id": id_col, "text": text_col}).withColumn("doc_id", F.col("doc_id").cast("long"))
    sigs = written(signatures(base, shingle, seed), "signatures")
    classes = written(sigs.where("doc_id is not null and k1 is not null").select("doc_id", "k1", "k2").distinct()
                      .groupBy("k1", "k2").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("copies")),
                      "classes")
    reps = written(sigs.join(classes, (sigs["k1"] == classes["k1"]) & (sigs["k2"] == classes["k2"])
                             & (sigs["doc_id"] == classes["class_id"]))
                   .select("class_id", sigs["k1"], "sig").dropDuplicates(["class_id", "k1"]), "representatives")

    bands = _bands(reps)
    shared = (bands.groupBy("key").agg(F.count("*").alias("n"), F.min("class_id").alias("lo"),
                                       F.max("class_id").alias("hi"), F.bit_xor(F.xxhash64("class_id")).alias("x"))
              .where("n > 1").groupBy("n", "lo", "hi", "x").agg(F.min("key").alias("key")).select("key", "n"))
    buckets = block_pairs(bands.join(shared, "key"), ["key"], "n", "class_id", block)
    look = F.expr(f"substring(sig, 1, {4 * FIRST_LOOK})").alias("sig")
    buckets = (buckets.select("key", "_bi", "_bj", "class_id")
               .join(reps.select("class_id", look), "class_id"))
    near = sized_components(_candidate_edges(buckets, threshold, tolerance), "u", "v")
    members = written(near.join(
        classes.groupBy("class_id").agg(F.sum("copies").alias("copies")), near["node"] == F.col("class_id"))
        .select("class_id", "root", "size", "copies"), "candidates")

    n_members = members.count()
    texts = semi_join(base.withColumnRenamed("doc_id", "class_id"), "class_id", members, n_members, extra=True)
    sets = _sets(texts, shingle).withColumnRenamed("root", "group")
    checked = written(_verified(block_pairs(sets, ["group"], "size", "class_id", block),
                                threshold, tolerance, seed), "verified")
    links = checked.groupBy("class_id").agg(F.sum("weight").alias("weight"))
    comp = components(checked.where("class_id <> root"), "class_id", "root")
    full = (classes.join(links, "class_id", "left").join(comp, classes["class_id"] == comp["node"], "left")
            .select("k1", "k2", "class_id", (F.col("copies") - 1 + F.coalesce("weight", F.lit(0))).alias("n_links"),
                    F.coalesce("root", "class_id").alias("component_id")))
    alone = F.col("doc_id")
    return (sigs.select("doc_id", "k1", "k2").join(full, ["k1", "k2"], "left")
            .select("doc_id", F.when(alone.isNotNull(), F.coalesce("class_id", alone)).alias("class_id"),
                    F.when(alone.isNotNull(), F.coalesce("n_links", F.lit(0))).otherwise(0).cast("long").alias("n_links"),
                    F.when(alone.isNotNull(), F.coalesce("component_id", alone)).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))
