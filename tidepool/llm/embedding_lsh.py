"""Operator 2: embedding near-duplicates by cross-polytope hashing.

A vector is rotated by three rounds of random signs and a fast Hadamard
transform; its cross-polytope hash is the axis (with sign) nearest to the
rotated vector. One table joins ``hashes`` such codes to a bucket. Every
vector enters, per table, its own bucket and the next best ones (multiprobe,
ordered by how much the rotated vector would have to move). The number of
codes follows the number of vectors, so that unrelated vectors rarely share a
bucket; probes follow the codes and tables the codes and the width
(``tables_for``), so that a pair at cosine 0.9 meets with probability above
0.999 (tests measure it at 64, 256 and 768 dimensions). Vectors of each width
are compared among themselves, all by the same method.

Exactly equal vectors are grouped first (partial aggregation), so a common
vector is one node with a weight. Buckets with equal members are looked at
once, large ones in pairs of blocks; inside a bucket candidates are verified
by their cosine in double precision and only a spanning forest leaves the
task. Links are then counted within the components of that forest, in blocks
of dot products: no list of pairs is ever made, and what is counted is exact.

Defined cases: a vector that is null, empty, zero, or holds a null or
non-finite component links with nothing and is its own component; vectors of
different widths do not link; rows that
repeat a vec_id count once (the least vector of them is taken); null vec_ids
give a row with null component. Labels and other columns are not read.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.graph import sized_components
from tidepool.llm.grouped import by_group, forest
from tidepool.llm.shared import block_pairs, pick, semi_join, written

TABLES, PROBES = {3: 8, 4: 12, 5: 16}, {3: 8, 4: 16, 5: 32}  # by the number of codes, at up to 64 dimensions
BLOCK = 512
_DEPTH = 6  # axes a code considers for probing


def codes_for(n: int, dim: int) -> int:
    """Codes a bucket joins: enough that n unrelated vectors rarely meet."""
    d = 1 << max(int(dim - 1).bit_length(), 1)
    return next((k for k in (3, 4) if (2 * d) ** k >= 16 * n), 5)


def tables_for(codes: int, dim: int) -> int:
    """Half as many tables again for each fourfold width beyond 64."""
    return ceil(TABLES[codes] * 1.5 ** max(0.0, ((int(dim - 1).bit_length()) - 6) / 2))


def hadamard(x: np.ndarray) -> np.ndarray:
    """Normalised Walsh-Hadamard transform of the rows (a power of two wide)."""
    n, d = x.shape
    h = 1
    while h < d:
        y = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(n, d)
        h *= 2
    return x / np.sqrt(d)


def bucket_codes(x: np.ndarray, codes: int = 3, tables: int | None = None, probes: int | None = None,
                 seed: int = 5) -> np.ndarray:
    """Bucket keys (n, tables, probes) of unit vectors, best bucket first."""
    n, dim = x.shape
    tables, probes = tables or tables_for(codes, dim), probes or PROBES[codes]
    d = 1 << max(int(dim - 1).bit_length(), 1)
    x = np.pad(x, ((0, 0), (0, d - dim)))
    depth = min(_DEPTH, d)
    combos = np.stack(np.meshgrid(*[np.arange(depth)] * codes, indexing="ij"), -1).reshape(-1, codes)
    combos = combos[np.argsort(combos.sum(1), kind="stable")][:128]
    out = np.empty((n, tables, min(probes, len(combos))), np.int64)
    rows = np.arange(n)[:, None]
    for t in range(tables):
        rng = np.random.Generator(np.random.PCG64([seed, t]))
        loss, key = 0.0, np.int64(0)
        for j in range(codes):
            r = x
            for _ in range(3):
                r = hadamard(r * rng.choice(np.array([-1.0, 1.0]), d))
            size = np.abs(r)
            best = np.argsort(-size, axis=1, kind="stable")[:, :depth]
            far = np.take_along_axis(size, best, 1)
            code = best * 2 + (np.take_along_axis(r, best, 1) >= 0)
            loss = loss + ((far[:, :1] - far) ** 2)[:, combos[:, j]]
            key = key * np.int64(2 * d) + code[:, combos[:, j]]
        top = np.argsort(loss, axis=1, kind="stable")[:, :out.shape[2]]
        out[:, t] = key[rows, top] * np.int64(tables) + t
    return out


def _unit(col) -> np.ndarray:
    """Unit vectors of a column whose vectors have one width."""
    v = np.asarray(col.combine_chunks().flatten() if isinstance(col, pa.ChunkedArray) else col.flatten(), np.float64)
    v = v.reshape(len(col), -1)
    v = v / np.abs(v).max(axis=1, keepdims=True)  # no overflow of the squares
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _buckets(nodes: DataFrame, n: int, codes: int | None, seed: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            widths = np.asarray(batch.column("v").value_lengths())
            for w in np.unique(widths).tolist():
                own = batch.take(pa.array(np.flatnonzero(widths == w)))
                for lo in range(0, own.num_rows, 1024):
                    part = own.slice(lo, 1024)
                    k = bucket_codes(_unit(part.column("v")), codes or codes_for(n, w), seed=seed).reshape(part.num_rows, -1)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(k.size, w, np.int32)), pa.array(k.ravel()),
                         pa.array(np.repeat(np.asarray(part.column("node")), k.shape[1]))], names=["width", "key", "node"])
    return nodes.select("node", "v").mapInArrow(run, "width int, key long, node long")


def _edges(buckets: DataFrame, threshold: float) -> DataFrame:
    def one(group: pa.Table):
        ids, v = np.asarray(group.column("node")), _unit(group.column("v"))
        e = forest(len(ids), lambda i, others: v[others] @ v[i] >= threshold)
        if e:
            e = np.array(e)
            yield pa.RecordBatch.from_arrays([pa.array(ids[e[:, 0]]), pa.array(ids[e[:, 1]])], names=["a", "b"])
    return by_group(buckets, ["width", "key", "_bi", "_bj"], one, "a long, b long")


def _weights(members: DataFrame, threshold: float) -> DataFrame:
    def one(group: pa.Table):
        ids, copies, own = (np.asarray(group.column(c)) for c in ("node", "copies", "_b"))
        v = _unit(group.column("v"))
        link = v @ v.T >= threshold
        np.fill_diagonal(link, False)
        if group.column("_bi")[0].as_py() != group.column("_bj")[0].as_py():
            link &= own[:, None] != own[None, :]
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(link @ copies), pa.array(np.asarray(group.column("root")))],
                                         names=["node", "weight", "root"])
    return by_group(members, ["root", "_bi", "_bj"], one, "node long, weight long, root long")


def embedding_near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                              threshold: float = 0.9, codes: int | None = None, block: int = BLOCK,
                              seed: int = 5) -> DataFrame:
    """One row per vec_id: vec_id, n_links (other vectors with cosine of at
    least ``threshold``), component_id (smallest vec_id reachable by links),
    kept (vec_id = component_id)."""
    base = pick(vectors, {"vec_id": id_col, "v": vector_col}).withColumn("vec_id", F.col("vec_id").cast("long"))
    base = base.where("vec_id is not null").groupBy("vec_id").agg(F.min("v").alias("v")).unionByName(
        base.where("vec_id is null").select("vec_id", "v"))
    good = F.coalesce(F.size("v") > 0, F.lit(False)) & F.coalesce(
        F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False)) & F.coalesce(
        F.exists("v", lambda x: x != 0), F.lit(False))
    # 0.0 and -0.0 are one value, so that equal vectors have equal keys
    plain = F.transform("v", lambda x: F.when(x == 0, F.lit(0)).otherwise(x))
    base = base.withColumn("v", F.when(good, plain))
    base = written(base.withColumn("k1", F.xxhash64("v")).withColumn("k2", F.xxhash64(F.lit(7), F.col("v"))), "vectors")
    usable = base.where("v is not null and vec_id is not null")
    classes = written(usable.groupBy("k1", "k2").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies")), "classes")
    reps = written(classes.join(usable.select(F.col("vec_id").alias("node"), "v"), "node")
                   .select("node", "copies", "v"), "representatives")
    buckets = _buckets(reps, reps.count(), codes, seed)
    shared = (buckets.groupBy("width", "key").agg(F.count("*").alias("n"), F.min("node").alias("lo"), F.max("node").alias("hi"),
                                                  F.bit_xor(F.xxhash64("node")).alias("x")).where("n > 1")
              .groupBy("width", "n", "lo", "hi", "x").agg(F.min("key").alias("key")).select("width", "key", "n"))
    inside = block_pairs(buckets.join(shared, ["width", "key"]), ["width", "key"], "n", "node", block)
    inside = inside.select("width", "key", "_bi", "_bj", "node").join(reps.select("node", "v"), "node")
    sized = written(sized_components(_edges(inside, threshold), "a", "b"), "members")
    members = semi_join(reps, "node", sized, sized.count(), extra=True)
    weights = _weights(block_pairs(members, ["root"], "size", "node", block), threshold)
    weights = weights.groupBy("node").agg(F.sum("weight").alias("weight"), F.min("root").alias("root"))
    full = (classes.join(weights, "node", "left")
            .select("k1", "k2", (F.col("copies") - 1 + F.coalesce("weight", F.lit(0))).alias("n_links"),
                    F.coalesce("root", "node").alias("component_id")))
    fits = F.col("v").isNotNull() & F.col("vec_id").isNotNull()
    keyed = base.select("vec_id", F.when(fits, F.col("k1")).alias("k1"), F.when(fits, F.col("k2")).alias("k2"))
    return (keyed.join(full, ["k1", "k2"], "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component_id", "vec_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))))
