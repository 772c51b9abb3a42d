"""Operator 9: benchmark decontamination by MinHash containment search.

An item is found in a document when at least 80 % of the item's five-word
shingles occur in the document. A short item inside a long document has a
tiny Jaccard similarity to it, so the search is partitioned by size: items
fall into classes by their number of shingles (8, 16, 32, ... at most), and
each document is cut, for each class in use, into blocks of that many
shingles. An item lying in the document shares at least about a fifth of the
joint shingles of two neighbouring blocks, so one of 64 MinHash values of a
block equals the item's with probability above 0.999998. Minima of larger
blocks are minima of smaller ones, so the text is hashed once.

Any equal value makes a candidate; each candidate is verified exactly by the
shingles of the whole document. Equal item texts are grouped first (partial
aggregation), so the index holds each text once, however many ids have it; the
ids are joined to the texts found. The index is broadcast in chunks whose size
is counted (``CHUNK_ITEMS`` texts, ``CHUNK_BYTES`` of text; only a single text
beyond that is a chunk of its own); a larger benchmark takes one pass over the
documents for each chunk. Documents are never shuffled.

Defined cases: items without words find nothing; an item of one to four
words has one shingle of all its words and is found only in a document of
exactly these words (the same definition of shingles holds for both sides);
null texts are empty; repeated items and documents are judged row by row and
equal result rows are given once. Extra columns are carried or ignored.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.llm import textkernel as tk
from tidepool.llm.shared import pick, written

HASHES, SMALLEST = 64, 8
CHUNK_ITEMS, CHUNK_BYTES = 20_000, 32 << 20
_U = np.uint64


class Index:
    """MinHash values of a chunk of items, by size class and hash function."""

    def __init__(self, ids: list, texts: list[str | None], shingle: int, threshold: float, seed: int):
        self.shingle, self.threshold, self.seed = shingle, threshold, seed
        self.ids, self.sets = [], []
        for lo, hi, w, off in tk.word_slices(pa.array(texts, pa.string())):
            h, off = tk.unique_rows(*tk.shingles(w, off, shingle))
            for r in range(hi - lo):
                if off[r + 1] > off[r]:
                    self.ids.append(ids[lo + r])
                    self.sets.append(h[off[r]:off[r + 1]])
        size = np.array([len(s) for s in self.sets], np.int64)
        flat = np.concatenate(self.sets) if self.sets else np.zeros(0, np.uint64)
        sig = tk.minhash(flat, np.concatenate([[0], np.cumsum(size)]), HASHES, seed)
        level = np.maximum(np.ceil(np.log2(np.maximum(size, 1))).astype(int), SMALLEST.bit_length() - 1)
        self.levels = {}
        for lv in np.unique(level):
            items = np.flatnonzero(level == lv)
            door = np.zeros((HASHES, 1 << 16), bool)
            value, owner = [], []
            for k in range(HASHES):
                order = np.argsort(sig[items, k], kind="stable")
                value.append(sig[items[order], k])
                owner.append(items[order])
                door[k, sig[items, k] & 0xFFFF] = True
            self.levels[int(lv)] = (door, value, owner)

    def candidates(self, h: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Distinct (row, item) pairs of equal MinHash values, as two columns."""
        found = []
        if not self.levels or not len(h):
            return np.zeros((0, 2), np.int64)
        first = min(self.levels)
        n = np.diff(off)
        blocks = -(-n // (1 << first))
        base = np.concatenate([[0], np.cumsum(blocks)])
        rows = np.repeat(np.arange(len(n)), blocks)
        starts = off[rows] + ((np.arange(len(rows)) - base[rows]) << first)
        low = tk.minhash_blocks(h, starts, HASHES, self.seed)
        for lv in range(first, max(self.levels) + 1):
            if lv in self.levels:
                door, value, owner = self.levels[lv]
                for k in range(HASHES):
                    at = np.flatnonzero(door[k][low[k] & np.uint32(0xFFFF)])
                    if len(at):
                        a = np.searchsorted(value[k], low[k][at], "left")
                        b = np.searchsorted(value[k], low[k][at], "right")
                        hit = b > a
                        if hit.any():
                            a, b, r = a[hit], b[hit], rows[at[hit]]
                            which = np.repeat(a - np.concatenate([[0], np.cumsum(b - a)[:-1]]), b - a) + np.arange((b - a).sum())
                            found.append(np.stack([np.repeat(r, b - a), owner[k][which]], 1))
            # pairs of blocks of one row make the blocks of the next class
            pos = np.arange(len(rows)) - base[rows]
            even = np.flatnonzero(pos % 2 == 0)
            low = np.minimum.reduceat(low, even, axis=1)
            rows = rows[even]
            base = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=len(n)))])
        return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), np.int64)

    def search(self, col):
        """(first row, rows, [(row, item, shared)]) of slices of the texts."""
        for lo, hi, w, off in tk.word_slices(col):
            h, off = tk.shingles(w, off, self.shingle)
            out, last, own = [], -1, None
            for r, i in self.candidates(h, off):
                if r != last:
                    last, own = r, np.unique(h[off[r]:off[r + 1]])
                shared = len(np.intersect1d(self.sets[i], own, assume_unique=True))
                if shared >= self.threshold * len(self.sets[i]) - 1e-9:
                    out.append((int(r), int(i), shared))
            yield lo, hi - lo, out


def item_texts(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(key, text) of every distinct text and (key, item_id) of every item; the
    key is the digest of the text."""
    base = pick(items, {"item_id": id_col, "text": text_col}).where("text is not null")
    base = base.withColumn("key", F.unhex(F.sha2("text", 256)))
    return base.groupBy("key").agg(F.min("text").alias("text")), base.select("key", "item_id").distinct()


def _chunks(texts: DataFrame) -> tuple[int, list[int]]:
    """(parts, parts in use): the fewest parts, doubling, so that the texts of
    each are within the bounds, or are a single text."""
    n, size = texts.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    parts = max(1, -(-n // CHUNK_ITEMS), -(-size // CHUNK_BYTES))
    while True:
        sizes = (texts.groupBy(F.pmod(F.xxhash64("key"), F.lit(parts)).alias("part"))
                 .agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("size")).collect())  # a row a part
        if all(r["n"] == 1 or (r["n"] <= CHUNK_ITEMS and r["size"] <= CHUNK_BYTES) for r in sizes):
            return parts, sorted(r["part"] for r in sizes)
        parts *= 2


def text_indexes(texts: DataFrame, shingle: int = 5, threshold: float = 0.8, seed: int = 9) -> list:
    """Broadcast indexes of distinct texts, in chunks of bounded size."""
    texts = written(texts, "items")
    parts, used = _chunks(texts)
    out = []
    for c in used:
        part = texts.where(F.pmod(F.xxhash64("key"), F.lit(parts)) == c).collect()
        index = Index([bytes(r["key"]) for r in part], [r["text"] for r in part], shingle, threshold, seed)
        out.append(texts.sparkSession.sparkContext.broadcast(index))
    return out


def find_texts(docs: DataFrame, indexes: list, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, key, shared, item_shingles) of every document and item text
    found in it."""
    base = pick(docs, {"doc_id": id_col, "text": text_col})
    schema = T.StructType([T.StructField("doc_id", base.schema["doc_id"].dataType), T.StructField("key", T.BinaryType()),
                           T.StructField("shared", T.LongType()), T.StructField("item_shingles", T.LongType())])

    def one(sent):
        def run(batches):
            index = sent.value
            for batch in batches:
                for lo, _, hits in index.search(batch.column("text")):
                    if hits:
                        ids = batch.column("doc_id").take(pa.array([lo + r for r, _, _ in hits]))
                        yield pa.RecordBatch.from_arrays(
                            [ids, pa.array([index.ids[i] for _, i, _ in hits], pa.binary()),
                             pa.array([s for _, _, s in hits], pa.int64()),
                             pa.array([len(index.sets[i]) for _, i, _ in hits], pa.int64())], names=schema.names)
        return base.mapInArrow(run, schema)

    if not indexes:
        return base.limit(0).select("doc_id", F.lit(b"").alias("key"), F.lit(0).cast("long").alias("shared"),
                                    F.lit(0).cast("long").alias("item_shingles"))
    return reduce(DataFrame.unionByName, [one(sent) for sent in indexes])


def contaminated_pairs(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       item_id: str = "item_id", item_text: str = "text", **options) -> DataFrame:
    """(doc_id, item_id, shared, item_shingles, containment) of every document
    and item found in it."""
    texts, members = item_texts(items, item_id, item_text)
    found = find_texts(docs, text_indexes(texts, **options), id_col, text_col)
    # written, so that Spark knows the size by which it chooses the join
    return (found.distinct().join(written(members, "item_ids"), "key")
            .select("doc_id", "item_id", "shared", "item_shingles").distinct()
            .withColumn("containment", F.col("shared") / F.col("item_shingles")))


def drop_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id",
                      item_text: str = "text", **options) -> DataFrame:
    """``docs``, all columns, without the documents that hold an item. One
    pass for each chunk of items, nothing is shuffled."""
    at = docs.columns.index(text_col)
    texts, _ = item_texts(items, item_id, item_text)
    for sent in text_indexes(texts, **options):
        def run(batches, sent=sent):
            index = sent.value
            for batch in batches:
                for lo, n, hits in index.search(batch.column(at)):
                    keep = np.ones(n, bool)
                    keep[[r for r, _, _ in hits]] = False
                    yield batch.slice(lo, n).filter(pa.array(keep))
        docs = docs.mapInArrow(run, docs.schema)
    return docs
