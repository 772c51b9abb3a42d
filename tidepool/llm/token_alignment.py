"""Operator 13: cross-tokenizer alignment with an identity-map fast path.

Tokenizer A is a byte-level BPE file of the ``tokenizers`` library, B a
sentencepiece model that puts a space before the text; both encode space+text.
Byte offsets where tokens of A and B both end cut a text into groups. The last
tokens of a group end together: they are its link (tokens are never empty, so
no other pair of occurrences ends together). A pair's count is the number of
links that hold it in the whole corpus.

``identity_map`` gives for every id of A the id of B with the same bytes. A
group of exactly one token of each that follows this map is regular: its links
are counted in one vector as long as A's vocabulary in each task, and looked up
in one such vector. Only links of the other groups become (pair, count) rows,
combined in the task, and only they are joined again to their counts.

Texts are encoded in units: a text is cut before a single space between two
other characters. No piece of B goes on after a space and A's words end there
(``_Pair`` checks both in the files and takes whole texts where they don't
hold), so tokens, groups and links of a text are those of its units in order.
A worker keeps the units it knows, up to ``UNITS``, and encodes new ones: for
B with sentencepiece, for A, if they are of plain characters only, with the
faster of the two libraries that read its vocabulary (see ``packing``; tests
compare the ids), else with ``tokenizers``. Documents are encoded once; what is needed later is written.

Defined cases: a null or empty text, or one whose joined token bytes differ
from space+text in either tokenizer (an unknown token, a normalised or literal
U+2581 space), has no tokens: zeros and an empty ``groups_sha256``. Repeated
rows and ids are rows of their own; null ids stay null; an empty table gives no
rows. Special tokens written in a text are plain text. Other columns are not
read.
"""

from __future__ import annotations

import hashlib
import json
import os
import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.packing import _PLAIN, _SPLIT, _byte_characters, byte_ranks
from tidepool.llm.shared import pick, semi_join, session, written
from tidepool.session import scratch_path

UNITS, UNIT_CHARS = 300_000, 16_000_000  # units a worker keeps; beyond either it starts anew
SLICE_CHARS = 1_000_000  # texts aligned at a time (one text at least)
PAIRS = 200_000  # distinct irregular pairs a task combines before it hands them on
_CUT = re.compile(r"(?<=\S)(?= \S)")
_LOADED: dict = {}


class _Pair:
    """The two tokenizers, the bytes of their ids and the units seen so far."""

    def __init__(self, path_a: str, path_b: str, units: int = UNITS):
        self.most = units
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        back = {c: b for b, c in _byte_characters().items()}
        vocab = self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(vocab.values()) + 1)
        for word, i in vocab.items():
            self.bytes_a[i] = bytes(back[c] for c in word) if all(c in back for c in word) else word.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]
        self.n_b = len(pieces)
        with open(path_a, encoding="utf-8") as f:
            spec = json.load(f)
        byte_level = spec["pre_tokenizer"] == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True,
                                               "use_regex": True} and spec["normalizer"] is None
        self.decimal = [str(i) for i in range(max(len(self.bytes_a), self.n_b))]
        ranks = byte_ranks(spec)
        self.fast = tiktoken.Encoding("vocabulary", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={}) if ranks else None
        self.by_unit = byte_level and not any(re.search("[^▁]▁", p) for p in pieces)
        self.size_a, self.size_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        self.same = identity_map(self.bytes_a, self.bytes_b)
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.chars = 0
        self.groups: list[str] = []
        self.sums = np.zeros((4, 1024), np.int64)  # tokens of A, of B, groups, 1 if the bytes differ
        self.links = {k: (np.zeros(1025, np.int64), np.zeros(4096, np.int64)) for k in ("regular", "irregular")}

    def units(self, text: str) -> list[str]:
        return _CUT.split(" " + text) if self.by_unit else [" " + text]

    def learn(self, units: list[str]) -> None:
        """Encode and align these new units. Plain ones are joined and encoded
        together: they start with a space before another character and end
        without one, so tokens end where units end."""
        at = len(self.known)
        joined = [u for u in units if self.fast and len(u) < 1000 and not u[1:2].isspace() and not u[-1].isspace() and _PLAIN.fullmatch(u)]
        found, rest = [], sorted(set(units).difference(joined))
        for lo in range(0, len(joined), 4096):
            some = joined[lo:lo + 4096]
            got = self._joined(some)
            found += [(some, *got)] if got else []
            rest += [] if got else some
        if rest:
            ids_a = [e.ids for e in self.a.encode_batch(rest, add_special_tokens=False)]
            ids_b = self.b.encode([u[1:] for u in rest])
            good = [b"".join(map(self.bytes_a.__getitem__, a)) == raw == b"".join(map(self.bytes_b.__getitem__, b))
                    for a, b, raw in zip(ids_a, ids_b, (u.encode() for u in rest), strict=True)]
            ids_a, ids_b = ([x if ok else [] for x, ok in zip(ids, good, strict=True)] for ids in (ids_a, ids_b))
            n_a, n_b = (np.array([len(x) for x in ids], np.int64) for ids in (ids_a, ids_b))
            flat_a, flat_b = (np.array([i for x in ids for i in x], np.int64) for ids in (ids_a, ids_b))
            found.append((rest, flat_a, flat_b, n_a, n_b, np.array(good, bool)))
        units = [u for f in found for u in f[0]]
        flat_a, flat_b, n_a, n_b, good = (np.concatenate([f[i] for f in found]) for i in range(1, 6))
        end_a, end_b = np.cumsum(self.size_a[flat_a]), np.cumsum(self.size_b[flat_b])
        ends = np.intersect1d(end_a, end_b, assume_unique=True)  # each unit's end is one of them
        group_a, group_b = np.searchsorted(ends, end_a), np.searchsorted(ends, end_b)
        last_a, last_b = np.searchsorted(end_a, ends), np.searchsorted(end_b, ends)
        link_a, link_b = flat_a[last_a], flat_b[last_b]
        one = (np.bincount(group_a, minlength=len(ends)) == 1) & (np.bincount(group_b, minlength=len(ends)) == 1)
        regular = one & (self.same[link_a] == link_b)
        unit_of = np.repeat(np.arange(len(units)), n_a)[last_a]  # of each group

        mark_a, mark_b = np.full(len(flat_a), ","), np.full(len(flat_b), ",")
        mark_a[last_a], mark_b[last_b] = "|", ";"
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        ids = np.concatenate([flat_a, flat_b])[order].tolist()
        words = [self.decimal[i] + m for i, m in zip(ids, np.concatenate([mark_a, mark_b])[order].tolist(), strict=True)]
        cut = np.concatenate([[0], np.cumsum(n_a + n_b)]).tolist()
        self.groups += ["".join(words[lo:hi])[:-1] for lo, hi in zip(cut, cut[1:])]

        stop = at + len(units)
        self.sums = _room(self.sums, stop)
        self.sums[:, at:stop] = n_a, n_b, np.bincount(unit_of, minlength=len(units)), ~good
        for kind, take, value in (("regular", regular, link_a), ("irregular", ~regular, link_a * self.n_b + link_b)):
            start, flat = self.links[kind]
            start = _room(start, stop + 1)
            start[at + 1:stop + 1] = start[at] + np.cumsum(np.bincount(unit_of[take], minlength=len(units)))
            flat = _room(flat, int(start[stop]))
            flat[start[at]:start[stop]] = value[take]
            self.links[kind] = start, flat
        for k, u in enumerate(units):
            self.known[u] = at + k
            self.chars += len(u)

    def _joined(self, units: list[str]):
        """(ids of A, of B, tokens a unit of A, of B, True), or None if the
        bytes differ or a token goes over the end of a unit."""
        text = "".join(units)
        raw, ends = text.encode(), np.cumsum([len(u.encode()) for u in units])
        out = []
        for ids, of, size in ((self.fast.encode_to_numpy(text, allowed_special=set(), disallowed_special=()), self.bytes_a, self.size_a),
                              (self.b.encode(text[1:]), self.bytes_b, self.size_b)):
            flat = np.asarray(ids, np.int64)
            end = np.cumsum(size[flat])
            n = np.searchsorted(end, ends)
            if b"".join(map(of.__getitem__, flat.tolist())) != raw or (end[n] != ends).any():
                return None
            out.append((flat, np.diff(n + 1, prepend=0)))
        (a, n_a), (b, n_b) = out
        return a, b, n_a, n_b, np.ones(len(units), bool)

    def align(self, texts: list[str | None]):
        """Per text: (tokens of A, of B, groups) as an array, the digest of
        its groups, and its (text, link, times) of either kind, by text."""
        if len(self.known) > self.most or self.chars > UNIT_CHARS:
            self.forget()
        split = [self.units(t) if t else [] for t in texts]
        new = [u for u in dict.fromkeys(u for us in split for u in us) if u not in self.known]
        if new:
            self.learn(new)
        unit = np.array([self.known[u] for us in split for u in us], np.int64)
        text = np.repeat(np.arange(len(texts)), [len(us) for us in split])
        bad = np.bincount(text[self.sums[3, unit] > 0], minlength=len(texts)) > 0
        keep = ~bad[text]
        unit, text = unit[keep], text[keep]
        upto = np.concatenate([np.zeros((3, 1), np.int64), np.cumsum(self.sums[:3, unit], axis=1)], axis=1)
        edge = np.searchsorted(text, np.arange(len(texts) + 1))
        sums = upto[:, edge[1:]] - upto[:, edge[:-1]]
        unit_list, lo_hi = unit.tolist(), edge.tolist()
        digests = [hashlib.sha256(";".join([self.groups[i] for i in unit_list[lo:hi]]).encode()).hexdigest() if hi > lo else ""
                   for lo, hi in zip(lo_hi, lo_hi[1:])]
        return sums, digests, {k: self._links(k, unit, text) for k in self.links}

    def _links(self, kind: str, unit: np.ndarray, text: np.ndarray):
        start, flat = self.links[kind]
        n = start[unit + 1] - start[unit]
        where = np.repeat(start[unit] - np.concatenate([[0], np.cumsum(n)[:-1]]) if len(n) else n, n) + np.arange(n.sum())
        value, owner = flat[where], np.repeat(text, n)
        order = np.lexsort((value, owner))
        value, owner = value[order], owner[order]
        first = np.flatnonzero(np.concatenate([[True], (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])]) if len(value) else value)
        return owner[first], value[first], np.diff(np.append(first, len(value)))


def _room(x: np.ndarray, n: int) -> np.ndarray:
    """``x`` with at least n places in its last dimension."""
    if x.shape[-1] >= n:
        return x
    return np.concatenate([x, np.zeros((*x.shape[:-1], max(n - x.shape[-1], x.shape[-1])), x.dtype)], axis=-1)


def identity_map(bytes_a: list[bytes], bytes_b: list[bytes]) -> np.ndarray:
    """For each id of A the id of B with the same bytes, -1 for none. Of
    several ids of B the largest: written pieces come after the byte tokens."""
    of = {b: i for i, b in enumerate(bytes_b) if b}
    return np.array([of.get(a, -1) if a else -1 for a in bytes_a], np.int64)


def _pair(*of) -> _Pair:
    if of not in _LOADED:
        _LOADED[of] = _Pair(*of)
    return _LOADED[of]


def _lists(owner: np.ndarray, values: np.ndarray, n: int, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(n + 1)).astype(np.int32)), pa.array(values, kind))


_DOC = "row long, doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, a array<int>, a_n array<int>, pair array<long>, pair_n array<int>"
_SCHEMA = "kind string, " + _DOC + ", link long, times long, regular boolean"


def _encoded(docs: DataFrame, path_a: str, path_b: str, units: int, pairs: int) -> DataFrame:
    """A row of kind ``doc`` for each document, and rows of kind ``count``
    with this task's counts of links (a link is id of A x size of B + id of B)."""
    def run(batches):
        pair = _pair(path_a, path_b, units)
        row = TaskContext.get().partitionId() << 36
        vector = np.zeros(len(pair.bytes_a), np.int64)
        more: dict[int, int] = {}

        def counts(links, times, regular):
            n = len(links)
            none = {f: pa.nulls(n, t) for f, t in schema.items()}
            yield pa.RecordBatch.from_pydict(none | {
                "kind": pa.array(["count"] * n, pa.string()), "link": pa.array(links, pa.int64()), "times": pa.array(times, pa.int64()),
                "regular": pa.array([regular] * n, pa.bool_())})

        schema = {"row": pa.int64(), "doc_id": pa.int64(), "n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(),
                  "groups_sha256": pa.string(), "a": pa.list_(pa.int32()), "a_n": pa.list_(pa.int32()),
                  "pair": pa.list_(pa.int64()), "pair_n": pa.list_(pa.int32())}
        schema = {"kind": pa.string()} | schema | {"link": pa.int64(), "times": pa.int64(), "regular": pa.bool_()}
        for batch in batches:
            for lo, texts in _slices(batch.column("text")):
                n = len(texts)
                sums, digests, links = pair.align(texts)
                (own_a, a, a_n), (own_p, p, p_n) = links["regular"], links["irregular"]
                np.add.at(vector, a, a_n)
                for k, c in zip(*[x.tolist() for x in _combined(p, p_n)], strict=True):
                    more[k] = more.get(k, 0) + c
                yield pa.RecordBatch.from_pydict({f: pa.nulls(n, t) for f, t in schema.items()} | {
                    "kind": pa.array(["doc"] * n), "row": pa.array(np.arange(row, row + n, dtype=np.int64)), "doc_id": batch.column("doc_id").slice(lo, n),
                    "n_a": pa.array(sums[0]), "n_b": pa.array(sums[1]), "n_groups": pa.array(sums[2]),
                    "groups_sha256": pa.array(digests, pa.string()), "a": _lists(own_a, a, n, pa.int32()), "a_n": _lists(own_a, a_n, n, pa.int32()),
                    "pair": _lists(own_p, p, n, pa.int64()), "pair_n": _lists(own_p, p_n, n, pa.int32())})
                row += n
                if len(more) > pairs:
                    yield from counts(list(more), list(more.values()), False)
                    more.clear()
        used = np.flatnonzero(vector)
        yield from counts(used * pair.n_b + pair.same[used], vector[used], True)
        yield from counts(list(more), list(more.values()), False)

    return docs.mapInArrow(run, _SCHEMA)


def _combined(keys: np.ndarray, n: np.ndarray):
    u, at = np.unique(keys, return_inverse=True)
    out = np.zeros(len(u), np.int64)
    np.add.at(out, at, n)
    return u, out


def _slices(column):
    """(first row, texts) of up to ``SLICE_CHARS`` characters, one text at least."""
    lo, texts, chars = 0, [], 0
    for i, x in enumerate(column):
        t = x.as_py()
        if texts and chars + len(t or "") > SLICE_CHARS:
            yield lo, texts
            lo, texts, chars = i, [], 0
        texts.append(t)
        chars += len(t or "")
    if texts:
        yield lo, texts


def align_tokenizers(docs: DataFrame, tokenizer_a: str, tokenizer_b: str, id_col: str = "doc_id", text_col: str = "text",
                     units: int = UNITS, pairs: int = PAIRS) -> DataFrame:
    """One row a document: doc_id, n_a, n_b (tokens), n_groups, n_links, n_best
    (links whose count is the highest of their id of B, ties included),
    count_sum (of the links' counts), groups_sha256. The paths must be readable
    by every worker."""
    spark = session(docs)
    base = pick(docs, {"doc_id": id_col, "text": text_col}).withColumn("doc_id", F.col("doc_id").cast("long"))
    path = scratch_path(spark, "llm/aligned")
    _encoded(base, tokenizer_a, tokenizer_b, units, pairs).write.partitionBy("kind").parquet(path)
    both = spark.read.schema(_SCHEMA).parquet(path)
    done = both.where("kind = 'doc'")
    pair = _pair(tokenizer_a, tokenizer_b)
    n_b, same = pair.n_b, pair.same
    counted = written(both.where("kind = 'count'").groupBy("link").agg(F.sum("times").alias("times"), F.first("regular").alias("regular")), "pairs")
    best = counted.groupBy(F.pmod("link", F.lit(n_b)).alias("b")).agg(F.max("times").alias("best"))  # a row an id of B
    times_a, top = np.zeros(len(same), np.int64), np.zeros(n_b, np.int64)
    for r in best.collect():
        top[r["b"]] = r["best"]
    for r in counted.where("regular").collect():  # a row an id of A at most
        times_a[r["link"] // n_b] = r["times"]
    best_a = (times_a == top[same]) & (same >= 0)

    def regular(batches):
        for batch in batches:
            a, n = batch.column("a"), np.asarray(batch.column("a_n").flatten(), np.int64)
            ids, edge = np.asarray(a.flatten()), np.concatenate([[0], np.cumsum(np.asarray(a.value_lengths().fill_null(0)))])
            s, b = (np.concatenate([[0], np.cumsum(x * n)]) for x in (times_a[ids], best_a[ids]))
            keep = [batch.column(c) for c in ("row", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256")]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(b[edge[1:]] - b[edge[:-1]]), pa.array(s[edge[1:]] - s[edge[:-1]])],
                                             names=["row", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "best_a", "sum_a"])

    rows = done.select("row", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "a", "a_n").mapInArrow(
        regular, "row long, doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, best_a long, sum_a long")
    odd = counted.where("not regular")
    lookup = written(odd.join(F.broadcast(best), F.pmod("link", F.lit(n_b)) == F.col("b"))
                     .select("link", "times", (F.col("times") == F.col("best")).cast("long").alias("is_best")), "irregular")
    seen = done.select("row", F.explode(F.arrays_zip("pair", "pair_n")).alias("p")).select("row", F.col("p.pair").alias("link"), "p.pair_n")
    seen = (semi_join(seen, "link", lookup, lookup.count(), extra=True).groupBy("row")
            .agg(F.sum(F.col("pair_n") * F.col("times")).alias("sum_p"), F.sum(F.col("pair_n") * F.col("is_best")).alias("best_p")))
    return rows.join(seen, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"),
        (F.col("best_a") + F.coalesce("best_p", F.lit(0))).alias("n_best"),
        (F.col("sum_a") + F.coalesce("sum_p", F.lit(0))).alias("count_sum"), "groups_sha256")
