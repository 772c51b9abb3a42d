"""Numpy kernels over Arrow text columns: word hashes, shingles, MinHash.

A *word* is a maximal run of ASCII letters and digits and of non-ASCII
characters, lower-cased, where the characters U+0080-U+00BF, U+2000-U+207F
and U+3000-U+303F (signs, spaces, dashes, quotes, CJK punctuation) separate
words like ASCII punctuation does. ``WORD_RE`` says the same as a pattern.

Whole texts are processed, in slices of about 256 KB so that the
temporary arrays stay bounded whatever the size of a text. Texts are cut only
between words, so a word longer than a slice is one slice with its surroundings.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WORD_RE = r"[0-9a-z\x{C0}-\x{1FFF}\x{2080}-\x{2FFF}\x{3040}-\x{10FFFF}]+"

SLICE = 1 << 18
_P = 0x9E3779B97F4A7C15 | 1
_U = np.uint64
_TABLES: dict = {}


def mix(h: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64: every input bit reaches every output bit."""
    h = h ^ (h >> _U(30))
    h = h * _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(27)
    h *= _U(0x94D049BB133111EB)
    h ^= h >> _U(31)
    return h


def multipliers(n: int, seed: int) -> np.ndarray:
    """n odd 64-bit multipliers, a fixed function of the seed."""
    rng = np.random.Generator(np.random.PCG64(seed))
    return rng.integers(0, 2**64, n, dtype=np.uint64) | _U(1)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """P^i and P^-i modulo 2^64 for i < n, grown on demand."""
    have = _TABLES.get("pow")
    if have is None or len(have[0]) < n:
        size = max(n, SLICE + 64)
        inv = pow(_P, -1, 1 << 64)
        out = []
        for base in (_P, inv):
            t = np.full(size, base, np.uint64)
            t[0] = 1
            out.append(np.multiply.accumulate(t))
        have = _TABLES["pow"] = (out[0], out[1])
    return have


def _word_table() -> np.ndarray:
    t = _TABLES.get("lut")
    if t is None:
        t = np.zeros(256, bool)
        t[ord("0"):ord("9") + 1] = True
        t[ord("a"):ord("z") + 1] = True
        t[ord("A"):ord("Z") + 1] = True
        t[0x80:] = True
        _TABLES["lut"] = t
    return t


def _is_word(data: np.ndarray) -> np.ndarray:
    """Which UTF-8 bytes belong to words."""
    w = _word_table()[data]
    at = np.flatnonzero(data == 0xC2)
    if len(at):
        w[at] = False
        w[np.minimum(at + 1, len(w) - 1)] = False
    for lead, seconds in ((0xE2, (0x80, 0x81)), (0xE3, (0x80,))):
        at = np.flatnonzero(data == lead)
        at = at[at + 2 < len(data)]
        if len(at):
            at = at[np.isin(data[at + 1], seconds)]
            for k in range(3):
                w[at + k] = False
    return w


def buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a string array without nulls."""
    wide = pa.types.is_large_string(col.type)
    bufs = col.buffers()
    off = np.frombuffer(bufs[1], np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1]
    off = off.astype(np.int64)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None and bufs[2].size else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def as_text(col) -> pa.Array:
    """One contiguous string array, nulls as empty text."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
        col = col.chunk(0) if isinstance(col, pa.ChunkedArray) else col
    if not (pa.types.is_string(col.type) or pa.types.is_large_string(col.type)):
        col = col.cast(pa.string())
    return pc.fill_null(col, "") if col.null_count else col


def slices(col: pa.Array, limit: int = SLICE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets) with at most ``limit`` bytes,
    but at least one row, a slice."""
    data, off = buffers(col)
    n, lo = len(col), 0
    while lo < n:
        hi = int(np.searchsorted(off, off[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi, data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
        lo = hi


def _hash_words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of a slice and their offsets by row."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(len(off), np.int64)
    w = _is_word(data)
    first = np.zeros(n + 1, bool)
    first[off] = True
    start = w.copy()
    start[1:] &= ~w[:-1] | first[1:n]
    end = w
    end[:-1] &= ~w[1:] | first[1:n]  # w is not read again
    s, e = np.flatnonzero(start), np.flatnonzero(end)
    up, down = _powers(n)
    acc = np.cumsum(data * up[:n], dtype=np.uint64)
    h = acc[e]
    inner = s > 0
    h[inner] -= acc[s[inner] - 1]
    h *= down[s]
    return mix(h), np.searchsorted(s, off).astype(np.int64)


def _cuts(data: np.ndarray, limit: int) -> list[int]:
    """Where one long text is cut: after whole characters that are in no word,
    ``limit`` apart or more where a word is longer than that."""
    cuts, at, n = [0], 0, len(data)
    while n - at > limit:
        width, ends = limit, ()
        while not len(ends) and at + width < n:
            part = data[at:at + width + 3]  # the last character is seen whole
            free = ~_is_word(part)
            free[:-1] &= (part[1:] & 0xC0) != 0x80
            ends = np.flatnonzero(free[:width])
            width *= 2
        if not len(ends):
            break
        at += int(ends[-1]) + 1
        cuts.append(at)
    return [*cuts, n]


def word_slices(col, limit: int = SLICE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, word hashes, offsets by row) of whole texts."""
    col = as_text(col)
    for lo, hi, _, _ in slices(col, limit):
        data, off = buffers(pc.utf8_lower(col.slice(lo, hi - lo)))
        if len(data) <= 2 * limit:
            yield lo, hi, *_hash_words(data, off)
            continue
        cuts = _cuts(data, limit)
        parts = [_hash_words(data[a:b], np.array([0, b - a]))[0] for a, b in zip(cuts, cuts[1:], strict=False)]
        h = np.concatenate(parts)
        yield lo, hi, h, np.array([0, len(h)], np.int64)
    pa.default_memory_pool().release_unused()


def row_ids(off: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(off) - 1), np.diff(off))


def shingles(words: np.ndarray, off: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of k words, with offsets by row. A text of fewer
    than k words, but at least one, has a single shingle of all its words."""
    count = np.diff(off)
    n = len(words)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(len(off), np.int64)
    c = multipliers(k, 11)
    full = np.zeros(max(n - k + 1, 0), np.uint64)
    for j in range(k):
        full += words[j:n - k + 1 + j] * c[j] if n >= k else 0
    rows = np.repeat(np.arange(len(count)), count)
    pos = np.arange(n) - off[rows]
    keep = pos + k <= count[rows]
    out_n = np.where(count >= k, count - k + 1, np.minimum(count, 1))
    off2 = np.concatenate([[0], np.cumsum(out_n)]).astype(np.int64)
    out = np.empty(off2[-1], np.uint64)
    long_rows = count >= k
    at = np.flatnonzero(keep)
    dest = off2[rows[at]] + pos[at]
    out[dest] = full[at]
    for r in np.flatnonzero(~long_rows & (count > 0)):
        w = words[off[r]:off[r + 1]]
        out[off2[r]] = (w * c[:len(w)]).sum(dtype=np.uint64) + _U(len(w))
    return mix(out), off2


def unique_rows(h: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes by row."""
    parts = [np.unique(h[a:b]) for a, b in zip(off, off[1:], strict=False)]
    size = np.array([len(p) for p in parts], np.int64)
    return (np.concatenate(parts) if parts else h[:0]), np.concatenate([[0], np.cumsum(size)])


def set_keys(h: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two order-free 64-bit keys by row of distinct hashes."""
    rows = np.flatnonzero(np.diff(off))
    a, b = np.zeros(len(off) - 1, np.uint64), np.zeros(len(off) - 1, np.uint64)
    if len(rows):
        at = off[rows]
        a[rows] = np.add.reduceat(mix(h + _U(0x51ED270B)), at)
        b[rows] = np.add.reduceat(mix(h ^ _U(0xA0761D6478BD642F)), at)
    return a.view(np.int64), b.view(np.int64)


def minhash(h: np.ndarray, off: np.ndarray, k: int, seed: int = 1) -> np.ndarray:
    """k MinHash values (uint32) by row; rows without hashes get the maximum."""
    a = multipliers(k, seed)
    out = np.full((len(off) - 1, k), 0xFFFFFFFF, np.uint32)
    rows = np.flatnonzero(np.diff(off))
    lo = 0
    buf = np.empty(0, np.uint64)
    while lo < len(rows):
        hi = lo + 1
        base = off[rows[lo]]
        while hi < len(rows) and off[rows[hi] + 1] - base <= 32768:
            hi += 1
        part = h[base:off[rows[hi - 1] + 1]]
        at = off[rows[lo:hi]] - base
        if len(buf) < len(part):
            buf = np.empty(len(part), np.uint64)
        t = buf[:len(part)]
        got = np.empty((k, hi - lo), np.uint64)
        for i in range(k):
            np.multiply(part, a[i], out=t)
            np.minimum.reduceat(t, at, out=got[i])
        out[rows[lo:hi]] = (got >> _U(32)).astype(np.uint32).T
        lo = hi
    return out


def band_keys(sig: np.ndarray, rows_per_band: int) -> np.ndarray:
    """64-bit bucket keys, one column a band of consecutive MinHash values."""
    n, k = sig.shape
    bands = k // rows_per_band
    c = multipliers(rows_per_band, 23)
    v = sig[:, :bands * rows_per_band].reshape(n, bands, rows_per_band).astype(np.uint64)
    h = (mix(v + _U(0x2545F491)) * c).sum(2, dtype=np.uint64)
    return mix(h + np.arange(1, bands + 1, dtype=np.uint64) * _U(_P)).view(np.int64)


def minhash_blocks(h: np.ndarray, starts: np.ndarray, k: int, seed: int = 1) -> np.ndarray:
    """k MinHash values (k, blocks) of consecutive blocks of hashes; the same
    hash functions as ``minhash``."""
    a = multipliers(k, seed)
    out = np.empty((k, len(starts)), np.uint32)
    lo = 0
    while lo < len(starts):
        hi = max(lo + 1, int(np.searchsorted(starts, starts[lo] + 32768, side="right")) - 1)
        if starts[-1] <= starts[lo] + 32768:
            hi = len(starts)
        stop = starts[hi] if hi < len(starts) else len(h)
        part, at = h[starts[lo]:stop], starts[lo:hi] - starts[lo]
        t = np.empty(len(part), np.uint64)
        for i in range(k):
            np.multiply(part, a[i], out=t)
            out[i, lo:hi] = np.minimum.reduceat(t, at) >> _U(32)
        lo = hi
    return out
