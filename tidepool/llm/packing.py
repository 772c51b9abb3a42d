"""Operator 7: hierarchical packing into several context sizes.

Every document becomes its token ids and the end id. Whole windows of the
longest context are sequences of their own; the rest of a document (shorter
than that) is routed to the smallest tier that holds it. Tiers are powers of
two. The longest tier is packed first: each of its pieces opens a window and
the gap is filled from the shorter tiers, best fit first, by cutting a piece
where none fits; then the next tier, and so on. So every window is exactly
full, a power of two, and needs no padding, except at most one in each block
of documents. Step groups hold sequences of the same total of tokens, filled
from long to short, so that every step of a block but the last is equal.

Documents are tokenised and packed where they are read, in blocks of
``BLOCK_DOCS`` documents or ``BLOCK_TOKENS`` tokens: nothing is shuffled,
memory holds one block, and a task that is run again gives the same rows.

Ids come from the vocabulary file. The two installed libraries read the same
vocabulary; the faster one is used for plain texts and the ``tokenizers``
library itself for texts with characters outside ``_PLAIN`` or very long
words, where the two libraries' character tables could differ; tests compare
the ids of both.

Defined cases: a null or empty text is the end id alone; repeated rows and
ids are packed row by row; an empty table gives no rows; null ids stay null.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidepool.llm.shared import pick

TIERS = (1024, 512, 256, 128)
STEP_TOKENS, BLOCK_DOCS, BLOCK_TOKENS = 8192, 4096, 2_000_000
END_ID = 0
_PLAIN = re.compile(r"[\t\n\r -~¡-ſ‐-‧€]*")
_LOADED: dict = {}


def encoder(path: str):
    """Function from a text to its ids (uint32 array), loaded once a worker."""
    if path not in _LOADED:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import json

        import tiktoken
        from tokenizers import Tokenizer
        exact: list[Tokenizer] = []  # loaded when a text needs it
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = byte_ranks(spec)
        fast = None
        if ranks is not None:
            fast = tiktoken.Encoding("vocabulary", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens=special)
        allowed = set(special)

        def encode(text: str) -> np.ndarray:
            if fast is not None and _PLAIN.fullmatch(text) and (len(text) < 1000 or max(map(len, text.split()), default=0) < 1000):
                return np.asarray(fast.encode_to_numpy(text, allowed_special=allowed, disallowed_special=()), np.uint32)
            if not exact:
                exact.append(Tokenizer.from_file(path))
            return np.array(exact[0].encode(text, add_special_tokens=False).ids, np.uint32)

        _LOADED[path] = encode
    return _LOADED[path]


def byte_ranks(spec: dict) -> dict[bytes, int] | None:
    """Id of each word's bytes, if the vocabulary file is such that merging by
    lowest id first is the file's own rule: plain byte-level BPE whose merges
    come in the order of their ids; else None."""
    model = spec["model"]
    special = {t["content"] for t in spec["added_tokens"]}
    plain = spec["pre_tokenizer"] == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True} \
        and spec["normalizer"] is None and model.get("type", "BPE") == "BPE" \
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec["added_tokens"]) \
        and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix",
                                           "fuse_unk", "byte_fallback", "ignore_merges"))
    if not plain:
        return None
    vocab = model["vocab"]
    made = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
    ids = [vocab.get(w, -1) for w in made]
    back = {c: b for b, c in _byte_characters().items()}
    words = {w: i for w, i in vocab.items() if w not in special}
    if any(a >= b for a, b in zip(ids, ids[1:])) or min(ids, default=0) < 0 or set(words) - set(made) != set(back):
        return None
    return {bytes(back[c] for c in w): i for w, i in words.items()}


# Byte-level vocabularies write each byte as a printable character: printable
# Latin-1 bytes as themselves, the others from U+0100 on, in order.
def _byte_characters() -> dict[int, str]:
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(other)}


# Fixed value: the word pattern of byte-level pre-tokenisation.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def pack_block(lengths: list[int], tiers: tuple[int, ...] = TIERS, step_tokens: int = STEP_TOKENS):
    """Pieces (doc, start, length, sequence, offset), and the padded length
    and step group of each sequence, for documents of these token counts."""
    top = tiers[0]
    pieces: list[tuple[int, int, int, int, int]] = []
    filled: list[int] = []
    pool: list[list[tuple[int, int]]] = [[] for _ in range(top + 1)]  # by length: (doc, start)
    mask = 0  # bit l: some piece of length l waits

    def put(doc: int, start: int, length: int) -> None:
        nonlocal mask
        if length:
            pool[length].append((doc, start))
            mask |= 1 << length

    def take(length: int) -> tuple[int, int]:
        nonlocal mask
        piece = pool[length].pop()
        if not pool[length]:
            mask &= ~(1 << length)
        return piece

    for doc, n in enumerate(lengths):
        whole = n // top
        for k in range(whole):
            pieces.append((doc, k * top, top, len(filled), 0))
            filled.append(top)
        put(doc, whole * top, n - whole * top)
    for t, tier in enumerate(tiers):
        least = tiers[t + 1] if t + 1 < len(tiers) else 0
        while (open_ := (mask & ((1 << (tier + 1)) - 1)).bit_length() - 1) > least:
            seq, at = len(filled), 0
            length = open_
            while True:
                doc, start = take(length)
                pieces.append((doc, start, length, seq, at))
                at += length
                gap = tier - at
                if not gap or not mask:
                    break
                length = (mask & ((1 << (gap + 1)) - 1)).bit_length() - 1
                if length <= 0:  # every piece is longer than the gap: cut the shortest
                    longer = (mask & -mask).bit_length() - 1
                    doc, start = take(longer)
                    put(doc, start + gap, longer - gap)
                    put(doc, start, gap)
                    length = gap
            filled.append(at)
    padded = [n if n & (n - 1) == 0 else top for n in filled]
    group, used, groups = 0, 0, [0] * len(padded)
    for s in sorted(range(len(padded)), key=lambda s: (-padded[s], s)):
        if used + padded[s] > step_tokens:
            group, used = group + 1, 0
        groups[s] = group
        used += padded[s]
    return pieces, padded, groups


def pack_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                   tiers: tuple[int, ...] = TIERS, step_tokens: int = STEP_TOKENS, end_id: int = END_ID) -> DataFrame:
    """One row a piece: doc_id, start, length, ids (little-endian unsigned
    32-bit, binary), doc_tokens, sequence_id, offset, sequence_length (padded;
    a tier or a smaller power of two), step_group. ``tokenizer`` is the path of a vocabulary file that
    every worker can read."""
    base = pick(docs, {"doc_id": id_col, "text": text_col})
    schema = T.StructType([T.StructField("doc_id", base.schema["doc_id"].dataType)] + [
        T.StructField(c, T.BinaryType() if c == "ids" else T.LongType())
        for c in ("start", "length", "ids", "doc_tokens", "sequence_id", "offset", "sequence_length", "step_group")])

    def run(batches):
        encode = encoder(tokenizer)
        first = TaskContext.get().partitionId() << 36
        end = np.array([end_id], np.uint32)
        seqs = steps = 0

        def flush(ids, tokens):
            nonlocal seqs, steps
            pieces, padded, groups = pack_block([len(t) for t in tokens], tiers, step_tokens)
            for lo in range(0, len(pieces), 4096):
                part = pieces[lo:lo + 4096]
                d, start, length, seq, offset = (np.array(c, np.int64) for c in zip(*part, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(d)), pa.array(start), pa.array(length),
                     pa.array([tokens[p[0]][p[1]:p[1] + p[2]].tobytes() for p in part], pa.binary()),
                     pa.array(np.array([len(tokens[i]) for i in d], np.int64)), pa.array(seq + (first + seqs)),
                     pa.array(offset), pa.array(np.array(padded, np.int64)[seq]),
                     pa.array(np.array(groups, np.int64)[seq] + (first + steps))], names=schema.names)
            seqs += len(padded)
            steps += max(groups, default=-1) + 1

        ids, tokens, total = [], [], 0
        for batch in batches:
            texts = batch.column("text")
            lo = 0
            for i, text in enumerate(texts):
                t = np.concatenate([encode(text.as_py() or ""), end])
                tokens.append(t)
                total += len(t)
                if len(tokens) >= BLOCK_DOCS or total >= BLOCK_TOKENS:
                    ids.append(batch.column("doc_id").slice(lo, i + 1 - lo))
                    yield from flush(pa.concat_arrays(ids), tokens)
                    ids, tokens, total, lo = [], [], 0, i + 1
            if lo < batch.num_rows:
                ids.append(batch.column("doc_id").slice(lo))
        if tokens:
            yield from flush(pa.concat_arrays(ids), tokens)

    return base.mapInArrow(run, schema)
