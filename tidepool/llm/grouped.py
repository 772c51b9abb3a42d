"""Streaming over key-sorted Arrow batches, and forests inside a group.

``sorted_groups`` hands every run of equal keys to a function as numpy
columns; with thousands of groups a task this is far cheaper than one pandas
frame a group, and it holds one batch and one group at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame


def by_group(df: DataFrame, keys: list[str], fn: Callable[[pa.Table], Iterator[pa.RecordBatch]],
             schema: str) -> DataFrame:
    """``fn`` applied to the rows of each distinct ``keys`` (all together, in
    one task); the groups of a task come sorted by key."""
    dealt = df.repartition(*keys).sortWithinPartitions(*keys)

    def run(batches):
        yield from _runs(batches, keys, fn)

    return dealt.mapInArrow(run, schema)


def _runs(batches, keys, fn):
    rest: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [np.asarray(batch.column(k)) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for c in cols:
            change[1:] |= c[1:] != c[:-1]
        now = tuple(c[0] for c in cols)
        at = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        if last is not None and now != last:
            yield from fn(pa.Table.from_batches(rest))
            rest = []
        for i in range(len(at) - 2):
            rest.append(batch.slice(at[i], at[i + 1] - at[i]))
            yield from fn(pa.Table.from_batches(rest))
            rest = []
        rest.append(batch.slice(at[-2], at[-1] - at[-2]))
        last = tuple(c[-1] for c in cols)
    if rest:
        yield from fn(pa.Table.from_batches(rest))


def forest(n: int, linked: Callable[[int, np.ndarray], np.ndarray]) -> list[tuple[int, int]]:
    """Edges of a spanning forest over members 0..n-1. ``linked(i, others)``
    tells which of the others link to i. Members that are already reached are
    not compared again, so a tight group of n costs about n comparisons of
    one with the rest, not all pairs."""
    open_, edges = np.arange(n), []
    while len(open_):
        root, open_ = open_[0], open_[1:]
        queue = [root]
        while queue and len(open_):
            i = queue.pop()
            hit = linked(int(i), open_)
            found = open_[hit]
            edges += [(int(root), int(j)) for j in found]
            queue += found.tolist()
            open_ = open_[~hit]
    return edges
