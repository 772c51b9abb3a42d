"""A bounded, repeatable sample of labelled documents for training."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.llm.shared import pick, written

# Training reads at most this many documents of each class; scoring reads all.
PER_CLASS = 3000
# and at most this many bytes of their features, so that the driver's memory
# has a bound whatever the length of the texts.
CLASS_BYTES = 64 << 20


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, usable: Callable[[Column], Column],
                    id_col: str = "doc_id", text_col: str = "text", per_class: int = PER_CLASS) -> DataFrame:
    """(doc_id, label, text): up to ``per_class`` documents of each label, the
    first in the order of a hash of the id, among ids that ``usable`` admits.
    Labels are 0 or 1; null labels and ids are ignored; an id labelled more
    than once has the label of the majority, 1 on a tie."""
    lab = pick(labels, {"doc_id": "doc_id", "label": label_col}).where("doc_id is not null and label is not null")
    lab = (lab.where(usable(F.col("doc_id"))).groupBy("doc_id").agg(F.avg("label").alias("m"))
           .select("doc_id", (F.col("m") >= 0.5).cast("int").alias("label")))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    some = [lab.where(F.col("label") == v).orderBy(*order).limit(per_class) for v in (0, 1)]
    chosen = F.broadcast(some[0].unionByName(some[1]))  # at most 2 x per_class rows
    base = pick(docs, {"doc_id": id_col, "text": text_col})
    return base.join(chosen, "doc_id").dropDuplicates(["doc_id"])


def within_budget(sizes: list[tuple], budget: int) -> list:
    """Ids of (label, id, bytes) rows: of each label, in the order given, those
    that fit into what is left of ``budget`` bytes. Documents are taken whole;
    one that does not fit is passed over."""
    left, out = {}, []
    for label, key, size in sizes:
        room = left.get(label, budget)
        if size <= room:
            left[label] = room - size
            out.append(key)
    return out


def fetch(sample: DataFrame, dtypes: dict[str, type], budget: int | None = None) -> list[tuple]:
    """(label, array, ...) of the sample's rows in order of doc_id, up to
    ``budget`` bytes (``CLASS_BYTES``) of each label in the order of a hash of
    the id.

    The sample is written first and passes the driver's JVM a part at a time;
    the arrays are views of one growing buffer a column, so that the driver
    holds them once and gives the memory back afterwards."""
    ids, labels, ends = [], [], [0]
    room = {c: np.empty(1 << 20, t) for c, t in dtypes.items()}
    sample = written(sample, "sample")
    size = sum((F.octet_length(c).cast("long") for c in dtypes), F.lit(0).cast("long"))
    sizes = [tuple(r) for r in sample.select("label", "doc_id", size).orderBy(F.xxhash64("doc_id"), "doc_id").collect()]
    some = within_budget(sizes, CLASS_BYTES if budget is None else budget)  # sizes: at most 2 x per_class rows
    if len(some) < len(sizes):
        chosen = sample.sparkSession.createDataFrame([(k,) for k in some], "doc_id long")
        sample = sample.join(F.broadcast(chosen), "doc_id", "left_semi")
    for row in sample.toLocalIterator():
        ids.append(row["doc_id"])
        labels.append(row["label"])
        for c, t in dtypes.items():
            part = np.frombuffer(row[c], t)
            stop = ends[-1] + len(part)
            if stop > len(room[c]):
                room[c] = np.concatenate([room[c][:ends[-1]], np.empty(max(len(room[c]) // 2, stop - ends[-1]), t)])
            room[c][ends[-1]:stop] = part
        ends.append(stop)
    return [(labels[i], *[room[c][ends[i]:ends[i + 1]] for c in dtypes]) for i in sorted(range(len(ids)), key=ids.__getitem__)]
