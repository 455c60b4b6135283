"""A bounded, repeatable sample of labelled documents for fitting a classifier.

``SAMPLE_ROWS`` documents per class at most, taken by a hash of the id among all
rows that may be learnt from, so the classes are drawn alike at every size.
Only the ids of the sample (two bounds of rows) are broadcast; the texts are
never shuffled: the sample is turned into features where it is read.  Rows that
repeat one id and text are one row of the sample, and an id gives the
``TEXTS_PER_ID`` texts of the smallest hash at most, so ``2 * SAMPLE_ROWS *
TEXTS_PER_ID`` rows bound what reaches the driver, whatever repeats.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablestats.llm.common import id_remainder, same_row

SAMPLE_ROWS = 6_000
TEXTS_PER_ID = 4


def sample_ids(labels: DataFrame, label: str, modulus: int, held_out: int, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``doc_id, y, n``: the sampled ids; ``n`` counts all learnable rows of the class.

    Held-out ids, null ids and null labels never take part; an id labelled
    more than once counts once, as 1 if any label is 1.
    """
    known = (labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()
                          & (id_remainder("doc_id", modulus) != held_out))
             .groupBy("doc_id").agg((F.max(label) > 0).cast("int").alias("y")))
    order = (F.xxhash64("doc_id"), "doc_id")
    parts = [known.where(F.col("y") == y).orderBy(*order).limit(rows) for y in (0, 1)]
    return parts[0].unionByName(parts[1])


def sampled(docs: DataFrame, labels: DataFrame, label: str, modulus: int, held_out: int,
            rows: int = SAMPLE_ROWS) -> DataFrame:
    """``doc_id, text, key, y`` of the sampled documents (2 * ``rows`` ids are broadcast)."""
    ids = sample_ids(labels, label, modulus, held_out, rows)
    return docs.select("doc_id", "text", same_row().alias("key")).join(F.broadcast(ids), "doc_id")


def collected(features: DataFrame, per_id: int = TEXTS_PER_ID) -> pa.Table:
    """``features`` (``doc_id, key, y`` and more) on the driver: one row per id and text, ``per_id`` texts at most.

    Copies meet in partial sums where they are read; ranks are limited there as well."""
    others = [F.first(c).alias(c) for c in features.columns if c not in ("doc_id", "key")]
    once = features.groupBy("doc_id", "key").agg(*others)
    rank = F.row_number().over(Window.partitionBy("doc_id").orderBy("key"))
    return (once.withColumn("rank", rank).where(F.col("rank") <= per_id).drop("rank")
            .toArrow().sort_by([("doc_id", "ascending"), ("key", "ascending")]))


def arrays(column: pa.ChunkedArray) -> list[np.ndarray | None]:
    """A list column as one numpy array a row, None for null."""
    out: list[np.ndarray | None] = []
    for chunk in column.chunks:
        values, offsets = chunk.values.to_numpy(), chunk.offsets.to_numpy()
        null = chunk.is_null().to_numpy(zero_copy_only=False)
        out += [None if gone else values[a:b] for a, b, gone in zip(offsets[:-1], offsets[1:], null, strict=True)]
    return out
