"""Quality classifier: histogram gradient-boosted trees over document statistics.

Each text becomes a fixed row of statistics (case, punctuation, symbols,
repetition, word and line lengths).  Trees are grown on binned statistics:
per level one histogram of gradients per node, feature and bin, and the split of
highest gain.  The finished forest is flattened into arrays (feature, threshold,
left child, value) and a batch of rows walks all trees at once in numpy.

Scale: the fit sees a bounded sample (``labelled.SAMPLE_ROWS`` per class) of
statistics; scoring is one pass over the documents without shuffle, with arrays
of fixed size.  Statistics are of the whole text.

Defined cases: null and empty texts have the statistics of an empty text and
are scored by them; without labelled rows of both classes every score is the
share of label 1 (0.5 without labels); repeated rows are scored each; further
columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from tablestats.llm.common import id_remainder, small_batches
from tablestats.llm.labelled import SAMPLE_ROWS, arrays, collected, sampled

MODULUS, HELD_OUT = 3, 1
BINS = 64

#: Kinds of bytes: counted per text by one table lookup.
_KINDS = ("upper", "lower", "digit", "blank", "newline", "stop", "bang", "pipe", "symbol", "other")
_KIND = np.full(256, 9, np.uint8)
for _k, _bytes in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" \t",
                             b"\n\r", b".,;:'\"()-", b"!?", b"|", b"#$%&*+/<=>@[\\]^_`{}~")):
    _KIND[list(_bytes)] = _k

FEATURES = (*(f"share_{k}" for k in _KINDS), "log_bytes", "log_words", "distinct_words", "top_word", "top_five_words",
            "repeated_next", "distinct_pairs", "word_bytes", "long_words", "one_byte_words", "marked_words",
            "upper_words", "title_words", "lines", "distinct_lines", "short_lines", "line_words", "deflated",
            "stopped_lines", "distinct_trigrams")
#: Bytes of text per deflate window that ``deflated`` is averaged over.
_WINDOW = 1 << 14


def statistics(text: str | None) -> list[float]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    n = max(1, len(raw))
    kinds = np.bincount(_KIND[np.frombuffer(raw, np.uint8)], minlength=len(_KINDS)) / n
    found = raw.split()
    w = max(1, len(found))
    counts = Counter(found)
    top = [c for _, c in counts.most_common(5)] + [0]
    pairs = list(zip(found, found[1:]))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    k = max(1, len(lines))
    deflated = sum(len(zlib.compress(raw[i:i + _WINDOW], 1)) for i in range(0, len(raw), _WINDOW)) / n
    trigrams = zip(found, found[1:], found[2:])
    return [
        *kinds, np.log1p(len(raw)), np.log1p(len(found)), len(counts) / w, top[0] / w, sum(top) / w,
        sum(a == b for a, b in pairs) / w, len(set(pairs)) / w, sum(map(len, found)) / w,
        sum(len(x) > 15 for x in found) / w, sum(len(x) == 1 for x in found) / w,
        sum(x[-1:] in b"#$%&*+@!~^=|" for x in found) / w, sum(x.isupper() for x in found) / w,
        sum(x[:1].isupper() for x in found) / w, k / w, len(set(lines)) / k, sum(len(x) < 30 for x in lines) / k,
        w / k, deflated, sum(x.rstrip()[-1:] in b".!?" for x in lines) / k, len(set(trigrams)) / w,
    ]


def _bins(x: np.ndarray, bins: int) -> list[np.ndarray]:
    """Per feature the cut points: distinct inner quantiles."""
    at = np.linspace(0, 1, bins + 1)[1:-1]
    return [np.unique(np.quantile(x[:, j], at)) for j in range(x.shape[1])]


def grow(x: np.ndarray, y: np.ndarray, *, trees: int = 120, depth: int = 4, rate: float = 0.1, l2: float = 1.0,
         min_rows: int = 10, bins: int = BINS) -> dict[str, np.ndarray]:
    """Forest as arrays: complete trees of ``depth`` levels, node i has children 2i+1, 2i+2.

    ``feature`` is -1 where a node doesn't split (both ways lead left);
    classes weigh alike.
    """
    n, m = x.shape
    cuts = _bins(x, bins)
    binned = np.stack([np.searchsorted(cuts[j], x[:, j], side="left") for j in range(m)], 1)
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * n
    inner, total = 2**depth - 1, 2 ** (depth + 1) - 1
    feature, threshold = np.full((trees, total), -1, np.int32), np.full((trees, total), np.inf)
    value, raw = np.zeros((trees, total)), np.zeros(n)
    columns = [binned[:, j].astype(np.int64) for j in range(m)]
    for t in range(trees):
        p = 1 / (1 + np.exp(-raw))
        g, h = weight * (p - y), weight * p * (1 - p)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            at = node - first
            best = np.full(width, 1e-6)
            for j in range(m):
                key = at * bins + columns[j]
                hg, hh, hn = (np.bincount(key, weights=v, minlength=width * bins).reshape(width, bins).cumsum(1)
                              for v in (g, h, None))
                gl, hl, nl = hg[:, :-1], hh[:, :-1], hn[:, :-1]
                gt, ht, nt = hg[:, -1:], hh[:, -1:], hn[:, -1:]
                gain = gl**2 / (hl + l2) + (gt - gl)**2 / (ht - hl + l2) - gt**2 / (ht + l2)
                gain[(nl < min_rows) | (nt - nl < min_rows)] = 0
                gain[:, len(cuts[j]):] = 0
                where = gain.argmax(1)
                top = gain[np.arange(width), where]
                for i in np.flatnonzero(top > best):
                    best[i], feature[t, first + i], threshold[t, first + i] = top[i], j, cuts[j][where[i]]
            f = feature[t, node]
            node = 2 * node + 1 + ((f >= 0) & (x[np.arange(n), np.maximum(f, 0)] > threshold[t, node]))
        leaf = node - inner
        lg, lh = (np.bincount(leaf, weights=v, minlength=2**depth) for v in (g, h))
        value[t, inner:] = -rate * lg / (lh + l2)
        raw += value[t, node]
    return {"feature": feature, "threshold": threshold, "value": value, "depth": np.array(depth)}


def walk(forest: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    """Scores in 0..1: all rows go down all trees level by level."""
    trees, total = forest["feature"].shape
    feature, threshold, value = (forest[k].ravel() for k in ("feature", "threshold", "value"))
    base = np.arange(trees) * total
    node = np.zeros((len(x), trees), np.int64)
    rows = np.arange(len(x))[:, None]
    for _ in range(int(forest["depth"])):
        at = base + node
        f = feature[at]
        node = 2 * node + 1 + ((f >= 0) & (x[rows, np.maximum(f, 0)] > threshold[at]))
    return 1 / (1 + np.exp(-value[base + node].sum(1)))


def _training_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame({"doc_id": batch["doc_id"], "key": batch["key"], "y": batch["y"],
                            "x": [[float(v) for v in statistics(t)] for t in batch["text"]]})


def train(docs: DataFrame, labels: DataFrame, *, rows: int = SAMPLE_ROWS, **how) -> dict | float:
    """The forest, or one score for all where the sample has a single class."""
    small_batches(docs.sparkSession)
    found = collected(sampled(docs, labels, "quality", MODULUS, HELD_OUT, rows)
                      .mapInPandas(_training_rows, "doc_id long, key long, y int, x array<double>"))
    y = found["y"].to_numpy().astype(np.float64)
    if len(np.unique(y)) < 2:
        return float(y.mean()) if len(y) else 0.5
    return grow(np.stack(arrays(found["x"])), y, **how)


def classify(docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    forest = train(docs, labels, **how)

    @F.pandas_udf(DoubleType())
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            if isinstance(forest, float):
                yield pd.Series(np.full(len(batch), forest))
                continue
            x = np.array([statistics(t) for t in batch], np.float64).reshape(len(batch), len(FEATURES))
            parts = [walk(forest, x[i:i + 1024]) for i in range(0, len(x), 1024)]
            yield pd.Series(np.concatenate(parts) if parts else np.empty(0))

    return (docs.select("doc_id", (id_remainder("doc_id", MODULUS) == HELD_OUT).alias("held_out"),
                        score("text").alias("score"))
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))
