"""Toxicity by a counterfactual-regularised classifier.

A logistic model over the presence of hashed words and word beginnings.  In every sentence of a
labelled text that names an identity group, the identity words are swapped for those of
another group; the fit penalises the change of the score between the two, so
the model can't use the mention of a group itself.  An L1 term keeps the model
to the few words that matter, so a long clean text gathers no score.

``groups`` names the identity words by language; a corpus in other languages, or
with other groups, gives its own.  ``n_pairs`` of the result is the number of
sentences swapped: where it is 0 the penalty has nothing to act on.

Scale: the fit sees a bounded sample (``labelled.SAMPLE_ROWS`` per class) as
arrays of at most ``BUCKETS`` distinct hashes per text and what
``PAIRS_PER_TEXT`` different swaps change in it at most; scoring is one pass over
the documents without shuffle, with a model of fixed size.  Texts are read whole,
however long.

Defined cases: null and empty texts have no words and get the score of the
bias; without labelled rows of both classes the score is the share of label 1
(0 without labels) for every text; repeated rows are scored each; further
columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from tablestats.llm.common import id_remainder, small_batches
from tablestats.llm.labelled import SAMPLE_ROWS, arrays, collected, sampled

BUCKETS = 1 << 18
MODULUS, HELD_OUT = 5, 0
WORD = re.compile(r"[^\W_]+")
STEMS = (3, 4, 5, 6)

SENTENCE_END = re.compile(r"[.!?\n]+")
PAIRS_PER_TEXT = 32

#: Identity groups by language: each word of a list is swapped for the next of its list.
IDENTITY_TERMS = {
    "en": (
        ("women", "men", "girls", "boys"),
        ("woman", "man", "girl", "boy"),
        ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
        ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
        ("gay", "straight", "lesbian", "bisexual", "transgender"),
        ("black", "white", "asian", "latino", "arab"),
        ("immigrants", "refugees", "foreigners", "natives"),
        ("african", "american", "european", "mexican", "chinese", "indian"),
        ("old", "young", "disabled", "deaf", "blind"),
    ),
    "de": (
        ("frauen", "männer", "mädchen", "jungen"),
        ("frau", "mann"),
        ("muslime", "christen", "juden", "hindus", "buddhisten", "atheisten"),
        ("muslimisch", "christlich", "jüdisch", "hinduistisch", "buddhistisch"),
        ("schwul", "lesbisch", "bisexuell", "transsexuell"),
        ("schwarze", "weiße", "asiaten", "araber"),
        ("einwanderer", "flüchtlinge", "ausländer", "einheimische"),
        ("alte", "junge", "behinderte", "gehörlose", "blinde"),
    ),
    "fr": (
        ("femmes", "hommes", "filles", "garçons"),
        ("femme", "homme", "fille", "garçon"),
        ("musulmans", "chrétiens", "juifs", "hindous", "bouddhistes", "athées"),
        ("musulman", "chrétien", "juif", "hindou", "bouddhiste", "athée"),
        ("homosexuel", "hétérosexuel", "lesbienne", "bisexuel"),
        ("noirs", "blancs", "asiatiques", "arabes"),
        ("immigrés", "réfugiés", "étrangers", "autochtones"),
        ("vieux", "jeunes", "handicapés", "sourds", "aveugles"),
    ),
    "es": (
        ("mujeres", "hombres", "niñas", "niños"),
        ("mujer", "hombre", "niña", "niño"),
        ("musulmanes", "cristianos", "judíos", "hindúes", "budistas", "ateos"),
        ("musulmán", "cristiano", "judío", "hindú", "budista", "ateo"),
        ("homosexual", "heterosexual", "lesbiana"),
        ("negros", "blancos", "asiáticos", "árabes"),
        ("inmigrantes", "refugiados", "extranjeros", "nativos"),
        ("viejos", "jóvenes", "discapacitados", "sordos", "ciegos"),
    ),
}


def swaps(groups=IDENTITY_TERMS) -> dict[str, str]:
    """Each identity word with the next of its list (of the first list that holds it)."""
    out: dict[str, str] = {}
    for lists in groups.values():
        for g in lists:
            for i, w in enumerate(g):
                out.setdefault(w, g[(i + 1) % len(g)])
    return out


def words(text: str | None) -> set[str]:
    return set(WORD.findall((text or "").lower()))


def bucket(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) % BUCKETS


def stems(found: set[str]) -> set[str]:
    """The words and their first letters (marked): inflected forms share a stem."""
    return {f"{w[:k]}~" for k in STEMS for w in found if len(w) > k} | found


def features(found: set[str]) -> np.ndarray:
    return np.array(sorted({bucket(w) for w in stems(found)}), np.int32)


def swapped(found: set[str], swap: dict[str, str]) -> set[str] | None:
    """The words after the swap of identity terms; None if the text has none."""
    if not any(w in swap for w in found):
        return None
    return {swap.get(w, w) for w in found}


def sentence_pairs(text: str | None, swap: dict[str, str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """What a swap takes from the features of a sentence and adds to them, for each sentence that names a group.

    Sentences that change alike are one pair; ``PAIRS_PER_TEXT`` pairs at most, the first in order of their features."""
    out = {}
    for sentence in SENTENCE_END.split(text or ""):
        found = words(sentence)
        other = swapped(found, swap)
        if other is not None and other != found:
            a, b = features(found), features(other)
            gone, new = np.setdiff1d(a, b), np.setdiff1d(b, a)
            out[(tuple(gone.tolist()), tuple(new.tolist()))] = gone, new
    return [out[k] for k in sorted(out)[:PAIRS_PER_TEXT]]


def _training_rows(swap: dict[str, str]):
    """Rows with ``x``, ``pair`` and ``change``: numbers of the text's pairs, and a bucket that
    goes (as it is) or comes (as its complement)."""
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x, pair, change = [], [], []
            for text in batch["text"]:
                found = sentence_pairs(text, swap)
                x.append(features(words(text)).tolist())
                pair.append([i for i, (a, b) in enumerate(found) for _ in range(len(a) + len(b))])
                change.append([int(v) for a, b in found for v in (*a, *~b)])
            yield pd.DataFrame({"doc_id": batch["doc_id"], "key": batch["key"], "y": batch["y"], "x": x,
                                "pair": pair, "change": change})
    return rows


def _pairs_of(pair: np.ndarray, change: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for i in np.unique(pair):
        of = change[pair == i]
        yield of[of >= 0], ~of[of < 0]


def fit(y: np.ndarray, x: list[np.ndarray], pairs: list[tuple[np.ndarray, np.ndarray]], *, l1: float = 1e-4,
        counterfactual: float = 5.0, min_docs: int = 3, least_z: float = 4.0, steps: int = 300) -> dict:
    """Weights by bucket and the bias; ``pairs``: buckets of a sentence, and of it with identity words swapped.

    Buckets take part if their share differs between the classes by
    ``least_z`` standard errors; then accelerated proximal gradient on
    partly class-balanced log loss + ``counterfactual`` * mean squared change of the
    margin under the swap + ``l1`` * sum of absolute weights."""
    if len(y) == 0 or y.min() == y.max():
        share = float(np.mean(y)) if len(y) else 0.0
        share = min(max(share, 1e-6), 1 - 1e-6)
        return {"buckets": np.empty(0, np.int64), "weights": np.empty(0), "bias": float(np.log(share / (1 - share))),
                "n_pairs": len(pairs)}
    n = len(y)
    ones, zeros = (np.bincount(np.concatenate([*(s for s, c in zip(x, y, strict=True) if c == k),
                                               np.empty(0, np.int32)]).astype(np.int64), minlength=BUCKETS)
                   for k in (1, 0))
    n1, n0 = int((y == 1).sum()), int((y == 0).sum())
    pooled = (ones + zeros + 0.5) / (n + 1)
    z = np.abs(ones / n1 - zeros / n0) / np.sqrt(pooled * (1 - pooled) * (1 / n1 + 1 / n0))
    used = np.flatnonzero((ones + zeros >= min_docs) & (z >= least_z))
    place = np.full(BUCKETS, -1, np.int64)
    place[used] = np.arange(len(used))

    def rows_of(sets):
        cols = [place[np.asarray(s, np.int64)] for s in sets]
        cols = [c[c >= 0] for c in cols]
        return np.repeat(np.arange(len(cols)), [len(c) for c in cols]), np.concatenate([*cols, np.empty(0, np.int64)])

    row, col = rows_of(x)
    prow, pcol = rows_of([a for a, _ in pairs] + [b for _, b in pairs])
    sign = np.where(prow < len(pairs), 1.0, -1.0)  # the swapped half is subtracted
    prow = np.where(prow < len(pairs), prow, prow - len(pairs))
    balance = np.where(y == 1, n1**-0.5, n0**-0.5)  # between even rows and even classes
    balance /= balance.sum()
    m, size = max(1, len(pairs)), len(used)
    lengths = np.bincount(row, minlength=n)
    step = 1.0 / (0.25 * float((balance * (lengths + 1)).sum()) + counterfactual * 2.0 * (
        float(np.bincount(prow, minlength=m).max()) if len(prow) else 0.0) + 1e-9)
    w, b = np.zeros(size), 0.0
    vw, vb, t = w, b, 1.0
    for _ in range(steps):
        margin = np.bincount(row, weights=vw[col], minlength=n) + vb
        slope = balance * (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y)
        grad = np.bincount(col, weights=slope[row], minlength=size)
        if len(pairs):
            change = np.bincount(prow, weights=sign * vw[pcol], minlength=m)
            grad += 2 * counterfactual / m * np.bincount(pcol, weights=sign * change[prow], minlength=size)
        new = vw - step * grad
        new = np.sign(new) * np.maximum(np.abs(new) - step * l1, 0)
        nb = vb - step * float(slope.sum())
        nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        vw, vb = new + (t - 1) / nt * (new - w), nb + (t - 1) / nt * (nb - b)
        w, b, t = new, nb, nt
    kept = np.flatnonzero(w)
    return {"buckets": used[kept], "weights": w[kept], "bias": float(b), "n_pairs": len(pairs)}


class Scorer:
    """Margins by the model; remembers which buckets of a word carry weight."""

    def __init__(self, model: dict, memory: int = 200_000):
        self.weights = dict(zip(model["buckets"].tolist(), model["weights"].tolist(), strict=True))
        self.bias, self.memory, self.seen = model["bias"], memory, {}

    def hits(self, word: str) -> tuple[int, ...]:
        if len(self.seen) >= self.memory:
            self.seen.clear()
        out = self.seen[word] = tuple(b for b in map(bucket, stems({word})) if b in self.weights)
        return out

    def margin(self, text: str | None) -> float:
        found, seen = set(), self.seen
        for word in words(text):
            found.update(seen[word] if word in seen else self.hits(word))
        return self.bias + sum(self.weights[b] for b in sorted(found))


def train(docs: DataFrame, labels: DataFrame, *, rows: int = SAMPLE_ROWS, groups=IDENTITY_TERMS, **how) -> dict:
    """Fit on the sample; its features (2 * ``rows`` short arrays) come to the driver."""
    small_batches(docs.sparkSession)
    found = collected(sampled(docs, labels, "toxic", MODULUS, HELD_OUT, rows).mapInPandas(
        _training_rows(swaps(groups)), "doc_id long, key long, y int, x array<int>, pair array<int>, change array<int>"))
    y, x, pair, change = found["y"].to_numpy().astype(np.float64), *(arrays(found[c]) for c in ("x", "pair", "change"))
    seen: set[bytes] = set()  # copies would count as evidence
    once = [i for i, v in enumerate(x) if not (v.tobytes() in seen or seen.add(v.tobytes()))]
    return fit(y[once], [x[i] for i in once], [p for i in once for p in _pairs_of(pair[i], change[i])], **how)


def scorer(model: dict):
    """The model as a column function of the text: 0 to 1."""
    @F.pandas_udf(DoubleType())
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(model)
        for batch in batches:
            z = np.array([scorer.margin(t) for t in batch], np.float64)
            yield pd.Series(1 / (1 + np.exp(-np.clip(z, -50, 50))))

    return score


def classify(docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """``doc_id, held_out, score, predicted, n_pairs`` of every document (``n_pairs``: sentences swapped in the fit)."""
    model = train(docs, labels, **how)
    score = scorer(model)
    return (docs.select("doc_id", (id_remainder("doc_id", MODULUS) == HELD_OUT).alias("held_out"),
                        score("text").alias("score"))
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
            .withColumn("n_pairs", F.lit(model["n_pairs"]).cast("long")))


def without_toxic(docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` that score below 0.5."""
    score = scorer(train(docs, labels, **how))
    return docs.select("*", score("text").alias("__score")).where("__score < 0.5").drop("__score")
