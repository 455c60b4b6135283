"""Small tables with the awkward cases every corpus operator has to bear."""

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, uid string, row string, shard string, "
          "score string, size string, label string")


def docs(spark, rows):
    """``rows``: (doc_id, text[, source]); extra columns clash with names used inside."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", 0, "u", "r", "s", "x", "z", "l") for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def awkward():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(40)]
    long = " ".join(rng.choice(words) for _ in range(6000))
    return [(1, None), (2, ""), (3, " \n\t "), (4, "a b c d e f"), (4, "a b c d e f"), (None, "x y z"), (None, None),
            (5, long), (6, "Über Straße ÀÉ 漢字 and more"), (7, "A B C D E F"), (8, "the " * 300), (9, "one")]


def vocabulary_texts(n, seed, words=60, least=5, most=40):
    rng = random.Random(seed)
    vocab = [f"v{i}" for i in range(words)]
    return [" ".join(rng.choice(vocab) for _ in range(rng.randint(least, most))) for _ in range(n)]
