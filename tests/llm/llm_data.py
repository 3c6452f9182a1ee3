"""Small document tables with the awkward cases every operator must handle."""

from __future__ import annotations

import random

WORDS = [f"{a}{b}" for a in ("ba", "ce", "di", "fo", "gu", "ha", "je", "ki") for b in ("ra", "lo", "mi", "nu", "pe", "sta")]


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + str(rng.randrange(50)) for _ in range(n))


def edited(rng: random.Random, text: str, edits: int) -> str:
    words = text.split(" ")
    for _ in range(edits):
        words[rng.randrange(len(words))] = "x" + str(rng.randrange(10**9))
    return " ".join(words)


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside, as columns of the input.
CLASHING = ("row", "node", "component", "hits", "spans", "score", "epoch", "words_taken", "size", "key", "id", "k1")


def documents(spark, texts, sources=None, ids=None, clashing=False):
    ids = ids if ids is not None else range(len(texts))
    rows = [(i, t, None, (sources[k] if sources else "s"), None if t is None else len(t)) for k, (i, t) in enumerate(zip(ids, texts))]
    df = spark.createDataFrame(rows, SCHEMA)
    if clashing:
        from pyspark.sql import functions as F
        for c in CLASHING:
            df = df.withColumn(c, F.lit(7))
    return df


def awkward(rng: random.Random) -> list:
    """Null, empty, blank, one word, repeated and very long texts."""
    long = prose(rng, 30_000)
    return [None, "", "   \n", "word", "word", prose(rng, 3), prose(rng, 40), long, long, "é" * 5000, "a" * 50_000, prose(rng, 300)]
