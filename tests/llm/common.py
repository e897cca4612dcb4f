"""Small tables for the tests of this folder."""

import random

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def documents(spark, texts, ids=None, extra=""):
    """Rows of the documents table; ``extra`` adds null columns of those names."""
    ids = range(len(texts)) if ids is None else ids
    names = [x for x in extra.split(",") if x]
    rows = [(i, t, "en", "s", None if t is None else len(t), *[None] * len(names)) for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, ", ".join([DOCS, *(f"{x} string" for x in names)]))


def prose(seed, n, words=400):
    draw = random.Random(seed)
    return [f"w{draw.randrange(words)}" for _ in range(n)]


def edited(words, seed, n):
    draw, out = random.Random(seed), list(words)
    for _ in range(n):
        out[draw.randrange(len(out))] = f"new{draw.randrange(10**6)}"
    return out
