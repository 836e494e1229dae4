"""Small tables for the tests of the training-data operators."""

from __future__ import annotations

import random

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"

#: A column of each kind that operators might use inside, and names that differ in case only.
CLASHING = ("uid", "size", "label", "TEXT", "score", "h", "part", "word", "pos", "a", "b", "key", "value", "_c0")


def documents(spark, rows, clashing=False):
    """Rows of (doc_id, text[, lang[, source]]) as a documents table."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "src0", len(r[1]) if r[1] is not None else None) for r in rows]
    if not clashing:
        return spark.createDataFrame(full, DOCUMENTS)
    extra = [(*r, *("x" for _ in CLASHING)) for r in full]
    return spark.createDataFrame(extra, DOCUMENTS + "".join(f", `{c}` string" for c in CLASHING))


def write_table(df, folder, name):
    df.write.parquet(f"{folder}/{name}.parquet")
    return folder


def prose(seed: int, n: int, vocabulary: int = 400) -> str:
    """Invented words, the frequent ones first."""
    r = random.Random(seed)
    return " ".join("w%d" % int(vocabulary * r.random() ** 2) for _ in range(n))


def edited(text: str, seed: int, changes: int) -> str:
    r = random.Random(seed)
    words = text.split()
    for _ in range(changes):
        words[r.randrange(len(words))] = "z%d" % r.randrange(10**6)
    return " ".join(words)


def collect(df):
    return [r.asDict(recursive=True) for r in df.collect()]
