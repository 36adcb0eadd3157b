"""Shared fixtures of the training-data operator tests."""

import random
import re

WORD = re.compile("[^\x20\x09-\x0d]+")

#: id, text, and columns whose names clash with internal ones.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, gid int, rid long, matches string, score string"


def table(spark, rows, lang="en"):
    """rows: (doc_id, text); the other columns carry clashing names."""
    full = [(i, t, lang, f"src{(i or 0) % 3}", len(t or ""), 7, 7, "m", "s") for i, t in rows]
    return spark.createDataFrame(full, SCHEMA)


def vocabulary(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n)]


def odd_rows():
    """Nulls, empties, repeated rows, ties and a very long text."""
    long = " ".join(vocabulary(20_000, 5))
    return [(None, None), (1, ""), (2, " \n\t"), (3, None), (3, None), (None, "one"), (None, "one"), (4, "one two"), (5, long), (5, long), (6, long + " end")]
