import math
import random
import re
from collections import Counter

import numpy as np
import pytest

import incidentlab.llm.dual_tree as dt
from helpers import odd_rows, table, vocabulary
from incidentlab.llm.dual_tree import Items, Search, _words, parts, rank_documents, weights

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(t):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def brute(rows, items, k=20):
    docs = [(i, Counter(terms(t))) for i, t in rows]
    docs = [(i, c, sum(c.values())) for i, c in docs if c]
    n, total = len(docs), sum(x for *_, x in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    out = []
    for item_id, text in items:
        found = []
        for i, c, size in docs:
            m = 75 + 25 * size * n // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                for t in terms(text)
                if t in c
            )
            if score > 0:
                found.append((-score, i is None, i))
        found = sorted(found, key=lambda f: (f[0], f[1], f[2] or 0))[:k]
        out.extend((item_id, r, f[2], -f[0]) for r, f in enumerate(found, 1))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def corpus(seed, n=300):
    rng = random.Random(seed)
    words = vocabulary(200, seed) + ["Été", "naïve", "x1"]
    zipf = [1 / (r + 1) for r in range(len(words))]
    rows = [(i, "-".join(rng.choices(words, zipf, k=rng.randint(0, 60)))) for i in range(n)]
    items = [(i, ". ".join(rng.choices(words, zipf, k=rng.randint(1, 25)))) for i in range(30)]
    return rows, items + [(100, ""), (101, None), (102, "no-such-word-zzz"), (103, items[0][1]), (103, items[0][1])]


def asked(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("k,options", [(20, {}), (3, {"block_bytes": 700})])
def test_matches_brute_force(spark, k, options):
    rows, items = corpus(4)
    rows += [(1000 + i, rows[7][1]) for i in range(60)]  # copies: ties by id
    docs = table(spark, rows).repartition(5)
    assert got(rank_documents(docs, asked(spark, items), k, **options)) == brute(rows, items, k)


def test_edges(spark):
    _, items = corpus(5)
    rows = odd_rows() + [(9, "\x00"), (10, "tab\tx1"), (None, "x1"), (None, "x1")]
    items = items + [(200, "one two x1 X1 end")]
    assert got(rank_documents(table(spark, rows), asked(spark, items))) == brute(rows, items)
    assert rank_documents(table(spark, []), asked(spark, items)).count() == 0
    assert rank_documents(table(spark, rows), asked(spark, [])).count() == 0


def test_text_ids(spark):
    rows = [(f"d{i % 3}", f"alpha {'beta ' * (i % 4)}") for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    items = spark.createDataFrame([("q", "beta alpha gamma")], "item_id string, text string")
    found = rank_documents(docs, items, 4).orderBy("rank").collect()
    assert [r.item_id for r in found] == ["q"] * 4 and [r.rank for r in found] == [1, 2, 3, 4]
    assert [r.doc_id for r in found[:3]] == ["d0", "d1", "d2"]


def test_prunes_pairs_and_stays_exact(monkeypatch):
    """With rare terms most pairs of nodes fall before single documents are scored."""
    monkeypatch.setattr(dt, "LIKELY", 4)
    rng = random.Random(1)
    common, rare = vocabulary(30, 1), vocabulary(4000, 2)
    rows = [(i, " ".join(rng.choices(common, k=20) + rng.choices(rare, k=10))) for i in range(2000)]
    items = [(i, rows[i * 17][1]) for i in range(64)]
    own, words = Items(items), _words([t for _, t in rows])
    doc, term, tf = own.postings(words)
    weight = weights(len(rows), np.bincount(term, minlength=len(own.vocabulary)))
    search = Search(own, weight, 1, {})
    search.add([(False, i) for i, _ in rows], doc, term, parts(tf, words.count[doc], len(rows), int(words.count.sum())))
    assert sorted((i, 1, d, s) for i, d, s in search.found()) == sorted(brute(rows, items, 1))
    assert search.bounded < len(rows) * len(items) / 2
