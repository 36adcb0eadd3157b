import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import incidentlab.llm.hard_negatives as hn
from incidentlab.llm.hard_negatives import mine_hard_negatives, strassen

SCHEMA = "vec_id long, embedding array<float>, label int, row long, v string, rank string"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "v", "r") for r in rows], SCHEMA)


def brute(rows, every, k=5):
    used = [
        (i, [math.floor(256 * float(np.float32(x))) for x in v], c)
        for i, v, c in rows
        if i is not None and c is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]

    def dot(a, b):
        return sum(x * y for x, y in zip(a, b))

    out = []
    for a, va, ca in used:
        if a % every:
            continue
        scored = [(-dot(va, v), i, c) for i, v, c in used]
        positives = sorted((s, i) for s, i, c in scored if c == ca and i != a)[:k]
        for ps, p in positives:
            own = sorted((s, i) for s, i, c in scored if c != ca and 80 * -ps <= 100 * -s <= 100 * -ps)[:k]
            out.extend((a, p, r, n, -ps, -s) for r, (s, n) in enumerate(own, 1))
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("shape", [(1, 1, 1), (7, 64, 5), (33, 64, 100), (16, 16, 16), (65, 129, 31), (3, 200, 3)])
def test_strassen_is_exact(shape):
    rng = np.random.default_rng(sum(shape))
    a = rng.integers(-(2**40), 2**40, shape[:2])
    b = rng.integers(-(2**15), 2**15, shape[1:])
    assert (strassen(a, b) == a @ b).all()


def test_strassen_recurses(monkeypatch):
    depth = []
    whole = hn._product
    monkeypatch.setattr(hn, "_product", lambda a, b, levels: depth.append(levels) or whole(a, b, levels))
    strassen(np.ones((64, 64), np.int64), np.ones((64, 64), np.int64))
    assert depth.count(0) == 7**3


@pytest.mark.parametrize("blocks", [(512, 4096), (3, 17)])
def test_matches_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(hn, "ANCHOR_BLOCK", blocks[0])
    monkeypatch.setattr(hn, "CANDIDATE_BLOCK", blocks[1])
    rng = random.Random(3)
    centre = [[rng.gauss(0, 1) for _ in range(12)] for _ in range(3)]
    rows = []
    for i in range(240):
        c = rng.randrange(3)
        rows.append((i, [0.3 + x + rng.gauss(0, 0.4) for x in centre[c]], c))
    rows += [(1000 + i, rows[0][1], i % 2) for i in range(40)]  # ties
    want = brute(rows, 20)
    assert len(want) > 50
    assert got(mine_hard_negatives(table(spark, rows).repartition(5), is_anchor=F.col("vec_id") % 20 == 0)) == want


def test_edges(spark):
    v = [0.5, 0.25, 0.125]
    rows = [(None, v, 1), (0, v, None), (1, None, 1), (2, [0.5, None, 1.0], 1), (3, [0.5, float("nan"), 1.0], 1)]
    rows += [(4, [0.5, float("inf"), 1.0], 1), (5, [], 1), (6, [0.5], 2), (10, v, 1), (10, v, 1), (11, v, 1), (12, v, 2)]
    rows += [(20, [-0.5, 0.0, 0.0], 1), (30, [1e30, -1e30, 0.0], 3), (31, [1e30, 0.0, 0.0], 3)]
    plain = [r for r in rows if r[0] not in (30, 31)]
    assert got(mine_hard_negatives(table(spark, plain), is_anchor=F.col("vec_id") % 10 == 0)) == brute(plain, 10)
    assert mine_hard_negatives(table(spark, rows)).count() >= 0
    assert mine_hard_negatives(table(spark, [])).count() == 0
    assert mine_hard_negatives(table(spark, rows[:1])).count() == 0
