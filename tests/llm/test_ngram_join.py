import random

import pytest

from helpers import WORD, odd_rows, table, vocabulary
from incidentlab.llm.components import connected_components
from incidentlab.llm.ngram_join import ngram_jaccard_join


def fold(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def brute(rows, n, percent):
    sets = []
    for _, t in rows:
        w = WORD.findall(fold(t))
        sets.append({tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            k = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * k >= percent * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    smallest = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            smallest[find(i)] = min(smallest.get(find(i), doc_id), doc_id)
    return sorted(((d, len(sets[i]), smallest.get(find(i))) for i, (d, _) in enumerate(rows)), key=str), len(
        {find(i) for i in range(len(rows))}
    )


def families(seed, n_families=6, size=25, length=150):
    """Near copies around the threshold, plus a shared passage everywhere."""
    rng = random.Random(seed)
    words = vocabulary(3000, seed)
    shared = [rng.choice(words) for _ in range(20)]
    rows, i = [], 0
    for f in range(n_families):
        base = shared + [rng.choice(words) for _ in range(length)]
        for _ in range(size):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3, 4, 6])):
                own[rng.randrange(len(own))] = rng.choice(words).upper() if rng.random() < 0.3 else rng.choice(words)
            rows.append((i, " ".join(own)))
            i += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("n,percent", [(3, 90), (5, 80)])
@pytest.mark.parametrize("limits", [{}, {"chunk_bytes": 5000, "block_ngrams": 1500}])
def test_matches_brute_force(spark, tmp_path, n, percent, limits):
    rows = families(n) + [(1000 + i, t) for i, t in enumerate(["A b", "a B", "a", "", "a b c", "a b c d"])]
    got = ngram_jaccard_join(table(spark, rows), n, percent, **limits)
    want, groups = brute(rows, n, percent)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()), key=str) == want
    assert got.filter("kept").count() == groups


def test_edges(spark):
    rows = odd_rows()
    got = ngram_jaccard_join(table(spark, rows), 3, 90).collect()
    want, _ = brute(rows, 3, 90)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == want
    # Rows without words stay, each of them; of the others one per group.
    assert sum(r.kept for r in got) == 5 + 3


def test_empty_table(spark):
    assert ngram_jaccard_join(table(spark, [])).count() == 0


def test_hot_copies_and_chain(spark):
    """Many copies of one text, and a chain whose ends do not link."""
    words = vocabulary(500, 9)
    chain = [" ".join(words[i * 3 : i * 3 + 100]) for i in range(12)]
    rows = [(i, chain[0]) for i in range(300)] + [(1000 + i, c) for i, c in enumerate(chain)]
    got = ngram_jaccard_join(table(spark, rows).repartition(7), 3, 90, chunk_bytes=3000)
    want, _ = brute(rows, 3, 90)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()), key=str) == want
    assert len({w[2] for w in want}) == 1


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 470)]
    edges += [(500, x) for x in range(501, 600)] + [(7, 7), (None, 3)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    assert got == {x: find(x) for x in list(parent)}


def test_components_empty(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_large_family_is_sent_a_fixed_number_of_times(spark, monkeypatch):
    """Near copies of one text in many blocks, with some that only link through others."""
    import incidentlab.llm.ngram_join as nj

    rng = random.Random(8)
    words = vocabulary(2000, 8)
    base = [rng.choice(words) for _ in range(120)]
    rows = []
    for i in range(500):
        own = list(base)
        own[rng.randrange(120)] = rng.choice(words[:40])
        rows.append((i, " ".join(own)))
    far = base[:100] + [rng.choice(words) for _ in range(20)]
    rows += [(600 + i, " ".join(far[:99] + [words[i], *far[100:]])) for i in range(5)]
    sent = []
    whole = nj._join
    monkeypatch.setattr(nj, "_join", lambda groups, by, percent: sent.append(groups.count()) or whole(groups, by, percent))
    got = ngram_jaccard_join(table(spark, rows).repartition(4), 3, 90, block_ngrams=2000)
    want, _ = brute(rows, 3, 90)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()), key=str) == want
    assert len(sent) == 4 and sum(sent) < 3 * len(rows)
