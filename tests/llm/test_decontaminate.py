import math
import random
from collections import Counter

import numpy as np
import pytest

from helpers import odd_rows, table, vocabulary
from incidentlab.llm.decontaminate import B, K1, PASSAGE, STRIDE, Index, _passes, _words, find_contamination, question_and_answer


def make(seed=3, n_items=60, n_docs=40):
    rng = random.Random(seed)
    words, common = vocabulary(1500, seed), ["the", "of", "and", "is"]

    def sentence(k):
        return " ".join(rng.choice(common) if rng.random() < 0.4 else rng.choice(words) for _ in range(k)).capitalize() + "."

    items = [(i, " ".join(sentence(rng.randint(4, 16)) for _ in range(rng.randint(1, 9)))) for i in range(n_items)]
    docs, planted = [], set()
    for d in range(n_docs):
        parts = [sentence(rng.randint(5, 20)) for _ in range(rng.randint(1, 30))]
        if d % 3 == 0:
            i = rng.randrange(n_items)
            text = items[i][1]
            parts.insert(rng.randint(0, len(parts)), text.upper() if d % 2 else text.replace(" ", "\n### "))
            planted.add((d, i))
        docs.append((d, " ".join(parts)))
    return items, docs, planted


def test_wand_equals_scoring_everything():
    items, docs, _ = make()
    for share in (0.5, 0.2, 0.05):
        index = Index(items, share)
        segments, plain = [], []
        for _, text in items:
            question, answer = question_and_answer(text)
            for t in [text, question] if answer else [text]:
                h = _words([t]).hash
                own = np.array_split(h, -(-len(h) // 32)) if len(h) else []
                segments += own
                plain += own if t is text else []
        segments.sort(key=len)  # the index numbers segments by length
        mean = np.mean([len(s) for s in plain])
        df = Counter(t for s in plain for t in set(s.tolist()))

        def part(t, s, tf):
            idf = math.log1p((len(plain) - df[t] + 0.5) / (df[t] + 0.5))
            return idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(s) / mean))

        counts = [Counter(s.tolist()) for s in segments]
        best = [sum(part(t, s, tf) for t, tf in c.items()) for s, c in zip(segments, counts)]
        for _, text in docs:
            h = _words([text]).hash
            for a in range(0, len(h), STRIDE):
                own = set(h[a : a + PASSAGE].tolist())
                want = {}
                for k, (s, c) in enumerate(zip(segments, counts)):
                    score = sum(part(t, s, tf) for t, tf in c.items() if t in own) / (share * best[k])
                    if score >= 1 - 1e-9:
                        want[k] = score
                term = np.minimum(np.searchsorted(index.vocabulary, h), len(index.vocabulary) - 1)
                found = index.retrieve(term, index.vocabulary[term] == h, np.array([a]), np.array([min(a + PASSAGE, len(h))]))
                got = {segment: score for _, segment, score in found}
                assert got.keys() == want.keys()
                assert all(abs(got[k] - want[k]) < 1e-6 for k in want)


@pytest.mark.parametrize("block_items", [20_000, 13])
def test_planted_items_are_found(spark, block_items):
    items, docs, planted = make()
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = find_contamination(table(spark, docs), bench, block_items=block_items)
    assert got.columns.count("matches") == 1
    found = {(r.doc_id, m.item_id) for r in got.collect() for m in r.matches}
    assert found == planted


def test_blocks_do_not_change_scores(spark):
    items, docs, _ = make()
    items.append((99, " ".join(w for _, t in items[:40] for w in t.split())))  # one very long item
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs.append((99, items[-1][1]))
    docs += [(100 + i, " ".join(t.split()[2:])) for i, t in items if 15 <= len(t.split()) <= 32]  # partial scores

    def found(**bounds):
        got = find_contamination(table(spark, docs), bench, **bounds).collect()
        assert len(got) == len(docs)
        return {(r.doc_id, m.item_id): tuple(m)[1:] for r in got for m in r.matches}

    whole = found()
    assert (99, 99) in whole and sum(m[0] < 0.99 for m in whole.values()) > 2
    assert found(block_items=13) == found(block_words=700) == found(block_items=20, block_words=900) == whole
    assert found(block_items=13, pass_bytes=1) == found(block_items=13, pass_bytes=20_000) == whole


def test_passes():
    assert _passes([(1, 5), (2, 5), (3, 1), (7, 20), (8, 1)], 10) == [[1, 2], [3], [7], [8]]
    assert _passes([], 10) == []


def test_many_blocks_read_the_documents_once(spark, tmp_path):
    """10,000 items in ten blocks: one scan, no join, no shuffle of documents."""
    words = vocabulary(9000, 31)
    items = [(f"item-{i}", " ".join(words[(i * 7 + 13 * j * (1 + i % 5)) % 9000] for j in range(20))) for i in range(10_000)]
    path = str(tmp_path / "docs")
    table(spark, [(i, f"pre fix {items[i * 97][1]} and more") for i in range(100)] + [(500, "nothing here")]).write.parquet(path)
    got = find_contamination(spark.read.parquet(path), spark.createDataFrame(items, "item_id string, text string"))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Join" not in plan and "Exchange" not in plan
    found = {r.doc_id: {m.item_id for m in r.matches} for r in got.collect()}
    assert found.pop(500) == set() and all(f"item-{d * 97}" in m for d, m in found.items()) and len(found) == 100


def test_passes_do_not_depend_on_splits(spark, tmp_path):
    """Passes planned for other splits than the last reading meet their rows."""
    items, docs, planted = make()
    path = str(tmp_path / "docs")
    table(spark, docs).repartition(40).write.parquet(path)
    bench = spark.createDataFrame(items, "item_id long, text string")
    try:
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", 4)
        got = find_contamination(spark.read.parquet(path), bench, block_items=13, pass_bytes=1)
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", 40)
        assert {(r.doc_id, m.item_id) for r in got.collect() for m in r.matches} == planted
    finally:
        spark.conf.unset("spark.sql.leafNodeDefaultParallelism")


def test_words_between_question_and_answer(spark):
    words, filler = vocabulary(400, 21), vocabulary(4000, 22)
    items = [(i, " ".join(words[28 * i : 28 * i + 14]) + "? " + " ".join(words[28 * i + 14 : 28 * i + 28]) + ".") for i in range(10)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = []
    for i, (_, text) in enumerate(items):
        q, a = text.split("? ")
        for n in (0, 45, 90, 500):
            docs.append((10 * n + i, " ".join([*filler[:i], q, *filler[:n], a, *filler[n : n + 70]])))
        docs.append((9000 + i, " ".join([*filler[:50], q, *filler[50:90]])))  # no answer
        docs.append((9100 + i, " ".join([*filler[:50], a, *filler[50:90]])))  # no question
    got = find_contamination(table(spark, docs), bench).collect()
    assert {r.doc_id: [m.item_id for m in r.matches] for r in got} == {d: [d % 10] if d < 9000 else [] for d, _ in docs}


def test_partial_overlaps_do_not_match(spark):
    item = " ".join(vocabulary(60, 8)) + ". " + " ".join(vocabulary(20, 9)) + "."
    words = item.split()
    rows = [(1, " ".join(words[:40])), (2, " ".join(reversed(words))), (3, item), (4, "x y " * 30 + " ".join(words[2:]))]
    bench = spark.createDataFrame([(5, item), (5, item), (None, None), (6, ""), (7, "...")], "item_id long, text string")
    got = {r.doc_id: [m.item_id for m in r.matches] for r in find_contamination(table(spark, rows), bench).collect()}
    assert got == {1: [], 2: [], 3: [5, 5], 4: [5, 5]}


def test_edges(spark):
    rows = odd_rows()
    bench = spark.createDataFrame([(1, "one two"), (2, "zebra quartz")], "item_id long, text string")
    got = find_contamination(table(spark, rows), bench)
    assert got.count() == len(rows)
    assert {r.doc_id for r in got.collect() if r.matches} == {4}
    assert find_contamination(table(spark, []), bench).count() == 0
    none = find_contamination(table(spark, rows), bench.limit(0))
    assert {len(r.matches) for r in none.collect()} == {0}


def test_question_and_answer():
    assert question_and_answer("What is it? A tree.") == ("What is it?", "A tree.")
    assert question_and_answer("a b c d") == ("a b", "c d")
    assert question_and_answer("One.\nTwo three") == ("One.", "Two three")
    assert question_and_answer("only.") == ("only.", "")


def _plain_matches(docs, items):
    """(document, item) pairs by overlap alone: every pair is looked at, with
    tuples of words, and none of the operator's code but the cut of an item."""
    import re

    def words(t):
        folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", folded)

    def grams(w, n):
        return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}

    found = set()
    for d, text in docs:
        own = words(text)
        five = grams(own, 5)
        for item_id, item in items:
            q, a = (words(t) for t in question_and_answer(item))
            parts = []
            for w in (q, words(item)):
                n = min(5, max(len(w), 1))
                want, held = grams(w, n), five if n == 5 else grams(own, n)
                parts.append(len(want & held) / len(want) if want else 1.0)
            if parts[1] >= 0.8 or (parts[0] >= 0.8 and len(set(a) & set(own)) >= 0.8 * len(set(a))):
                found.add((d, item_id))
    return found


def test_query_against_plain_overlap(spark, monkeypatch):
    from conftest import SF01
    from incidentlab.llm.queries import op5_decontaminate

    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF01}/benchmark.parquet").collect()]
    want = _plain_matches(docs, items)
    got = {(r.doc_id, r.item_id) for r in op5_decontaminate(spark, SF01).collect()}
    assert got == want and len(want) >= 20


def test_nothing_without_retrieval(monkeypatch):
    items, docs, _ = make()
    index = Index(items, 0.6)
    assert any(index.match([t for _, t in docs], 0.6, 0.8))
    monkeypatch.setattr(Index, "retrieve", lambda *a: [])
    assert not any(index.match([t for _, t in docs], 0.6, 0.8))
