import hashlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from helpers import WORD, odd_rows, table, vocabulary
from incidentlab.llm import sketch
from incidentlab.llm.substring_dedup import cut_repeats
from incidentlab.llm.textops import Words, window_hashes


def brute(rows, k):
    docs = [WORD.findall(t or "") for _, t in rows]
    seen = Counter(tuple(w[i : i + k]) for w in docs for i in range(len(w) - k + 1))
    out = []
    for (doc_id, _), w in zip(rows, docs):
        gone = set()
        for i in range(len(w) - k + 1):
            if seen[tuple(w[i : i + k])] > 1:
                gone.update(range(i, i + k))
        out.append((doc_id, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=str)


@pytest.mark.parametrize("chunk_bytes", [1 << 22, 300])
def test_matches_brute_force(spark, chunk_bytes):
    words = vocabulary(400, 1)
    rows = []
    rng = np.random.default_rng(0)
    passage = " ".join(words[:60])
    for i in range(60):
        own = " ".join(rng.choice(words, 80))
        rows.append((i, f"{own}\n{passage}\t{own[:100]}" if i % 4 == 0 else own))
    rows += [(100, rows[0][1]), (101, "a b " * 60)]  # a copy; repeats inside one text
    got = cut_repeats(table(spark, rows), window=35, chunk_bytes=chunk_bytes)
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept_text"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, 35)


def test_edges(spark):
    rows = odd_rows()
    got = cut_repeats(table(spark, rows), window=35, chunk_bytes=10_000)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, 35)


def test_empty_table(spark):
    got = cut_repeats(table(spark, []), window=35)
    assert got.count() == 0 and dict(got.dtypes)["doc_id"] == "bigint"


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aBé  \n\t\x0b\x0c\x1c", max_size=30)), max_size=8))
def test_words_are_the_contracts(texts):
    w = Words(texts)
    want = [WORD.findall(t or "") for t in texts]
    assert w.count.tolist() == [len(x) for x in want]
    flat = [x for own in want for x in own]
    assert len(set(w.hash.tolist())) == len(set(flat))
    assert [bytes(w.buf[a:b]).decode() for a, b in zip(w.start, w.end)] == flat


def test_window_hashes_tell_sequences_apart():
    w = Words([" ".join(vocabulary(500, 3)[:7] * 60)]).hash
    for k in (1, 2, 3, 5, 35):
        h = window_hashes(w, k)
        keys = [tuple(w[i : i + k].tolist()) for i in range(len(w) - k + 1)]
        assert len(h) == len(keys) and len(set(h.tolist())) == len(set(keys))


def test_sketch_never_underestimates_and_exact_counts_are_exact():
    rng = np.random.default_rng(2)
    parts = [rng.integers(0, 3000, 4000).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) for _ in range(3)]
    true = Counter(np.concatenate(parts).tolist())
    import pandas as pd

    for shards in (1, 5):
        sent = pd.concat([sketch.partial_sketches(g, p, shards) for g, p in enumerate(parts)])
        back = pd.concat([sketch.merge_sketches(x) for _, x in sent.groupby(["shard", "level"])])
        sent = pd.concat([sketch.partial_exact(g, p, p.astype(np.uint32), shards) for g, p in enumerate(parts)])
        exact = pd.concat([sketch.merge_exact(x) for _, x in sent.groupby("shard")])
        for g, p in enumerate(parts):
            want = np.array([min(true[x], 255) for x in p.tolist()])
            assert (sketch.estimates(p, back[back.gid == g], shards) >= want).all()
            assert (sketch.exact_counts(p, p.astype(np.uint32), exact[exact.gid == g]) == want).all()


def test_kept_hash_column(spark):
    from pyspark.sql import functions as F

    row = cut_repeats(table(spark, [(1, " a  b\n")])).select(F.sha2("kept_text", 256)).first()
    assert row[0] == hashlib.sha256(b"a b").hexdigest()
