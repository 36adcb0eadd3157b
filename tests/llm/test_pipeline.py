from collections import Counter

import corpus_pipeline as cp
from conftest import SF001
from helpers import odd_rows, table
from test_decontaminate import _plain_matches
from test_mixing import draw
from test_ngram_join import brute


def reread(spark, df, path):
    df.write.parquet(str(path))
    return spark.read.parquet(str(path))


def test_stages_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    columns = docs.columns
    items = [tuple(r) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").select("item_id", "text").collect()]
    for i, (name, stage) in enumerate(cp.STAGES):
        before = {r.doc_id: r for r in docs.collect()}
        out = stage(spark, docs, SF001)
        if i < 4:
            assert out.columns == columns
            docs = reread(spark, out, tmp_path / str(i))
            after = {r.doc_id: r for r in docs.collect()}
            assert all(before[k] == r for k, r in after.items())
        if i == 0:  # plain prose stays
            assert len(after) == len(before)
        elif i == 1:
            best = {}
            for r in before.values():
                best[r.text] = max(best.get(r.text, r.doc_id), r.doc_id)
            assert set(after) == set(best.values()) and len(after) < len(before)
        elif i == 2:
            want, groups = brute([(k, r.text) for k, r in before.items()], 5, 80)
            assert set(after) == {c for _, _, c in want} and len(after) == groups < len(before)
        elif i == 3:
            held = {d for d, _ in _plain_matches([(k, r.text) for k, r in before.items()], items)}
            assert set(after) == set(before) - held
            assert len(after) < len(before)
        else:
            sizes = Counter()
            for r in before.values():
                sizes[r.source] += len(r.text)
            weight = {s: n**0.7 for s, n in sizes.items()}
            rate = {s: weight[s] / sum(weight.values()) * sum(sizes.values()) / n for s, n in sizes.items()}
            got = Counter(r.doc_id for r in out.collect())
            assert got == Counter({k: n for k, r in before.items() if (n := draw(rate[r.source], k))})
    assert Counter(r.doc_id for r in cp.run(spark, SF001).collect()) == got


def test_odd_and_empty_tables(spark, tmp_path):
    for n, rows in enumerate((odd_rows(), [])):
        docs = reread(spark, table(spark, rows).select("doc_id", "text", "lang", "source", "n_chars"), tmp_path / f"{n}")
        for i, (_, stage) in enumerate(cp.STAGES):
            docs = reread(spark, stage(spark, docs, SF001), tmp_path / f"{n}-{i}")
        assert rows or docs.count() == 0
