import hashlib
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from helpers import odd_rows, table
from incidentlab.llm.mixing import replicate, source_rates


def poisson_inverse(rate, u):
    k, term = 0, math.exp(-rate)
    total = term
    while total <= u:
        k += 1
        term *= rate / k
        total += term
    return k


def draw(rate, key, seed=0):
    parts = max(1, math.ceil(rate / 100))
    n = 0
    for j in range(1, parts + 1):
        digest = hashlib.sha256(f"copies:{seed}:{j}:{key}".encode()).hexdigest()
        n += poisson_inverse(rate / parts, int(digest[:13], 16) / 2**52)
    return n


def rows(n=3000):
    return [(i, "x" * (i % 50)) for i in range(n)]


@pytest.mark.parametrize("epochs", [1.0, 0.3, 250.0])
def test_counts_invert_the_distribution(spark, epochs):
    docs = table(spark, rows(600))
    rates = source_rates(docs, epochs=epochs)
    rate = {r.source: r.rate for r in rates.collect()}
    got = Counter(r.doc_id for r in replicate(docs, rates).select("doc_id").collect())
    for i, _ in rows(600):
        assert got[i] == draw(rate[f"src{i % 3}"], i), i


def test_target_weights_are_met(spark):
    docs = table(spark, rows())
    weights = spark.createDataFrame([("src0", 3.0), ("src1", 1.0), ("absent", 5.0)], "source string, weight double")
    mix = replicate(docs, source_rates(docs, weights.filter("source <> 'absent'"), epochs=4.0))
    size = {r.source: r.s for r in mix.groupBy("source").agg(F.sum(F.length("text")).alias("s")).collect()}
    total = sum(len(t) for _, t in rows())
    assert size.keys() == {"src0", "src1"}
    assert abs(size["src0"] / (3 * total) - 1) < 0.1 and abs(size["src1"] / total - 1) < 0.1


def test_mean_and_variance(spark):
    docs = table(spark, [(i, "ab") for i in range(20_000)])
    rates = source_rates(docs, epochs=2.0)
    n = replicate(docs, rates).groupBy("doc_id").count().agg(F.sum("count"), F.sum(F.col("count") ** 2)).first()
    mean = n[0] / 20_000
    assert abs(mean - 2) < 0.05 and abs(n[1] / 20_000 - mean**2 - 2) < 0.12


def test_shuffled_and_complete(spark):
    docs = table(spark, rows(500)).withColumn("copy", F.lit("clash"))
    mix = replicate(docs, source_rates(docs))
    assert mix.columns == [*[c for c in docs.columns if c != "copy"], "copy", "n_copies", "shuffle_key"]
    got = mix.collect()
    assert len({(r.doc_id, r.copy) for r in got}) == len(got)
    assert all(1 <= r.copy <= r.n_copies for r in got)
    per = mix.withColumn("part", F.spark_partition_id()).select("part", "shuffle_key").collect()
    for p in {r.part for r in per}:
        keys = [r.shuffle_key for r in per if r.part == p]
        assert keys == sorted(keys)


def test_edges(spark):
    docs = table(spark, odd_rows()).withColumn("source", F.when(F.col("doc_id") > 2, F.col("source")))
    got = Counter((r.doc_id, r.text) for r in replicate(docs, source_rates(docs, epochs=30.0)).collect())
    assert got[1, ""] > 0  # its source has other, longer texts
    blank = table(spark, [(0, None), (3, ""), (1, "abc")])
    assert {r.source for r in replicate(blank, source_rates(blank, epochs=50.0)).collect()} == {"src1"}
    assert got[5, odd_rows()[8][1]] % 2 == 0  # equal rows get equal draws
    assert replicate(table(spark, []), source_rates(table(spark, []))).count() == 0
