import random
from collections import Counter

import numpy as np
import pytest

from helpers import odd_rows, table
from incidentlab.llm.sharding import fisher_yates, shard_documents, write_shards


def check(rows, got, shards):
    assert Counter((r.doc_id, r.text) for r in got) == Counter(rows)
    slots = {s: sorted(r.slot for r in got if r.shard == s) for s in range(shards)}
    assert all(slots[s] == list(range(len(slots[s]))) for s in slots) and {r.shard for r in got} <= set(slots)
    sizes = [len(x) for x in slots.values()]
    assert max(sizes) - min(sizes) <= 1


@pytest.mark.parametrize("shards,bucket_bytes", [(8, 1 << 24), (8, 700), (3, 50), (1, 1000)])
def test_counts_and_slots(spark, tmp_path, shards, bucket_bytes):
    rows = [(i % 50 if i % 3 else None, f"text {i % 7} " * (i % 9)) for i in range(301)]
    table(spark, rows).repartition(5).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    got = shard_documents(docs, shards, bucket_bytes=bucket_bytes)
    assert got.columns == [*docs.columns, "shard", "slot"]
    check(rows, got.collect(), shards)


def test_odd_and_empty_tables(spark):
    check(odd_rows(), shard_documents(table(spark, odd_rows()), 4, bucket_bytes=1000).collect(), 4)
    check([(1, "a")], shard_documents(table(spark, [(1, "a")]), 8).collect(), 8)
    assert shard_documents(table(spark, [])).count() == 0
    clash = spark.createDataFrame([(1, "a", "x", 7), (2, "b", "y", 8)], "doc_id int, text string, shard string, slot int")
    got = shard_documents(clash, 2).collect()
    assert sorted((r.doc_id, r.text) for r in got) == [(1, "a"), (2, "b")] and sorted(r.shard for r in got) == [0, 1]
    with pytest.raises(ValueError):
        shard_documents(clash, 0)


def test_order_by_hand(spark, tmp_path):
    """Bucket by bucket in row order, shuffled by the same draws."""
    rows = [(i, "x" * 9) for i in range(200)]
    table(spark, rows).coalesce(1).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    ids = [r.doc_id for r in docs.collect()]
    got = {(r.shard, r.slot): r.doc_id for r in shard_documents(docs, 4, seed=5, bucket_bytes=500).collect()}
    hashed = spark.range(200).selectExpr("id", "pmod(xxhash64(5, id), 4) AS b").collect()
    want = []
    for b in range(4):
        own = [ids[r.id] for r in hashed if r.b == b]
        want += [own[k] for k in fisher_yates(len(own), 5, b)]
    assert [got[k] for k in sorted(got)] == want


def test_same_order_for_any_layout(spark, tmp_path):
    rows = [(random.Random(i).randrange(20), f"t {i % 11}") for i in range(500)]
    table(spark, rows).repartition(7).write.parquet(str(tmp_path / "d"))
    seen = []
    for size in ("134217728", "3000"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        docs = spark.read.parquet(str(tmp_path / "d"))
        seen.append(sorted((r.shard, r.slot, r.doc_id, r.text) for r in shard_documents(docs, bucket_bytes=300).collect()))
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert seen[0] == seen[1]
    again = sorted((r.shard, r.slot, r.doc_id, r.text) for r in shard_documents(docs, seed=1, bucket_bytes=300).collect())
    assert again != seen[0]


def test_fisher_yates_is_uniform():
    seen = Counter(tuple(fisher_yates(4, 7, b)) for b in range(24_000))
    assert len(seen) == 24 and max(abs(n - 1000) for n in seen.values()) < 160
    assert (np.sort(fisher_yates(1000, 0, 0)) == np.arange(1000)).all() and len(fisher_yates(0, 0, 0)) == 0


def test_written_files(spark, tmp_path):
    rows = [(i, f"text {i}") for i in range(100)]
    write_shards(table(spark, rows), str(tmp_path / "out"), shards=3, bucket_bytes=200)
    assert sorted(p.name for p in (tmp_path / "out").glob("shard=*")) == ["shard=0", "shard=1", "shard=2"]
    check(rows, spark.read.parquet(str(tmp_path / "out")).collect(), 3)


def test_query_against_the_documents(spark):
    import zlib

    from conftest import SF01
    from incidentlab.llm.queries import op11_two_pass_shuffle

    got = op11_two_pass_shuffle(spark, SF01)
    assert got.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    rows = got.collect()
    texts = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    assert all((r.size, r.text_crc32) == (len(texts[r.doc_id]) + 1, zlib.crc32(texts[r.doc_id])) for r in rows)
    assert {(r.law, r.grown_shard) for r in rows} == {("rows", None)}
    for s in range(8):
        own = sorted(r.slot for r in rows if r.shard == s)
        assert own == list(range(len(own))) and len(own) == len(texts) // 8
