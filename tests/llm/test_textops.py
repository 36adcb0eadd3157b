import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
import incidentlab.llm.textops as textops
from helpers import odd_rows, table
from incidentlab.llm.textops import add_text_columns, numbered, slices


def forty_files(spark, path, n=1000):
    rows = [(i % 400, f"word{i % 300} " * (i % 17 + 6)) for i in range(n)]
    table(spark, rows).select("doc_id", "text", "lang", "source", "n_chars").repartition(40).write.parquet(str(path))
    return spark.read.parquet(str(path))


def test_same_number_however_files_are_packed(spark, tmp_path):
    docs = forty_files(spark, tmp_path / "a file %20name")
    seen = []
    for cores in ("4", "40"):
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", cores)
        rows = numbered(docs.filter("doc_id > 3"), "n")
        assert rows.columns == [*docs.columns, "n"]
        seen.append(sorted((r.n, r.doc_id, r.text) for r in rows.collect()))
    spark.conf.unset("spark.sql.leafNodeDefaultParallelism")
    assert seen[0] == seen[1] and len({n for n, *_ in seen[0]}) == len(seen[0]) == docs.filter("doc_id > 3").count()


@pytest.mark.parametrize("stage", [1, 2, 3])
def test_stages_when_the_parallelism_changes_between_readings(spark, tmp_path, stage):
    docs = forty_files(spark, tmp_path / "d")
    spark.conf.set("spark.sql.leafNodeDefaultParallelism", "4")
    out = cp.STAGES[stage][1](spark, docs, "/root/testdata/sf0.001")
    spark.conf.set("spark.sql.leafNodeDefaultParallelism", "40")
    got = sorted(r.doc_id for r in out.collect())
    spark.conf.unset("spark.sql.leafNodeDefaultParallelism")
    same = sorted(r.doc_id for r in cp.STAGES[stage][1](spark, docs, "/root/testdata/sf0.001").collect())
    assert got == same
    if stage == 1:
        best = {}
        for r in docs.collect():
            best[r.text] = max(best.get(r.text, -1), r.doc_id)
        assert got == sorted(best.values())


def test_other_inputs_are_written_once(spark, tmp_path, monkeypatch):
    docs = forty_files(spark, tmp_path / "d", 50)
    for df in (docs.withColumn("x", F.explode(F.array(F.lit(1), F.lit(2)))), docs.distinct(), docs.union(docs), table(spark, odd_rows())):
        rows = numbered(df, "n").collect()
        assert len({r.n for r in rows}) == len(rows) == df.count()
    monkeypatch.setattr(textops, "MAX_FILES", 3)
    rows = numbered(docs, "n")
    assert "incidentlab-scratch" in rows.inputFiles()[0] and rows.select("n").distinct().count() == 50
    assert numbered(table(spark, []), "n").count() == 0


def test_slices_are_bounded():
    texts = ["x" * n for n in (10, 500, 3, 3, 3, 3, 0, 90, 20)] + [None, "y"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["t"])
    parts = [p.column("t").to_pylist() for p in slices(batch, "t", 3, 100)]
    assert [t for p in parts for t in p] == texts
    assert all(len(p) <= 3 and (len(p) == 1 or sum(len(t or "") for t in p) <= 100) for p in parts)


def test_long_texts_together(spark):
    docs = table(spark, [(i, "word " * 300_000) for i in range(12)]).coalesce(1)
    sizes = []

    def start():
        return lambda texts: [[sum(len(t) for t in texts)] * len(texts)]

    got = add_text_columns(docs, "text", "seen long", start, n_bytes=4 << 20).collect()
    sizes = [r.seen for r in got]
    assert len(got) == 12 and max(sizes) <= 4 << 20
