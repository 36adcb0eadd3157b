import datetime as dt

import pytest
from pyspark.sql import functions as F

from incidentlab import sinks, sources
from incidentlab.sources import feeds


def _months(spark, n, tag):
    rows = [(i, tag, 2020 + i % 2, 1 + i % 3) for i in range(n)]
    return spark.createDataFrame(rows, "id int, tag string, year int, month int")


def test_failed_write_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.publish_parquet(_months(spark, 60, "old"), path)

    @F.udf("string")
    def fail(i):
        if i == 37:
            raise ValueError("killed half-way")
        return "new"

    with pytest.raises(Exception, match="killed half-way"):
        sinks.publish_parquet(_months(spark, 60, "x").withColumn("tag", fail("id")), path)
    assert len(list((tmp_path / "t" / "published").iterdir())) == 1
    assert {r.tag for r in sources.read_published(spark, path).collect()} == {"old"}
    sinks.publish_parquet(_months(spark, 70, "new"), path)
    got = sources.read_published(spark, path)
    assert got.count() == 70 and {r.tag for r in got.collect()} == {"new"}
    pruned = sources.read_published(spark, path, months=((2020, 2), (2020, 3)))
    assert {(r.year, r.month) for r in pruned.collect()} <= {(2020, 2), (2020, 3)} and pruned.count() > 0
    assert "PartitionFilters: [isnotnull" in pruned._jdf.queryExecution().executedPlan().toString()


def test_a_short_version_is_not_published(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    sinks.publish_parquet(_months(spark, 6, "old"), path)
    import incidentlab.sinks.writers as writers

    whole = writers.write_partitioned_parquet

    def losing(df, folder, by):
        whole(df, folder, by)
        next(next(p for p in (tmp_path / "t/versions").glob("*") if str(p) == folder).rglob("part-*.parquet")).unlink()

    monkeypatch.setattr(writers, "write_partitioned_parquet", losing)
    with pytest.raises(RuntimeError, match="not published"):
        sinks.publish_parquet(_months(spark, 60, "new"), path)
    assert {r.tag for r in sources.read_published(spark, path).collect()} == {"old"}


def test_quarantine(spark, tmp_path):
    src = str(tmp_path / "raw file")
    _months(spark, 50, "a").repartition(3).write.parquet(src)
    rows = spark.read.parquet(src)
    reason = F.when(F.col("id") % 10 == 0, "tenth").when(F.col("id") == 7, "seven")
    out = str(tmp_path / "out")
    assert sinks.write_with_quarantine(rows, reason, out) == {"good": 44, "rejected": 6, "read": 50}
    table = sources.read_parquet_table(spark, out)
    bad = table.filter("status = 'rejected'").collect()
    assert sorted((r.id, r.reason) for r in bad) == [(0, "tenth"), (7, "seven"), (10, "tenth"), (20, "tenth"), (30, "tenth"), (40, "tenth")]
    assert all("raw" in r.file for r in bad) and table.filter("status = 'good' AND (reason IS NOT NULL OR file IS NOT NULL)").count() == 0
    assert sinks.write_with_quarantine(rows.limit(0), reason, str(tmp_path / "none")) == {"good": 0, "rejected": 0, "read": 0}


def test_moved_and_missing_columns(spark, tmp_path):
    folder = tmp_path / "a folder"
    folder.mkdir()
    (folder / "one.csv").write_text("month,key,n\n2024-01-01,a,5\n")
    (folder / "two.csv").write_text("n,month,key\n7,2024-02-01,b\n8,2024-03-01,c\n")
    (folder / "three.csv").write_text('"key","other","month"\nd,zz,2024-04-01\n')
    (folder / "empty.csv").write_text("")
    schema = "key STRING, month DATE, n INT"
    got = sorted(tuple(r) for r in sources.read_summary_csv(spark, str(folder), schema).collect())
    assert got == [("a", dt.date(2024, 1, 1), 5), ("b", dt.date(2024, 2, 1), 7), ("c", dt.date(2024, 3, 1), 8), ("d", dt.date(2024, 4, 1), None)]
    report = {r.file.rsplit("/", 1)[1]: (r.missing, r.extra, r.moved) for r in sources.header_report(spark, str(folder), schema).collect()}
    assert report == {"one.csv": ([], [], True), "two.csv": ([], [], True), "three.csv": (["n"], ["other"], False)}


def test_headers_are_found_without_sorting_the_lines(spark, tmp_path):
    (tmp_path / "one.csv").write_text("key,n\na,1\n")
    plan = feeds.file_headers(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    scans = [stage for stage in plan.split("Exchange") if "FileScan text" in stage]
    assert scans and not any("Sort" in stage for stage in scans)  # a sort would hold each whole split


@pytest.mark.parametrize("same_marks", [False, True])
def test_headers_that_come_again_as_lines(spark, tmp_path, monkeypatch, same_marks):
    if same_marks:  # every line has the same hash
        monkeypatch.setattr(F, "xxhash64", lambda c: F.length(c) * F.lit(0).cast("bigint"))
    texts = {
        "a": "n,key\n" + "key,n\n" * 40,
        "b": "key,n\n" + "n,key\n" * 40 + "key,n\n",
        "c": "z\n" + "n,key\n" * 300 + "a\n" * 300,
        "d": "a\nz\n",
        "e": '"n","key"\r\nz\r\n',
        "f": "",
    }
    for name, text in texts.items():
        (tmp_path / f"{name}.csv").write_bytes(text.encode())
    for size in ("128m", "512"):  # many files in a task; files in many tasks
        before = spark.conf.get("spark.sql.files.maxPartitionBytes")
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            got = {r.file.rsplit("/", 1)[1][0]: r.header for r in feeds.file_headers(spark, str(tmp_path)).collect()}
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        assert got == {"a": "n,key", "b": "key,n", "c": "z", "d": "a", "e": '"n","key"'}
