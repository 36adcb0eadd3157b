"""End-to-end stages on the sf0.001 driver tables written out as raw feeds,
and the incremental (streaming) ingest."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from incidentlab.plans import stages
from incidentlab.sources.standins import RAW_FEEDS
from incidentlab.streaming import ingest_new_files


def _write_raw(spark, base):
    for feed, make in RAW_FEEDS.items():
        raw = make(spark, SF001)
        # Spark names its own part files; link them into <base>/<yyyy-MM>/<yyyy-MM>-<i>-<feed>.csv.
        out = f"{base}/tmp-{feed}"
        raw.withColumn("folder", F.substring(F.col(raw.columns[1]), 1, 7)).write.partitionBy("folder").option(
            "header", True
        ).csv(out)
        for d in os.listdir(out):
            if not d.startswith("folder="):
                continue
            month = d.split("=", 1)[1]
            os.makedirs(f"{base}/{month}", exist_ok=True)
            for i, f in enumerate(x for x in os.listdir(f"{out}/{d}") if x.endswith(".csv")):
                os.link(f"{out}/{d}/{f}", f"{base}/{month}/{month}-{i}-{feed.replace('_', '-')}.csv")


@pytest.fixture(scope="module")
def lake(spark):
    root = tempfile.mkdtemp(prefix="lake-")
    _write_raw(spark, f"{root}/raw")
    return root


def test_stages_end_to_end(spark, lake):
    report = {r["table"]: r for r in stages.ingest(spark, f"{lake}/raw", f"{lake}/processed").collect()}
    li = spark.read.parquet(f"{SF001}/lineitem.parquet").count()
    assert report["street"]["rows"] == li and report["street"]["bad_dates"] == 0 and report["street"]["bad_coordinates"] == 0
    assert report["stop_and_search"]["rows"] == spark.read.parquet(f"{SF001}/events.parquet").count()

    stages.clean_all(spark, f"{lake}/processed", f"{lake}/clean")
    street = spark.read.parquet(f"{lake}/clean/street")
    assert street.filter((F.col("latitude") == 0) | (F.col("longitude") == 0)).count() == 0
    assert street.filter(F.col("crime_type") != F.lower(F.col("crime_type"))).count() == 0

    tables = stages.summaries(spark, f"{lake}/clean")
    assert len(tables) == 11
    # The one-scan grouping-sets summaries equal the direct operators.
    from incidentlab.operators import summary

    def rows(df):
        return sorted(tuple(r) for r in df.collect())

    stops = spark.read.parquet(f"{lake}/clean/stop_and_search")
    assert rows(tables["counts_by_month"]) == rows(summary.count_by(street, "month"))
    assert rows(tables["year_month_trend"]) == rows(summary.year_month_trend(street))
    assert [tuple(r) for r in tables["top10_lsoas"].collect()] == [tuple(r) for r in summary.top_areas(street).collect()]
    assert rows(tables["coordinate_stats"]) == rows(summary.coord_stats(street))
    assert rows(tables["distinct_crime_types"]) == rows(summary.distinct_count(street, "crime_type", "distinct_crime_types"))
    assert rows(tables["counts_by_hour"]) == rows(summary.count_by_hour(stops))
    assert rows(tables["stop_object_counts"]) == rows(summary.count_by(stops, "object_of_search"))
    paths = stages.write_summaries(tables, f"{lake}/eda")
    assert spark.read.option("header", True).csv(paths["crime_type_counts"]).count() == 3
    assert tables["counts_by_hour"].count() > 1  # the time of day survived ingest

    res = stages.outcome_analysis(spark, f"{lake}/clean")
    chi = res["chi_square"].collect()[0]
    assert chi["dof"] > 0 and 0.0 <= chi["p"] <= 1.0

    clusters = stages.hotspots(spark, f"{lake}/clean", f"{lake}/clusters", k=4)
    assert "date" in spark.read.parquet(clusters).columns

    total = stages.total_forecast(spark, f"{lake}/clean")
    assert total["forecast"].count() == 6 and total["metrics"].count() == 1

    per_cluster = stages.cluster_forecast(spark, clusters, horizon=2)
    k = spark.read.parquet(clusters).select("prediction").distinct().count()
    assert per_cluster["forecast"].count() == 2 * k
    assert per_cluster["map_layer"].count() == 2 * k


def test_streaming_ingest_picks_up_new_files(spark, lake):
    out, ckpt = f"{lake}/stream-out", f"{lake}/stream-ckpt"
    months = sorted(d for d in os.listdir(f"{lake}/raw") if d[:2] in ("19", "20"))
    src = tempfile.mkdtemp(prefix="arrivals-")
    os.makedirs(f"{src}/{months[0]}")
    for f in os.listdir(f"{lake}/raw/{months[0]}"):
        if f.endswith("-street.csv"):
            os.link(f"{lake}/raw/{months[0]}/{f}", f"{src}/{months[0]}/{f}")
    ingest_new_files(spark, "street", f"{src}/*/*-street.csv", out, ckpt).awaitTermination()
    first = spark.read.parquet(out).count()
    assert first > 0
    os.makedirs(f"{src}/{months[1]}")
    for f in os.listdir(f"{lake}/raw/{months[1]}"):
        if f.endswith("-street.csv"):
            os.link(f"{lake}/raw/{months[1]}/{f}", f"{src}/{months[1]}/{f}")
    ingest_new_files(spark, "street", f"{src}/*/*-street.csv", out, ckpt).awaitTermination()
    both = spark.read.parquet(out)
    assert both.count() > first
    assert both.select("year", "month").distinct().count() == 2


def test_cli_runs_stages(spark, lake):
    from incidentlab.plans.__main__ import main

    out = tempfile.mkdtemp(prefix="cli-")
    assert main(["ingest", "--raw", f"{lake}/raw", "--processed", f"{out}/processed"]) == 0
    assert main(["clean", "--processed", f"{out}/processed", "--clean", f"{out}/clean"]) == 0
    assert main(["summaries", "--clean", f"{out}/clean", "--out", f"{out}/eda"]) == 0
    assert main(["outcomes", "--clean", f"{out}/clean", "--out", f"{out}/analysis"]) == 0
    assert sorted(os.listdir(f"{out}/eda"))[:2] == ["coordinate_stats", "counts_by_dow"]
    chi = spark.read.option("header", True).csv(f"{out}/analysis/chi_square").collect()[0]
    assert int(chi["dof"]) > 0

