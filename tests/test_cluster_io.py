import random
import math
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from incidentlab import sinks, sources
from incidentlab.operators import cluster, maplayer
from incidentlab.schemas import STREET_HEADER, STREET_RAW


def test_assign_nearest_brute_force(spark):
    pts = spark.createDataFrame([(0.1, 0.1), (5.0, 5.2), (2.5, 2.5), (None, 1.0), (9.0, 0.0)], "latitude double, longitude double")
    cents = spark.createDataFrame([(0, 0.0, 0.0), (1, 5.0, 5.0), (2, 9.0, 1.0)], "prediction int, latitude double, longitude double")
    got = [r["prediction"] for r in cluster.assign_nearest(pts, cents).collect()]
    # (2.5, 2.5) is equidistant from centres 0 and 1: the smaller id wins.
    assert got == [0, 1, 0, None, 2]


def test_kmeans_invariants(spark):
    rows = [(float(x % 5) + (0.01 * i), float(x // 5)) for i, x in enumerate(range(200))]
    df = spark.createDataFrame(rows, "latitude double, longitude double").withColumn("id", F.monotonically_increasing_id())
    model = cluster.fit_kmeans(df, k=4, seed=42)
    out = cluster.kmeans_assign(df, model)
    assert set(out.columns) >= {"latitude", "longitude", "id", "features", "prediction"}  # D4: inputs kept
    centres = model.clusterCenters()
    assert len(centres) <= 4
    for r in out.select("latitude", "longitude", "prediction").collect():
        d = [math.dist((r[0], r[1]), c) for c in centres]
        assert d[r[2]] == pytest.approx(min(d), abs=1e-9)


def test_map_layer_columns(spark):
    fc = spark.createDataFrame([(0, "2024-01-01", 10.0), (1, "2024-01-01", 40.0), (2, "2024-01-01", 5.0)], "prediction int, date string, forecast double")
    fc = fc.withColumn("date", F.to_date("date"))
    cents = spark.createDataFrame([(0, 51.5, -0.1), (1, 51.6, -0.2)], "prediction int, centroid_lat double, centroid_lon double")
    rows = {r["prediction"]: r for r in maplayer.map_layer(fc, cents).collect()}
    assert set(rows) == {0, 1}  # inner join
    assert rows[1]["intensity"] == 1.0 and rows[0]["radius"] == 6.0
    assert rows[0]["popup"] == "Cluster 0<br>2024-01-01: 10"
    zero = maplayer.map_layer(fc.withColumn("forecast", F.lit(0.0)), cents).collect()
    assert {r["intensity"] for r in zero} == {0.0}


def test_csv_feed_header_checked_and_typed(spark):
    base = tempfile.mkdtemp(prefix="feed-")
    os.makedirs(os.path.join(base, "2024-01"))
    with open(os.path.join(base, "2024-01", "2024-01-street.csv"), "w") as fh:
        fh.write(",".join(STREET_HEADER) + "\n")
        fh.write("abc,2024-01,Force,Force,-0.12,51.5,Here,E01,Area,Burglary,,\n")
        fh.write("def,2024-13,Force,Force,n/a,0.4,Here,E02,Area,Drugs,,\n")
    df = sources.ingest_feed(spark, "street", f"{base}/*/*-street.csv")
    rows = sorted(df.collect(), key=lambda r: r["crime_id"])
    assert rows[0]["longitude"] == -0.12 and rows[0]["year"] == 2024 and rows[0]["month"] == 1
    assert rows[1]["longitude"] is None and rows[1]["date"] is None  # malformed -> null
    assert "crime_type" in df.columns and df.schema["latitude"].dataType.typeName() == "double"
    raw = sources.read_feed(spark, f"{base}/*/*-street.csv", STREET_RAW)
    assert raw.count() == 2


def test_partitioned_parquet_prunes_months(spark):
    rows = [(i, 2024, m) for i in range(20) for m in (1, 2, 3)]
    df = spark.createDataFrame(rows, "id int, year int, month int")
    path = sinks.write_partitioned_parquet(df, tempfile.mkdtemp(prefix="pq-") + "/t")
    sub = sources.read_parquet_table(spark, path, months=((2024, 2), (2024, 3)))
    assert sub.count() == 40
    plan = sub._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "month" in plan


@pytest.mark.parametrize("session_mode", ["static", "dynamic"])
def test_overwrite_mode_is_the_writes_own(spark, session_mode):
    rows = [(i, 2024, m) for i in range(20) for m in (1, 2)]
    df = spark.createDataFrame(rows, "id int, year int, month int")
    path = tempfile.mkdtemp(prefix="pq-") + "/t"
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", session_mode)
    try:
        sinks.write_partitioned_parquet(df, path)
        sinks.write_partitioned_parquet(df.filter("month = 1 AND id < 5"), path)
        assert {(r[0], r[1]) for r in spark.read.parquet(path).groupBy("month").count().collect()} == {(1, 5)}
        sinks.write_partitioned_parquet(df.filter("month = 2 AND id < 3"), path, overwrite="dynamic")
        assert {(r[0], r[1]) for r in spark.read.parquet(path).groupBy("month").count().collect()} == {(1, 5), (2, 3)}
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)
    with pytest.raises(ValueError):
        sinks.write_partitioned_parquet(df, path, overwrite="append")


def test_assign_nearest_many_centres(spark):
    cents = spark.range(1000).selectExpr("cast(id as int) prediction", "cast(id as double) latitude", "0.0D longitude")
    pts = spark.range(1000).selectExpr("id + 0.2D latitude", "1.0D longitude", "cast(id as int) want")
    assert cluster.assign_nearest(pts, cents).filter("prediction <> want").count() == 0
    assert cluster.assign_nearest(pts, cents.limit(0)).filter("prediction IS NOT NULL").count() == 0


def test_single_csv_round_trip(spark):
    df = spark.createDataFrame([("a", 3), ("b", 5)], "k string, count bigint")
    path = sinks.write_single_csv(df, tempfile.mkdtemp(prefix="csv-") + "/s")
    assert len([f for f in os.listdir(path) if f.endswith(".csv")]) == 1
    typed = sources.read_summary_csv(spark, path, "k STRING, count BIGINT")
    assert sorted(tuple(r) for r in typed.collect()) == [("a", 3), ("b", 5)]
    text = sources.read_summary_text(spark, path)
    assert dict(text.dtypes)["count"] == "bigint"


def test_centres_do_not_depend_on_the_layout(spark):
    rng = random.Random(5)
    rows = [(51 + rng.gauss(0, 0.1) + i % 4, -1 + rng.gauss(0, 0.1) - i % 3, f"r{i}") for i in range(2000)]
    rows += [(51.5, -1.25, "hot")] * 700 + [(None, 1.0, "n"), (float("nan"), 1.0, "n")]
    df = spark.createDataFrame(rows, "latitude double, longitude double, tag string")
    seen = [sorted(tuple(r) for r in cluster.fit_centres(df.repartition(n), k=6, seed=42).collect()) for n in (1, 4, 40)]
    assert seen[0] == seen[1] == seen[2] and len(seen[0]) == 6
    centres = cluster.fit_centres(df, k=6, seed=42)
    placed = cluster.assign_centres(df, centres)
    assert placed.count() == 2700 and placed.columns == [*df.columns, "prediction"]
    at = {r["prediction"]: (r["latitude"], r["longitude"]) for r in centres.collect()}
    cost = 0.0
    for r in placed.collect():
        d = [(r["latitude"] - a) ** 2 + (r["longitude"] - b) ** 2 for _, (a, b) in sorted(at.items())]
        assert d[r["prediction"]] <= min(d) + 1e-9
        cost += min(d)
    ml = cluster.fit_kmeans(df.filter("NOT isnan(latitude)"), k=6, seed=42)
    assert cost < 1.5 * ml.summary.trainingCost
    assert cluster.fit_centres(df, k=6, seed=7).collect() != centres.collect()


def test_fewer_points_than_centres(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 2.0), (3.0, 4.0)], "latitude double, longitude double")
    assert sorted(tuple(r)[1:] for r in cluster.fit_centres(df, k=8).collect()) == [(1.0, 2.0), (3.0, 4.0)]
    assert cluster.fit_centres(df.limit(0), k=8).count() == 0
    assert cluster.assign_centres(df.limit(0), cluster.fit_centres(df, k=2)).count() == 0
