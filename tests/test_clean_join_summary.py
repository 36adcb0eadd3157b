import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from incidentlab.operators import clean, join, summary


def test_nonzero_filter_compares_numbers(spark):
    # Text compared with integer 0 would drop '-0.12' and '0.4'.
    rows = [("51.5", "-0.12"), ("0.4", "1.2"), ("0", "0"), ("", "1"), (None, "1")]
    df = spark.createDataFrame(rows, "latitude string, longitude string")
    kept = clean.filter_nonzero_coords(clean.filter_not_null(df, "latitude", "longitude"))
    assert sorted(tuple(r) for r in kept.collect()) == [("0.4", "1.2"), ("51.5", "-0.12")]


def test_clean_geo_dedups_and_filters(spark):
    rows = [(1, 51.5, -0.1), (1, 51.5, -0.1), (1, 51.5, -0.2), (2, 0.0, 1.0), (3, None, 1.0)]
    df = spark.createDataFrame(rows, "id int, latitude double, longitude double")
    assert sorted(tuple(r) for r in clean.clean_geo(df).collect()) == [(1, 51.5, -0.2), (1, 51.5, -0.1)]


def test_normalize_text_only_named_columns(spark):
    df = spark.createDataFrame([("É A ", " B ")], "a string, b string")
    assert tuple(clean.normalize_text(df, ["a"]).collect()[0]) == ("a", " B ")
    with pytest.raises(ValueError):
        clean.normalize_text(df, ["zzz"])


def test_drop_null_variants(spark):
    df = spark.createDataFrame([(1, None), (None, "x"), (2, "y")], "a int, b string")
    assert clean.drop_any_null(df).count() == 1
    assert clean.drop_null_subset(df, ["b"]).count() == 2


def test_sample_by_key_is_layout_independent(spark):
    df = spark.range(0, 5000).withColumnRenamed("id", "k")
    a = {r[0] for r in clean.sample_by_key(df, "k").collect()}
    b = {r[0] for r in clean.sample_by_key(df.repartition(7), "k").collect()}
    assert a == b and 300 < len(a) < 700


def test_sample_bernoulli_seeded_is_repeatable(spark):
    df = spark.range(0, 10000).repartition(4)
    a = clean.sample_bernoulli(df, 0.1, 42).collect()
    b = clean.sample_bernoulli(df, 0.1, 42).collect()
    assert a == b


@pytest.fixture
def feeds(spark):
    street = spark.createDataFrame(
        [(1, "burglary"), (2, "drugs"), (None, "asb"), (None, "asb"), (3, "drugs"), (9, "burglary")],
        "crime_id bigint, crime_type string",
    )
    outcomes = spark.createDataFrame(
        [(1, "charged"), (2, "caution"), (2, "charged"), (None, "orphan"), (7, "unmatched")],
        "crime_id bigint, outcome_type string",
    )
    return street, outcomes


def test_join_outcomes_nulls_and_fanout(spark, feeds):
    street, outcomes = feeds
    got = sorted(
        (r["crime_id"] or -1, r["crime_type"], r["outcome_type"] or "")
        for r in join.join_outcomes(street, outcomes).collect()
    )
    assert got == [
        (-1, "asb", ""), (-1, "asb", ""), (1, "burglary", "charged"), (2, "drugs", "caution"),
        (2, "drugs", "charged"), (3, "drugs", ""), (9, "burglary", ""),
    ]


def test_pair_counts_equal_brute_force(spark, feeds):
    street, outcomes = feeds
    brute = (
        street.alias("s")
        .join(outcomes.alias("o"), F.col("s.crime_id") == F.col("o.crime_id"), "left")
        .groupBy("crime_type", "outcome_type")
        .count()
    )
    fast = summary.pair_counts(street, outcomes)
    norm = lambda rows: sorted((a, b or "", int(c)) for a, b, c in rows)
    assert norm(fast.collect()) == norm(brute.collect())
    by_type = {r[0]: r[1] for r in summary.rollup_counts(fast, "crime_type").collect()}
    assert by_type == {"asb": 2, "burglary": 2, "drugs": 3}  # D7: fan-out counts twice


def test_pair_counts_hot_key(spark):
    # One key holding most rows on both sides: counts multiply, rows never do.
    street = spark.range(0, 3000).select(F.lit(5).cast("bigint").alias("crime_id"), F.lit("t").alias("crime_type"))
    outcomes = spark.range(0, 2000).select(F.lit(5).cast("bigint").alias("crime_id"), F.lit("o").alias("outcome_type"))
    got = summary.pair_counts(street, outcomes).collect()
    assert [(r[0], r[1], r[2]) for r in got] == [("t", "o", 6_000_000)]


def test_distinct_count_counts_null(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,), ("a",)], "c string")
    assert summary.distinct_count(df, "c", "n").collect()[0][0] == 3


def test_hour_refuses_date_column(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1),)], "date date")
    with pytest.raises(ValueError):
        summary.count_by_hour(df, "date")


def test_dow_sunday_is_one(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 7, 10),), (dt.datetime(2024, 1, 13, 10),)], "ts timestamp")
    assert sorted(tuple(r) for r in summary.count_by_dow(df, "ts").collect()) == [(1, 1), (7, 1)]


def test_top_areas_tie_break(spark):
    rows = [(c, "n") for c in ["b", "a", "c", "a", "b", "c", "d"]]
    df = spark.createDataFrame(rows, "lsoa_code string, lsoa_name string")
    got = [r[0] for r in summary.top_areas(df, k=2).collect()]
    assert got == ["a", "b"]  # a, b, c all have 2; ties by code


def test_coord_stats_numeric(spark):
    # D3: numeric min/max, not lexicographic.
    df = spark.createDataFrame([(1.0, -0.5), (2.0, -5.2), (3.0, 10.1), (4.0, 9.9)], "latitude double, longitude double")
    r = summary.coord_stats(df).collect()[0]
    assert (r["min_longitude"], r["max_longitude"]) == (-5.2, 10.1)


def test_load_report_rejects(spark):
    df = spark.createDataFrame([(None, "x"), (dt.date(2024, 1, 1), "1.5"), (None, None)], "date date, lat string")
    checks = {"t": {"bad_dates": F.col("date").isNull(), "bad_lat": F.col("lat").isNotNull() & F.col("lat").try_cast("double").isNull()}}
    rep = summary.load_report({"t": df, "u": df}, checks).orderBy("table").collect()
    assert [tuple(r) for r in rep] == [("t", 3, 2, 1), ("u", 3, 0, 0)]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.sampled_from(["a", "b", None])), min_size=1, max_size=30))
def test_pair_counts_property(spark, rows):
    street = spark.createDataFrame([(i, "x" if i % 2 else "y") for i, _ in rows], "crime_id bigint, crime_type string")
    outcomes = spark.createDataFrame([(i, o) for i, o in rows], "crime_id bigint, outcome_type string")
    total = sum(r[2] for r in summary.pair_counts(street, outcomes).collect())
    assert total == join.join_outcomes(street, outcomes).count()


def _rows(df):
    return sorted(((r[0] if r[0] is not None else -1, r[1], r[2] or "") for r in df.collect()))


def _skewed(spark):
    # Key 5 holds most of the left rows; key 6 a few; nulls and unmatched keys too.
    left_rows = [(5, f"t{i % 3}") for i in range(3000)] + [(6, "a")] * 5 + [(None, "n")] * 700 + [(i, "c") for i in range(100, 400)]
    left = spark.createDataFrame(left_rows, "crime_id bigint, crime_type string")
    right = spark.createDataFrame(
        [(5, "x"), (5, "y"), (5, "x"), (6, "z"), (150, "w"), (None, "orphan")], "crime_id bigint, outcome_type string"
    )
    return left, right


def test_left_join_against_brute_force(spark):
    left, right = _skewed(spark)
    by = {}
    for k, o in (tuple(r) for r in right.collect()):
        by.setdefault(k, []).append(o)
    want = sorted(
        (-1 if k is None else k, t, o or "")
        for k, t in (tuple(r) for r in left.collect())
        for o in (by.get(k) if k is not None and k in by else [None])
    )
    assert _rows(join.join_outcomes(left, right)) == want
    assert _rows(join.join_outcomes(left, right, salt=8)) == want
    pairs = {}
    for _, t, o in want:
        pairs[t, o] = pairs.get((t, o), 0) + 1
    assert {(a, b or ""): n for a, b, n in summary.pair_counts(left, right).collect()} == pairs


def test_identical_rows_spread_over_the_salt(spark):
    left = spark.createDataFrame([(5, "same")] * 1000, "crime_id bigint, crime_type string")
    right = spark.createDataFrame([(5, "x")], "crime_id bigint, outcome_type string")
    plan = join.join_outcomes(left, right, salt=64)
    assert plan.count() == 1000
    salts = left.select(F.pmod(F.monotonically_increasing_id(), F.lit(64)).alias("s")).distinct().count()
    assert salts > 32


def test_sample_by_key_leaves_null_keys_out(spark):
    df = spark.createDataFrame([(None,), (10,), (11,)], "k bigint")
    assert [r["k"] for r in clean.sample_by_key(df, "k", 10, 1, hashed=False).collect()] == [10]
    assert clean.sample_by_key(df, "k", 1, 1).count() == 2


def test_only_heavy_keys_are_repeated(spark):
    rows = [("hot", i) for i in range(600)] + [(None, i) for i in range(500)] + [(f"k{i % 450}", i) for i in range(900)]
    left = spark.createDataFrame(rows, "crime_id string, i int").repartition(6)
    right = spark.createDataFrame([("hot", "a"), ("hot", "b")] + [(f"k{i}", "c") for i in range(400)], "crime_id string, outcome_type string")
    assert join.heavy_keys(left, "crime_id", 0.05) == ["hot"] and join.heavy_keys(left, "crime_id", 0.5) == []
    assert join.heavy_keys(left.limit(0), "crime_id", 0.05) == []
    assert len(join.heavy_keys(left, "crime_id", 0.0005)) == 451
    plain = join.join_outcomes(left, right)
    split = join.join_outcomes(left, right, salt=16, share=0.05)
    assert sorted(map(str, split.collect())) == sorted(map(str, plain.collect())) and plain.count() == 600 * 2 + 500 + 900
    # The right side grows by the two rows of the heavy key: 402 + 2 * 15.
    hot = F.col("crime_id").isin(["hot"])
    repeated = right.withColumn("s", F.explode(F.sequence(F.lit(0), F.when(hot, 15).otherwise(0)))).count()
    plan = split._jdf.queryExecution().optimizedPlan().toString()
    assert repeated == 432 and "Generate" in plan and "hot" in plan
    with pytest.raises(ValueError):
        join.heavy_keys(left, "crime_id", 0)


def test_wide_rows_shuffle_digests_only(spark, monkeypatch, tmp_path):
    rows = [(i, f"text {i} " * 40, None if i % 5 else 1.5, [i, None], {"k": i}) for i in range(2000)] + [(7, "text 7 " * 40, 1.0, None, None)] * 20
    rows += [rows[3], rows[3], (None, None, None, None, None), (None, None, None, None, None), (None, "1", 0.0, None, None), (1, None, -0.0, None, None)]
    df = spark.createDataFrame(rows, "a long, t string, d double, l array<int>, m map<string,int>")
    flat = df.drop("m")
    want = sorted(map(str, flat.dropDuplicates().collect()))
    same = lambda df: sorted(str(r).replace("-0.0", "0.0") for r in df.collect())  # noqa: E731  equal values
    assert same(clean.dedup_wide_rows(flat)) == want
    assert clean.dedup_wide_rows(flat).columns == flat.columns
    flat.repartition(7).write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    out = clean.dedup_wide_rows(stored)
    assert same(out) == want
    plan = out._jdf.queryExecution().executedPlan().toString()
    # One branch reads and keeps rows without an exchange; only marked rows are dealt out by their values.
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    moved = [line for line in plan.split("\n") if "Exchange hashpartitioning" in line]
    assert len(moved) <= 2
    monkeypatch.setattr(clean, "MAX_REPEATED", 0)
    assert same(clean.dedup_wide_rows(stored)) == want


def test_equal_digests_of_different_rows(spark, monkeypatch):
    df = spark.createDataFrame([(i % 5, f"v{i % 3}") for i in range(60)], "a int, b string")
    monkeypatch.setattr(clean.F, "xxhash64", lambda *c: clean.F.lit(1))
    assert clean.dedup_wide_rows(df).count() == 15
