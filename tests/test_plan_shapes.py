"""Physical-plan properties the scale design relies on."""

from conftest import SF01

import __spark_entry__ as entry_mod
from incidentlab.operators import join, series
from incidentlab.sources import standins as sv

Q = entry_mod.queries()


def plan(df) -> str:
    df.collect()  # let AQE settle, then read the final plan
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_k_is_take_ordered(spark):
    p = Q["top_areas"](spark, SF01)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in p


def test_scan_prunes_columns_and_pushes_null_filter(spark):
    o = sv.outcomes(spark, SF01)
    df = join.join_outcomes(sv.street(spark, SF01).select("crime_id", "crime_type"), o)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(o_orderkey)" in p
    schemas = [line for line in p.split("\n") if "ReadSchema" in line]
    assert schemas and all("l_partkey" not in s and "l_shipdate" not in s and "o_totalprice" not in s for s in schemas)


def test_one_street_scan(spark):
    """The join and the pair counts read the street table once; the join's
    shuffle has the salt as a key, so null keys spread."""
    df = join.join_outcomes(sv.street(spark, SF01).select("crime_id", "crime_type"), sv.outcomes(spark, SF01))
    p = df._jdf.queryExecution().executedPlan().toString()
    assert p.count("FileScan parquet") == 2
    # The salt stays an equality key of the join instead of folding away.
    assert p.count("_salt") >= 2 and "Union" not in p
    pairs = Q["pair_counts"](spark, SF01)._jdf.queryExecution().executedPlan().toString()
    assert pairs.count("FileScan parquet") == 2 and "Union" not in pairs


def test_hard_branches_occur(spark):
    """The stand-ins hold unmatched keys, fan-out, null keys, an empty crosstab
    cell, and rows with unreadable dates and coordinates."""
    s, o = sv.street(spark, SF01), sv.outcomes(spark, SF01)
    keyed = s.filter("crime_id IS NOT NULL")
    assert keyed.join(o, "crime_id", "left_anti").count() > 0 and s.filter("crime_id IS NULL").count() > 0
    assert o.groupBy("crime_id").count().filter("count > 1").count() > 0
    pairs = Q["pair_counts"](spark, SF01)
    rows, cols = (pairs.select(c).distinct().count() for c in ("crime_type", "outcome_type"))
    assert pairs.count() < rows * cols
    street = Q["load_report"](spark, SF01).filter("table = 'street'").first()
    assert street["bad_dates"] > 0 and street["bad_coordinates"] > 0


def test_gapfill_has_no_join(spark):
    s = series.monthly_counts(sv.customer_orders(spark, SF01), "date", "key")
    p = series.gapfill(s, "key")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in p and "Window" in p


def test_partition_filters_reach_the_scan(spark):
    p = plan(Q["scan_parquet_partitioned"](spark, SF01))
    assert "PartitionFilters" in p and "year" in p


def test_pair_counts_aggregate_partially_before_shuffle(spark):
    p = Q["pair_counts"](spark, SF01)._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in p and "partial_count" in p
