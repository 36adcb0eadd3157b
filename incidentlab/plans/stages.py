"""The batch stages, in order.

    raw CSV month folders --ingest--> processed (Parquet by year/month)
        --clean--> clean (Parquet by year/month)
        --summaries / outcome_analysis / hotspots / forecasts--> result tables

Paths are folders (HDFS, object store or local); feeds are
``street``, ``outcomes`` and ``stop_and_search``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from incidentlab import sinks, sources
from incidentlab.functions import make_month_date
from incidentlab.operators import clean, cluster, crosstab, forecast, maplayer, series, summary
from incidentlab.schemas import FEEDS

FEED_NAMES = ("street", "outcomes", "stop_and_search")


def _feed_glob(raw_base: str, feed: str) -> str:
    suffix = feed.replace("_", "-")
    return f"{raw_base.rstrip('/')}/*/*-{suffix}.csv"


def _table(base: str, feed: str) -> str:
    return f"{base.rstrip('/')}/{feed}"


# ------------------------------------------------------------------ ingest


def ingest(spark: SparkSession, raw_base: str, processed_base: str) -> DataFrame:
    """Raw feeds -> typed Parquet partitioned by year/month.  Returns the load
    report (rows, unparsable dates and unparsable coordinates per feed; both
    kinds become null and the clean stage drops such rows).  The counts are observed
    during the write itself (``DataFrame.observe``), so the CSV text is
    scanned once and the written tables are not read back."""
    report = []
    for feed in FEED_NAMES:
        typed = sources.ingest_feed(spark, feed, _feed_glob(raw_base, feed), report_rejects=True)
        obs = Observation(f"load-{feed}")
        observed = typed.observe(
            obs,
            F.count(F.lit(1)).alias("rows"),
            *(F.count_if(F.col(f"_bad_{x}")).alias(f"bad_{x}") for x in ("dates", "coordinates")),
        ).drop("_bad_dates", "_bad_coordinates")
        sinks.write_partitioned_parquet(observed, _table(processed_base, feed))
        got = obs.get
        report.append((feed, *(int(got.get(x) or 0) for x in ("rows", "bad_dates", "bad_coordinates"))))
    return spark.createDataFrame(report, "table string, rows bigint, bad_dates bigint, bad_coordinates bigint")


# ------------------------------------------------------------------- clean


def clean_feed(df: DataFrame, feed: str) -> DataFrame:
    """Coordinates present and non-zero, whole-row dedup, text normalised."""
    _, text_cols = FEEDS[feed]
    cols = [c for c in text_cols if c in df.columns]
    return clean.normalize_text(clean.clean_geo(df), cols)


def clean_all(spark: SparkSession, processed_base: str, clean_base: str) -> dict[str, str]:
    out = {}
    for feed in FEED_NAMES:
        df = sources.read_parquet_table(spark, _table(processed_base, feed))
        out[feed] = sinks.write_partitioned_parquet(clean_feed(df, feed), _table(clean_base, feed))
    return out


# --------------------------------------------------------------- summaries


# The count summaries of each feed, as grouping sets.
STREET_SETS = {
    "counts_by_month": ["month"],
    "year_month_trend": ["year", "month"],
    "crime_types": ["crime_type"],
    "lsoas": ["lsoa_code", "lsoa_name"],
    "all": [],
}
STOP_SETS = {
    "counts_by_hour": ["hour"],
    "counts_by_dow": ["dow"],
    "stop_object_counts": ["object_of_search"],
    "stop_outcome_linked_counts": ["outcome_linked_to_object_of_search"],
}


def summaries(spark: SparkSession, clean_base: str) -> dict[str, DataFrame]:
    """The eleven summary tables from three scans in total.

    Street counts (month, year-month, types, areas, coordinate stats) come
    from one GROUPING SETS pass, stop counts from another, each checkpointed
    once (they are summary-sized) and split.  Type and outcome counts roll up
    from one (type, outcome) count of the joined feeds.  Hour and day of week
    use the stop feed's event timestamp (street dates have month grain)."""
    street = sources.read_parquet_table(spark, _table(clean_base, "street"))
    outcomes = sources.read_parquet_table(spark, _table(clean_base, "outcomes"))
    stops = sources.read_parquet_table(spark, _table(clean_base, "stop_and_search"))
    pairs = summary.pair_counts(street, outcomes, "crime_id", "crime_type", "outcome_type")

    coord_aggs = [
        F.min("latitude").alias("min_latitude"), F.max("latitude").alias("max_latitude"),
        F.min("longitude").alias("min_longitude"), F.max("longitude").alias("max_longitude"),
        F.avg("latitude").alias("avg_latitude"), F.avg("longitude").alias("avg_longitude"),
    ]
    s = summary.grouping_set_counts(street, STREET_SETS, coord_aggs).checkpoint(eager=True)
    stop_cols = stops.select(
        F.hour("event_ts").alias("hour"), F.dayofweek("event_ts").alias("dow"),
        "object_of_search", "outcome_linked_to_object_of_search",
    )
    t = summary.grouping_set_counts(stop_cols, STOP_SETS).checkpoint(eager=True)
    lsoas = summary.from_grouping_set(s, "lsoas", ["lsoa_code", "lsoa_name"], "count")
    out = {
        "crime_type_counts": summary.rollup_counts(pairs, "crime_type"),
        "outcome_type_counts": summary.rollup_counts(pairs, "outcome_type"),
        "counts_by_month": summary.from_grouping_set(s, "counts_by_month", ["month"], "count"),
        "year_month_trend": summary.from_grouping_set(s, "year_month_trend", ["year", "month"], "count").orderBy("year", "month"),
        "distinct_crime_types": summary.from_grouping_set(s, "crime_types", ["crime_type"]).agg(
            F.count(F.lit(1)).alias("distinct_crime_types")
        ),
        "top10_lsoas": summary.top_k(lsoas, 10, "count", ["lsoa_code", "lsoa_name"]),
        "coordinate_stats": summary.from_grouping_set(
            s, "all", [], "min_latitude", "max_latitude", "min_longitude", "max_longitude", "avg_latitude", "avg_longitude"
        ),
    }
    for name, cols in STOP_SETS.items():
        out[name] = summary.from_grouping_set(t, name, cols, "count")
    return out


def write_summaries(tables: dict[str, DataFrame], out_base: str) -> dict[str, str]:
    return {name: sinks.write_single_csv(df, f"{out_base.rstrip('/')}/{name}") for name, df in tables.items()}


# -------------------------------------------------------- outcome analysis


def outcome_analysis(spark: SparkSession, clean_base: str, top: int = 5, null_policy: str = "category") -> dict[str, DataFrame]:
    """Type x outcome crosstab (wide and long), row percentages, expected
    counts, the chi-square test and the top-``top`` type profile.

    ``null_policy``: 'category' keeps crimes without an outcome as their own
    column; 'drop' removes them before the test."""
    street = sources.read_parquet_table(spark, _table(clean_base, "street"))
    outcomes = sources.read_parquet_table(spark, _table(clean_base, "outcomes"))
    pairs = summary.pair_counts(street, outcomes, "crime_id", "crime_type", "outcome_type")
    if null_policy == "drop":
        pairs = pairs.filter(F.col("outcome_type").isNotNull())
    # The long table is category-sized; write it once for the consumers below.
    pairs = crosstab.materialize(pairs)
    return {
        "crosstab": crosstab.crosstab_wide(pairs, "crime_type", "outcome_type"),
        "crosstab_long": pairs,
        "percent": crosstab.crosstab_percent(pairs, "crime_type", "outcome_type"),
        "expected": crosstab.chi_square_expected(pairs, "crime_type", "outcome_type"),
        "chi_square": crosstab.chi_square_test(pairs, "crime_type", "outcome_type"),
        "top_profile": crosstab.crosstab_top_rows(pairs, "crime_type", "outcome_type", top=top),
    }


# ---------------------------------------------------------------- hotspots


def hotspots(spark: SparkSession, clean_base: str, clusters_path: str, k: int = 8, seed: int = 42) -> str:
    """KMeans on street coordinates; the cluster table keeps every street
    column (so later stages can still read ``date``)."""
    street = sources.read_parquet_table(spark, _table(clean_base, "street"))
    centres = cluster.fit_centres(street, k=k, seed=seed)
    return sinks.write_flat_parquet(cluster.assign_centres(street, centres), clusters_path)


# --------------------------------------------------------------- forecasts


def total_forecast(spark: SparkSession, clean_base: str, horizon: int = 6, order=(1, 1, 1)) -> dict[str, DataFrame]:
    """Monthly street counts -> holdout of ``horizon`` months -> ARIMA fit on
    the rest -> forecast with 95 % band, scores and residual diagnostics.

    The monthly counts group by the partition columns, so no data column of
    the street table is read."""
    street = sources.read_parquet_table(spark, _table(clean_base, "street"))
    monthly = summary.count_by(street, "year", "month", name="n").select(
        F.lit("all").alias("key"), make_month_date("year", "month").alias("month"), "n"
    )
    ts = series.gapfill(monthly, "key").checkpoint(eager=True)
    split = series.holdout_split(ts, "key", horizon=horizon)
    params = forecast.fit_arima(split.filter(~F.col("is_test")), "key", order=order).checkpoint(eager=True)
    fc = forecast.forecast_from_params(params, "key", horizon).checkpoint(eager=True)
    scored = split.filter("is_test").join(fc.select("key", "month", "mean"), ["key", "month"])
    resid = forecast.residuals(params, "key")
    return {
        "series": ts,
        "params": params,
        "forecast": fc,
        "metrics": series.forecast_metrics(scored, "key", "n", "mean"),
        "actual_vs_forecast": series.actual_vs_forecast(ts, fc, "key"),
        "residuals": series.standardized_residuals(resid, "key", "month", "resid"),
        "residual_acf": series.autocorrelation(resid, "key", "month", "resid"),
    }


def cluster_forecast(spark: SparkSession, clusters_path: str, horizon: int = 6) -> dict[str, DataFrame]:
    """Per-cluster monthly counts (gaps as 0) -> automatic order per cluster ->
    forecast with band, joined to full-data centroids, plus the map layer."""
    clusters = sources.read_parquet_table(spark, clusters_path)
    ts = series.gapfill(series.monthly_counts(clusters, "date", "prediction"), "prediction").checkpoint(eager=True)
    # Written once: the result, the map layer and its maximum read the same copy.
    fc = forecast.forecast_by_key(ts, "prediction", horizon=horizon).checkpoint(eager=True)
    centroids = cluster.cluster_centroids(clusters, "prediction", scale=None)
    return {
        "series": ts,
        "forecast": fc,
        "centroids": centroids,
        "map_layer": maplayer.map_layer(fc, centroids, "prediction", "date", "forecast"),
        "map_center": cluster.map_center(clusters, scale=None),
    }
