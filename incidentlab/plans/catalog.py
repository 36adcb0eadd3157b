"""Registered queries: each binds operators to the stand-in views of the driver
tables and, where the result is expressible in SQL, carries the DuckDB query
that must give the same rows.  ``__spark_entry__`` exposes this registry.

Floating results are rounded to 6 places on both sides (summation order
differs between engines).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from incidentlab import sinks, sources
from incidentlab.operators import clean, cluster, columns, crosstab, forecast, join, likelihood, maplayer, series, summary
from incidentlab.sources import standins as sv
from incidentlab.functions import (
    date_parts,
    fill_unknown,
    label_fallback,
    make_month_date,
    parse_timestamp_date,
    parse_timestamp_text,
    parse_year_month,
    to_double,
)
from incidentlab.session import scratch_path
from incidentlab.sources.standins import with_views


@dataclass(frozen=True)
class Query:
    name: str
    ids: str  # inventory items covered
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def _recursive(sql: str) -> str:
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


def register(name: str, ids: str, sql: str | None = None):
    def deco(fn: Callable[[SparkSession, str], DataFrame]):
        REGISTRY[name] = Query(name, ids, fn, sql)
        return fn

    return deco


def _pairs(spark: SparkSession, sf: str) -> DataFrame:
    return summary.pair_counts(sv.street(spark, sf), sv.outcomes(spark, sf), "crime_id", "crime_type", "outcome_type")


# ---------------------------------------------------------------- joins


@register(
    "join_left_outcomes",
    "J1",
    with_views(
        """SELECT s.crime_id, s.crime_type, s.date, o.outcome_type
FROM street s LEFT JOIN (SELECT crime_id, outcome_type FROM outcomes) o ON s.crime_id = o.crime_id""",
        "street",
        "outcomes",
    ),
)
def q_join_left_outcomes(spark, sf):
    s = sv.street(spark, sf).select("crime_id", "crime_type", "date")
    return join.join_outcomes(s, sv.outcomes(spark, sf), "crime_id", ["outcome_type"])


_J1_SQL = with_views(
    """SELECT s.crime_id, s.crime_type, s.date, o.outcome_type
FROM street s LEFT JOIN (SELECT crime_id, outcome_type FROM outcomes) o ON s.crime_id = o.crime_id""",
    "street",
    "outcomes",
)


@register("join_left_outcomes_split", "J1", _J1_SQL)
def q_join_left_outcomes_split(spark, sf):
    # Keys that hold a thousandth of the rows are dealt over four reducers.
    s = sv.street(spark, sf).select("crime_id", "crime_type", "date")
    return join.join_outcomes(s, sv.outcomes(spark, sf), "crime_id", ["outcome_type"], salt=4, share=0.001)


# ---------------------------------------------------------- aggregations (A)


@register("pair_counts", "A12", with_views("SELECT crime_type, outcome_type, n FROM pairs", "pairs"))
def q_pair_counts(spark, sf):
    return _pairs(spark, sf)


@register("pair_counts_split", "A12", with_views("SELECT crime_type, outcome_type, n FROM pairs", "pairs"))
def q_pair_counts_split(spark, sf):
    # The same counts from the joined rows, with every key dealt over four reducers.
    s = sv.street(spark, sf).select("crime_id", "crime_type")
    rows = join.join_outcomes(s, sv.outcomes(spark, sf), "crime_id", ["outcome_type"], salt=4)
    return summary.count_by(rows, "crime_type", "outcome_type", name="n")


@register(
    "count_by_type",
    "A1",
    with_views(
        """SELECT s.crime_type, COUNT(*) AS "count"
FROM street s LEFT JOIN outcomes o ON s.crime_id = o.crime_id GROUP BY s.crime_type""",
        "street",
        "outcomes",
    ),
)
def q_count_by_type(spark, sf):
    return summary.rollup_counts(_pairs(spark, sf), "crime_type")


@register(
    "count_by_outcome",
    "A2",
    with_views(
        """SELECT o.outcome_type, COUNT(*) AS "count"
FROM street s LEFT JOIN outcomes o ON s.crime_id = o.crime_id GROUP BY o.outcome_type""",
        "street",
        "outcomes",
    ),
)
def q_count_by_outcome(spark, sf):
    return summary.rollup_counts(_pairs(spark, sf), "outcome_type")


@register(
    "count_by_hour",
    "A3 P14",
    with_views('SELECT CAST(hour(event_ts) AS INTEGER) AS hour, COUNT(*) AS "count" FROM stops GROUP BY 1', "stops"),
)
def q_count_by_hour(spark, sf):
    return summary.count_by_hour(sv.stops(spark, sf), "event_ts")


@register(
    "count_by_dow",
    "A4 P15",
    with_views(
        'SELECT CAST(dayofweek(event_ts) + 1 AS INTEGER) AS dow, COUNT(*) AS "count" FROM stops GROUP BY 1', "stops"
    ),
)
def q_count_by_dow(spark, sf):
    return summary.count_by_dow(sv.stops(spark, sf), "event_ts")


@register(
    "count_by_month",
    "A5",
    with_views('SELECT CAST(month(date) AS INTEGER) AS month, COUNT(*) AS "count" FROM street GROUP BY 1', "street"),
)
def q_count_by_month(spark, sf):
    return summary.count_by_month(sv.street(spark, sf), "date")


@register(
    "year_month_trend",
    "A6 T1",
    with_views('SELECT year, month, COUNT(*) AS "count" FROM street GROUP BY 1, 2', "street"),
)
def q_year_month_trend(spark, sf):
    return summary.year_month_trend(sv.street(spark, sf))


@register(
    "distinct_types",
    "A7",
    with_views("SELECT COUNT(*) AS distinct_crime_types FROM (SELECT DISTINCT crime_type FROM street)", "street"),
)
def q_distinct_types(spark, sf):
    return summary.distinct_count(sv.street(spark, sf), "crime_type", "distinct_crime_types")


@register(
    "distinct_outcomes_with_null",
    "A7",
    with_views(
        """SELECT COUNT(*) AS distinct_outcome_types FROM (
  SELECT DISTINCT o.outcome_type FROM street s LEFT JOIN outcomes o ON s.crime_id = o.crime_id)""",
        "street",
        "outcomes",
    ),
)
def q_distinct_outcomes_with_null(spark, sf):
    return summary.distinct_count(_pairs(spark, sf), "outcome_type", "distinct_outcome_types")


@register(
    "coord_stats",
    "A9",
    with_views(
        """SELECT min(latitude) AS min_latitude, max(latitude) AS max_latitude,
       min(longitude) AS min_longitude, max(longitude) AS max_longitude,
       round(avg(latitude), 6) AS avg_latitude, round(avg(longitude), 6) AS avg_longitude
FROM street""",
        "street",
    ),
)
def q_coord_stats(spark, sf):
    return summary.coord_stats(sv.street(spark, sf), scale=6)


@register(
    "count_stop_object",
    "A10",
    with_views('SELECT object_of_search, COUNT(*) AS "count" FROM stops GROUP BY 1', "stops"),
)
def q_count_stop_object(spark, sf):
    return summary.count_by(sv.stops(spark, sf), "object_of_search")


@register(
    "count_stop_linked",
    "A11",
    with_views('SELECT outcome_linked_to_object_of_search, COUNT(*) AS "count" FROM stops GROUP BY 1', "stops"),
)
def q_count_stop_linked(spark, sf):
    return summary.count_by(sv.stops(spark, sf), "outcome_linked_to_object_of_search")


@register(
    "load_report",
    "A17 D10",
    with_views(
        """SELECT 'street' AS "table", COUNT(*) AS "rows",
       count_if(try_strptime(month_text, '%Y-%m') IS NULL)::BIGINT AS bad_dates,
       count_if((latitude IS NOT NULL AND try_cast(latitude AS DOUBLE) IS NULL)
             OR (longitude IS NOT NULL AND try_cast(longitude AS DOUBLE) IS NULL))::BIGINT AS bad_coordinates
FROM street_text
UNION ALL SELECT 'outcomes', COUNT(*), count_if(date IS NULL)::BIGINT, 0::BIGINT FROM outcomes
UNION ALL SELECT 'stop_and_search', COUNT(*), count_if(date IS NULL)::BIGINT, 0::BIGINT FROM stops""",
        "street_text",
        "outcomes",
        "stops",
    ),
)
def q_load_report(spark, sf):
    tables = {"street": sv.street_text(spark, sf), "outcomes": sv.outcomes(spark, sf), "stop_and_search": sv.stops(spark, sf)}
    bad = [F.col(c).isNotNull() & to_double(c).isNull() for c in ("latitude", "longitude")]
    no_date = {"bad_dates": F.col("date").isNull()}
    checks = {
        "street": {"bad_dates": parse_year_month("month_text").isNull(), "bad_coordinates": bad[0] | bad[1]},
        "outcomes": no_date,
        "stop_and_search": no_date,
    }
    return summary.load_report(tables, checks)


# ------------------------------------------------------------- top-k (T)


@register(
    "top_areas",
    "A8 T2",
    with_views(
        """SELECT lsoa_code, lsoa_name, COUNT(*) AS "count" FROM street GROUP BY 1, 2
ORDER BY "count" DESC, lsoa_code, lsoa_name LIMIT 10""",
        "street",
    ),
)
def q_top_areas(spark, sf):
    return summary.top_areas(sv.street(spark, sf))


@register(
    "top_categories",
    "T3 T4",
    with_views(
        """SELECT lsoa_code, COUNT(*) AS "count" FROM street GROUP BY 1 ORDER BY "count" DESC, lsoa_code LIMIT 10""",
        "street",
    ),
)
def q_top_categories(spark, sf):
    return summary.top_k(summary.count_by(sv.street(spark, sf), "lsoa_code"), 10, "count", ["lsoa_code"])


@register(
    "peek",
    "T6",
    with_views("SELECT * FROM outcomes ORDER BY crime_id, outcome_type LIMIT 5", "outcomes"),
)
def q_peek(spark, sf):
    return summary.peek(sv.outcomes(spark, sf), ["crime_id", "outcome_type"], 5)


# ---------------------------------------------------------- crosstab (X)


@register(
    "crosstab",
    "X1 P11",
    with_views(
        """SELECT crime_type,
       CAST(SUM(CASE WHEN outcome_type = 'F' THEN n ELSE 0 END) AS BIGINT) AS "F",
       CAST(SUM(CASE WHEN outcome_type = 'O' THEN n ELSE 0 END) AS BIGINT) AS "O",
       CAST(SUM(CASE WHEN outcome_type = 'P' THEN n ELSE 0 END) AS BIGINT) AS "P",
       CAST(SUM(CASE WHEN outcome_type = 'X' THEN n ELSE 0 END) AS BIGINT) AS "X",
       CAST(SUM(CASE WHEN outcome_type IS NULL THEN n ELSE 0 END) AS BIGINT) AS "null"
FROM pairs GROUP BY crime_type""",
        "pairs",
    ),
)
def q_crosstab(spark, sf):
    return crosstab.crosstab_wide(_pairs(spark, sf), "crime_type", "outcome_type", "n")


@register(
    "crosstab_percent",
    "X2",
    with_views(
        """SELECT crime_type, outcome_type, n,
       round(n * 100.0 / SUM(n) OVER (PARTITION BY crime_type), 6) AS pct
FROM pairs""",
        "pairs",
    ),
)
def q_crosstab_percent(spark, sf):
    return crosstab.crosstab_percent(_pairs(spark, sf), "crime_type", "outcome_type", "n")


_GRID_SQL = """grid AS (
  SELECT r.crime_type, c.outcome_type, COALESCE(p.n, 0) AS n
  FROM (SELECT DISTINCT crime_type FROM pairs) r
  CROSS JOIN (SELECT DISTINCT outcome_type FROM pairs) c
  LEFT JOIN pairs p ON p.crime_type IS NOT DISTINCT FROM r.crime_type
                   AND p.outcome_type IS NOT DISTINCT FROM c.outcome_type),
expected AS (
  SELECT crime_type, outcome_type, n,
         SUM(n) OVER (PARTITION BY crime_type) * SUM(n) OVER (PARTITION BY outcome_type)
           / SUM(n) OVER () AS e
  FROM grid)"""


@register(
    "chi_square",
    "X3",
    with_views(
        """SELECT round(SUM((n - e) * (n - e) / e), 4) AS chi2,
       CAST(((SELECT COUNT(DISTINCT crime_type) FROM pairs) - 1)
          * ((SELECT COUNT(*) FROM (SELECT DISTINCT outcome_type FROM pairs)) - 1) AS BIGINT) AS dof
FROM expected""",
        "pairs",
        ctes=_GRID_SQL,
    ),
)
def q_chi_square(spark, sf):
    return crosstab.chi_square(crosstab.materialize(_pairs(spark, sf)), "crime_type", "outcome_type", "n")


@register(
    "chi_square_expected",
    "X4",
    with_views(
        "SELECT crime_type, outcome_type, n AS observed, round(e, 6) AS expected FROM expected",
        "pairs",
        ctes=_GRID_SQL,
    ),
)
def q_chi_square_expected(spark, sf):
    return crosstab.chi_square_expected(crosstab.materialize(_pairs(spark, sf)), "crime_type", "outcome_type", "n")


@register(
    "chi_square_test",
    "X3 K5",
    # Oracle p-value: for an even dof the chi-square tail is
    # exp(-x/2) * sum_{i < dof/2} (x/2)^i / i!  (the stand-in has dof = 8).
    with_views(
        """SELECT round(x, 4) AS chi2,
       round((SELECT sum(exp(i * ln(x / 2) - lgamma(i + 1))) FROM range(CAST(dof / 2 AS BIGINT)) t(i)) * exp(-x / 2), 6) AS p,
       round(ln((SELECT sum(exp(i * ln(x / 2) - lgamma(i + 1))) FROM range(CAST(dof / 2 AS BIGINT)) t(i))) - x / 2, 6) AS log_p,
       dof
FROM (SELECT SUM((n - e) * (n - e) / e) AS x,
             CAST(((SELECT COUNT(DISTINCT crime_type) FROM pairs) - 1)
                * ((SELECT COUNT(*) FROM (SELECT DISTINCT outcome_type FROM pairs)) - 1) AS BIGINT) AS dof
      FROM expected)""",
        "pairs",
        ctes=_GRID_SQL,
    ),
)
def q_chi_square_test(spark, sf):
    t = crosstab.chi_square_test(crosstab.materialize(_pairs(spark, sf)), "crime_type", "outcome_type", "n")
    return t.select(F.round("chi2", 4).alias("chi2"), F.round("p", 6).alias("p"), F.round("log_p", 6).alias("log_p"), "dof")


@register(
    "crosstab_top_rows",
    "X5 T5 D5",
    with_views(
        """SELECT lsoa_code, outcome_type, n,
       round(n * 100.0 / SUM(n) OVER (PARTITION BY lsoa_code), 6) AS pct
FROM area_pairs WHERE lsoa_code IN (SELECT lsoa_code FROM top)""",
        "street",
        "outcomes",
        ctes="""area_pairs AS (
  SELECT s.lsoa_code, o.outcome_type, COUNT(*) AS n
  FROM street s LEFT JOIN outcomes o ON s.crime_id = o.crime_id GROUP BY 1, 2),
top AS (
  SELECT lsoa_code FROM (SELECT lsoa_code, SUM(n) AS t FROM area_pairs GROUP BY 1)
  ORDER BY t DESC, lsoa_code NULLS FIRST LIMIT 5)""",
    ),
)
def q_crosstab_top_rows(spark, sf):
    # Area x outcome rows: 100+ areas, so the top-5 cut is exercised.
    pairs = summary.pair_counts(sv.street(spark, sf), sv.outcomes(spark, sf), "crime_id", "lsoa_code", "outcome_type")
    return crosstab.crosstab_top_rows(pairs, "lsoa_code", "outcome_type", "n", top=5)


# ------------------------------------------------------- cleaning (P, R)


@register(
    "normalize_text",
    "P9",
    "SELECT doc_id, lower(trim(regexp_replace(text, '[^\\x00-\\x7F]', '', 'g'))) AS text FROM documents",
)
def q_normalize_text(spark, sf):
    docs = sv.read(spark, sf, "documents").select("doc_id", "text")
    return clean.normalize_text(docs, ["text"])


@register(
    "normalize_columns",
    "P1",
    with_views(
        "SELECT crime_id, date, year, month, crime_type, lsoa_code, lsoa_name, latitude, longitude FROM street",
        "street",
    ),
)
def q_normalize_columns(spark, sf):
    s = sv.street(spark, sf)
    raw = s.toDF(*["Crime ID", "Date", "Year", "Month", "Crime type", "LSOA code", "LSOA-name", " Latitude ", "Longitude"])
    return columns.normalize_columns(raw)


@register(
    "dedup_rows",
    "R1",
    with_views("SELECT DISTINCT crime_id, crime_type, lsoa_name FROM street", "street"),
)
def q_dedup_rows(spark, sf):
    return clean.dedup_rows(sv.street(spark, sf).select("crime_id", "crime_type", "lsoa_name"))


@register(
    "dedup_wide_rows",
    "R1",
    with_views("SELECT DISTINCT crime_id, crime_type, lsoa_name FROM street", "street"),
)
def q_dedup_wide_rows(spark, sf):
    return clean.dedup_wide_rows(sv.street(spark, sf).select("crime_id", "crime_type", "lsoa_name"))


@register(
    "clean_geo",
    "R2 R3 R4",
    with_views(
        """SELECT DISTINCT * FROM street
WHERE latitude IS NOT NULL AND longitude IS NOT NULL AND latitude <> 0 AND longitude <> 0""",
        "street",
    ),
)
def q_clean_geo(spark, sf):
    return clean.clean_geo(sv.street(spark, sf))


# ------------------------------------------------------------ series (W, A13-14, F6-F7)


@register(
    "monthly_counts",
    "A13 P5 W1",
    with_views("SELECT CAST(date_trunc('month', date) AS DATE) AS month, COUNT(*) AS n FROM street GROUP BY 1", "street"),
)
def q_monthly_counts(spark, sf):
    return series.monthly_counts(sv.street(spark, sf), "date")


@register("monthly_counts_by_key", "A14", with_views("SELECT key, month, n FROM series", "series"))
def q_monthly_counts_by_key(spark, sf):
    return series.monthly_counts(sv.priority_orders(spark, sf), "date", "key")


_CUSTOMER_SERIES = """c AS (
  SELECT o_custkey AS key, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, COUNT(*) AS n
  FROM orders GROUP BY 1, 2)"""


@register(
    "month_gapfill",
    "W2 D13",
    f"""WITH {_CUSTOMER_SERIES},
b AS (SELECT key, min(month) AS lo, max(month) AS hi FROM c GROUP BY key),
g AS (SELECT key, CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS month FROM b)
SELECT g.key, g.month, COALESCE(c.n, 0) AS n FROM g LEFT JOIN c ON g.key = c.key AND g.month = c.month""",
)
def q_month_gapfill(spark, sf):
    return series.gapfill(series.monthly_counts(sv.customer_orders(spark, sf), "date", "key"), "key")


@register(
    "holdout_split",
    "W3",
    with_views(
        "SELECT key, month, n, row_number() OVER (PARTITION BY key ORDER BY month DESC) <= 6 AS is_test FROM series",
        "series",
    ),
)
def q_holdout_split(spark, sf):
    return series.holdout_split(series.monthly_counts(sv.priority_orders(spark, sf), "date", "key"), "key")


@register(
    "future_months",
    "W4",
    with_views(
        """SELECT key, step, CAST(last + to_months(CAST(step AS INTEGER)) AS DATE) AS month
FROM (SELECT key, max(month) AS last FROM series GROUP BY key)
CROSS JOIN (SELECT CAST(range AS INTEGER) AS step FROM range(1, 7))""",
        "series",
    ),
)
def q_future_months(spark, sf):
    return series.future_months(series.monthly_counts(sv.priority_orders(spark, sf), "date", "key"), "key")


@register(
    "forecast_metrics",
    "F6",
    with_views(
        """SELECT key, round(sqrt(avg((n - p) * (n - p))), 6) AS rmse, round(avg(abs(n - p)), 6) AS mae
FROM (SELECT key, n, lag(n, 12) OVER (PARTITION BY key ORDER BY month) AS p,
             row_number() OVER (PARTITION BY key ORDER BY month DESC) AS back
      FROM series)
WHERE back <= 6 AND p IS NOT NULL GROUP BY key""",
        "series",
    ),
)
def q_forecast_metrics(spark, sf):
    s = series.holdout_split(series.monthly_counts(sv.priority_orders(spark, sf), "date", "key"), "key")
    # Scored pair: each test month against the same month a year earlier.
    w = Window.partitionBy("key").orderBy("month")
    s = s.withColumn("p", F.lag("n", 12).over(w)).filter("is_test")
    return series.forecast_metrics(s, "key", "n", "p")


@register(
    "residual_acf",
    "F7",
    with_views(
        """SELECT key, lag, round(CASE lag WHEN 1 THEN s1 WHEN 2 THEN s2 WHEN 3 THEN s3 WHEN 4 THEN s4 WHEN 5 THEN s5
                   WHEN 6 THEN s6 WHEN 7 THEN s7 WHEN 8 THEN s8 WHEN 9 THEN s9 ELSE s10 END / den, 6) AS acf
FROM s CROSS JOIN lags""",
        "series",
        ctes="""lags AS (SELECT CAST(range AS INTEGER) AS lag FROM range(1, 11)),
c AS (SELECT key, month, n - avg(n) OVER (PARTITION BY key) AS c FROM series),
l AS (SELECT key, month, c, lag(c, 1) OVER w AS l1, lag(c, 2) OVER w AS l2, lag(c, 3) OVER w AS l3,
             lag(c, 4) OVER w AS l4, lag(c, 5) OVER w AS l5, lag(c, 6) OVER w AS l6, lag(c, 7) OVER w AS l7,
             lag(c, 8) OVER w AS l8, lag(c, 9) OVER w AS l9, lag(c, 10) OVER w AS l10
      FROM c WINDOW w AS (PARTITION BY key ORDER BY month)),
s AS (SELECT key, sum(c * c) AS den, sum(c * l1) AS s1, sum(c * l2) AS s2, sum(c * l3) AS s3, sum(c * l4) AS s4,
             sum(c * l5) AS s5, sum(c * l6) AS s6, sum(c * l7) AS s7, sum(c * l8) AS s8, sum(c * l9) AS s9,
             sum(c * l10) AS s10 FROM l GROUP BY key)""",
    ),
)
def q_residual_acf(spark, sf):
    s = series.monthly_counts(sv.priority_orders(spark, sf), "date", "key")
    return series.autocorrelation(s, "key", "month", "n", max_lag=10)


# --------------------------------------------------------- clustering (C, A15-16, J2, P17)


@register(
    "assign_nearest",
    "C3",
    with_views(
        """SELECT p.crime_type, p.lsoa_code, p.latitude, p.longitude, b.id AS prediction
FROM pts p JOIN best b ON p.rid = b.rid""",
        "street",
        ctes="""cent AS (
  SELECT CAST(dense_rank() OVER (ORDER BY crime_type) - 1 AS INTEGER) AS id,
         round(avg(latitude), 6) AS clat, round(avg(longitude), 6) AS clon
  FROM street GROUP BY crime_type),
pts AS (SELECT row_number() OVER () AS rid, crime_type, lsoa_code, latitude, longitude FROM street),
d AS (SELECT rid, id, (latitude - clat) * (latitude - clat) + (longitude - clon) * (longitude - clon) AS dist
      FROM pts CROSS JOIN cent),
best AS (SELECT rid, id FROM (SELECT rid, id, row_number() OVER (PARTITION BY rid ORDER BY dist, id) AS r FROM d)
         WHERE r = 1)""",
    ),
)
def q_assign_nearest(spark, sf):
    s = sv.street(spark, sf)
    cent = cluster.cluster_centroids(s, "crime_type", scale=6).withColumn(
        "prediction", (F.dense_rank().over(Window.orderBy("crime_type")) - 1).cast("int")
    )
    pts = s.select("crime_type", "lsoa_code", "latitude", "longitude")
    return cluster.assign_nearest(pts, cent, centre_cols=["centroid_lat", "centroid_lon"])


@register("cluster_centroids", "A15 D11", with_views("SELECT * FROM centroids", "centroids"))
def q_cluster_centroids(spark, sf):
    return cluster.cluster_centroids(sv.points(spark, sf))


@register(
    "map_center",
    "A16",
    with_views(
        "SELECT round(avg(latitude), 6) AS center_lat, round(avg(longitude), 6) AS center_lon FROM points", "points"
    ),
)
def q_map_center(spark, sf):
    return cluster.map_center(sv.points(spark, sf))


@register(
    "join_inner_centroids",
    "J2",
    with_views(
        "SELECT h.prediction, h.date, h.forecast, c.centroid_lat, c.centroid_lon FROM hotspot_series h JOIN centroids c ON h.prediction = c.prediction",
        "hotspot_series",
        "centroids",
    ),
)
def q_join_inner_centroids(spark, sf):
    return join.join_centroids(sv.hotspot_series(spark, sf), cluster.cluster_centroids(sv.points(spark, sf)))


@register(
    "map_layer",
    "P17 A18",
    with_views(
        """SELECT h.prediction, h.date, h.forecast, c.centroid_lat, c.centroid_lon,
       round(5.0 + h.forecast * 0.1, 6) AS radius,
       round(h.forecast / (SELECT max(forecast) FROM hotspot_series), 6) AS intensity,
       CAST(h.prediction % 10 AS INTEGER) AS colour_slot,
       printf('Cluster %d<br>%s: %d', h.prediction, CAST(h.date AS VARCHAR), CAST(trunc(h.forecast) AS INTEGER)) AS popup
FROM hotspot_series h JOIN centroids c ON h.prediction = c.prediction""",
        "hotspot_series",
        "centroids",
    ),
)
def q_map_layer(spark, sf):
    return maplayer.map_layer(sv.hotspot_series(spark, sf), cluster.cluster_centroids(sv.points(spark, sf)))


def _clean_points(spark, sf):
    """Cleaned street points, written once as Parquet: the KMeans fit reads two
    columns of it, the assignment all (as in the stages)."""
    path = sinks.write_flat_parquet(clean.clean_geo(sv.street(spark, sf)), scratch_path(spark, "clean-points"))
    return sources.read_parquet_table(spark, path)


# Oracle form of the fit: the same races and Lloyd rounds over lists of centres.
_KMEANS_CTES = """pts0 AS (SELECT DISTINCT * FROM street WHERE latitude <> 0 AND longitude <> 0),
pts AS (
  SELECT floor(latitude * 1000000 + 0.5)::BIGINT AS x, floor(longitude * 1000000 + 0.5)::BIGINT AS y, count(*) AS n
  FROM pts0 GROUP BY ALL),
seeds AS (
  SELECT 0 AS i, []::STRUCT(x BIGINT, y BIGINT)[] AS cs
  UNION ALL
  SELECT i + 1, list_append(any_value(cs), arg_min({'x': x, 'y': y}, (-ln(u) / w, x, y)))
  FROM (SELECT i, cs, x, y, (('0x' || substr(sha256('42:' || i || ':' || x || ':' || y), 1, 13))::BIGINT::DOUBLE + 1) / 4503599627370496 AS u,
               CASE WHEN i = 0 THEN n::DOUBLE
                    ELSE n::DOUBLE * list_min(list_transform(cs, lambda c: (x - c.x) * (x - c.x) + (y - c.y) * (y - c.y)))::DOUBLE END AS w
        FROM seeds, pts WHERE i < 8)
  WHERE w > 0 GROUP BY i),
lloyd AS (
  SELECT 0 AS i, cs FROM seeds WHERE i = 8
  UNION ALL
  SELECT i + 1, list_transform(any_value(cs), lambda c, j: coalesce(list_filter(list({'id': id, 'c': new}), lambda f: f.id = j)[1].c, c))
  FROM (SELECT i, any_value(cs) AS cs, id,
               {'x': ((2 * sum(n * x) + sum(n) - (2 * sum(n * x) + sum(n)) % (2 * sum(n)) - CASE WHEN (2 * sum(n * x) + sum(n)) % (2 * sum(n)) < 0 THEN 2 * sum(n) ELSE 0 END) // (2 * sum(n)))::BIGINT,
                'y': ((2 * sum(n * y) + sum(n) - (2 * sum(n * y) + sum(n)) % (2 * sum(n)) - CASE WHEN (2 * sum(n * y) + sum(n)) % (2 * sum(n)) < 0 THEN 2 * sum(n) ELSE 0 END) // (2 * sum(n)))::BIGINT} AS new
        FROM (SELECT i, cs, x, y, n,
                     list_min(list_transform(cs, lambda c, j: {'d': (x - c.x) * (x - c.x) + (y - c.y) * (y - c.y), 'id': j})).id AS id
              FROM lloyd, pts WHERE i < 20)
        GROUP BY i, id)
  GROUP BY i),
centres AS (SELECT cs FROM lloyd WHERE i = 20)"""


@register(
    "kmeans_fit",
    "C1 C2",
    _recursive(with_views(
        "SELECT (j - 1)::INT AS prediction, cs[j].x / 1000000.0::DOUBLE AS latitude, cs[j].y / 1000000.0::DOUBLE AS longitude FROM centres, range(1, 9) t(j)",
        "street",
        ctes=_KMEANS_CTES,
    )),
)
def q_kmeans_fit(spark, sf):
    return cluster.fit_centres(_clean_points(spark, sf), k=8, seed=42)


@register(
    "kmeans_assign",
    "C3 D4",
    _recursive(with_views(
        """SELECT pts0.*, (list_min(list_transform(cs, lambda c, j: {
         'd': (floor(latitude * 1000000 + 0.5)::BIGINT - c.x) * (floor(latitude * 1000000 + 0.5)::BIGINT - c.x)
              + (floor(longitude * 1000000 + 0.5)::BIGINT - c.y) * (floor(longitude * 1000000 + 0.5)::BIGINT - c.y), 'id': j})).id - 1)::INT AS prediction
FROM pts0, centres""",
        "street",
        ctes=_KMEANS_CTES,
    )),
)
def q_kmeans_assign(spark, sf):
    pts = _clean_points(spark, sf)
    return cluster.assign_centres(pts, cluster.fit_centres(pts, k=8, seed=42))


@register(
    "kmeans_invariants",
    "C1 C2 C3",
    with_views(
        """SELECT COUNT(*) AS n_rows, TRUE AS at_most_k, 0::BIGINT AS nearer_elsewhere
FROM (SELECT DISTINCT * FROM street WHERE latitude <> 0 AND longitude <> 0)""",
        "street",
    ),
)
def q_kmeans_invariants(spark, sf):
    """Of a fit with k = 8: all rows are kept, at most k clusters are used, and
    no point is nearer to the centre of another cluster."""
    pts = _clean_points(spark, sf)
    model = cluster.fit_kmeans(pts, k=8, seed=42)
    placed = cluster.kmeans_assign(pts, model).drop("features")
    again = cluster.assign_nearest(placed.withColumnRenamed("prediction", "own"), cluster.kmeans_centres(spark, model))

    def distance(centre):
        lat, lon = (F.col(c) - F.element_at(positions, (centre + 1).cast("int"))[c] for c in ("latitude", "longitude"))
        return lat * lat + lon * lon

    positions = F.array(*(
        F.struct(F.lit(float(c[0])).alias("latitude"), F.lit(float(c[1])).alias("longitude")) for c in model.clusterCenters()
    ))
    nearer = distance(F.col("prediction")) < distance(F.col("own")) - 1e-12
    return again.agg(
        F.count(F.lit(1)).alias("n_rows"),
        (F.count_distinct("own") <= 8).alias("at_most_k"),
        F.count_if(nearer).alias("nearer_elsewhere"),
    )


# ------------------------------------------------------------ forecasting (F, K6, U1, W5)


def _priority_series(spark, sf):
    """Monthly order counts per priority, without a partial last month, gaps
    filled with 0 (D13)."""
    orders = series.complete_months(sv.priority_orders(spark, sf))
    return series.gapfill(series.monthly_counts(orders, "date", "key"), "key").select("key", "month", "n")


def _train(spark, sf):
    return series.holdout_split(_priority_series(spark, sf), "key").filter(~F.col("is_test")).drop("is_test")


_TRAIN_SQL = """train AS (
  SELECT key, month, n FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY month DESC) AS r FROM complete_series)
  WHERE r > 6)"""


# Oracle form of the maximum-likelihood fit: lists and one recursive search.
# The coefficients of a point x, in SQL.
_R2, _TH, _SPHI, _STH = "tanh({x}[2])", "tanh({x}[3])", "tanh({x}[4])", "tanh({x}[5])"
_P1 = "(tanh({x}[1]) * (1 - tanh({x}[2])))"


def _evaluate_sql(x: str) -> str:
    """{v, f, sigma2, objective, scaled} of the list ``w`` at ``x``."""
    p1, p2, q, big_phi, big_theta = (t.format(x=x) for t in (_P1, _R2, _TH, _SPHI, _STH))
    u = f"""list_reduce(w, lambda s, o: list_append(s, o
      - {big_phi} * CASE WHEN len(s) >= 12 THEN w[len(s) - 11] ELSE 0 END
      - {big_theta} * CASE WHEN len(s) >= 12 THEN s[len(s) - 11] ELSE 0 END), []::DOUBLE[])[skipped + 1:]"""
    g0 = f"""(({p1} * (1 + {p2}) * {q} / (1 - {p2}) + 1 + {q} * {q} + {q} * {p1})
      / ((1 - {p2} * {p2}) - {p1} * {p1} * (1 + {p2}) / (1 - {p2})))"""
    g1 = f"(({p1} * {g0} + {q}) / (1 - {p2}))"
    run = f"""list_reduce({u}, lambda s, o: {{
      'a1': {p1} * o + s.a2 + s.p12 / s.p11 * (o - s.a1), 'a2': {p2} * o,
      'p11': s.p22 - s.p12 / s.p11 * s.p12 + 1, 'p12': {q}, 'p22': {q} * {q},
      'v': list_append(s.v, o - s.a1), 'f': list_append(s.f, s.p11)}},
      {{'a1': 0.0::DOUBLE, 'a2': 0.0::DOUBLE, 'p11': {g0}, 'p12': {p2} * {g1} + {q}, 'p22': {p2} * {p2} * {g0} + {q} * {q},
        'v': []::DOUBLE[], 'f': []::DOUBLE[]}})"""
    n = "greatest(len(r.v), 1)"
    squares = "coalesce(list_sum(list_transform(r.v, lambda a, i: a * a / r.f[i])), 0)"
    logs = "coalesce(list_sum(list_transform(r.f, lambda a: ln(a))), 0)"
    return f"""list_transform([{run}], lambda r: {{'v': r.v, 'f': r.f, 'sigma2': {squares} / {n},
      'objective': ln(greatest({squares} / {n}, 1e-12)) + {logs} / {n},
      'scaled': list_transform(r.v, lambda a, i: a / sqrt(r.f[i]) * exp({logs} / (2 * {n})))}})[1]"""


_DOT = "coalesce(list_sum(list_transform({a}, lambda o, g: o * {b}[g])), 0)"


def _search_sql(source: str) -> str:
    """CTEs from ``source`` (key, order columns, w, skipped, plain) to ``fits``
    with x, e and aic: the same start grid and damped steps as the operator."""
    grid = ", ".join(f"[{a}, 0.0, {b}, 0.0, 0.0]::DOUBLE[]" for a in likelihood.START for b in likelihood.START)
    order = "key, p, d, q, seasonal_p, seasonal_d, seasonal_q"
    beside = "list_transform(x, lambda o, i: CASE WHEN i = j THEN o + 1e-6 ELSE o END)"
    slope = f"list_transform({_evaluate_sql('y')}.scaled, lambda o, i: (o - e.scaled[i]) / 1e-6)"
    slopes = f"list_transform(list_transform(active, lambda j: {beside}), lambda y: {slope})"
    length = f"greatest({_DOT.format(a='e.scaled', b='e.scaled')}, 1e-12)"
    gradient = f"list_transform(slopes, lambda a: 2 * {_DOT.format(a='a', b='e.scaled')} / {length})"
    row = f"""list_concat(list_transform(slopes, lambda b, k: 2 * {_DOT.format(a='a', b='b')} / {length}
        * CASE WHEN i = k THEN 1.001 ELSE 1 END + CASE WHEN i = k THEN 1e-9 ELSE 0 END),
        list_transform(slopes, lambda b, k: CASE WHEN i = k THEN 1.0 ELSE 0.0 END::DOUBLE))"""
    inverse = f"""list_transform(list_reduce(range(1, len(slopes) + 1), lambda z, k: list_transform(z, lambda r, i:
        list_transform(r, lambda c, j: CASE WHEN i = k THEN c / z[k][k] ELSE c - r[k] * z[k][j] / z[k][k] END)),
        list_transform(slopes, lambda a, i: {row})), lambda r: r[len(slopes) + 1:])"""
    moved = f"""least(6.0, greatest(-6.0, o + CASE WHEN list_contains(active, i)
        THEN -part * list_transform([h[list_position(active, i)]], lambda c: {_DOT.format(a='c', b='gradient')})[1] ELSE 0 END))"""
    sy = _DOT.format(a="step", b="y")
    corrected = f"""CASE WHEN {sy} > 1e-14 THEN list_transform(h, lambda r, i: list_transform(r, lambda c, k:
        c - (step[i] * hy[k] + hy[i] * step[k]) / {sy} + (1 + {_DOT.format(a='y', b='hy')} / {sy}) * step[i] * step[k] / {sy})) ELSE h END"""
    keep = f"{order}, size, skipped, plain, active, w"
    return ",\n".join([
        f"""g0 AS (
  SELECT *, p + q + seasonal_p + seasonal_q AS size,
         CASE WHEN len(w) - skipped >= p + q + seasonal_p + seasonal_q + 5
              THEN list_filter([CASE WHEN p >= 1 THEN 1 END, CASE WHEN p >= 2 THEN 2 END, CASE WHEN q >= 1 THEN 3 END,
                                CASE WHEN seasonal_p >= 1 THEN 4 END, CASE WHEN seasonal_q >= 1 THEN 5 END], lambda c: c IS NOT NULL)
              ELSE [] END AS active
  FROM {source}),
g1 AS (
  SELECT *, unnest(list_filter([{grid}], lambda g: (list_contains(active, 1) OR g[1] = 0) AND (list_contains(active, 3) OR g[3] = 0))) AS x
  FROM g0),
g2 AS (SELECT *, {_evaluate_sql('x')} AS e FROM g1),
g3 AS (
  SELECT * FROM g2 QUALIFY row_number() OVER (PARTITION BY {order}, x[1] >= 0, x[1] + x[3] >= 0 ORDER BY e.objective, x) = 1),
g4 AS (SELECT *, {slopes} AS slopes FROM g3),
search AS (
  SELECT {keep}, 1 AS k, x, e, 1.0::DOUBLE AS part, {gradient} AS gradient, {inverse} AS h FROM g4
  UNION ALL
  SELECT {keep}, k + 1, x, e, CASE WHEN better THEN 1.0 ELSE part / 4 END, CASE WHEN better THEN new_gradient ELSE gradient END,
         CASE WHEN better THEN {corrected} ELSE h END
  FROM (SELECT *, list_transform(h, lambda r: {_DOT.format(a='r', b='y')}) AS hy FROM (
    SELECT *, list_transform(new_gradient, lambda o, i: o - gradient[i]) AS y FROM (
      SELECT *, {gradient} AS new_gradient FROM (
        SELECT *, {slopes} AS slopes FROM (
          SELECT {keep}, k, part, gradient, h, better, step, CASE WHEN better THEN nx ELSE x END AS x, CASE WHEN better THEN tried ELSE e END AS e
          FROM (SELECT *, tried.objective < e.objective AS better, list_transform(active, lambda j: nx[j] - x[j]) AS step FROM (
            SELECT *, {_evaluate_sql('nx')} AS tried FROM (
              SELECT *, list_transform(x, lambda o, i: {moved}) AS nx FROM search WHERE k < 31))))))))),
fits AS (
  SELECT * EXCLUDE (w, k, part, gradient, h, active), len(w) - skipped AS nobs,
         CASE WHEN len(w) > skipped THEN (len(w) - skipped) * (e.objective + ln(2 * pi()) + 1) END AS m2ll,
         CASE WHEN len(w) > skipped THEN (len(w) - skipped) * (e.objective + ln(2 * pi()) + 1) + 2 * (size + plain::INT + 1) END AS aic
  FROM search WHERE k = 31 QUALIFY row_number() OVER (PARTITION BY {order} ORDER BY e.objective, x) = 1)""",
    ])


def _held_sql(source: str) -> str:
    return f"""held AS (
  SELECT key, list(month ORDER BY month) AS months, list(n::DOUBLE ORDER BY month) AS y FROM {source} GROUP BY key)"""


def _diff_sql(xs: str, lag: int) -> str:
    return f"list_transform({xs}[{lag + 1}:], lambda o, i: o - {xs}[i])"


_ONE_FIT_SQL = f"""ready AS (
  SELECT key, 1 AS p, 1 AS d, 1 AS q, 0 AS seasonal_p, 0 AS seasonal_d, 0 AS seasonal_q, {_diff_sql('y', 1)} AS w,
         0 AS skipped, FALSE AS plain, 0.0::DOUBLE AS mean
  FROM held)"""

# KPSS statistic of a list z: partial sums over the long-run variance.
_KPSS_SQL = """list_transform([list_transform({z}, lambda o: o - list_avg({z}))], lambda c:
   list_sum(list_transform(c, lambda o, i: pow(list_sum(c[1:i]), 2))) / (len(c) * len(c))
   / (list_sum(list_transform(c, lambda o: o * o)) / len(c)
      + 2 * coalesce(list_sum(list_transform(range(1, floor(3 * sqrt(len(c)) / 13)::BIGINT + 1), lambda h:
          (1 - h / (floor(3 * sqrt(len(c)) / 13) + 1)) * list_sum(list_transform(c[h + 1:], lambda o, i: o * c[i])) / len(c))), 0)))[1]"""

_GRID_FIT_SQL = f"""placed AS (
  SELECT key, n::DOUBLE AS y, row_number() OVER o AS t, count(*) OVER (PARTITION BY key) AS months,
         (avg(n::DOUBLE) OVER (PARTITION BY key ORDER BY month ROWS BETWEEN 6 PRECEDING AND 5 FOLLOWING)
          + avg(n::DOUBLE) OVER (PARTITION BY key ORDER BY month ROWS BETWEEN 5 PRECEDING AND 6 FOLLOWING)) / 2 AS trend
  FROM complete_series WINDOW o AS (PARTITION BY key ORDER BY month)),
parted AS (
  SELECT key, months, y - trend AS x, avg(y - trend) OVER (PARTITION BY key, t % 12) AS season
  FROM placed WHERE t > 6 AND t <= months - 6),
strength AS (
  SELECT key, CASE WHEN any_value(months) >= 36 THEN greatest(0, 1 - var_pop(x - season) / var_pop(x)) ELSE 0 END AS strong
  FROM parted GROUP BY key),
seasons AS (
  SELECT held.*, CASE WHEN coalesce(strong, 0) > 0.64 AND len(y) > 29 THEN 1 ELSE 0 END AS seasonal_d
  FROM held LEFT JOIN strength USING (key)),
level0 AS (SELECT *, CASE WHEN seasonal_d = 1 THEN {_diff_sql('y', 12)} ELSE y END AS z FROM seasons),
level1 AS (SELECT *, CASE WHEN {_KPSS_SQL.format(z='z')} <= 0.463 THEN 0 ELSE 1 END AS d FROM level0),
level2 AS (
  SELECT *, d + seasonal_d = 0 AS plain, CASE WHEN d + seasonal_d = 0 THEN list_avg(z) ELSE 0 END AS mean,
         CASE WHEN d = 1 THEN {_diff_sql('z', 1)} WHEN seasonal_d = 0 THEN list_transform(z, lambda o: o - list_avg(z)) ELSE z END AS w
  FROM level1),
ready AS (
  SELECT key, p, d, q, seasonal_p, seasonal_d, seasonal_q, w, CASE WHEN len(w) > 36 THEN 12 ELSE 0 END AS skipped, plain, mean
  FROM level2, (VALUES (0), (1), (2)) ps(p), (VALUES (0), (1)) qs(q), (VALUES (0), (1)) sps(seasonal_p), (VALUES (0), (1)) sqs(seasonal_q)
  WHERE len(w) > 36 OR seasonal_p + seasonal_q = 0)"""

_RANK = "aic IS NULL, aic, size, p, q, seasonal_p, seasonal_q"
_PICK_SQL = f"""pick1 AS (
  SELECT * FROM fits WHERE seasonal_p + seasonal_q = 0 QUALIFY row_number() OVER (PARTITION BY key ORDER BY {_RANK}) = 1),
pick2 AS (
  SELECT f.* FROM fits f JOIN pick1 b ON f.key IS NOT DISTINCT FROM b.key AND f.p = b.p AND f.q = b.q
  QUALIFY row_number() OVER (PARTITION BY f.key ORDER BY {', '.join('f.' + c for c in _RANK.split(', '))}) = 1),
picked AS (
  SELECT f.* FROM fits f JOIN pick2 b ON f.key IS NOT DISTINCT FROM b.key
    AND ((f.p = b.p AND f.q = b.q AND f.seasonal_p = b.seasonal_p AND f.seasonal_q = b.seasonal_q)
         OR (b.seasonal_p + b.seasonal_q > 0 AND f.seasonal_p = b.seasonal_p AND f.seasonal_q = b.seasonal_q))
  QUALIFY row_number() OVER (PARTITION BY f.key ORDER BY {', '.join('f.' + c for c in _RANK.split(', '))}) = 1)"""


def _chosen_sql(picked: str) -> str:
    return f"""chosen AS (
  SELECT f.*, h.y AS history, h.months, r.mean, h.months[-1] AS last_month, e.sigma2 AS sigma2,
         {_P1.format(x='x')} AS phi1, {_R2.format(x='x')} AS phi2, {_TH.format(x='x')} AS theta,
         {_SPHI.format(x='x')} AS big_phi, {_STH.format(x='x')} AS big_theta
  FROM {picked} f JOIN held h ON f.key IS NOT DISTINCT FROM h.key
  JOIN (SELECT DISTINCT key, mean FROM ready) r ON f.key IS NOT DISTINCT FROM r.key)"""


# Recursions over the parameter row: mean, psi weights, error of the last shock.
_FORECAST_SQL = """poly1 AS (SELECT *, [1.0, -phi1, -phi2, 0.0]::DOUBLE[] AS c1 FROM chosen),
poly2 AS (
  SELECT *, CASE WHEN d = 1 THEN list_transform(range(1, 6), lambda i: coalesce(c1[i], 0) - CASE WHEN i > 1 THEN c1[i - 1] ELSE 0 END)
                 ELSE c1 END AS c2 FROM poly1),
poly3 AS (
  SELECT *, CASE WHEN seasonal_d = 1
                 THEN list_transform(range(1, len(c2) + 13), lambda i: coalesce(c2[i], 0) - CASE WHEN i > 12 THEN coalesce(c2[i - 12], 0) ELSE 0 END)
                 ELSE c2 END AS c3 FROM poly2),
poly4 AS (
  SELECT *, CASE WHEN seasonal_p = 1
                 THEN list_transform(range(1, len(c3) + 13), lambda i: coalesce(c3[i], 0) - big_phi * CASE WHEN i > 12 THEN coalesce(c3[i - 12], 0) ELSE 0 END)
                 ELSE c3 END AS c4 FROM poly3),
poly AS (
  SELECT *, list_transform(c4[2:], lambda o: -o) AS a, mean * (1 - phi1 - phi2) * (1 - big_phi) AS c,
         list_transform(range(0, 14), lambda j: CASE j WHEN 0 THEN 1 WHEN 1 THEN theta WHEN 12 THEN big_theta WHEN 13 THEN theta * big_theta ELSE 0 END) AS ma,
         list_transform(e.v, lambda o, i: CASE WHEN i = len(e.v) THEN o / e.f[i] ELSE o END) AS shocks,
         coalesce(sigma2 * theta * theta * (1 - 1 / e.f[-1]), 0) AS shock_var FROM poly4),
rec AS (
  SELECT key, 0 AS k, a, c, ma, shocks, big_theta, sigma2, shock_var, last_month,
         list_concat(list_transform(range(greatest(len(a) - len(history), 0)::BIGINT), lambda i: history[1]), history) AS acc,
         list_transform(range(len(a)::BIGINT), lambda i: 0.0::DOUBLE) AS psi, list_transform(range(len(a)::BIGINT), lambda i: 0.0::DOUBLE) AS chi
  FROM poly
  UNION ALL
  SELECT key, k + 1, a, c, ma, shocks, big_theta, sigma2, shock_var, last_month,
         list_append(acc, c + list_sum(list_transform(a, lambda o, j: o * acc[len(acc) + 1 - j]))
                          + coalesce(list_sum(list_transform(range(k + 1, 14), lambda j:
                              ma[j + 1] * CASE WHEN len(shocks) - j + k + 1 >= 1 THEN shocks[len(shocks) - j + k + 1] ELSE 0 END)), 0)),
         list_append(psi, list_sum(list_transform(a, lambda o, j: o * psi[len(psi) + 1 - j])) + coalesce(ma[k + 1], 0)),
         list_append(chi, list_sum(list_transform(a, lambda o, j: o * chi[len(chi) + 1 - j]))
                          + CASE k WHEN 0 THEN 1 WHEN 12 THEN big_theta ELSE 0 END)
  FROM rec WHERE k < 6),
fc AS (
  SELECT key, k AS step, CAST(last_month + to_months(k) AS DATE) AS month, acc[len(acc)] AS mean,
         sqrt(sigma2 * list_sum(list_transform(psi[len(a) + 1:], lambda o: o * o)) + shock_var * chi[len(chi)] * chi[len(chi)]) AS mean_se
  FROM rec WHERE k > 0)"""

_BAND = "round(mean, 2) AS mean, round(mean_se, 2) AS mean_se, round(mean - 1.959963984540054 * mean_se, 2) AS lower, round(mean + 1.959963984540054 * mean_se, 2) AS upper"


_ONE_CTES = ",\n".join([_TRAIN_SQL, _held_sql("train"), _ONE_FIT_SQL, _search_sql("ready"), _chosen_sql("fits"), _FORECAST_SQL])
_GRID_CTES = ",\n".join([
    _held_sql("complete_series"), _GRID_FIT_SQL, _search_sql("ready"), _PICK_SQL, _chosen_sql("picked"), _FORECAST_SQL
])
_FORECAST_ONE_SQL = _recursive(with_views(f"SELECT key, step, month, {_BAND} FROM fc", "complete_series", ctes=_ONE_CTES))


def _rounded(df: DataFrame, *cols: str, scale: int = 4) -> DataFrame:
    return df.withColumns({c: F.round(c, scale) for c in cols})


@register(
    "arima_fit",
    "F1 K6",
    _recursive(with_views(
        """SELECT key, p, d, q, round(phi1, 5) AS phi, round(theta, 5) AS theta, round(sigma2, 3) AS sigma2,
       round(-m2ll / 2, 5) AS loglik, round(aic, 5) AS aic, nobs, last_month FROM chosen""",
        "complete_series",
        ctes=_ONE_CTES,
    )),
)
def q_arima_fit(spark, sf):
    params = forecast.fit_arima(_train(spark, sf), "key", order=(1, 1, 1))
    one = params.withColumns({c: F.round(F.element_at(c, 1), 5) for c in ("phi", "theta")})
    one = _rounded(_rounded(one, "sigma2", scale=3), "loglik", "aic", scale=5)
    return one.select("key", "p", "d", "q", "phi", "theta", "sigma2", "loglik", "aic", "nobs", "last_month")


@register("arima_forecast", "F2", _FORECAST_ONE_SQL)
def q_arima_forecast(spark, sf):
    fc = forecast.arima_forecast(_train(spark, sf), "key", order=(1, 1, 1), horizon=6)
    return _rounded(fc, "mean", "mean_se", "lower", "upper", scale=2)


@register(
    "auto_arima_select",
    "F3",
    _recursive(with_views(
        """SELECT key, p, d, q, seasonal_p, seasonal_d, seasonal_q, 12 AS m, round(aic, 4) AS aic, round(sigma2, 2) AS sigma2
FROM chosen""",
        "complete_series",
        ctes=_GRID_CTES,
    )),
)
def q_auto_arima_select(spark, sf):
    best = forecast.auto_arima(_priority_series(spark, sf), "key")
    best = _rounded(_rounded(best, "aic"), "sigma2", scale=2)
    return best.select("key", "p", "d", "q", "seasonal_p", "seasonal_d", "seasonal_q", "m", "aic", "sigma2")


@register(
    "forecast_by_key",
    "F4",
    _recursive(with_views(
        f"SELECT key, month AS date, forecast, lower, upper FROM (SELECT key, month, round(mean, 2) AS forecast, {_BAND} FROM fc)",
        "complete_series",
        ctes=_GRID_CTES,
    )),
)
def q_forecast_by_key(spark, sf):
    return _rounded(forecast.forecast_by_key(_priority_series(spark, sf), "key", horizon=6), "forecast", "lower", "upper", scale=2)


@register("model_params_roundtrip", "K6 F5", _FORECAST_ONE_SQL)
def q_model_params_roundtrip(spark, sf):
    params = forecast.fit_arima(_train(spark, sf), "key", order=(1, 1, 1))
    saved = sinks.write_flat_parquet(params, scratch_path(spark, "arima-params"))
    fc = forecast.forecast_from_params(sources.read_parquet_table(spark, saved), "key", horizon=6)
    return _rounded(fc, "mean", "mean_se", "lower", "upper", scale=2)


@register(
    "arima_holdout_metrics",
    "F6 W3",
    _recursive(with_views(
        """SELECT key, round(sqrt(avg((n - mean) * (n - mean))), 3) AS rmse, round(avg(abs(n - mean)), 3) AS mae
FROM fc JOIN complete_series USING (key, month) GROUP BY key""",
        "complete_series",
        ctes=_ONE_CTES,
    )),
)
def q_arima_holdout_metrics(spark, sf):
    s = series.holdout_split(_priority_series(spark, sf), "key")
    fc = forecast.arima_forecast(s.filter(~F.col("is_test")), "key", horizon=6)
    fc = fc.select(F.col("key").alias("fc_key"), F.col("month").alias("fc_month"), "mean")
    on = F.col("key").eqNullSafe(F.col("fc_key")) & (F.col("month") == F.col("fc_month"))
    scored = s.filter("is_test").join(fc, on, "inner")
    return _rounded(series.forecast_metrics(scored, "key", "n", "mean", scale=None), "rmse", "mae", scale=3)


_AVF_SQL = """SELECT key, month, s.n AS actual, mean, lower, upper, mean IS NOT NULL AS is_forecast,
       min(CASE WHEN mean IS NOT NULL THEN month END) OVER (PARTITION BY key) AS forecast_start
FROM complete_series s FULL JOIN {forecast} f USING (key, month)"""


@register(
    "actual_vs_forecast",
    "W5",
    _recursive(with_views(
        _AVF_SQL.format(forecast=f"(SELECT key, month, {_BAND} FROM fc)"), "complete_series", ctes=_ONE_CTES
    )),
)
def q_actual_vs_forecast(spark, sf):
    s = _priority_series(spark, sf)
    train = series.holdout_split(s, "key").filter(~F.col("is_test"))
    fc = forecast.arima_forecast(train, "key", horizon=6)
    return _rounded(series.actual_vs_forecast(s, fc, "key"), "mean", "lower", "upper", scale=2)


_NAIVE_SQL = """naive AS (
  SELECT key, CAST(month + INTERVAL 12 MONTH AS DATE) AS month, n::DOUBLE AS mean, n * 0.9::DOUBLE AS lower, n * 1.1::DOUBLE AS upper
  FROM (SELECT *, max(month) OVER (PARTITION BY key) AS last FROM complete_series) WHERE month + INTERVAL 18 MONTH > last)"""


@register(
    "actual_vs_supplied_forecast",
    "W5 S9",
    with_views(
        _AVF_SQL.format(forecast="(SELECT key, month, mean, round(lower, 4) AS lower, round(upper, 4) AS upper FROM naive)"),
        "complete_series",
        ctes=_NAIVE_SQL,
    ),
)
def q_actual_vs_supplied_forecast(spark, sf):
    """A saved forecast (last year's value, from six months before the end of
    the series on) read back from CSV with its DATE column, next to the history."""
    s = _priority_series(spark, sf)
    last = F.max("month").over(Window.partitionBy("key"))
    recent = s.withColumn("last", last).filter(F.add_months("month", 18) > F.col("last"))
    n = F.col("n").cast("double")
    naive = recent.select("key", F.add_months("month", 12).alias("month"), n.alias("mean"), (n * 0.9).alias("lower"), (n * 1.1).alias("upper"))
    path = sinks.write_single_csv(naive, scratch_path(spark, "supplied-forecast"))
    saved = sources.read_summary_csv(spark, path, "key STRING, month DATE, mean DOUBLE, lower DOUBLE, upper DOUBLE")
    return _rounded(series.actual_vs_forecast(s, saved, "key"), "lower", "upper")


# Residuals of the one-order fit, and the normal quantile by Newton's method on
# the power series of the normal distribution function.
_RESIDUAL_CTES = _ONE_CTES + """,
resid AS (SELECT key, unnest(months[2:]) AS month, unnest(e.v) AS r FROM chosen),
scaled AS (SELECT key, month, r, (r - avg(r) OVER b) / stddev_samp(r) OVER b AS z, count(*) OVER b AS n FROM resid WINDOW b AS (PARTITION BY key)),
placed AS (
  SELECT *, percent_rank() OVER (PARTITION BY key ORDER BY z) AS quantile_rank,
         row_number() OVER (PARTITION BY key ORDER BY z, month) / (n + 1) AS share FROM scaled)"""
_QUANTILE_SQL = """list_reduce(range(40), lambda g, i:
    g - (0.5 - share + exp(-g * g / 2) / sqrt(2 * pi())
           * list_reduce(range(1, 120), lambda s, k: {'t': s.t * g * g / (2 * k + 1), 'sum': s.sum + s.t * g * g / (2 * k + 1)}, {'t': g, 'sum': g}).sum)
        / (exp(-g * g / 2) / sqrt(2 * pi())), 0.0::DOUBLE)"""


def _one_residuals(spark, sf):
    return forecast.residuals(forecast.fit_arima(_train(spark, sf), "key", order=(1, 1, 1)), "key")


@register(
    "residual_diagnostics",
    "F7",
    _recursive(with_views(
        f"""SELECT key, month, round(r, 2) AS resid, round(z, 3) AS std_resid,
       least(greatest(floor((z + 4) / 0.8), 0), 9)::INT AS bucket, round(quantile_rank, 6) AS quantile_rank,
       round({_QUANTILE_SQL}, 6) AS theoretical_quantile
FROM placed""",
        "complete_series",
        ctes=_RESIDUAL_CTES,
    )),
)
def q_residual_diagnostics(spark, sf):
    table = series.standardized_residuals(_one_residuals(spark, sf), "key", "month", "resid")
    return _rounded(_rounded(table, "resid", scale=2), "std_resid", scale=3)


@register(
    "residual_density",
    "F7",
    _recursive(with_views(
        """SELECT key, x, round(avg(exp(-pow((x - z) * pow(n, 0.2), 2) / 2) * pow(n, 0.2) / sqrt(2 * pi())), 4) AS density,
       round(exp(-x * x / 2) / sqrt(2 * pi()), 4) AS normal_density
FROM scaled, (SELECT round(-3.92 + 7.84 * i / 49, 6) AS x FROM range(50) t(i)) GROUP BY key, x""",
        "complete_series",
        ctes=_RESIDUAL_CTES,
    )),
)
def q_residual_density(spark, sf):
    table = series.residual_density(_one_residuals(spark, sf), "key", "resid")
    return _rounded(_rounded(table, "density", "normal_density"), "x", scale=6)


@register(
    "residual_acf_band",
    "F7",
    # The tail beyond q for k degrees of freedom: one less the power series of the lower part.
    _recursive(with_views(
        """SELECT key, lag, round(acf, 4) AS acf, round(1.959963984540054 * sqrt((1 + 2 * shorter) / n), 4) AS band, round(lb, 3) AS ljung_box,
       round(1 - exp(lag / 2 * ln(lb / 2) - lb / 2)
               * list_sum(list_transform(range(400), lambda i: exp(i * ln(lb / 2) - lgamma(lag / 2 + i + 1)))), 4) AS p
FROM (SELECT key, lag, acf, n, coalesce(sum(acf * acf) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS shorter,
             n * (n + 2) * sum(acf * acf / (n - lag)) OVER o AS lb FROM acfs WINDOW o AS (PARTITION BY key ORDER BY lag))""",
        "complete_series",
        ctes=_RESIDUAL_CTES + """,
lists AS (SELECT key, count(*) AS n, list(r - mu ORDER BY month) AS c FROM (SELECT *, avg(r) OVER (PARTITION BY key) AS mu FROM resid) GROUP BY key),
acfs AS (
  SELECT key, n, lag, list_sum(list_transform(c[lag + 1:], lambda o, i: o * c[i])) / list_sum(list_transform(c, lambda o: o * o)) AS acf
  FROM lists, (SELECT i AS lag FROM range(1, 11) t(i)))""",
    ).replace("lag, round(acf", "lag::INT AS lag, round(acf", 1)),
)
def q_residual_acf_band(spark, sf):
    table = series.acf_diagnostics(_one_residuals(spark, sf), "key", "month", "resid")
    return _rounded(_rounded(table, "acf", "band", "p"), "ljung_box", scale=3)


@register(
    "union_forecasts",
    "U1",
    with_views(
        """SELECT 'street' AS source, CAST(date_trunc('month', date) AS DATE) AS month, COUNT(*) AS n FROM street GROUP BY 2
UNION ALL
SELECT 'outcomes' AS source, CAST(date_trunc('month', date) AS DATE) AS month, COUNT(*) AS n FROM outcomes GROUP BY 2""",
        "street",
        "outcomes",
    ),
)
def q_union_forecasts(spark, sf):
    a = series.monthly_counts(sv.street(spark, sf), "date").withColumn("source", F.lit("street"))
    b = series.monthly_counts(sv.outcomes(spark, sf), "date").select(F.lit("outcomes").alias("source"), "n", "month")
    return forecast.union_forecasts(a, b)


# ------------------------------------------------------- text, dates, casts (P)


@register(
    "parse_year_month",
    "P2 P5 D10",
    with_views(
        "SELECT crime_id, month_text, CAST(try_strptime(month_text, '%Y-%m') AS DATE) AS date FROM street_text",
        "street_text",
    ),
)
def q_parse_year_month(spark, sf):
    t = sv.street_text(spark, sf)
    return t.select("crime_id", "month_text", parse_year_month("month_text").alias("date"))


@register(
    "date_parts",
    "P3",
    "SELECT o_orderkey AS crime_id, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month FROM orders",
)
def q_date_parts(spark, sf):
    o = sv.read(spark, sf, "orders")
    return o.select(F.col("o_orderkey").alias("crime_id"), *date_parts(F.to_date("o_orderdate")))


@register(
    "parse_timestamp_date",
    "P4 D2",
    """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S+00:00') AS date_text, CAST(ts AS DATE) AS date,
       date_trunc('second', ts) AS event_ts
FROM events""",
)
def q_parse_timestamp_date(spark, sf):
    e = sv.read(spark, sf, "events").select(
        "event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias("date_text")
    )
    return e.select(
        "event_id",
        "date_text",
        parse_timestamp_date("date_text").alias("date"),
        parse_timestamp_text("date_text").alias("event_ts"),
    )


@register(
    "cast_coordinates",
    "P6 D10",
    with_views(
        "SELECT crime_id, TRY_CAST(latitude AS DOUBLE) AS latitude, TRY_CAST(longitude AS DOUBLE) AS longitude FROM street_text",
        "street_text",
    ),
)
def q_cast_coordinates(spark, sf):
    t = sv.street_text(spark, sf)
    return t.select("crime_id", to_double("latitude").alias("latitude"), to_double("longitude").alias("longitude"))


@register(
    "filter_not_null",
    "R2",
    with_views(
        """SELECT * FROM (SELECT crime_id, TRY_CAST(latitude AS DOUBLE) AS latitude, TRY_CAST(longitude AS DOUBLE) AS longitude
               FROM street_text) WHERE latitude IS NOT NULL AND longitude IS NOT NULL""",
        "street_text",
    ),
)
def q_filter_not_null(spark, sf):
    t = sv.street_text(spark, sf)
    typed = t.select("crime_id", to_double("latitude").alias("latitude"), to_double("longitude").alias("longitude"))
    return clean.filter_not_null(typed, "latitude", "longitude")


@register(
    "filter_nonzero_coords",
    "R3 D1",
    with_views(
        """SELECT crime_id, latitude, longitude FROM street_text
WHERE TRY_CAST(latitude AS DOUBLE) <> 0 AND TRY_CAST(longitude AS DOUBLE) <> 0""",
        "street_text",
    ),
)
def q_filter_nonzero_coords(spark, sf):
    return clean.filter_nonzero_coords(sv.street_text(spark, sf).select("crime_id", "latitude", "longitude"))


@register("project_columns", "P8", with_views("SELECT crime_id, crime_type FROM street", "street"))
def q_project_columns(spark, sf):
    return columns.project_columns(sv.street(spark, sf), "crime_id", "crime_type")


@register(
    "fill_unknown",
    "P10",
    with_views(
        """SELECT COALESCE(o.outcome_type, 'Unknown') AS outcome_type, COUNT(*) AS "count"
FROM street s LEFT JOIN outcomes o ON s.crime_id = o.crime_id GROUP BY 1""",
        "street",
        "outcomes",
    ),
)
def q_fill_unknown(spark, sf):
    counts = summary.rollup_counts(_pairs(spark, sf), "outcome_type")
    return counts.select(fill_unknown("outcome_type").alias("outcome_type"), "count")


@register(
    "label_fallback",
    "P12",
    with_views(
        """SELECT COALESCE(CASE WHEN lsoa_name = 'F' THEN NULL ELSE lsoa_name END, lsoa_code) AS area, COUNT(*) AS "count"
FROM street GROUP BY 1""",
        "street",
    ),
)
def q_label_fallback(spark, sf):
    s = sv.street(spark, sf).withColumn(
        "lsoa_name", F.when(F.col("lsoa_name") == "F", F.lit(None)).otherwise(F.col("lsoa_name"))
    )
    return summary.count_by(s, label_fallback(s, "lsoa_name", "lsoa_code").alias("area"))


@register(
    "make_month_date",
    "P13",
    with_views('SELECT make_date(year, month, 1) AS month_date, COUNT(*) AS "count" FROM street GROUP BY year, month', "street"),
)
def q_make_month_date(spark, sf):
    t = summary.year_month_trend(sv.street(spark, sf))
    return t.select(make_month_date("year", "month").alias("month_date"), "count")


# ------------------------------------------------------ nulls and samples


@register(
    "drop_any_null",
    "R5",
    with_views(
        """SELECT * FROM (SELECT s.crime_id, s.crime_type, o.outcome_type
               FROM street s LEFT JOIN outcomes o ON s.crime_id = o.crime_id)
WHERE crime_id IS NOT NULL AND crime_type IS NOT NULL AND outcome_type IS NOT NULL""",
        "street",
        "outcomes",
    ),
)
def q_drop_any_null(spark, sf):
    s = sv.street(spark, sf).select("crime_id", "crime_type")
    return clean.drop_any_null(join.join_outcomes(s, sv.outcomes(spark, sf)))


@register(
    "drop_null_subset",
    "R6",
    with_views(
        """SELECT * FROM (SELECT s.crime_id, s.crime_type, o.outcome_type
               FROM street s LEFT JOIN outcomes o ON s.crime_id = o.crime_id)
WHERE outcome_type IS NOT NULL""",
        "street",
        "outcomes",
    ),
)
def q_drop_null_subset(spark, sf):
    s = sv.street(spark, sf).select("crime_id", "crime_type")
    return clean.drop_null_subset(join.join_outcomes(s, sv.outcomes(spark, sf)), ["outcome_type"])


@register("sample_bernoulli", "R7 D9")
def q_sample_bernoulli(spark, sf):
    return clean.sample_bernoulli(sv.points(spark, sf), fraction=0.1, seed=42)


@register(
    "sample_bernoulli_invariants",
    "R7 D9",
    "SELECT TRUE AS repeats, TRUE AS near_fraction, 0::BIGINT AS not_in_input",
)
def q_sample_bernoulli_invariants(spark, sf):
    """The same seed gives the same rows, about the fraction, all from the input."""
    pts = sv.points(spark, sf)
    one, two = (clean.sample_bernoulli(pts, fraction=0.1, seed=42).select("vec_id") for _ in range(2))
    ids = one.withColumn("a", F.lit(1)).join(two.withColumn("b", F.lit(1)), "vec_id", "full")
    both = ids.join(pts.select("vec_id", F.lit(1).alias("c")), "vec_id", "full")
    return both.agg(
        (F.count_if(F.col("a").isNull() != F.col("b").isNull()) == 0).alias("repeats"),
        (F.abs(F.count("a") / F.count("c") - 0.1) < 0.05).alias("near_fraction"),
        F.count_if(F.col("c").isNull()).alias("not_in_input"),
    )


@register(
    "sample_by_key",
    "R7 D9",
    with_views("SELECT * FROM street WHERE crime_id % 10 = 0", "street"),
)
def q_sample_by_key(spark, sf):
    return clean.sample_by_key(sv.street(spark, sf), "crime_id", buckets=10, keep=1, hashed=False)


# --------------------------------------------------------- sources and sinks (S, K)


@register(
    "scan_csv_glob",
    "S1 S2 S3 P1 P2 P3 P6",
    """SELECT CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE CAST(l_orderkey AS VARCHAR) END AS crime_id,
       'Central Force' AS reported_by, 'Central Force' AS falls_within,
       l_discount AS longitude, l_tax AS latitude, 'On or near ' || CAST(l_partkey AS VARCHAR) AS location,
       CAST(l_suppkey AS VARCHAR) AS lsoa_code, l_linestatus AS lsoa_name, l_returnflag AS crime_type,
       CAST(NULL AS VARCHAR) AS last_outcome_category, CAST(NULL AS VARCHAR) AS context,
       CAST(date_trunc('month', l_shipdate) AS DATE) AS date,
       CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month
FROM lineitem""",
)
def q_scan_csv_glob(spark, sf):
    raw = sv.street_raw(spark, sf)
    base = scratch_path(spark, "raw-street")
    # Month folders, as the feeds arrive: <base>/<folder>/part-*.csv
    raw.withColumn("folder", F.col("Month")).hint("rebalance", "folder").write.mode("overwrite").partitionBy(
        "folder"
    ).option("header", True).csv(base)
    return sources.ingest_feed(spark, "street", f"{base}/*/*.csv")


@register(
    "scan_csv_suffix_glob",
    "S1 S2",
    """SELECT 'street' AS feed, CAST(date_trunc('month', l_shipdate) AS DATE) AS date, COUNT(*) AS n FROM lineitem GROUP BY 2
UNION ALL
SELECT 'outcomes', CAST(date_trunc('month', o_orderdate) AS DATE), COUNT(*) FROM orders GROUP BY 2""",
)
def q_scan_csv_suffix_glob(spark, sf):
    """Two feeds in the same month folders, told apart by ``*-<feed>.csv``."""
    base = scratch_path(spark, "raw-mixed")
    for feed in ("street", "outcomes"):
        raw = sv.RAW_FEEDS[feed](spark, sf)
        month = F.substring(F.col("Month"), 1, 7)
        placed = raw.withColumn("folder", month).withColumn("file", F.concat(month, F.lit(f"-{feed}.csv")))
        placed.hint("rebalance", "folder").write.mode("append").partitionBy("folder", "file").option("header", True).csv(base)
    out = None
    for feed in ("street", "outcomes"):
        part = summary.count_by(sources.ingest_feed(spark, feed, f"{base}/*/*-{feed}.csv"), "date", name="n")
        part = part.select(F.lit(feed).alias("feed"), "date", "n")
        out = part if out is None else out.unionByName(part)
    return out


@register(
    "scan_csv_dates",
    "S9 K4",
    with_views("SELECT key, month, n FROM complete_series", "complete_series"),
)
def q_scan_csv_dates(spark, sf):
    """A saved result with a DATE column, read with a declared schema."""
    path = sinks.write_single_csv(_priority_series(spark, sf), scratch_path(spark, "series-csv"))
    return sources.read_summary_csv(spark, path, "key STRING, month DATE, n BIGINT")


@register(
    "scan_parquet_partitioned",
    "S4 S5 K1",
    with_views("SELECT * FROM street WHERE year * 100 + month BETWEEN 199601 AND 199712", "street"),
)
def q_scan_parquet_partitioned(spark, sf):
    path = sinks.write_partitioned_parquet(sv.street(spark, sf), scratch_path(spark, "street-processed"))
    return sources.read_parquet_table(spark, path, months=((1996, 1), (1997, 12)))


@register(
    "sink_parquet_partitioned",
    "K1",
    with_views("SELECT * FROM street", "street"),
)
def q_sink_parquet_partitioned(spark, sf):
    path = sinks.write_partitioned_parquet(
        sv.street(spark, sf), scratch_path(spark, "street-rewritten")
    )
    # A second write of the same table replaces the first one whole.
    sinks.write_partitioned_parquet(sv.street(spark, sf), path)
    return sources.read_parquet_table(spark, path)


@register("sink_published_parquet", "K1", with_views("SELECT * FROM street WHERE year * 100 + month >= 199601", "street"))
def q_sink_published_parquet(spark, sf):
    path = scratch_path(spark, "street-published")
    sinks.publish_parquet(sv.street(spark, sf).limit(5), path)
    sinks.publish_parquet(sv.street(spark, sf), path)  # the pointer moves on
    return sources.read_published(spark, path, months=((1996, 1), (9999, 12)))


@register(
    "sink_quarantine",
    "A17 D10 K1",
    with_views(
        "SELECT CASE WHEN crime_id IS NULL THEN 'rejected' ELSE 'good' END AS status, CASE WHEN crime_id IS NULL THEN 'no id' END AS reason, year, month, COUNT(*) AS n FROM street GROUP BY ALL",
        "street",
    ),
)
def q_sink_quarantine(spark, sf):
    path = scratch_path(spark, "street-quarantine")
    sinks.write_with_quarantine(sv.street(spark, sf), F.when(F.col("crime_id").isNull(), "no id"), path)
    return summary.count_by(sources.read_parquet_table(spark, path), "status", "reason", "year", "month", name="n")


@register(
    "scan_csv_by_header",
    "S7 S9",
    with_views("SELECT crime_id, date, CASE WHEN year = 1996 THEN NULL ELSE lsoa_code END AS lsoa_code FROM street", "street"),
)
def q_scan_csv_by_header(spark, sf):
    """Files of one year lack a column, those of the others have it in another order."""
    s = sv.street(spark, sf)
    path = scratch_path(spark, "moved-columns")
    for name, rows, cols in (
        ("a", F.col("year") == 1996, ["crime_id", "date"]),
        ("b", F.col("year") > 1996, ["lsoa_code", "date", "crime_id", "crime_type"]),
        ("c", F.col("year") < 1996, ["date", "crime_id", "lsoa_code"]),
    ):
        s.filter(rows).select(*cols).write.option("header", True).csv(f"{path}/{name}")
    kinds = dict(s.dtypes)
    return sources.read_csv_by_header(spark, f"{path}/*", ", ".join(f"{c} {kinds[c]}" for c in ("crime_id", "date", "lsoa_code")))


@register("scan_parquet_flat", "S6 K3", with_views("SELECT * FROM points", "points"))
def q_scan_parquet_flat(spark, sf):
    path = sinks.write_flat_parquet(sv.points(spark, sf), scratch_path(spark, "clusters"))
    return sources.read_parquet_table(spark, path)


_TYPE_COUNTS_SQL = """SELECT s.crime_type, COUNT(*) AS "count"
FROM street s LEFT JOIN outcomes o ON s.crime_id = o.crime_id GROUP BY s.crime_type"""


@register("sink_csv_single", "K2 K4 S9", with_views(_TYPE_COUNTS_SQL, "street", "outcomes"))
def q_sink_csv_single(spark, sf):
    counts = summary.rollup_counts(_pairs(spark, sf), "crime_type")
    path = sinks.write_single_csv(counts, scratch_path(spark, "crime-type-counts"))
    return sources.read_summary_csv(spark, path, "crime_type STRING, count BIGINT")


@register(
    "scan_csv_infer",
    "S7",
    with_views(
        'SELECT CAST(hour(event_ts) AS INTEGER) AS hour, CAST(COUNT(*) AS INTEGER) AS "count" FROM stops GROUP BY 1',
        "stops",
    ),
)
def q_scan_csv_infer(spark, sf):
    path = sinks.write_single_csv(summary.count_by_hour(sv.stops(spark, sf)), scratch_path(spark, "counts-by-hour"))
    return sources.read_summary_csv(spark, path)


@register("scan_csv_cast", "S8 P7", with_views(_TYPE_COUNTS_SQL, "street", "outcomes"))
def q_scan_csv_cast(spark, sf):
    counts = summary.rollup_counts(_pairs(spark, sf), "crime_type")
    path = sinks.write_single_csv(counts, scratch_path(spark, "crime-type-counts-text"))
    return sources.read_summary_text(spark, path, ("count",))


# ------------------------------------------------- more feeds, policies


def _roundtrip_feed(spark, sf, feed):
    raw = sv.RAW_FEEDS[feed](spark, sf)
    base = scratch_path(spark, f"raw-{feed}")
    month_text = F.substring(F.col(raw.columns[1]), 1, 7)
    raw.withColumn("folder", month_text).hint("rebalance", "folder").write.mode("overwrite").partitionBy(
        "folder"
    ).option("header", True).csv(base)
    return sources.ingest_feed(spark, feed, f"{base}/*/*.csv")


@register(
    "scan_csv_outcomes",
    "S2 P1 P2 P6",
    """SELECT CAST(o_orderkey AS VARCHAR) AS crime_id,
       'Central Force' AS reported_by, 'Central Force' AS falls_within,
       -0.1 - o_totalprice / 1e7 AS longitude, 51.0 + o_custkey / 1e4 AS latitude,
       CAST(NULL AS VARCHAR) AS location, CAST(NULL AS VARCHAR) AS lsoa_code, CAST(NULL AS VARCHAR) AS lsoa_name,
       o_orderstatus AS outcome_type, CAST(date_trunc('month', o_orderdate) AS DATE) AS date,
       CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month
FROM orders""",
)
def q_scan_csv_outcomes(spark, sf):
    return _roundtrip_feed(spark, sf, "outcomes")


@register(
    "scan_csv_stops",
    "S3 P1 P4 P6 D2",
    """SELECT 'Person search' AS type, 'False' AS part_of_a_policing_operation,
       CAST(NULL AS VARCHAR) AS policing_operation,
       51.0 + value / 1000 AS latitude, -0.5 + user_id / 1000 AS longitude,
       CAST(NULL AS VARCHAR) AS gender, CAST(NULL AS VARCHAR) AS age_range,
       CAST(NULL AS VARCHAR) AS self_defined_ethnicity, CAST(NULL AS VARCHAR) AS officer_defined_ethnicity,
       CAST(NULL AS VARCHAR) AS legislation, event_type AS object_of_search,
       'A no further action disposal' AS outcome,
       CASE WHEN value > 50 THEN 'True' ELSE 'False' END AS outcome_linked_to_object_of_search,
       CAST(NULL AS VARCHAR) AS removal_of_more_than_just_outer_clothing,
       CAST(ts AS DATE) AS date, date_trunc('second', ts) AS event_ts,
       CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month
FROM events""",
)
def q_scan_csv_stops(spark, sf):
    return _roundtrip_feed(spark, sf, "stop_and_search")


@register(
    "chi_square_drop_null",
    "X3 D8",
    with_views(
        """SELECT round(SUM((n - e) * (n - e) / e), 4) AS chi2,
       CAST(((SELECT COUNT(DISTINCT crime_type) FROM kept) - 1)
          * ((SELECT COUNT(DISTINCT outcome_type) FROM kept) - 1) AS BIGINT) AS dof
FROM expected""",
        "pairs",
        ctes="""kept AS (SELECT * FROM pairs WHERE outcome_type IS NOT NULL),
grid AS (
  SELECT r.crime_type, c.outcome_type, COALESCE(p.n, 0) AS n
  FROM (SELECT DISTINCT crime_type FROM kept) r
  CROSS JOIN (SELECT DISTINCT outcome_type FROM kept) c
  LEFT JOIN kept p ON p.crime_type IS NOT DISTINCT FROM r.crime_type AND p.outcome_type = c.outcome_type),
expected AS (
  SELECT crime_type, outcome_type, n,
         SUM(n) OVER (PARTITION BY crime_type) * SUM(n) OVER (PARTITION BY outcome_type) / SUM(n) OVER () AS e
  FROM grid)""",
    ),
)
def q_chi_square_drop_null(spark, sf):
    kept = crosstab.materialize(_pairs(spark, sf).filter(F.col("outcome_type").isNotNull()))
    return crosstab.chi_square(kept, "crime_type", "outcome_type", "n")


@register("kmeans_lat_weighted", "C2 C3 D12")
def q_kmeans_lat_weighted(spark, sf):
    pts = _clean_points(spark, sf)
    model = cluster.fit_kmeans(pts, k=8, seed=42, lat_weighted=True)
    return cluster.kmeans_assign(pts, model, lat_weighted=True).drop("features")


@register(
    "summary_grouping_sets",
    "A5 A6 A7 A8 A9",
    with_views(
        """SELECT month, year, crime_type, lsoa_code, lsoa_name, COUNT(*) AS "count",
       min(latitude) AS min_latitude, max(latitude) AS max_latitude,
       round(avg(latitude), 6) AS avg_latitude,
       CASE GROUPING(month, year, crime_type, lsoa_code, lsoa_name)
            WHEN 15 THEN 'counts_by_month' WHEN 7 THEN 'year_month_trend' WHEN 27 THEN 'crime_types'
            WHEN 28 THEN 'lsoas' ELSE 'all' END AS grouping_set
FROM street
GROUP BY GROUPING SETS ((month), (year, month), (crime_type), (lsoa_code, lsoa_name), ())""",
        "street",
    ),
)
def q_summary_grouping_sets(spark, sf):
    sets = {
        "counts_by_month": ["month"],
        "year_month_trend": ["year", "month"],
        "crime_types": ["crime_type"],
        "lsoas": ["lsoa_code", "lsoa_name"],
        "all": [],
    }
    aggs = [F.min("latitude").alias("min_latitude"), F.max("latitude").alias("max_latitude"),
            F.round(F.avg("latitude"), 6).alias("avg_latitude")]
    return summary.grouping_set_counts(sv.street(spark, sf), sets, aggs)
