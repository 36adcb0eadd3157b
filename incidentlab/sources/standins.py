"""Incident feeds derived from the driver's TPC-H-like tables.

The engine's operators take column names as parameters; these views give the
driver tables the shape of the incident feeds so every registered query runs
on (and grows with) the given tables.  Each view has a Spark form and the
equivalent DuckDB SQL (a CTE) used by the oracle check; keep them together.

Mapping (fixed values, the same in both forms):
  street   <- lineitem: crime_id = l_orderkey (null where l_orderkey % 7 = 0),
              date = first of the month of l_shipdate, crime_type = l_returnflag
              ('A' for 'R' where l_orderkey % 5 = 0),
              lsoa_code = l_suppkey as text, lsoa_name = l_linestatus,
              latitude = l_tax, longitude = l_discount
  outcomes <- orders:   crime_id = o_orderkey, outcome_type = o_orderstatus,
              date = first of the month of o_orderdate; no outcome where
              o_orderkey % 11 = 0 (unmatched keys), a second outcome 'X' where
              o_orderkey % 5 = 0 (fan-out; no 'R' crime ever meets an 'X')
  stops    <- events:   event_ts = ts, date = day of ts, object_of_search = event_type,
              outcome_linked_to_object_of_search = 'true' when value > 50 else 'false'
  series   <- orders:   monthly order counts per o_orderpriority
  complete_series: the same without a partial last month (the month of the
              latest o_orderdate, unless that is its last day), months without
              orders filled with 0
  points   <- embeddings: prediction = label, latitude/longitude = embedding[0], [1]
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from incidentlab.functions.dates import month_start
from incidentlab.session import table_path


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def street(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read(spark, sf_dir, "lineitem")
    d = month_start("l_shipdate")
    key = F.col("l_orderkey")
    return li.select(
        F.when(key % 7 == 0, F.lit(None).cast("bigint")).otherwise(key).alias("crime_id"),
        d.alias("date"),
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.when((key % 5 == 0) & (F.col("l_returnflag") == "R"), "A").otherwise(F.col("l_returnflag")).alias("crime_type"),
        F.col("l_suppkey").cast("string").alias("lsoa_code"),
        F.col("l_linestatus").alias("lsoa_name"),
        F.col("l_tax").alias("latitude"),
        F.col("l_discount").alias("longitude"),
    )


def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders").filter(F.col("o_orderkey") % 11 != 0)
    d = month_start("o_orderdate")
    first = F.col("o_orderstatus")
    types = F.when(F.col("o_orderkey") % 5 == 0, F.array(first, F.lit("X"))).otherwise(F.array(first))
    return o.select(
        F.col("o_orderkey").alias("crime_id"),
        d.alias("date"),
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.explode(types).alias("outcome_type"),
    )


def stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events")
    d = F.to_date("ts")
    return e.select(
        F.col("event_id"),
        F.col("ts").alias("event_ts"),
        d.alias("date"),
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.col("event_type").alias("object_of_search"),
        F.when(F.col("value") > 50, "true").otherwise("false").alias("outcome_linked_to_object_of_search"),
    )


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "embeddings")
    return e.select(
        F.col("vec_id"),
        F.col("embedding")[0].cast("double").alias("latitude"),
        F.col("embedding")[1].cast("double").alias("longitude"),
        F.col("label").alias("prediction"),
    )


def street_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Street with raw-text month and coordinates; line number 7 carries
    malformed text ('yyyy-13' month, 'n/a' coordinates)."""
    li = read(spark, sf_dir, "lineitem")
    bad = F.col("l_linenumber") == 7
    key = F.col("l_orderkey")
    return li.select(
        F.when(key % 7 == 0, F.lit(None).cast("bigint")).otherwise(key).alias("crime_id"),
        F.when(bad, F.concat(F.year("l_shipdate").cast("string"), F.lit("-13")))
        .otherwise(F.date_format("l_shipdate", "yyyy-MM"))
        .alias("month_text"),
        F.when(bad, F.lit("n/a")).otherwise(F.col("l_tax").cast("string")).alias("latitude"),
        F.when(bad, F.lit("n/a")).otherwise(F.col("l_discount").cast("string")).alias("longitude"),
        F.col("l_returnflag").alias("crime_type"),
    )


def priority_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as dated events keyed by priority (the multi-series panel)."""
    o = read(spark, sf_dir, "orders")
    return o.select(F.col("o_orderpriority").alias("key"), F.col("o_orderdate").alias("date"))


def customer_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as dated events keyed by customer (sparse series with gaps)."""
    o = read(spark, sf_dir, "orders")
    return o.select(F.col("o_custkey").alias("key"), F.col("o_orderdate").alias("date"))


def hotspot_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-cluster monthly values: cluster id = leading digit of o_orderpriority - 1."""
    o = read(spark, sf_dir, "orders")
    cid = (F.substring("o_orderpriority", 1, 1).cast("int") - 1).alias("prediction")
    return o.groupBy(cid, month_start("o_orderdate").alias("date")).agg(F.count(F.lit(1)).cast("double").alias("forecast"))


def street_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The street stand-in as raw feed text, with published header names."""
    li = read(spark, sf_dir, "lineitem")
    key = F.col("l_orderkey")
    return li.select(
        F.when(key % 7 == 0, F.lit(None)).otherwise(key.cast("string")).alias("Crime ID"),
        F.date_format("l_shipdate", "yyyy-MM").alias("Month"),
        F.lit("Central Force").alias("Reported by"),
        F.lit("Central Force").alias("Falls within"),
        F.col("l_discount").cast("string").alias("Longitude"),
        F.col("l_tax").cast("string").alias("Latitude"),
        F.concat(F.lit("On or near "), F.col("l_partkey").cast("string")).alias("Location"),
        F.col("l_suppkey").cast("string").alias("LSOA code"),
        F.col("l_linestatus").alias("LSOA name"),
        F.col("l_returnflag").alias("Crime type"),
        F.lit(None).cast("string").alias("Last outcome category"),
        F.lit(None).cast("string").alias("Context"),
    )


def outcomes_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The outcomes stand-in as raw feed text."""
    o = read(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").cast("string").alias("Crime ID"),
        F.date_format("o_orderdate", "yyyy-MM").alias("Month"),
        F.lit("Central Force").alias("Reported by"),
        F.lit("Central Force").alias("Falls within"),
        (F.lit(-0.1) - F.col("o_totalprice") / 1e7).cast("string").alias("Longitude"),
        (F.lit(51.0) + F.col("o_custkey") / 1e4).cast("string").alias("Latitude"),
        F.lit(None).cast("string").alias("Location"),
        F.lit(None).cast("string").alias("LSOA code"),
        F.lit(None).cast("string").alias("LSOA name"),
        F.col("o_orderstatus").alias("Outcome type"),
    )


def stops_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stop-and-search stand-in as raw feed text (timestamp with offset)."""
    e = read(spark, sf_dir, "events")
    return e.select(
        F.lit("Person search").alias("Type"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias("Date"),
        F.lit("False").alias("Part of a policing operation"),
        F.lit(None).cast("string").alias("Policing operation"),
        (F.lit(51.0) + F.col("value") / 1000).cast("string").alias("Latitude"),
        (F.lit(-0.5) + F.col("user_id") / 1000).cast("string").alias("Longitude"),
        F.lit(None).cast("string").alias("Gender"),
        F.lit(None).cast("string").alias("Age range"),
        F.lit(None).cast("string").alias("Self-defined ethnicity"),
        F.lit(None).cast("string").alias("Officer-defined ethnicity"),
        F.lit(None).cast("string").alias("Legislation"),
        F.col("event_type").alias("Object of search"),
        F.lit("A no further action disposal").alias("Outcome"),
        F.when(F.col("value") > 50, "True").otherwise("False").alias("Outcome linked to object of search"),
        F.lit(None).cast("string").alias("Removal of more than just outer clothing"),
    )


RAW_FEEDS = {"street": street_raw, "outcomes": outcomes_raw, "stop_and_search": stops_raw}


# DuckDB forms of the same views, used by oracle_sql().
SQL_VIEWS = {
    "street": """street AS (
  SELECT CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_orderkey END AS crime_id,
         CAST(date_trunc('month', l_shipdate) AS DATE) AS date,
         CAST(year(l_shipdate) AS INTEGER) AS year,
         CAST(month(l_shipdate) AS INTEGER) AS month,
         CASE WHEN l_orderkey % 5 = 0 AND l_returnflag = 'R' THEN 'A' ELSE l_returnflag END AS crime_type,
         CAST(l_suppkey AS VARCHAR) AS lsoa_code,
         l_linestatus AS lsoa_name,
         l_tax AS latitude,
         l_discount AS longitude
  FROM lineitem)""",
    "outcomes": """outcomes AS (
  SELECT o_orderkey AS crime_id,
         CAST(date_trunc('month', o_orderdate) AS DATE) AS date,
         CAST(year(o_orderdate) AS INTEGER) AS year,
         CAST(month(o_orderdate) AS INTEGER) AS month,
         unnest(CASE WHEN o_orderkey % 5 = 0 THEN [o_orderstatus, 'X'] ELSE [o_orderstatus] END) AS outcome_type
  FROM orders WHERE o_orderkey % 11 <> 0)""",
    "stops": """stops AS (
  SELECT event_id, ts AS event_ts, CAST(ts AS DATE) AS date,
         CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
         event_type AS object_of_search,
         CASE WHEN value > 50 THEN 'true' ELSE 'false' END AS outcome_linked_to_object_of_search
  FROM events)""",
    "points": """points AS (
  SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS latitude, CAST(embedding[2] AS DOUBLE) AS longitude,
         label AS prediction
  FROM embeddings)""",
    "pairs": """pairs AS (
  SELECT s.crime_type, o.outcome_type, COUNT(*) AS n
  FROM street s LEFT JOIN outcomes o ON s.crime_id = o.crime_id
  GROUP BY s.crime_type, o.outcome_type)""",
    "street_text": """street_text AS (
  SELECT CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_orderkey END AS crime_id,
         CASE WHEN l_linenumber = 7 THEN CAST(year(l_shipdate) AS VARCHAR) || '-13'
              ELSE strftime(l_shipdate, '%Y-%m') END AS month_text,
         CASE WHEN l_linenumber = 7 THEN 'n/a' ELSE CAST(l_tax AS VARCHAR) END AS latitude,
         CASE WHEN l_linenumber = 7 THEN 'n/a' ELSE CAST(l_discount AS VARCHAR) END AS longitude,
         l_returnflag AS crime_type
  FROM lineitem)""",
    "hotspot_series": """hotspot_series AS (
  SELECT CAST(substr(o_orderpriority, 1, 1) AS INTEGER) - 1 AS prediction,
         CAST(date_trunc('month', o_orderdate) AS DATE) AS date, CAST(COUNT(*) AS DOUBLE) AS forecast
  FROM orders GROUP BY 1, 2)""",
    "centroids": """centroids AS (
  SELECT prediction, round(avg(latitude), 6) AS centroid_lat, round(avg(longitude), 6) AS centroid_lon
  FROM points GROUP BY prediction)""",
    "series": """series AS (
  SELECT o_orderpriority AS key, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, COUNT(*) AS n
  FROM orders GROUP BY 1, 2)""",
    "complete_series": """complete_series AS (
  SELECT g.key, CAST(g.month AS DATE) AS month, coalesce(s.n, 0) AS n
  FROM (SELECT key, unnest(generate_series(min(month), max(month), INTERVAL 1 MONTH)) AS month
        FROM series
        WHERE month < (SELECT date_trunc('month', max(o_orderdate) + INTERVAL 1 DAY) FROM orders)
        GROUP BY key) g
  LEFT JOIN series s ON s.key = g.key AND s.month = g.month)""",
}

# Views a view depends on (prepended first).
_SQL_DEPS = {"pairs": ("street", "outcomes"), "centroids": ("points",), "complete_series": ("series",)}


def with_views(body: str, *views: str, ctes: str | None = None) -> str:
    """Prefix a DuckDB query with the CTEs of the stand-in views it uses, then
    any query-specific ``ctes``."""
    order: list[str] = []

    def add(v: str) -> None:
        for d in _SQL_DEPS.get(v, ()):
            add(d)
        if v not in order:
            order.append(v)

    for v in views:
        add(v)
    parts = [SQL_VIEWS[v] for v in order] + ([ctes] if ctes else [])
    return "WITH " + ",\n".join(parts) + "\n" + body
