"""Readers (S1-S9).

Raw feeds are text: every column is read as a string against a declared
header (``enforceSchema=False`` makes Spark check the file header against
it), names are normalised, then typed once with ``try_`` casts.  Typed tables
are Parquet, partitioned by ``year``/``month`` so month filters prune files.
"""

from __future__ import annotations

import csv
import functools
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from incidentlab.functions.casts import to_count, to_double
from incidentlab.operators.columns import normalize_columns, type_month_feed, type_timestamp_feed
from incidentlab.schemas import FEEDS


def read_feed(spark: SparkSession, path_glob: str, schema: StructType | None = None) -> DataFrame:
    """CSV files matching ``path_glob`` (e.g. ``raw/*/*-street.csv``), header
    row, all columns text.  With a declared schema the header is checked."""
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if schema is not None:
        reader = reader.schema(schema).option("enforceSchema", False)
    return reader.csv(path_glob)


def ingest_feed(spark: SparkSession, feed: str, path_glob: str, report_rejects: bool = False) -> DataFrame:
    """Raw feed -> typed table: normalised names, dates parsed, ``year``/``month``
    ints, coordinates as doubles (malformed text becomes null).

    ``report_rejects`` adds two flags per row for the load report: ``_bad_dates``
    (no date could be read) and ``_bad_coordinates`` (a coordinate has text that
    is not a number)."""
    schema, _ = FEEDS[feed]
    df = normalize_columns(read_feed(spark, path_glob, schema))
    if report_rejects:
        bad = F.lit(False)
        for c in ("latitude", "longitude"):
            bad = bad | (F.col(c).isNotNull() & to_double(c).isNull())
        df = df.withColumn("_bad_coordinates", bad)
    typed = type_timestamp_feed(df) if feed == "stop_and_search" else type_month_feed(df)
    return typed.withColumn("_bad_dates", F.col("date").isNull()) if report_rejects else typed


def read_parquet_table(
    spark: SparkSession, path: str, months: tuple[tuple[int, int], tuple[int, int]] | None = None
) -> DataFrame:
    """Parquet table, flat or partitioned (partition columns discovered).
    ``months=((y0, m0), (y1, m1))`` keeps an inclusive month range via partition
    filters, so only those folders are listed and read."""
    df = spark.read.parquet(path)
    if months is not None:
        (y0, m0), (y1, m1) = months
        ym = F.col("year") * 100 + F.col("month")
        df = df.filter((ym >= y0 * 100 + m0) & (ym <= y1 * 100 + m1))
    return df


def file_headers(spark: SparkSession, path: str) -> DataFrame:
    """``file, header``: the first line of every CSV file under ``path`` (two passes
    over the lines; empty files have none).

    A text per group would make Spark sort all lines, so a task would hold its whole
    split.  The first pass keeps numbers alone (the hash of each file's first line),
    the second keeps only lines with such a hash, of which the first of a file is its
    header, whatever else has the same hash."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), "value"
    )
    lines = lines.filter("at = 0").select("file", "value", F.xxhash64("value").alias("mark"), F.monotonically_increasing_id().alias("line"))
    marks = lines.groupBy("file").agg(F.min_by("mark", "line").alias("mark")).select("mark").distinct()
    found = lines.join(F.broadcast(marks), "mark", "left_semi").groupBy("file", "value").agg(F.min("line").alias("line"))
    return found.groupBy("file").agg(F.min_by("value", "line").alias("header"))


def _names(header: str) -> list[str]:
    return [c.strip().removeprefix("\ufeff") for c in next(csv.reader([header]))]


def read_csv_by_header(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """CSV files whose columns differ in order or number, read by name.

    Files are grouped by their header line; each group is read with its own column
    order and the groups are joined by name.  A declared column that a file does
    not have is null there (``header_report`` tells which), other columns are left
    out.  Headers must be single lines."""
    declared = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    types = {f.name: f.dataType for f in declared}
    groups = file_headers(spark, path).groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files"))
    parts = []
    for r in groups.orderBy("header").collect():  # the list of files, as the driver holds it for the scan
        names = _names(r["header"])
        own = StructType([StructField(c, types.get(c, StringType())) for c in names])
        files = [unquote(f) for f in r["files"]]
        part = spark.read.option("header", True).option("enforceSchema", False).schema(own).csv(files)
        parts.append(part.select(*(F.col(f"`{c}`") if c in names else F.lit(None).cast(t).alias(c) for c, t in types.items())))
    if not parts:
        return spark.createDataFrame([], declared)
    return functools.reduce(DataFrame.unionByName, parts)


def header_report(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """``file, missing, extra, moved``: per file the declared columns it lacks, the
    undeclared ones it has, and whether the others stand in another order."""
    declared = (StructType.fromDDL(schema) if isinstance(schema, str) else schema).names
    rows = file_headers(spark, path)
    names = F.transform(F.split("header", ","), lambda c: F.trim(F.regexp_replace(c, '^[\ufeff"]+|"$', "")))
    known = F.array(*(F.lit(c) for c in declared))
    return rows.select(
        "file",
        F.array_except(known, names).alias("missing"),
        F.array_except(names, known).alias("extra"),
        (F.filter(names, lambda c: F.array_contains(known, c)) != F.filter(known, lambda c: F.array_contains(names, c))).alias("moved"),
    )


def read_published(
    spark: SparkSession, path: str, months: tuple[tuple[int, int], tuple[int, int]] | None = None
) -> DataFrame:
    """K1: the latest version that ``sinks.publish_parquet`` has published at
    ``path``; ``months`` prunes as in ``read_parquet_table``."""
    latest = spark.read.text(f"{path}/published/*").agg(F.max("value")).first()[0]
    return read_parquet_table(spark, f"{path}/versions/{latest}", months)


def read_summary_csv(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """A summary CSV directory with header.  A declared schema is used
    when given (DDL string or StructType), by column name whatever the order in
    the files; otherwise types are inferred."""
    if schema is not None:
        return read_csv_by_header(spark, path, schema)
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def read_summary_text(spark: SparkSession, path: str, count_cols: tuple[str, ...] = ("count",)) -> DataFrame:
    """S8 + P7: summary CSV read as text, the named count columns cast to bigint."""
    df = spark.read.option("header", True).csv(path)
    return df.select(*[to_count(c).alias(c) if c in count_cols else F.col(c) for c in df.columns])
