"""Writers (K1-K6).  Every write is an overwrite of its target, so a rerun
after a lost executor or a failed job gives the same table."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def write_partitioned_parquet(
    df: DataFrame, path: str, by: Sequence[str] = ("year", "month"), overwrite: str = "static"
) -> str:
    """K1: Parquet partitioned by ``by``.

    The write states what it replaces, whatever the session's setting:
    ``static`` replaces the whole table (no month of an earlier write stays),
    ``dynamic`` only the partitions that ``df`` holds.

    The rows go through a REBALANCE on the partition columns: AQE shuffles
    them so each written file is near the advisory partition size, splitting a
    month that holds a third of the data over many writers and merging small
    ones.  Without it every task would write one file per month it holds
    (tasks x months small files after any shuffle)."""
    if overwrite not in ("static", "dynamic"):
        raise ValueError("overwrite must be 'static' or 'dynamic'")
    writer = df.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", overwrite)
    writer.partitionBy(*by).parquet(path)
    return path


def publish_parquet(df: DataFrame, path: str, by: Sequence[str] = ("year", "month")) -> str:
    """K1 without a moment at which the table is gone: the rows are written to a
    new folder ``versions/<name>``, counted while they are written and again from
    the files, and only then a pointer file under ``published`` names the folder.
    ``sources.read_published`` follows the pointer with the greatest name, so a
    write that fails half-way leaves the old table as it was.  Older versions
    stay until they are removed by hand.  Returns the version's folder."""
    spark = df.sparkSession
    version = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    folder = f"{path}/versions/{version}"
    seen = Observation()
    write_partitioned_parquet(df.observe(seen, F.count(F.lit(1)).alias("n")), folder, by)
    stored, written = spark.read.schema(df.schema).parquet(folder).count(), seen.get["n"]
    if stored != written:
        raise RuntimeError(f"{folder} holds {stored} rows of {written}; it is not published")
    spark.createDataFrame([(version,)], "value string").coalesce(1).write.text(f"{path}/published/{version}")
    return folder


def write_with_quarantine(df: DataFrame, reason: Column, path: str, by: Sequence[str] = ("year", "month")) -> dict[str, int]:
    """One scan that sends the rows with a ``reason`` (null: none) to a
    quarantine beside the good rows: the table is partitioned by ``status`` (good
    or rejected) first, so that a reader of one never opens the other's files.
    Rejected rows keep all columns and get ``reason`` and ``file``.  Returns the
    counts; rows in must equal good plus rejected rows in the files."""
    spark = df.sparkSession
    seen = Observation()
    status = F.when(F.col("reason").isNull(), "good").otherwise("rejected")
    marked = df.observe(seen, F.count(F.lit(1)).alias("n")).withColumns({"reason": reason, "file": F.input_file_name()})
    marked = marked.withColumn("file", F.when(F.col("reason").isNotNull(), F.col("file"))).withColumn("status", status)
    write_partitioned_parquet(marked, path, ["status", *by])
    counts = {r["status"]: r["count"] for r in spark.read.parquet(path).groupBy("status").count().collect()} if seen.get["n"] else {}
    found = {k: counts.get(k, 0) for k in ("good", "rejected")}
    if sum(found.values()) != seen.get["n"]:
        raise RuntimeError(f"{path} holds {found}, but {seen.get['n']} rows were read")
    return found | {"read": seen.get["n"]}


def write_flat_parquet(df: DataFrame, path: str) -> str:
    """K3 / K6: unpartitioned Parquet."""
    df.write.mode("overwrite").parquet(path)
    return path


def write_single_csv(df: DataFrame, path: str) -> str:
    """K2 / K4 / K5: one CSV file with header, for a small aggregated result.
    ``coalesce(1)`` only narrows the last stage of an already-aggregated plan;
    never call this on an unaggregated table."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    return path
