"""Exact dedup by a tree-merge of sorted digest runs (DataFrame functions only).

Level 0: every input partition is a run of (digest, leader, count), sorted and
reduced to one row per digest.  In each round up to ``fan_in`` neighbouring
runs are exchanged, sorted by digest and merged into one; every level keeps the
winning identifier of a digest.  After log(runs) rounds one run, spread over
all tasks by digest, holds the winners.  They go back down through the level-0
runs, so a digest held by a third of all rows meets its winner once per run,
never as one giant join key.

A match is verified: rows merge only if the SHA-256 digest, the byte length and
a second 64-bit hash of the text all agree.

Defined results: a null text counts as empty; null ids lose to any id; among
rows with the winning id the one with the smallest row number stays, so exactly
one row of a group stays; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from incidentlab.llm.textops import fresh, numbered
from incidentlab.session import checkpoint

_KEY = ["digest", "n_bytes", "check"]


def _winner(keep: str):
    """(aggregate, struct of ordering fields) that picks the row that stays."""
    if keep == "max":  # null sorts lowest
        return F.max, F.struct(F.col("id"), (-F.col("row")).alias("order"))
    if keep == "min":  # null must sort last
        return F.min, F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("row").alias("order"))
    raise ValueError("keep must be 'max' or 'min'")


def tree_merge_dedup(
    docs: DataFrame,
    keep: str = "max",
    id_col: str = "doc_id",
    text_col: str = "text",
    fan_in: int = 8,
    row_col: str | None = None,
) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept,
    text_sha256`` and ``row``, the row number: the column ``row_col`` of ``docs``
    if given, else that of ``textops.numbered``."""
    pick, order = _winner(keep)
    if row_col is None:
        row_col = fresh("__row", docs.columns)
        docs = numbered(docs, row_col)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = checkpoint(
        docs.select(
            F.col(id_col).alias("id"),
            F.unhex(F.sha2(text, 256)).alias("digest"),
            F.octet_length(text).alias("n_bytes"),
            F.xxhash64(text).alias("check"),
            F.spark_partition_id().alias("run"),
            F.col(row_col).alias("row"),
        )
    )
    runs = (rows.agg(F.max("run")).first()[0] or 0) + 1
    first = rows.groupBy("run", *_KEY).agg(pick(order).alias("leader"), F.count(F.lit(1)).alias("n"))
    level = first
    while runs > 1:
        runs = -(-runs // fan_in)
        level = (
            level.withColumn("run", F.floor(F.col("run") / fan_in).cast("int"))
            .repartition("run", "digest")
            .sortWithinPartitions("run", *_KEY)
            .groupBy("run", *_KEY)
            .agg(pick("leader").alias("leader"), F.sum("n").alias("n"))
        )
    winners = level.select(*_KEY, "leader", F.col("n").alias("group_size"))
    per_run = first.select("run", *_KEY).join(winners, _KEY)
    return rows.join(per_run, ["run", *_KEY]).select(
        F.col("id").alias("doc_id"),
        F.col("leader.id").alias("keep_id"),
        F.col("group_size").cast("long").alias("group_size"),
        (F.col("row") == (-F.col("leader.order") if keep == "max" else F.col("leader.order"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        "row",
    )
