"""Sharding by a two-pass external shuffle.

Pass 1 scatters the rows over buckets that fit a task's memory, by a seeded hash
of the row number; their number follows the size of the input.  Pass 2 shuffles
every bucket by Fisher and Yates, with a generator seeded by (seed, bucket), and
writes it.  The buckets one after another are a uniform random order of the whole
input.  Shard s of n takes the rows from ceil(s * rows / n) on, so the shards'
row counts differ by at most one and a row's slot in its shard follows from its
place in its bucket and the number of rows before that bucket.

The counts come from a scan of the row numbers alone; the texts cross the
network once.  The row number is stable (``textops.numbered``), so a task that
runs again scatters and shuffles alike, and equal rows and null ids spread over
all buckets.  The order depends on the seed, ``bucket_bytes`` and the input's
files, not on the cluster.

Defined results: null texts count as empty; repeated rows are rows of their own;
an empty table gives empty shards; columns of the input that clash with the new
ones are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from incidentlab.llm.textops import fresh, numbered

BUCKET_BYTES = 16 << 20
RUN = 1024  # buckets whose counts are added up by one task


def fisher_yates(n: int, seed: int, bucket: int) -> np.ndarray:
    """A uniform random order of range(n), by swaps from the end."""
    draw = np.random.Generator(np.random.PCG64([seed, bucket]))
    other = draw.integers(0, np.arange(n, 0, -1)) if n else np.empty(0, np.int64)
    order = list(range(n))
    for i, j in zip(range(n - 1, 0, -1), other.tolist()):
        order[i], order[j] = order[j], order[i]
    return np.array(order, np.int64)


def _starts(counts: DataFrame) -> DataFrame:
    """``bucket, before``: rows of the buckets in front.  Sums run over RUN
    buckets a task, then over the runs' totals."""
    runs = counts.withColumn("run", F.floor(F.col("bucket") / RUN))
    before = Window.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    totals = runs.groupBy("run").agg(F.sum("n").alias("total"))
    totals = totals.select("run", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("earlier"))
    inside = Window.partitionBy("run").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    return runs.join(totals, "run").select("bucket", (F.col("earlier") + F.col("inside")).alias("before"))


def shard_documents(
    docs: DataFrame, shards: int = 8, seed: int = 0, text_col: str = "text", bucket_bytes: int = BUCKET_BYTES
) -> DataFrame:
    """``docs`` with ``shard`` (0 to shards - 1) and ``slot`` (from 0, without
    gaps) added; each task's rows come bucket by bucket in slot order."""
    if shards < 1 or bucket_bytes < 1:
        raise ValueError("shards and bucket_bytes must be positive")
    own = [c for c in docs.columns if c not in ("shard", "slot")]
    row, bucket = fresh("__row", docs.columns), fresh("__bucket", docs.columns)
    total = F.sum(F.coalesce(F.octet_length(F.col(text_col).cast("string")), F.lit(0)) + 1)
    n_rows, n_bytes = docs.agg(F.count(F.lit(1)), F.coalesce(total, F.lit(0))).first()
    buckets = max(1, -(-n_bytes // bucket_bytes))
    dealt = numbered(docs.select(*own), row)
    dealt = dealt.withColumn(bucket, F.pmod(F.xxhash64(F.lit(seed), F.col(row)), F.lit(buckets)))
    starts = _starts(dealt.groupBy(F.col(bucket).alias("bucket")).agg(F.count(F.lit(1)).alias("n")))
    fields = [StructField(c, docs.schema[c].dataType) for c in own]
    schema = StructType([*fields, StructField("shard", IntegerType()), StructField("slot", LongType())])

    def shuffle(key: tuple, rows: pa.Table, start: pa.Table) -> pa.Table:
        # Rows arrive in any order; the row numbers put them into one order first.
        in_order = np.argsort(rows[row].to_numpy(), kind="stable")
        order = in_order[fisher_yates(len(in_order), seed, key[0].as_py())]
        place = start["before"][0].as_py() + np.arange(len(order), dtype=np.int64)
        shard = place * shards // n_rows
        first = -(-shard * n_rows // shards)
        out = rows.select(own).take(pa.array(order))
        return out.append_column("shard", pa.array(shard, pa.int32())).append_column("slot", pa.array(place - first))

    return dealt.groupBy(bucket).cogroup(starts.groupBy("bucket")).applyInArrow(shuffle, schema)


def write_shards(docs: DataFrame, path: str, **options) -> None:
    """Writes ``shard_documents(docs, **options)`` as Parquet under ``path``, a
    folder per shard whose files hold runs of slots in order."""
    done = shard_documents(docs, **options)
    done.sortWithinPartitions("shard", "slot").write.mode("overwrite").partitionBy("shard").parquet(path)
