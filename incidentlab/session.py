"""Session construction and the shared scratch location.

Scratch data (round-trip tables, lineage cuts) lives under the folder the
cluster names in ``spark.checkpoint.dir``.  Only when the session has none
(local tests) do we pick one ourselves.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale: AQE re-plans joins and coalesces small
# shuffle partitions at runtime, and splits skewed partitions of sort-merge
# joins.  Shuffle partitions are sized by the caller (cores locally, a few
# thousand on a large cluster; AQE coalesces the surplus).
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # Lineage cuts write to the shared checkpoint folder; delete them once unreferenced.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


# Large-cluster profile (100 TB, ~1000 executors): 256 MB input splits and
# shuffle partitions (about 400k scan tasks at 100 TB), coalescing that
# respects the advisory size instead of maximising task count, and a skewed
# partition is one over 5x the median and over 1 GB.  Size
# spark.sql.shuffle.partitions to about total shuffle bytes / 256 MB; AQE
# coalesces the surplus.
CLUSTER_CONF = {
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
}


def build_session(
    master: str | None = None,
    shuffle_partitions: int = 8,
    app_name: str = "incidentlab",
    extra: dict | None = None,
    profile: str = "local",
) -> SparkSession:
    """``profile='cluster'`` adds CLUSTER_CONF; 'local' keeps Spark's
    parallelism-first defaults, which suit small local data."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SCALE_CONF)
    if profile == "cluster":
        conf.update(CLUSTER_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder.  The cluster's setting is used
    when present; a local temporary folder only in local mode (tests)."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        # Executors on other machines cannot share a driver-local folder.
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS / object store) for cluster runs")
    local = tempfile.mkdtemp(prefix="incidentlab-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def checkpoint(df):
    """Cut lineage: write ``df`` once to the shared checkpoint folder (reliable,
    survives executor loss) and read it from there from now on."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for a written table."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/incidentlab-scratch/{name}-{uuid.uuid4().hex[:12]}"


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
