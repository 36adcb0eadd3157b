"""Run the batch stages from the command line.

    python -m incidentlab.plans ingest    --raw RAW --processed PROCESSED
    python -m incidentlab.plans clean     --processed PROCESSED --clean CLEAN
    python -m incidentlab.plans summaries --clean CLEAN --out EDA_OUT
    python -m incidentlab.plans outcomes  --clean CLEAN --out ANALYSIS_OUT [--null-policy drop]
    python -m incidentlab.plans hotspots  --clean CLEAN --clusters CLUSTERS [--k 8 --seed 42]
    python -m incidentlab.plans forecast  --clean CLEAN --out FORECAST_OUT [--clusters CLUSTERS]

Paths are folders on any Hadoop-compatible store.  Small result tables are
written as single CSV files with a header, model parameters as Parquet.  On a
cluster, submit with spark-submit and set spark.checkpoint.dir to a shared
folder; the session's settings are kept, and ``--profile cluster`` adds the
large-data sizes from ``incidentlab.session.CLUSTER_CONF``.
"""

from __future__ import annotations

import argparse
import sys

from incidentlab import sinks
from incidentlab.plans import stages
from incidentlab.session import CLUSTER_CONF, ensure_checkpoint_dir


def _session(profile: str):
    from pyspark.sql import SparkSession

    spark = SparkSession.builder.appName("incidentlab").getOrCreate()
    if profile == "cluster":
        for k, v in CLUSTER_CONF.items():
            spark.conf.set(k, v)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ensure_checkpoint_dir(spark)
    return spark


def _write_tables(tables: dict, out: str, parquet: tuple[str, ...] = ()) -> None:
    for name, df in tables.items():
        path = f"{out.rstrip('/')}/{name}"
        if name in parquet:
            sinks.write_flat_parquet(df, path)
        else:
            sinks.write_single_csv(df, path)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="python -m incidentlab.plans")
    ap.add_argument("stage", choices=["ingest", "clean", "summaries", "outcomes", "hotspots", "forecast"])
    ap.add_argument("--raw")
    ap.add_argument("--processed")
    ap.add_argument("--clean")
    ap.add_argument("--out")
    ap.add_argument("--clusters")
    ap.add_argument("--k", type=int, default=8)
    ap.add_argument("--seed", type=int, default=42)
    ap.add_argument("--horizon", type=int, default=6)
    ap.add_argument("--null-policy", default="category", choices=["category", "drop"])
    ap.add_argument("--profile", default="local", choices=["local", "cluster"])
    a = ap.parse_args(argv)
    spark = _session(a.profile)

    if a.stage == "ingest":
        stages.ingest(spark, a.raw, a.processed).show(truncate=False)
    elif a.stage == "clean":
        stages.clean_all(spark, a.processed, a.clean)
    elif a.stage == "summaries":
        stages.write_summaries(stages.summaries(spark, a.clean), a.out)
    elif a.stage == "outcomes":
        _write_tables(stages.outcome_analysis(spark, a.clean, null_policy=a.null_policy), a.out)
    elif a.stage == "hotspots":
        stages.hotspots(spark, a.clean, a.clusters, k=a.k, seed=a.seed)
    elif a.stage == "forecast":
        total = stages.total_forecast(spark, a.clean, horizon=a.horizon)
        _write_tables(total, f"{a.out.rstrip('/')}/total", parquet=("params",))
        if a.clusters:
            _write_tables(stages.cluster_forecast(spark, a.clusters, horizon=a.horizon), f"{a.out.rstrip('/')}/clusters")
    return 0


if __name__ == "__main__":
    sys.exit(main())
