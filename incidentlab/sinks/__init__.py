"""Sinks: partitioned / flat / published Parquet, quarantine, single-file CSV summaries."""

from incidentlab.sinks.writers import (
    publish_parquet,
    write_flat_parquet,
    write_partitioned_parquet,
    write_single_csv,
    write_with_quarantine,
)

__all__ = [
    "publish_parquet",
    "write_flat_parquet",
    "write_partitioned_parquet",
    "write_single_csv",
    "write_with_quarantine",
]
