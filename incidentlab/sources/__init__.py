"""Sources: raw CSV feeds, Parquet tables, summary CSVs, driver-table stand-ins."""

from incidentlab.sources.feeds import (
    header_report,
    ingest_feed,
    read_csv_by_header,
    read_feed,
    read_parquet_table,
    read_published,
    read_summary_csv,
    read_summary_text,
)

__all__ = [
    "header_report",
    "ingest_feed",
    "read_csv_by_header",
    "read_feed",
    "read_parquet_table",
    "read_published",
    "read_summary_csv",
    "read_summary_text",
]
