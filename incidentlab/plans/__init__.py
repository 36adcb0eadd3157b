"""End-to-end stages over stored tables: ingest, clean, summaries, outcome
analysis, hotspots and forecasts.  Each stage reads what the previous one
wrote, so a failed stage is rerun alone and every write is an overwrite."""
