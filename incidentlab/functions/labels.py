"""Display labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: label shown for a missing category.
UNKNOWN_LABEL = "Unknown"


def fill_unknown(c: Column | str, label: str = UNKNOWN_LABEL) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(col, F.lit(label))


def label_fallback(df: DataFrame, preferred: str, fallback: str, row_level: bool = True) -> Column:
    """Area label: ``preferred`` when the column exists (row-level coalesce with
    ``fallback`` by default), else ``fallback``.  Decided at plan time."""
    if preferred in df.columns:
        if row_level and fallback in df.columns:
            return F.coalesce(F.col(preferred), F.col(fallback))
        return F.col(preferred)
    return F.col(fallback)
