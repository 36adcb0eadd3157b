"""Text normalisation for column names (P1) and values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters outside 7-bit ASCII are removed from text values.
NON_ASCII_PATTERN = r"[^\x00-\x7F]"


def normalize_name(name: str) -> str:
    """Header rule: strip, lower-case, then space and hyphen become underscore."""
    return name.strip().lower().replace(" ", "_").replace("-", "_")


def ascii_lower_trim(c: Column | str) -> Column:
    """Drop non-ASCII characters, then trim spaces, then lower-case.

    Trimming runs after the removal, so a space left in front of a removed
    character is trimmed too.  ``trim`` removes spaces only; tabs stay.
    """
    col = F.col(c) if isinstance(c, str) else c
    return F.lower(F.trim(F.regexp_replace(col, NON_ASCII_PATTERN, "")))
