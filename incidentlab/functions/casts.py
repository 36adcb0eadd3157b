"""Casts of raw text to numbers (P6, P7).  Malformed text becomes null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_double(c: Column | str) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return col.try_cast("double")


def to_count(c: Column | str) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return col.try_cast("bigint")
