"""Column-level operators: header normalisation (P1), projection (P8),
typing of a raw feed (P2-P6)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from incidentlab.functions.casts import to_double
from incidentlab.functions.dates import parse_timestamp_date, parse_timestamp_text, parse_year_month
from incidentlab.functions.text import normalize_name


def normalize_columns(df: DataFrame) -> DataFrame:
    """Rename every column by the header rule in one projection.

    Raises if two columns collapse to the same name (e.g. 'Crime ID' and 'crime-id').
    """
    names = [normalize_name(c) for c in df.columns]
    seen: dict[str, str] = {}
    for raw, new in zip(df.columns, names):
        if new in seen:
            raise ValueError(f"columns {seen[new]!r} and {raw!r} both normalise to {new!r}")
        seen[new] = raw
    return df.toDF(*names)


def project_columns(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*cols)


def type_month_feed(df: DataFrame, month_col: str = "month", coords: tuple[str, ...] = ("latitude", "longitude")) -> DataFrame:
    """Street / outcomes feed: 'yyyy-MM' text -> ``date``; ``year``/``month`` ints
    (``month`` replaces the text); coordinates to double.  One projection."""
    date = parse_year_month(month_col)
    out = []
    for c in df.columns:
        if c == month_col:
            continue
        out.append(to_double(c).alias(c) if c in coords else F.col(c))
    return df.select(*out, date.alias("date"), F.year(date).alias("year"), F.month(date).alias("month"))


def type_timestamp_feed(df: DataFrame, ts_col: str = "date", coords: tuple[str, ...] = ("latitude", "longitude")) -> DataFrame:
    """Stop-and-search feed: timestamp text -> ``date`` (first ten characters),
    plus the full instant in ``event_ts`` so the time of day survives."""
    date = parse_timestamp_date(ts_col)
    out = []
    for c in df.columns:
        if c == ts_col:
            continue
        out.append(to_double(c).alias(c) if c in coords else F.col(c))
    return df.select(
        *out,
        date.alias("date"),
        parse_timestamp_text(ts_col).alias("event_ts"),
        F.year(date).alias("year"),
        F.month(date).alias("month"),
    )
