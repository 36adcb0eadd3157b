"""Date parsing and date parts.

Raw text goes through the ``try_`` forms so a malformed value becomes null
instead of failing the job under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Formats of the incident feeds.
YEAR_MONTH_FORMAT = "yyyy-MM"
DAY_FORMAT = "yyyy-MM-dd"
TIMESTAMP_FORMATS = ("yyyy-MM-dd'T'HH:mm:ssXXX", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_year_month(c: Column | str) -> Column:
    """'2024-03' -> DATE 2024-03-01; malformed or null -> null."""
    return F.try_to_date(_col(c), YEAR_MONTH_FORMAT)


def parse_timestamp_date(c: Column | str) -> Column:
    """Date from the first ten characters of timestamp text ('yyyy-MM-dd...')."""
    return F.try_to_date(F.substring(_col(c), 1, 10), DAY_FORMAT)


def parse_timestamp_text(c: Column | str) -> Column:
    """Full instant from timestamp text with or without an offset, as TIMESTAMP_NTZ in UTC.

    Keeps the time of day that the date-only parse throws away, so hour and
    day-of-week summaries have something to count.
    """
    col = _col(c)
    parsed = F.coalesce(*[F.try_to_timestamp(col, F.lit(fmt)) for fmt in TIMESTAMP_FORMATS])
    # The cast to wall-clock time uses the session zone, pinned to UTC by session.SCALE_CONF.
    return parsed.cast("timestamp_ntz")


def month_start(c: Column | str) -> Column:
    """First day of the month of a date or timestamp."""
    return F.trunc(F.to_date(_col(c)), "month")


def make_month_date(year: Column | str, month: Column | str) -> Column:
    """DATE(year, month, 1)."""
    return F.make_date(_col(year), _col(month), F.lit(1))


def date_parts(date: Column | str) -> tuple[Column, Column]:
    """(year, month) as ints from a date."""
    d = _col(date)
    return F.year(d).alias("year"), F.month(d).alias("month")
