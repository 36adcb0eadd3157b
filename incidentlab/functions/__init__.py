"""Column expressions built only from ``pyspark.sql.functions`` (JVM side, codegen)."""

from incidentlab.functions.casts import to_count, to_double
from incidentlab.functions.dates import (
    date_parts,
    make_month_date,
    month_start,
    parse_timestamp_date,
    parse_timestamp_text,
    parse_year_month,
)
from incidentlab.functions.labels import fill_unknown, label_fallback
from incidentlab.functions.text import ascii_lower_trim, normalize_name

__all__ = [
    "ascii_lower_trim",
    "date_parts",
    "fill_unknown",
    "label_fallback",
    "make_month_date",
    "month_start",
    "normalize_name",
    "parse_timestamp_date",
    "parse_timestamp_text",
    "parse_year_month",
    "to_count",
    "to_double",
]
