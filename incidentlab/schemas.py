"""Declared schemas of the three raw incident feeds.

Raw feeds are read as text (every column a string) with these headers; the
names are normalised afterwards (``operators.columns.normalize_columns``).
"""

from __future__ import annotations

from pyspark.sql.types import StringType, StructField, StructType

# Published header names of the three monthly feeds, in file order.
STREET_HEADER = [
    "Crime ID", "Month", "Reported by", "Falls within", "Longitude", "Latitude",
    "Location", "LSOA code", "LSOA name", "Crime type", "Last outcome category", "Context",
]
OUTCOMES_HEADER = [
    "Crime ID", "Month", "Reported by", "Falls within", "Longitude", "Latitude",
    "Location", "LSOA code", "LSOA name", "Outcome type",
]
STOP_HEADER = [
    "Type", "Date", "Part of a policing operation", "Policing operation", "Latitude",
    "Longitude", "Gender", "Age range", "Self-defined ethnicity", "Officer-defined ethnicity",
    "Legislation", "Object of search", "Outcome", "Outcome linked to object of search",
    "Removal of more than just outer clothing",
]

# Text columns normalised by the clean stage, per feed.
STREET_TEXT_COLS = [
    "reported_by", "falls_within", "location", "lsoa_code", "lsoa_name", "crime_type",
    "last_outcome_category", "context",
]
OUTCOMES_TEXT_COLS = ["reported_by", "falls_within", "location", "lsoa_code", "lsoa_name", "outcome_type"]
STOP_TEXT_COLS = [
    "type", "part_of_a_policing_operation", "policing_operation", "gender", "age_range",
    "self_defined_ethnicity", "officer_defined_ethnicity", "legislation", "object_of_search",
    "outcome", "outcome_linked_to_object_of_search", "removal_of_more_than_just_outer_clothing",
]


def text_schema(header: list[str]) -> StructType:
    return StructType([StructField(h, StringType(), True) for h in header])


STREET_RAW = text_schema(STREET_HEADER)
OUTCOMES_RAW = text_schema(OUTCOMES_HEADER)
STOP_RAW = text_schema(STOP_HEADER)

FEEDS = {
    "street": (STREET_RAW, STREET_TEXT_COLS),
    "outcomes": (OUTCOMES_RAW, OUTCOMES_TEXT_COLS),
    "stop_and_search": (STOP_RAW, STOP_TEXT_COLS),
}
