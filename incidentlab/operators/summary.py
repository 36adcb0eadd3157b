"""Summary tables.

All counts are two-phase hash aggregates (partial map-side, final after one
shuffle), so a hot key costs one row per map task, not one row per input row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

COUNT = "count"


def count_by(df: DataFrame, *keys: str | Column, name: str = COUNT) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def pair_counts(
    left: DataFrame,
    right: DataFrame,
    key: str = "crime_id",
    row: str = "crime_type",
    col: str = "outcome_type",
    name: str = "n",
) -> DataFrame:
    """Row count of ``left ⟕ right`` on ``key`` grouped by (row, col) (A12), exact,
    without materialising the joined rows and with one scan of each side.

    Both sides are first counted per (key, category), with partial aggregation
    before their shuffle: the null key and a key held by a third of the rows
    become one row per category, so no reducer of the join gets a hot key's
    rows.  The joined counts multiply; an unmatched left row counts once."""
    lefts = left.groupBy(key, row).agg(F.count(F.lit(1)).alias("_n_left"))
    rights = right.filter(F.col(key).isNotNull()).groupBy(key, col).agg(F.count(F.lit(1)).alias("_n_right"))
    joined = lefts.join(rights, on=key, how="left")
    n = F.col("_n_left") * F.coalesce(F.col("_n_right"), F.lit(1))
    return joined.groupBy(row, col).agg(F.sum(n).alias(name))


def rollup_counts(pairs: DataFrame, key: str, n: str = "n", name: str = COUNT) -> DataFrame:
    """A1 / A2 from A12: the per-category count of the joined rows."""
    return pairs.groupBy(key).agg(F.sum(n).alias(name))


def _refuse_month_grain(df: DataFrame, c: str) -> None:
    if isinstance(df.schema[c].dataType, DateType):
        raise ValueError(f"{c!r} is a DATE: hour of day is always 0; use the event timestamp")


def count_by_hour(df: DataFrame, ts: str = "event_ts") -> DataFrame:
    """A3 on a timestamp column (a date column is refused)."""
    _refuse_month_grain(df, ts)
    return count_by(df, F.hour(ts).alias("hour"))


def count_by_dow(df: DataFrame, ts: str = "event_ts") -> DataFrame:
    """A4: 1 = Sunday ... 7 = Saturday."""
    return count_by(df, F.dayofweek(ts).alias("dow"))


def count_by_month(df: DataFrame, date: str = "date") -> DataFrame:
    """A5: month of year over all years."""
    return count_by(df, F.month(date).alias("month"))


def year_month_trend(df: DataFrame, year: str = "year", month: str = "month") -> DataFrame:
    """A6/T1.  On a table partitioned by (year, month) this reads no data column."""
    return count_by(df, year, month).orderBy(year, month)


def distinct_count(df: DataFrame, c: str, name: str) -> DataFrame:
    """Number of distinct values, a null counting as one value.
    (``count_distinct`` would skip the null.)"""
    return df.select(c).distinct().agg(F.count(F.lit(1)).alias(name))


def coord_stats(df: DataFrame, lat: str = "latitude", lon: str = "longitude", scale: int | None = None) -> DataFrame:
    """Numeric min / max / avg of both coordinates, one row."""

    def r(c: Column) -> Column:
        return F.round(c, scale) if scale is not None else c

    return df.agg(
        F.min(lat).alias("min_latitude"),
        F.max(lat).alias("max_latitude"),
        F.min(lon).alias("min_longitude"),
        F.max(lon).alias("max_longitude"),
        r(F.avg(lat)).alias("avg_latitude"),
        r(F.avg(lon)).alias("avg_longitude"),
    )


def top_k(df: DataFrame, k: int, by: str, ties: Sequence[str]) -> DataFrame:
    """First ``k`` rows by ``by`` descending, ties broken by ``ties``
    ascending.  Planned as TakeOrderedAndProject: a per-partition top-k, no
    full sort."""
    return df.orderBy(F.col(by).desc(), *[F.col(t).asc_nulls_first() for t in ties]).limit(k)


def top_areas(df: DataFrame, code: str = "lsoa_code", name: str = "lsoa_name", k: int = 10) -> DataFrame:
    """A8 + T2: the ``k`` areas with most incidents."""
    return top_k(count_by(df, code, name), k, COUNT, [code, name])


def peek(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    """First ``n`` rows in a stated order (stable across runs)."""
    return df.orderBy(*order).limit(n)


def load_report(tables: Mapping[str, DataFrame], reject_checks: Mapping[str, Mapping[str, Column]]) -> DataFrame:
    """One row per table with its row count and, per named check, the
    number of rows it rejects (e.g. a month or a coordinate that is present but
    cannot be parsed); a table without that check rejects none."""
    names = list(dict.fromkeys(n for checks in reject_checks.values() for n in checks))
    out = None
    for table, df in tables.items():
        checks = reject_checks.get(table, {})
        part = df.agg(
            F.count(F.lit(1)).alias("rows"),
            *(F.count_if(checks[n]).alias(n) if n in checks else F.lit(0).cast("bigint").alias(n) for n in names),
        ).select(F.lit(table).alias("table"), "rows", *names)
        out = part if out is None else out.unionByName(part)
    return out



def grouping_set_counts(
    df: DataFrame,
    sets: Mapping[str, Sequence[str]],
    extra_aggs: Sequence[Column] = (),
    name: str = COUNT,
) -> DataFrame:
    """Several group-by counts from ONE scan of ``df``: a GROUPING SETS
    aggregation (each row is expanded once per set and combined map-side
    before the single shuffle).  Returns a long table with a ``grouping_set``
    column naming the set of each row; the grouping columns of other sets are
    null there.  Split it with ``from_grouping_set``.

    The result has one row per group of each set, so it is summary-sized; a
    caller that derives several tables from it can checkpoint it once."""
    cols: list[str] = []
    for s in sets.values():
        for c in s:
            if c not in cols:
                cols.append(c)
    n = len(cols)
    gid_of = {}
    for set_name, s in sets.items():
        gid_of[set_name] = sum(1 << (n - 1 - i) for i, c in enumerate(cols) if c not in s)
    agg = df.groupingSets([tuple(s) for s in sets.values()], *cols).agg(
        F.count(F.lit(1)).alias(name), *extra_aggs, F.grouping_id().alias("_gid")
    )
    label = None
    for set_name, gid in gid_of.items():
        label = (F.when(F.col("_gid") == gid, F.lit(set_name)) if label is None
                 else label.when(F.col("_gid") == gid, F.lit(set_name)))
    return agg.withColumn("grouping_set", label).drop("_gid")


def from_grouping_set(counts: DataFrame, set_name: str, cols: Sequence[str], *other: str | Column) -> DataFrame:
    """Rows of one set of ``grouping_set_counts``, with its grouping columns."""
    return counts.filter(F.col("grouping_set") == set_name).select(*cols, *other)
