"""Row cleaning (R1-R7) and text normalisation."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from incidentlab.functions.casts import to_double
from incidentlab.functions.text import ascii_lower_trim
from incidentlab.session import checkpoint


MAX_REPEATED = 1_000_000  # broadcast digests, 16 bytes each


def dedup_rows(df: DataFrame) -> DataFrame:
    """Whole-row dedup (R1): partial hash aggregate map-side, then one shuffle."""
    return df.dropDuplicates()


def dedup_wide_rows(df: DataFrame) -> DataFrame:
    """R1 for wide rows of which few repeat: only digests are shuffled for all.

    128 bits of digest per row are counted.  The digests that occur more than
    once, at most MAX_REPEATED, are broadcast and decide which whole rows are
    shuffled to be compared value by value; all others stay where they were
    read.  Rows with equal digests but different values are all kept.  A table
    with more repeated digests gains nothing and goes the plain way.  Reads ``df``
    three times."""
    names = [f"c{i}" for i in range(len(df.columns))]
    rows = df.toDF(*names)
    # Map keys have no order and no digest of their own.
    parts = [F.to_json(F.struct(c)) if "map<" in t else F.col(c) for c, t in rows.dtypes]
    digest = F.struct(F.xxhash64(F.lit(1), *parts).alias("a"), F.xxhash64(F.lit(2), *(F.struct(p, F.lit(i)) for i, p in enumerate(parts))).alias("b"))
    keyed = rows.withColumn("_digest", digest)
    counts = keyed.groupBy("_digest").agg(F.count(F.lit(1)).alias("_n"))
    repeated = checkpoint(counts.filter("_n > 1").select("_digest", F.lit(True).alias("_again")))
    if repeated.count() > MAX_REPEATED:
        return dedup_rows(df)
    marked = keyed.join(F.broadcast(repeated), "_digest", "left")
    alone = marked.filter("_again IS NULL").select(*names)
    several = marked.filter("_again").select(*names).dropDuplicates()
    return alone.unionByName(several).toDF(*df.columns)


def filter_not_null(df: DataFrame, *cols: str) -> DataFrame:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return df.filter(cond)


def _numeric(df: DataFrame, c: str):
    dtype = df.schema[c].dataType
    return F.col(c) if isinstance(dtype, NumericType) else to_double(c)


def filter_nonzero_coords(df: DataFrame, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Both coordinates non-zero, compared as numbers.

    Text coordinates are cast to double first, so '-0.12' survives (a text
    comparison with integer 0 would truncate it to 0 and drop it)."""
    return df.filter((_numeric(df, lat) != 0.0) & (_numeric(df, lon) != 0.0))


def clean_geo(df: DataFrame, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """R4 = dedup + coordinates present + coordinates non-zero.

    The filters are written first: they are row-local, so they shrink the data
    before the dedup shuffle and reach the Parquet scan as pushed filters.
    Filtering before or after a whole-row dedup gives the same rows."""
    filtered = filter_nonzero_coords(filter_not_null(df, lat, lon), lat, lon)
    return dedup_rows(filtered)


def drop_any_null(df: DataFrame) -> DataFrame:
    return df.na.drop(how="any")


def drop_null_subset(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    return df.na.drop(how="any", subset=list(cols))


def normalize_text(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """P9 on the listed columns, in one projection; other columns pass through."""
    targets = set(cols)
    missing = targets - set(df.columns)
    if missing:
        raise ValueError(f"unknown text columns: {sorted(missing)}")
    return df.select(*[ascii_lower_trim(c).alias(c) if c in targets else F.col(c) for c in df.columns])


def sample_bernoulli(df: DataFrame, fraction: float = 0.1, seed: int = 42) -> DataFrame:
    """Seeded Bernoulli sample (R7).  Both arguments are passed by name: with a
    positional fraction PySpark ignores a keyword seed.  The rows still depend
    on the partition layout; use ``sample_by_key`` for a reproducible sample."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def sample_by_key(df: DataFrame, key: str, buckets: int = 10, keep: int = 1, hashed: bool = True) -> DataFrame:
    """Reproducible sample: keep rows whose key falls in the first ``keep`` of
    ``buckets`` buckets.  Independent of partitioning and retries.  Rows with a
    null key belong to no bucket and are never kept.

    ``hashed=False`` buckets an integer key by ``pmod(key, buckets)`` directly."""
    k = F.col(key)
    bucket = F.pmod(F.xxhash64(k), F.lit(buckets)) if hashed else F.pmod(k, F.lit(buckets))
    return df.filter(k.isNotNull() & (bucket < keep))
