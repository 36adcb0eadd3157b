"""Joins (J1, J2).

J1 keeps every street row and reads the street table once.  Rows whose key is
null can never match, and in a sort-merge join they would all hash to one
reducer (a third of the feed can be such rows), so the join has a second key:
a salt that is 0 for keyed rows and follows the row number for null-keyed ones,
which spreads them over the reducers.  Skew of a real key is left to AQE's
skew join (the preserved left side of a left outer join is splittable), or
spread explicitly over ``salt`` reducers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NULL_SALT = 64


def heavy_keys(df: DataFrame, key: str, share: float) -> list:
    """The non-null keys that hold at least ``share`` of the rows, at most
    1 / share of them.  A frequent-items summary (Misra and Gries: bounded, merged
    over the tasks, no heavy key missing) names the candidates in one scan of the
    key; a second scan counts those alone."""
    if not 0 < share <= 1:
        raise ValueError("share must be in (0, 1]")
    known = df.select(F.col(key).alias("k")).filter("k IS NOT NULL")
    found = known.freqItems(["k"], support=max(share / 2, 1e-4)).first()["k_freqItems"] or []
    rows = df.count()
    counted = known.filter(F.col("k").isin(list(found))).groupBy("k").count() if found else None
    if counted is None:
        return []
    return [r["k"] for r in counted.filter(F.col("count") >= share * rows).orderBy("k").collect()]


def join_outcomes(
    left: DataFrame,
    right: DataFrame,
    key: str = "crime_id",
    cols: Sequence[str] = ("outcome_type",),
    salt: int = 1,
    share: float | None = None,
) -> DataFrame:
    """``left`` left-outer-join ``right.select(key, *cols)`` on ``key``.

    Null keys keep null outcomes; a key with several outcomes fans out.
    ``salt`` > 1 deals the rows of a left key over that many reducers and repeats
    the key's right rows for each of them: of every key, or with ``share`` only of
    the keys that hold at least that share of the left rows (``heavy_keys``), so
    the right table grows by the rows of those keys alone.  Salts follow the row
    number, not the row's content, so identical rows spread as well."""
    number = F.monotonically_increasing_id()
    none, last = F.lit(0).cast("bigint"), F.lit(salt - 1).cast("bigint")
    hot = F.lit(salt > 1)
    if salt > 1 and share is not None:
        heavy = heavy_keys(left, key, share)
        hot = F.coalesce(F.col(key).isin(heavy), F.lit(False)) if heavy else F.lit(False)
    dealt = F.when(hot, F.pmod(number, F.lit(salt))).otherwise(none) if salt > 1 else none
    keyed = left.withColumn("_salt", F.when(F.col(key).isNull(), F.pmod(number, F.lit(NULL_SALT))).otherwise(dealt))
    r = right.select(key, *cols).filter(F.col(key).isNotNull())
    r = r.withColumn("_salt", F.explode(F.sequence(none, F.when(hot, last).otherwise(none))))
    return keyed.join(r, on=[key, "_salt"], how="left").select(*left.columns, *cols)


def join_centroids(df: DataFrame, centroids: DataFrame, key: str = "prediction") -> DataFrame:
    """Inner join of per-key rows with the per-cluster centroid table.
    Spark broadcasts the centroid table where its measured size allows it."""
    return df.join(centroids, on=key, how="inner")
