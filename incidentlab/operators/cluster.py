"""Location hotspots.

``fit_centres`` is a KMeans whose result depends on the points, k and the seed
alone: coordinates are whole numbers of 1 / UNITS, so distances and sums are exact
and neither the partitions nor a task that runs again can change them.
``fit_kmeans`` is Spark ML's distributed Lloyd iteration, which offers other
features but follows the partition layout.  Assigning points to given
centres needs no join: the centre table becomes one array value (a scalar
subquery of the same plan) and each row picks its nearest centre inside one
projection, an expression of the same size for any number of centres.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import VectorAssembler
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from incidentlab.session import checkpoint


def assemble(
    df: DataFrame,
    cols: Sequence[str] = ("latitude", "longitude"),
    out: str = "features",
    lat_weighted: bool = False,
) -> DataFrame:
    """Dense feature vector; rows with a null input are dropped first.

    ``lat_weighted`` scales the longitude by cos(latitude) so a degree east
    counts as the distance it is on the ground (equirectangular projection);
    the default treats degrees as a plane."""
    clean = df.na.drop(subset=list(cols))
    inputs = list(cols)
    if lat_weighted:
        lat, lon = cols[0], cols[1]
        clean = clean.withColumn("_lon_scaled", F.col(lon) * F.cos(F.radians(F.col(lat))))
        inputs = [lat, "_lon_scaled", *cols[2:]]
    out_df = VectorAssembler(inputCols=inputs, outputCol=out).transform(clean)
    return out_df.drop("_lon_scaled") if lat_weighted else out_df


def fit_kmeans(
    df: DataFrame,
    k: int = 8,
    seed: int = 42,
    cols: Sequence[str] = ("latitude", "longitude"),
    max_iter: int = 20,
    lat_weighted: bool = False,
) -> KMeansModel:
    """KMeans(k, seed), other settings at Spark's defaults.

    The iterations re-read the input once per pass, so only the feature column
    is persisted (memory, spilling to disk) for the duration of the fit."""
    data = assemble(df, cols, lat_weighted=lat_weighted).select("features").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol="features", predictionCol="prediction").fit(data)
    finally:
        data.unpersist()


UNITS = 1_000_000  # steps of a coordinate; of a degree, 11 cm


def _whole(c: str) -> Column:
    return F.floor(F.col(c).cast("double") * UNITS + F.lit(0.5))


def _usable(cols: Sequence[str]) -> Column:
    return functools.reduce(operator.and_, (F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in cols))


def _nearest(centres: Sequence[tuple], xs: Sequence[Column]) -> Column:
    """(squared distance, number) of the nearest centre, ties to the smaller
    number, by whole numbers."""
    choices = [
        F.struct(sum((x - F.lit(c)) * (x - F.lit(c)) for x, c in zip(xs, centre)).alias("d"), F.lit(i).alias("id"))
        for i, centre in enumerate(centres)
    ]
    return F.least(*choices) if len(choices) > 1 else choices[0]


def fit_centres(
    df: DataFrame,
    k: int = 8,
    seed: int = 42,
    cols: Sequence[str] = ("latitude", "longitude"),
    max_iter: int = 20,
) -> DataFrame:
    """The centres ``(prediction, *cols)`` of a KMeans, at most k.

    Equal points are counted once and weigh by their number, which is all that is
    read again.  The first centre and then one a round wins a race in which a
    point's time is exponential, drawn by a hash of the seed, the round and the
    point, at a rate of its weight times its squared distance from the nearest
    centre (k-means++).  Lloyd rounds follow until nothing moves, ``max_iter`` at
    most; a centre without points stays.  Only the k centres and their sums come
    to the driver.  Coordinates must be below 1000 in size (rows with a null or
    NaN one are left out)."""
    names = [f"x{i}" for i in range(len(cols))]
    points = df.filter(_usable(cols)).select(*(_whole(c).alias(n) for c, n in zip(cols, names)))
    points = checkpoint(points.groupBy(*names).agg(F.count(F.lit(1)).alias("n")))
    xs = [F.col(n) for n in names]

    def first(weight: Column, number: int) -> tuple | None:
        text = F.concat_ws(":", F.lit(f"{seed}:{number}"), *(x.cast("string") for x in xs))
        u = (F.conv(F.substring(F.sha2(text, 256), 1, 13), 16, 10).cast("double") + 1) / float(1 << 52)
        runs = points.select(F.struct((-F.log(u) / weight).alias("time"), *xs).alias("run"), weight.alias("w")).filter("w > 0")
        best = runs.agg(F.min("run")).first()[0]
        return best and tuple(best[n] for n in names)

    centres: list[tuple] = []
    while len(centres) < k:
        weight = F.col("n").cast("double")
        if centres:
            weight = weight * _nearest(centres, xs)["d"].cast("double")
        found = first(weight, len(centres))
        if found is None:  # fewer different points than centres
            break
        centres.append(found)
    for _ in range(max_iter if centres else 0):
        placed = points.select(_nearest(centres, xs)["id"].alias("id"), "n", *xs).groupBy("id")
        sums = placed.agg(F.sum("n").alias("n"), *(F.sum(F.col("n").cast("decimal(38,0)") * x).alias(c) for c, x in zip(names, xs)))
        moved = list(centres)
        for r in sums.collect():  # at most k rows; whole-number division, half up
            moved[r["id"]] = tuple((2 * int(r[c]) + r["n"]) // (2 * r["n"]) for c in names)
        if moved == centres:
            break
        centres = moved
    schema = ", ".join(["prediction int", *(f"`{c}` double" for c in cols)])
    rows = [(i, *(x / UNITS for x in c)) for i, c in enumerate(centres)]
    return df.sparkSession.createDataFrame(rows, schema)


def assign_centres(df: DataFrame, centres: DataFrame, cols: Sequence[str] = ("latitude", "longitude")) -> DataFrame:
    """C3 for ``fit_centres``: every column of the usable rows, and ``prediction``."""
    held = centres.orderBy("prediction").collect()  # at most k rows
    at = [tuple(round(r[c] * UNITS) for c in cols) for r in held]
    nearest = _nearest(at, [_whole(c) for c in cols])["id"] if at else F.lit(None).cast("int")
    return df.filter(_usable(cols)).withColumn("prediction", nearest)


def kmeans_assign(
    df: DataFrame, model: KMeansModel, cols: Sequence[str] = ("latitude", "longitude"), lat_weighted: bool = False
) -> DataFrame:
    """Every input column kept, plus ``features`` and ``prediction``."""
    return model.transform(assemble(df, cols, lat_weighted=lat_weighted))


def kmeans_centres(spark: SparkSession, model: KMeansModel, cols: Sequence[str] = ("latitude", "longitude")) -> DataFrame:
    """The fitted centres as a table ``(prediction, *cols)`` (k rows)."""
    rows = [(i, *[float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    return spark.createDataFrame(rows, ["prediction", *cols])


def cluster_centroids(df: DataFrame, key: str = "prediction", lat: str = "latitude", lon: str = "longitude", scale: int | None = 6) -> DataFrame:
    """Mean position of each cluster over all of its points."""

    def r(c):
        return F.round(c, scale) if scale is not None else c

    return df.groupBy(key).agg(r(F.avg(lat)).alias("centroid_lat"), r(F.avg(lon)).alias("centroid_lon"))


def map_center(df: DataFrame, lat: str = "latitude", lon: str = "longitude", scale: int | None = 6) -> DataFrame:
    """Overall mean position (one row)."""

    def r(c):
        return F.round(c, scale) if scale is not None else c

    return df.agg(r(F.avg(lat)).alias("center_lat"), r(F.avg(lon)).alias("center_lon"))


def assign_nearest(
    df: DataFrame,
    centres: DataFrame,
    cols: Sequence[str] = ("latitude", "longitude"),
    centre_cols: Sequence[str] | None = None,
    key: str = "prediction",
) -> DataFrame:
    """C3 with given centres: nearest centre by squared Euclidean distance,
    ties to the smallest centre id.  Rows with a null coordinate get null, as
    do all rows where there is no centre; centres with a null coordinate are
    left out."""
    centre_cols = list(centre_cols or cols)
    known = centres.dropna(subset=centre_cols).select(
        F.struct(F.col(key).alias("id"), *(F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(centre_cols))).alias("c")
    )
    all_centres = known.agg(F.collect_list("c")).scalar()

    def candidate(c):
        dist = sum((F.col(own) - c[f"x{i}"]) * (F.col(own) - c[f"x{i}"]) for i, own in enumerate(cols))
        return F.struct(dist.alias("d"), c["id"].alias("id"))

    best = F.array_min(F.transform("_centres", candidate))
    present = F.lit(True)
    for c in cols:
        present = present & F.col(c).isNotNull()
    placed = df.withColumn("_centres", all_centres).withColumn(key, F.when(present, best["id"]))
    return placed.drop("_centres")
