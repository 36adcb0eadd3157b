"""Map layer of forecast hotspots (P17, A18, J2) as a table.

Drawing is left to mapping tools; this builds the rows they draw: marker
position, radius, colour intensity, colour slot and popup text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from incidentlab.operators.join import join_centroids

# Marker radius = BASE + forecast * SCALE; ten colour slots.
RADIUS_BASE = 5.0
RADIUS_SCALE = 0.1
COLOUR_SLOTS = 10


def map_layer(
    forecast: DataFrame,
    centroids: DataFrame,
    key: str = "prediction",
    date: str = "date",
    value: str = "forecast",
    scale: int | None = 6,
) -> DataFrame:
    """One marker per (cluster, date).  Intensity is the share of the largest
    value (A18, a scalar subquery of the same plan), 0 where that is 0.  The
    forecast is read twice, so hand in a written table, not a plan that fits."""
    top = forecast.agg(F.max(value).cast("double")).scalar()
    layer = join_centroids(forecast, centroids, key)
    intensity = F.when(top == 0, F.lit(0.0)).otherwise(F.col(value) / top)
    radius = F.lit(RADIUS_BASE) + F.col(value) * F.lit(RADIUS_SCALE)
    if scale is not None:
        intensity, radius = F.round(intensity, scale), F.round(radius, scale)
    popup = F.format_string("Cluster %d<br>%s: %d", F.col(key), F.col(date).cast("string"), F.col(value).cast("int"))
    return layer.select(
        key,
        date,
        value,
        "centroid_lat",
        "centroid_lon",
        radius.alias("radius"),
        intensity.alias("intensity"),
        F.pmod(F.col(key), F.lit(COLOUR_SLOTS)).alias("colour_slot"),
        popup.alias("popup"),
    )
