"""Monthly series (A13, A14, W1-W5) and forecast scores.

A series is a DataFrame ``(key..., month DATE, n BIGINT)``; ordering exists
only inside windows partitioned by the key, so series spread over tasks by key.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from statistics import NormalDist

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from incidentlab.functions.dates import month_start
from incidentlab.functions.stats import chi2_sf, normal_quantile


def _one_month():
    return F.make_ym_interval(F.lit(0), F.lit(1))


def _keys(keys: str | Sequence[str] | None) -> list[str]:
    if keys is None:
        return []
    return [keys] if isinstance(keys, str) else list(keys)


def monthly_counts(df: DataFrame, date: str = "date", keys: str | Sequence[str] | None = None, name: str = "n") -> DataFrame:
    """Incidents per (key, month)."""
    return df.groupBy(*_keys(keys), month_start(date).alias("month")).agg(F.count(F.lit(1)).alias(name))


def complete_months(df: DataFrame, date: str = "date") -> DataFrame:
    """Dated rows without those of a partial last month: the month of the
    latest date counts as partial unless that date is its last day."""
    end = df.agg(F.date_trunc("month", F.date_add(F.max(date), 1)).cast("date")).scalar()
    return df.filter(F.col(date) < end)


def gapfill(
    series: DataFrame,
    keys: str | Sequence[str] | None = None,
    month: str = "month",
    value: str = "n",
    fill: int | float | None = 0,
) -> DataFrame:
    """Every month between each key's first and last month; an absent month
    gets ``fill`` (``None`` keeps it null, as a plain regular-frequency view).

    One window pass: each present month expands to itself plus the absent
    months before the key's next present month.  No join, no second
    aggregation; other columns are null on the added months."""
    ks = _keys(keys)
    w = Window.partitionBy(*ks).orderBy(month)
    others = [c for c in series.columns if c not in (*ks, month)]
    with_next = series.withColumn("_last", F.coalesce(F.add_months(F.lead(month).over(w), -1), F.col(month)))
    expanded = with_next.select(
        *ks, *others, F.posexplode(F.sequence(F.col(month), F.col("_last"), _one_month())).alias("_pos", "_month")
    )
    dtype = series.schema[value].dataType
    filler = F.lit(fill).cast(dtype) if fill is not None else F.lit(None).cast(dtype)
    cols = [*ks, F.col("_month").alias(month)]
    for c in others:
        gap = filler if c == value else F.lit(None).cast(series.schema[c].dataType)
        cols.append(F.when(F.col("_pos") == 0, F.col(c)).otherwise(gap).alias(c))
    return expanded.select(*cols)


def holdout_split(series: DataFrame, keys: str | Sequence[str] | None = None, month: str = "month", horizon: int = 6) -> DataFrame:
    """Flag the last ``horizon`` points of each series as test."""
    ks = _keys(keys)
    w = Window.partitionBy(*ks).orderBy(F.col(month).desc())
    return series.withColumn("is_test", F.row_number().over(w) <= horizon)


def future_months(series: DataFrame, keys: str | Sequence[str] | None = None, month: str = "month", horizon: int = 6) -> DataFrame:
    """The ``horizon`` months after each series' last month, with step 1..h."""
    ks = _keys(keys)
    last = series.groupBy(*ks).agg(F.max(month).alias("_last"))
    months = F.sequence(F.add_months("_last", 1), F.add_months("_last", horizon), _one_month())
    return last.select(*ks, F.posexplode(months).alias("_pos", month)).select(
        *ks, (F.col("_pos") + 1).alias("step"), month
    )


def actual_vs_forecast(
    actual: DataFrame,
    forecast: DataFrame,
    keys: str | Sequence[str] | None = None,
    month: str = "month",
    value: str = "n",
) -> DataFrame:
    """History and forecast band in one table, for plotting elsewhere, with
    the first forecast month of each key as ``forecast_start``.  The forecast
    may come from anywhere, e.g. a saved result file.  A null key is a series
    like any other."""
    ks = _keys(keys)
    a = actual.select(*ks, month, F.col(value).alias("actual"))
    own = {k: f"_f_{k}" for k in [*ks, month]}
    f = forecast.select(*[F.col(k).alias(o) for k, o in own.items()], "mean", "lower", "upper")
    on = [F.col(k).eqNullSafe(F.col(own[k])) for k in ks] + [F.col(month) == F.col(own[month])]
    both = a.join(f, on=on, how="full").select(
        *[F.coalesce(k, o).alias(k) for k, o in own.items()], "actual", "mean", "lower", "upper"
    )
    both = both.withColumn("is_forecast", F.col("mean").isNotNull())
    start = F.min(F.when(F.col("is_forecast"), F.col(month))).over(Window.partitionBy(*ks))
    return both.withColumn("forecast_start", start)


def forecast_metrics(df: DataFrame, keys: str | Sequence[str] | None, actual: str, predicted: str, scale: int | None = 6) -> DataFrame:
    """RMSE and MAE per key over the rows where both values exist."""
    err = F.col(actual).cast("double") - F.col(predicted).cast("double")
    rmse = F.sqrt(F.avg(err * err))
    mae = F.avg(F.abs(err))
    if scale is not None:
        rmse, mae = F.round(rmse, scale), F.round(mae, scale)
    both = df.filter(F.col(actual).isNotNull() & F.col(predicted).isNotNull())
    return both.groupBy(*_keys(keys)).agg(rmse.alias("rmse"), mae.alias("mae"))


def autocorrelation(
    df: DataFrame,
    keys: str | Sequence[str] | None,
    order: str,
    value: str,
    max_lag: int = 10,
    scale: int | None = 6,
) -> DataFrame:
    """sample autocorrelation per key for lags 1..max_lag
    (sum over t of (x_t - mean)(x_{t-k} - mean) / sum of (x_t - mean)^2).

    Lags come from window functions over one partitioning of the key, so the
    work is one shuffle and one sort, never pairs of rows."""
    ks = _keys(keys)
    by_key = Window.partitionBy(*ks)
    ordered = by_key.orderBy(order)
    c = F.col(value).cast("double") - F.avg(F.col(value).cast("double")).over(by_key)
    centered = df.select(*ks, order, c.alias("_c"))
    lagged = centered.select(*ks, "_c", *[F.lag("_c", k).over(ordered).alias(f"_l{k}") for k in range(1, max_lag + 1)])
    sums = lagged.groupBy(*ks).agg(
        F.sum(F.col("_c") * F.col("_c")).alias("_den"),
        *[F.sum(F.col("_c") * F.col(f"_l{k}")).alias(f"_s{k}") for k in range(1, max_lag + 1)],
    )
    cells = F.array(*[F.struct(F.lit(k).alias("lag"), F.col(f"_s{k}").alias("_s")) for k in range(1, max_lag + 1)])
    acf = F.col("_s") / F.col("_den")
    return sums.select(*ks, "_den", F.inline(cells)).select(
        *ks, "lag", (F.round(acf, scale) if scale is not None else acf).alias("acf")
    )


def acf_diagnostics(
    df: DataFrame, keys: str | Sequence[str] | None, order: str, value: str, max_lag: int = 10, level: float = 0.95
) -> DataFrame:
    """the autocorrelations with the half width ``band`` of their ``level``
    interval (Bartlett: variance (1 + 2 * sum of the squared shorter lags) / n) and
    the Ljung-Box test up to each lag, ``ljung_box`` and ``p``."""
    ks = _keys(keys)
    acf = autocorrelation(df, keys, order, value, max_lag, scale=None)
    known = df.filter(F.col(value).isNotNull()).groupBy(*ks).agg(F.count(F.lit(1)).alias("_n"))
    if ks:
        same = [F.col(k).eqNullSafe(F.col(f"_own_{k}")) for k in ks]
        acf = acf.join(known.select(*[F.col(k).alias(f"_own_{k}") for k in ks], "_n"), same)
    else:
        acf = acf.withColumn("_n", known.scalar())
    up_to = Window.partitionBy(*ks).orderBy("lag")
    square = F.col("acf") * F.col("acf")
    shorter = F.coalesce(F.sum(square).over(up_to.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    weighted = F.sum(square / F.when(F.col("_n") > F.col("lag"), F.col("_n") - F.col("lag"))).over(up_to)
    z = NormalDist().inv_cdf(0.5 + level / 2)
    out = acf.withColumns(
        {"band": z * F.sqrt((1 + 2 * shorter) / F.col("_n")), "ljung_box": F.col("_n") * (F.col("_n") + 2) * weighted}
    )
    return out.select(*ks, "lag", "acf", "band", "ljung_box", chi2_sf(F.col("ljung_box"), F.col("lag")).alias("p"))


def residual_density(
    df: DataFrame, keys: str | Sequence[str] | None, value: str, points: int = 50, reach: float = 3.92
) -> DataFrame:
    """Gaussian kernel density of the standardised values per key on
    ``points`` places from -reach to reach (Scott's bandwidth, n^(-1/5)), and the
    standard normal density there.  One aggregate with a sum per place."""
    ks = _keys(keys)
    by_key = Window.partitionBy(*ks)
    z = (F.col(value) - F.avg(value).over(by_key)) / F.when(F.stddev_samp(value).over(by_key) > 0, F.stddev_samp(value).over(by_key))
    width = F.pow(F.count(value).over(by_key), F.lit(-0.2))
    rows = df.select(*ks, z.alias("_z"), width.alias("_h")).filter("_z IS NOT NULL")
    places = [-reach + 2 * reach * i / (points - 1) for i in range(points)]
    front = 1 / math.sqrt(2 * math.pi)

    def kernel(x: float) -> Column:
        u = (F.lit(x) - F.col("_z")) / F.col("_h")
        return F.avg(front * F.exp(-u * u / 2) / F.col("_h"))

    sums = rows.groupBy(*ks).agg(*(kernel(x).alias(f"_d{i}") for i, x in enumerate(places)))
    cells = F.array(
        *(
            F.struct(F.lit(x).alias("x"), F.col(f"_d{i}").alias("density"), F.lit(front * math.exp(-x * x / 2)).alias("normal_density"))
            for i, x in enumerate(places)
        )
    )
    return sums.select(*ks, F.inline(cells))


def standardized_residuals(df: DataFrame, keys: str | Sequence[str] | None, order: str, resid: str, scale: int | None = 6) -> DataFrame:
    """F7 table: residual, standardised residual, histogram bucket (10 equal-width
    bins of the standardised value over [-4, 4]), the empirical quantile position
    and the Q-Q abscissa (``theoretical_quantile``: the normal quantile at rank /
    (n + 1)) per key."""
    ks = _keys(keys)
    by_key = Window.partitionBy(*ks)
    z = (F.col(resid) - F.avg(resid).over(by_key)) / F.stddev_samp(resid).over(by_key)
    out = df.select(*ks, order, resid, z.alias("std_resid"))
    out = out.withColumn("bucket", F.least(F.greatest(F.floor((F.col("std_resid") + 4) / 0.8), F.lit(0)), F.lit(9)).cast("int"))
    ranked = by_key.orderBy("std_resid")
    rank = F.row_number().over(by_key.orderBy("std_resid", order))
    n = F.count("std_resid").over(by_key)
    out = out.withColumns(
        {
            "quantile_rank": F.percent_rank().over(ranked),
            "theoretical_quantile": F.when(F.col("std_resid").isNotNull(), normal_quantile(rank / (n + 1))),
        }
    )
    if scale is not None:
        out = out.withColumns({c: F.round(c, scale) for c in ("std_resid", "quantile_rank", "theoretical_quantile")})
    return out
