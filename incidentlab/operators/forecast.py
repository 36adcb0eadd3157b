"""Forecasting over many monthly series at once (F1-F5, K6, U1, F7 residuals),
as Spark expressions over one array per series.

A model is ARIMA(p, d, q) x (P, D, Q)_m with p <= 2 and q, P, D, Q <= 1, fitted by
maximum likelihood (``operators/likelihood.py``): exact for the ARMA part, with
the season before the first month taken as zero for the seasonal part.  A series
crosses the network once, to be collected into the array of its key; fits, order
choice and forecasts are projections of that row.  Every key keeps a model, a null
key and a key with a single month included: too short a series is its mean, or its
last value and season where it is differenced.

The fitted model is a row of a parameter table, which is what gets saved and
re-forecast (K6, F5); forecasting is a recursion over that row alone.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence
from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from incidentlab.operators.likelihood import (
    centred,
    difference,
    kpss,
    let,
    maximise,
    mean,
    minus_two_log_likelihood,
    seasonal_strength,
    total,
)

# The orders of the automatic search; season length 12.
AUTO_P = (0, 1, 2)
AUTO_Q = (0, 1)
AUTO_D = (0, 1)
AUTO_SEASONAL = (0, 1)
SEASON = 12
# 5 % point of the KPSS test, seasonal strength that asks for a difference.
KPSS_LEVEL = 0.463
STRENGTH = 0.64

SPARE = 5  # months a fit needs beyond its unknowns

ORDER = ["p", "d", "q", "seasonal_p", "seasonal_d", "seasonal_q"]


def _keys(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def _collected(series: DataFrame, ks: list[str], month: str, value: str) -> DataFrame:
    """One row per key: its months and values in order."""
    rows = F.array_sort(F.collect_list(F.struct(F.col(month).alias("t"), F.col(value).cast("double").alias("y"))))
    rows = F.filter(rows, lambda r: r["y"].isNotNull())
    held = series.groupBy(*ks).agg(rows.alias("_rows"))
    return held.select(*ks, F.col("_rows.t").alias("_months"), F.col("_rows.y").alias("_y"))


def _differenced(y: Column, d: Column, seasonal_d: Column, max_d: int, m: int) -> Column:
    w = F.when(seasonal_d == 1, difference(y, F.lit(m))).otherwise(y)
    for k in range(max_d):
        w = let(w, lambda x, k=k: F.when(d > k, difference(x, F.lit(1))).otherwise(x))
    return w


def _fit(
    w: Column, p: Column, q: Column, seasonal_p: Column, seasonal_q: Column, unknowns: Column, m: int, first: Column, bic: bool = False
) -> Column:
    """The fit of one order to the array w: the ``rank`` it is chosen by and
    ``aic`` (null without a month), ``size`` and the order, then ``x, e`` of the
    maximum."""
    wanted = F.array(
        F.when(p >= 1, F.lit(0)), F.when(p >= 2, F.lit(1)), F.when(q >= 1, F.lit(2)),
        F.when(seasonal_p >= 1, F.lit(3)), F.when(seasonal_q >= 1, F.lit(4)),
    )
    n = F.size(w) - first
    size = p + q + seasonal_p + seasonal_q
    active = F.when(n >= size + SPARE, F.array_compact(wanted)).otherwise(F.array().cast("array<int>"))

    def described(s: Column) -> Column:
        fitted = minus_two_log_likelihood(s["e"]["objective"], n)
        aic = F.when(n > 0, fitted + 2 * (size + unknowns))
        rank = F.when(n > 0, fitted + F.log(n) * (size + unknowns)) if bic else aic
        return F.struct(
            aic.isNull().alias("none"), rank.alias("rank"), size.alias("size"),
            p.alias("p"), q.alias("q"), seasonal_p.alias("seasonal_p"), seasonal_q.alias("seasonal_q"),
            aic.alias("aic"), s["x"].alias("x"), s["e"].alias("e"),
        )

    return let(maximise(w, active, F.lit(m), first), described)


def _parameters(rows: DataFrame, ks: list[str], m: int) -> DataFrame:
    """The parameter table of rows with ``_months, _y, _mean, d, seasonal_d`` and
    the chosen fit ``_fit``."""
    fit, e = F.col("_fit"), F.col("_fit.e")

    def tanh(i: int) -> Column:
        return F.tanh(F.get(fit["x"], F.lit(i)))

    r2 = tanh(1)
    phi = F.array(tanh(0) * (1 - r2), r2)
    n = F.size(e["v"])
    first_month = F.size("_months") - n
    resid = F.zip_with(
        F.slice("_months", first_month + 1, n), e["v"], lambda t, v: F.struct(t.alias("month"), v.alias("resid"))
    )
    # What is known of the last shocks; the last one still has a variance.
    f_last = F.coalesce(F.get(e["f"], n - 1), F.lit(1.0))
    kept = F.least(n, 1 + m * fit["seasonal_q"])
    shocks = F.slice(e["v"], n - kept + 1, kept)
    shocks = F.transform(shocks, lambda v, i: F.when(i == kept - 1, v / f_last).otherwise(v))
    keep = F.least(F.size("_y"), 2 + F.col("d") + m * (F.col("seasonal_d") + fit["seasonal_p"]))
    return rows.select(
        *ks,
        fit["p"].alias("p"), "d", fit["q"].alias("q"),
        fit["seasonal_p"].alias("seasonal_p"), "seasonal_d", fit["seasonal_q"].alias("seasonal_q"),
        F.lit(m).alias("m"),
        F.slice(phi, F.lit(1), fit["p"]).alias("phi"),
        F.slice(F.array(tanh(2)), F.lit(1), fit["q"]).alias("theta"),
        F.slice(F.array(tanh(3)), F.lit(1), fit["seasonal_p"]).alias("seasonal_phi"),
        F.slice(F.array(tanh(4)), F.lit(1), fit["seasonal_q"]).alias("seasonal_theta"),
        F.col("_mean").alias("mean"),
        e["sigma2"].alias("sigma2"),
        F.when(n > 0, -0.5 * minus_two_log_likelihood(e["objective"], n)).alias("loglik"),
        fit["aic"].alias("aic"),
        n.cast("long").alias("nobs"),
        F.slice("_y", F.size("_y") - keep + 1, keep).alias("last_values"),
        F.when(kept > 0, shocks).otherwise(F.array(F.lit(0.0))).alias("last_shocks"),
        (e["sigma2"] * tanh(2) * tanh(2) * (1 - 1 / f_last)).alias("shock_var"),
        F.get("_months", F.lit(0)).alias("first_month"),
        F.get("_months", F.size("_months") - 1).alias("last_month"),
        resid.alias("resid"),
    )


def _check(p: int, d: int, q: int, *seasonal: int) -> None:
    if not (p in (0, 1, 2) and q in (0, 1) and d >= 0 and all(s in (0, 1) for s in seasonal)):
        raise ValueError("orders need p <= 2, q <= 1 and seasonal orders <= 1")


def _centred_rows(rows: DataFrame, max_d: int, m: int) -> DataFrame:
    """Adds the differenced, centred array ``_w`` and the mean taken off (0
    where the series is differenced)."""
    rows = rows.withColumn("_w", _differenced(F.col("_y"), F.col("d"), F.col("seasonal_d"), max_d, m))
    plain = (F.col("d") + F.col("seasonal_d")) == 0
    rows = rows.withColumn("_mean", F.when(plain, mean(F.col("_w"))).otherwise(0.0))
    return rows.withColumn("_w", F.when(plain, centred(F.col("_w"))).otherwise(F.col("_w")))


def _unknowns() -> Column:
    """The variance, and the mean of a series that is not differenced."""
    return F.when(F.col("d") + F.col("seasonal_d") == 0, 2).otherwise(1)


def fit_arima(
    series: DataFrame,
    keys: str | Sequence[str],
    month: str = "month",
    value: str = "n",
    order: tuple[int, int, int] = (1, 1, 1),
    seasonal_d: int = 0,
    m: int = SEASON,
    seasonal_p: int = 0,
    seasonal_q: int = 0,
) -> DataFrame:
    """one maximum-likelihood model per key; the parameter table (K6)."""
    ks = _keys(keys)
    p, d, q = order
    _check(p, d, q, seasonal_p, seasonal_d, seasonal_q)
    rows = _collected(series, ks, month, value).withColumns({"d": F.lit(d), "seasonal_d": F.lit(seasonal_d)})
    rows = _centred_rows(rows, d, m)
    fit = _fit(F.col("_w"), F.lit(p), F.lit(q), F.lit(seasonal_p), F.lit(seasonal_q), _unknowns(), m, F.lit(0))
    return _parameters(rows.withColumn("_fit", fit), ks, m)


def auto_arima(
    series: DataFrame,
    keys: str | Sequence[str],
    month: str = "month",
    value: str = "n",
    p_values: Sequence[int] = AUTO_P,
    q_values: Sequence[int] = AUTO_Q,
    d_values: Sequence[int] = AUTO_D,
    seasonal_d_values: Sequence[int] = AUTO_SEASONAL,
    m: int = SEASON,
    seasonal_p_values: Sequence[int] = AUTO_SEASONAL,
    seasonal_q_values: Sequence[int] = AUTO_SEASONAL,
    criterion: str = "aic",
) -> DataFrame:
    """an order per key.

    D is the larger of its values where the season is strong, d the smallest of
    its values after which the KPSS test accepts a constant level (the largest, if
    none).  Then by lowest AIC (or ``criterion="bic"``), ties to the simplest: p and q without seasonal
    terms; P and Q for these; p and q again where seasonal terms were taken.  Seasonal
    terms are tried on series of more than three seasons after differencing;
    all orders of such a series are scored without its first season."""
    ks = _keys(keys)
    if criterion not in ("aic", "bic"):
        raise ValueError("criterion must be 'aic' or 'bic'")
    _check(max(p_values), max(d_values), max(q_values), max(seasonal_p_values), max(seasonal_d_values), max(seasonal_q_values))
    rows = _collected(series, ks, month, value)
    low, high = min(seasonal_d_values), max(seasonal_d_values)
    strong = (seasonal_strength(F.col("_y"), m) > STRENGTH) & (F.size("_y") > 2 * m + SPARE)
    rows = rows.withColumn("seasonal_d", F.when(strong, F.lit(high)).otherwise(F.lit(low)) if high > low else F.lit(low))
    ds = sorted(d_values)
    d = F.lit(ds[-1])
    for k in reversed(ds[:-1]):
        level = _differenced(F.col("_y"), F.lit(k), F.col("seasonal_d"), k, m)
        d = F.when(let(level, kpss) <= KPSS_LEVEL, F.lit(k)).otherwise(d)
    rows = _centred_rows(rows.withColumn("d", d), ds[-1], m)
    seasonal = F.size("_w") > 3 * m
    if max(seasonal_p_values) == max(seasonal_q_values) == 0:
        seasonal = F.lit(False)
    rows = rows.withColumn("_seasonal", seasonal).withColumn("_first", F.when(F.col("_seasonal"), F.lit(m)).otherwise(F.lit(0)))

    orders = F.array(
        *(
            F.struct(*(F.lit(v).alias(n) for n, v in zip(("p", "q", "seasonal_p", "seasonal_q"), o)))
            for o in itertools.product(p_values, q_values, seasonal_p_values, seasonal_q_values)
        )
    )

    def to_try(best: Column, k: Column) -> Column:
        """Orders of the k-th search, given the best of those before."""

        def wanted(o: Column) -> Column:
            seasonal, best_seasonal = o["seasonal_p"] + o["seasonal_q"] > 0, best["seasonal_p"] + best["seasonal_q"] > 0
            same = (o["p"] == best["p"]) & (o["q"] == best["q"])
            same_season = (o["seasonal_p"] == best["seasonal_p"]) & (o["seasonal_q"] == best["seasonal_q"])
            return (
                F.when(k == 0, ~seasonal)
                .when(k == 1, F.col("_seasonal") & seasonal & same)
                .otherwise(best_seasonal & same_season & ~same)
            )

        return F.filter(orders, wanted)

    def fitted(o: Column) -> Column:
        parts = (o[n] for n in ("p", "q", "seasonal_p", "seasonal_q"))
        return _fit(F.col("_w"), *parts, _unknowns(), m, F.col("_first"), criterion == "bic")

    none, zero = F.lit(None).cast("double"), F.lit(0)
    empty = F.array().cast("array<double>")
    fit = F.struct(empty.alias("v"), empty.alias("f"), none.alias("sigma2"), none.alias("objective"), empty.alias("scaled"))
    nothing = F.struct(  # sorts behind every fit
        F.lit(True).alias("none"), none.alias("rank"), F.lit(99).alias("size"), zero.alias("p"), zero.alias("q"),
        zero.alias("seasonal_p"), zero.alias("seasonal_q"), none.alias("aic"), empty.alias("x"), fit.alias("e"),
    )
    search = F.aggregate(
        F.sequence(F.lit(0), F.lit(2)),
        nothing,
        lambda best, k: F.array_min(F.array_append(F.transform(to_try(best, k), fitted), best)),
    )
    return _parameters(rows.withColumn("_fit", search), ks, m)


def _recursion(coefs: Column, start: Column, bumps: Column, constant: Column, steps: int) -> Column:
    """``start`` continued by x_k = constant + sum_j coefs_j x_{k-j} + bumps_k,
    ``steps`` times; the new values."""

    def step(acc: Column, k: Column) -> Column:
        recent = F.reverse(F.slice(acc, -F.size(coefs), F.size(coefs)))
        added = total(F.zip_with(coefs, recent, lambda a, x: a * x))
        return F.array_append(acc, constant + added + F.coalesce(F.get(bumps, k - 1), F.lit(0.0)))

    return F.slice(F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, step), -steps, steps)


def forecast_from_params(
    params: DataFrame,
    keys: str | Sequence[str],
    horizon: int = 6,
    level: float = 0.95,
    month: str = "month",
) -> DataFrame:
    """``horizon`` months ahead per model row, with standard error and
    a normal ``level`` band.  A projection of the parameter rows: no shuffle.

    ``shock_var`` is the variance left about the moving-average part of the
    last shock; it adds to the band through the autoregressive recursion."""
    ks = _keys(keys)
    zero, none = F.array(F.lit(0.0)), F.lit(0.0)
    m0 = F.array_repeat(F.lit(0.0), F.col("m"))
    big_phi = F.coalesce(F.get("seasonal_phi", F.lit(0)), none)
    theta = F.coalesce(F.get("theta", F.lit(0)), none)
    big_theta = F.coalesce(F.get("seasonal_theta", F.lit(0)), none)

    def less(a: Column, b: Column, k: Column) -> Column:
        return F.zip_with(a, b, lambda x, y: x - k * y)

    # phi(B) Phi(B^m) (1 - B)^d (1 - B^m)^D as coefficients; one more zero keeps it longer than 1.
    poly = F.concat(F.array(F.lit(1.0)), F.transform("phi", lambda x: -x), zero)
    differences = F.when(F.col("d") > 0, F.sequence(F.lit(1), F.col("d"))).otherwise(F.array().cast("array<int>"))
    poly = F.aggregate(differences, poly, lambda p, _: less(F.concat(p, zero), F.concat(zero, p), F.lit(1.0)))
    rows = params.withColumn("_poly", poly)
    for used, k in ((F.col("seasonal_d") == 1, F.lit(1.0)), (F.size("seasonal_phi") > 0, big_phi)):
        longer = less(F.concat("_poly", m0), F.concat(m0, "_poly"), k)
        rows = rows.withColumn("_poly", F.when(used, longer).otherwise(F.col("_poly")))
    rows = rows.withColumn("_a", F.transform(F.slice("_poly", F.lit(2), F.size("_poly") - 1), lambda x: -x))
    # theta(B) Theta(B^m), and what the last shocks and the error about the last one add.
    short = F.array(F.lit(1.0), theta)
    rows = rows.withColumn("_ma", less(F.concat(short, m0), F.concat(m0, short), -big_theta))
    steps_ahead = F.sequence(F.lit(1), F.lit(horizon))

    def from_shocks(k: Column) -> Column:
        later = F.slice("_ma", k + 1, F.greatest(F.size("_ma") - k, F.lit(0)))
        return F.when(
            F.size(later) > 0,
            total(F.transform(later, lambda c, i: c * F.coalesce(F.get("last_shocks", F.size("last_shocks") - 1 - i), none))),
        ).otherwise(none)

    n = F.size("_a")
    missing = F.greatest(n - F.size("last_values"), F.lit(0))
    padded = F.concat(F.array_repeat(F.element_at("last_values", 1), missing), "last_values")
    constant = F.col("mean") * (1 - total(F.col("phi"))) * (1 - big_phi)
    rows = rows.withColumns(
        {
            "_start": padded,
            "_c": constant,
            "_zeros": F.array_repeat(none, n),
            "_shocks": F.transform(steps_ahead, from_shocks),
            "_error": F.concat(F.array(F.lit(1.0)), F.slice(m0, F.lit(2), F.col("m") - 1), F.array(big_theta)),
        }
    )
    rows = rows.withColumns(
        {
            "_mean": _recursion(F.col("_a"), F.col("_start"), F.col("_shocks"), F.col("_c"), horizon),
            "_psi": _recursion(F.col("_a"), F.col("_zeros"), F.col("_ma"), none, horizon),
            "_chi": _recursion(F.col("_a"), F.col("_zeros"), F.col("_error"), none, horizon),
        }
    )

    def at_step(k: Column) -> Column:
        psi = total(F.transform(F.slice("_psi", F.lit(1), k), lambda x: x * x))
        chi = F.element_at("_chi", k)
        se = F.sqrt(F.col("sigma2") * psi + F.col("shock_var") * chi * chi)
        return F.struct(k.alias("step"), F.element_at("_mean", k).alias("mean"), se.alias("mean_se"))

    steps = F.transform(F.sequence(F.lit(1), F.lit(horizon)), at_step)
    z = NormalDist().inv_cdf(0.5 + level / 2)
    return rows.select(*ks, "last_month", F.inline(steps)).select(
        *ks,
        "step",
        F.add_months("last_month", F.col("step")).alias(month),
        "mean",
        "mean_se",
        (F.col("mean") - z * F.col("mean_se")).alias("lower"),
        (F.col("mean") + z * F.col("mean_se")).alias("upper"),
    )


def arima_forecast(
    series: DataFrame,
    keys: str | Sequence[str],
    month: str = "month",
    value: str = "n",
    order: tuple[int, int, int] = (1, 1, 1),
    horizon: int = 6,
    level: float = 0.95,
) -> DataFrame:
    """F1 + F2."""
    return forecast_from_params(fit_arima(series, keys, month, value, order), keys, horizon, level, month)


def forecast_by_key(
    series: DataFrame,
    keys: str | Sequence[str],
    month: str = "month",
    value: str = "n",
    horizon: int = 6,
    level: float = 0.95,
) -> DataFrame:
    """automatic order per key, then ``(key, date, forecast, lower, upper)``."""
    ks = _keys(keys)
    fc = forecast_from_params(auto_arima(series, ks, month, value), ks, horizon, level, month)
    return fc.select(*ks, F.col(month).alias("date"), F.col("mean").alias("forecast"), "lower", "upper")


def residuals(params: DataFrame, keys: str | Sequence[str], month: str = "month") -> DataFrame:
    """Residuals of each fitted model, by month (input to F7)."""
    ks = _keys(keys)
    return params.select(*ks, F.inline("resid")).select(*ks, F.col("month").alias(month), "resid")


def union_forecasts(*frames: DataFrame) -> DataFrame:
    """Stack result frames by column name."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
