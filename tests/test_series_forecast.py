import datetime as dt
from statistics import NormalDist

import numpy as np
import pytest
from pyspark.sql import functions as F

from incidentlab.operators import forecast, likelihood, series
from incidentlab.plans import catalog

# Published 6-step forecast (mean, standard error) and the model
# quantities that reproduce it: phi, theta, sigma2 and u, the variance left
# about the last shock (theta^2 * Var(eps_n | data)).
PUBLISHED_MEAN = [254877.0277330444, 255302.50722662453, 254908.07642439328,
                  255273.72426429202, 254934.75899569152, 255248.98881132292]
PUBLISHED_SE = [15674.375649278201, 22786.776390581792, 27693.1532166273,
                32226.294189280175, 35887.62163399404, 39470.15227363677]
PHI, THETA, SIGMA2, U = -0.9270265857, 0.9964825, 242202696.825, 3483355.1697
Z95 = 1.959964


def _params(spark, shock_var):
    """The published model's parameter row: the level and the last shock that
    its first two means imply."""
    level = PUBLISHED_MEAN[0] - (PUBLISHED_MEAN[1] - PUBLISHED_MEAN[0]) / PHI
    row = ("k", 1, 1, 1, 0, 12, [PHI], [THETA], [], [], 0.0, SIGMA2, [level] * 3, [(PUBLISHED_MEAN[0] - level) / THETA],
           shock_var, dt.date(2023, 11, 1))
    return spark.createDataFrame(
        [row],
        "key string, p int, d int, q int, seasonal_d int, m int, phi array<double>, theta array<double>, "
        "seasonal_phi array<double>, seasonal_theta array<double>, mean double, "
        "sigma2 double, last_values array<double>, last_shocks array<double>, shock_var double, last_month date",
    )


def test_golden_forecast_recursion_and_band(spark):
    rows = forecast.forecast_from_params(_params(spark, U), "key", 6).orderBy("step").collect()
    np.testing.assert_allclose([r["mean"] for r in rows], PUBLISHED_MEAN, rtol=1e-8)
    np.testing.assert_allclose([r["mean_se"] for r in rows], PUBLISHED_SE, rtol=1e-8)
    np.testing.assert_allclose([(r["upper"] - r["mean"]) / r["mean_se"] for r in rows], Z95, atol=1e-6)
    assert rows[0]["month"] == dt.date(2023, 12, 1)
    # Without the variance of the last shock the standard errors cannot match.
    plain = forecast.forecast_from_params(_params(spark, 0.0), "key", 6).orderBy("step").first()
    assert abs(plain["mean_se"] - PUBLISHED_SE[0]) / PUBLISHED_SE[0] > 1e-3


def _simulate(phi, theta, n, seed):
    rng = np.random.default_rng(seed)
    e = rng.normal(0, 1, n + 1)
    w = np.zeros(n)
    for t in range(n):
        w[t] = phi * (w[t - 1] if t else 0.0) + e[t + 1] + theta * e[t]
    return np.cumsum(w) + 50


def _series_df(spark, values, key="k", start=(2020, 1)):
    y0, m0 = start
    rows = []
    for i, v in enumerate(values):
        mm = m0 - 1 + i
        rows.append((key, dt.date(y0 + mm // 12, mm % 12 + 1, 1), int(v)))
    return spark.createDataFrame(rows, "key string, month date, n bigint")


def test_gapfill_missing_month(spark):
    df = spark.createDataFrame(
        [("a", dt.date(2024, 1, 1), 3), ("a", dt.date(2024, 4, 1), 5), ("b", dt.date(2024, 2, 1), 1)],
        "key string, month date, n bigint",
    )
    out = sorted(tuple(r) for r in series.gapfill(df, "key").collect())
    assert out == [
        ("a", dt.date(2024, 1, 1), 3), ("a", dt.date(2024, 2, 1), 0), ("a", dt.date(2024, 3, 1), 0),
        ("a", dt.date(2024, 4, 1), 5), ("b", dt.date(2024, 2, 1), 1),
    ]
    kept_null = series.gapfill(df, "key", fill=None).filter(F.col("n").isNull()).count()
    assert kept_null == 2


def test_holdout_and_future(spark):
    df = _series_df(spark, range(10))
    flags = [r["is_test"] for r in series.holdout_split(df, "key").orderBy("month").collect()]
    assert flags == [False] * 4 + [True] * 6
    fut = series.future_months(df, "key", horizon=3).orderBy("step").collect()
    assert [(r["step"], r["month"]) for r in fut] == [(1, dt.date(2020, 11, 1)), (2, dt.date(2020, 12, 1)), (3, dt.date(2021, 1, 1))]


def test_autocorrelation_matches_numpy(spark):
    vals = np.array([5, 7, 3, 8, 9, 4, 6, 10, 2, 7, 8, 5], dtype=float)
    df = _series_df(spark, vals)
    got = {r["lag"]: r["acf"] for r in series.autocorrelation(df, "key", "month", "n", max_lag=3, scale=None).collect()}
    c = vals - vals.mean()
    for k in (1, 2, 3):
        assert got[k] == pytest.approx(np.sum(c[k:] * c[:-k]) / np.sum(c * c), rel=1e-12)


def test_metrics(spark):
    df = spark.createDataFrame([("k", 10.0, 12.0), ("k", 5.0, 4.0), ("k", None, 1.0)], "key string, y double, p double")
    r = series.forecast_metrics(df, "key", "y", "p", scale=None).collect()[0]
    assert r["rmse"] == pytest.approx(np.sqrt((4 + 1) / 2)) and r["mae"] == pytest.approx(1.5)


def _two_regressions(w):
    """AR(1) and MA(1) coefficients of w by two regressions (long AR, then lag and shock), kept inside the stable region."""
    x = np.column_stack([w[3 - k : len(w) - k] for k in (1, 2, 3)])
    e = np.r_[[0.0] * 3, w[3:] - x @ np.linalg.lstsq(x, w[3:], rcond=None)[0]]
    phi, theta = np.linalg.lstsq(np.column_stack([w[3:-1], e[3:-1]]), w[4:], rcond=None)[0]
    return float(np.clip(phi, -0.99, 0.99)), float(np.clip(theta, -0.99, 0.99))


def _log_likelihood(w, phi, theta):
    """Gaussian log likelihood, variance concentrated out, from the dense
    covariance matrix of the stationary ARMA process (long MA weights)."""
    phi, theta = list(phi), list(theta)
    psi = [1.0]
    for j in range(1, 4000):
        psi.append((theta[j - 1] if j <= len(theta) else 0.0) + sum(p * psi[j - i - 1] for i, p in enumerate(phi) if j - i - 1 >= 0))
    psi = np.array(psi)
    n = len(w)
    gamma = np.array([psi[: len(psi) - k] @ psi[k:] for k in range(n)])
    cov = gamma[np.abs(np.subtract.outer(np.arange(n), np.arange(n)))]
    sigma2 = w @ np.linalg.solve(cov, w) / n
    return -0.5 * (n * (np.log(2 * np.pi * sigma2) + 1) + np.linalg.slogdet(cov)[1]), sigma2


@pytest.mark.parametrize("p,d,q", [(1, 1, 1), (2, 1, 1), (2, 0, 0), (0, 1, 1), (1, 0, 1), (0, 2, 1)])
def test_likelihood_is_exact_and_maximal(spark, p, d, q):
    y = [int(v) for v in _simulate(0.5, 0.3, 70, 7) * 10]
    got = forecast.fit_arima(_series_df(spark, y), "key", order=(p, d, q)).first()
    w = np.diff(np.asarray(y, float), d)
    w = w - (w.mean() if d == 0 else 0.0)
    value, sigma2 = _log_likelihood(w, got["phi"], got["theta"])
    assert got["loglik"] == pytest.approx(value, rel=1e-9) and got["sigma2"] == pytest.approx(sigma2, rel=1e-8)
    for i in range(p + q):  # no better point beside it
        for step in (-1e-3, 1e-3):
            other = [*got["phi"], *got["theta"]]
            other[i] += step
            assert _log_likelihood(w, other[:p], other[p:])[0] < value + 1e-9


def test_likelihood_never_below_two_regressions(spark):
    df, series_of = None, {}
    for i in range(12):
        phi, theta = [(0.6, 0.3), (-0.7, 0.4), (0.9, -0.5), (0.2, 0.9), (-0.93, 0.99), (0.0, 0.0)][i % 6]
        series_of[f"s{i}"] = [int(v) for v in _simulate(phi, theta, 60, 50 + i) * 100]
        part = _series_df(spark, series_of[f"s{i}"], f"s{i}")
        df = part if df is None else df.unionByName(part)
    rows = forecast.fit_arima(df, "key").collect()
    assert len(rows) == 12
    for r in rows:
        w = np.diff(np.asarray(series_of[r["key"]], float))
        phi, theta = _two_regressions(w)
        assert r["loglik"] >= _log_likelihood(w, [phi], [theta])[0] - 1e-9


def test_fit_recovers_simulated_arma(spark):
    """Eight series of 400 months: every estimate within three standard errors
    of an ARMA(1, 1) fit (0.07 each), their means within 0.05."""
    df = None
    for i in range(8):
        part = _series_df(spark, _simulate(0.6, 0.3, 400, i) * 1000, f"s{i}", start=(1980, 1))
        df = part if df is None else df.unionByName(part)
    rows = forecast.fit_arima(df, "key").collect()
    for got, true in (([r["phi"][0] for r in rows], 0.6), ([r["theta"][0] for r in rows], 0.3)):
        assert len(got) == 8 and max(abs(g - true) for g in got) < 0.21
        assert np.mean(got) == pytest.approx(true, abs=0.05)
    assert all(r["sigma2"] == pytest.approx(1e6, rel=0.2) for r in rows)


def test_no_key_vanishes(spark):
    """Null, one-month, three-month, constant and long keys all keep a model."""
    long_s = _series_df(spark, _simulate(0.5, 0.2, 40, 6) * 10, "long")
    df = long_s
    for key, values in ((None, range(30)), ("one", [5]), ("three", [3, 5, 4]), ("flat", [7] * 30), ("short", [12, 15, 11, 14, 16, 13, 15, 17])):
        df = df.unionByName(_series_df(spark, values, key))
    keys = {"long", None, "one", "three", "flat", "short"}
    for params in (forecast.fit_arima(df, "key"), forecast.auto_arima(df, "key")):
        assert {r["key"] for r in params.collect()} == keys and params.count() == 6
    fc = forecast.forecast_by_key(df, "key", horizon=3).collect()
    assert len(fc) == 18 and {r["key"] for r in fc} == keys
    assert all(r["forecast"] is not None and r["lower"] is not None for r in fc)
    one = forecast.arima_forecast(df.filter("key = 'one'"), "key", horizon=2).collect()
    assert [(r["mean"], r["mean_se"]) for r in one] == [(5.0, 0.0)] * 2
    flat = forecast.arima_forecast(df.filter("key = 'flat'"), "key", horizon=2).collect()
    assert [(r["mean"], r["mean_se"]) for r in flat] == [(7.0, 0.0)] * 2
    short = {r["key"]: r for r in forecast.auto_arima(df, "key").collect()}["short"]
    assert short["seasonal_d"] == 0


def test_forecast_equals_plain_recursion(spark):
    y = [int(v) for v in _simulate(0.4, 0.2, 60, 8) * 10]
    got = forecast.fit_arima(_series_df(spark, y), "key", order=(2, 1, 1), seasonal_d=1)
    r = got.first()
    means = [x["mean"] for x in forecast.forecast_from_params(got, "key", 14).orderBy("step").collect()]
    w = np.diff(np.asarray(y[12:], float) - np.asarray(y[:-12], float))
    w, out, hist = list(w), [], list(map(float, y))
    for h in range(14):
        nxt = r["phi"][0] * w[-1] + r["phi"][1] * w[-2] + (r["theta"][0] * r["last_shocks"][-1] if h == 0 else 0.0)
        w.append(nxt)
        value = nxt + hist[-1] + hist[-12] - hist[-13]
        hist.append(value)
        out.append(value)
    np.testing.assert_allclose(means, out, rtol=1e-9)


def test_auto_arima_picks_one_order_per_key(spark):
    a = _simulate(0.7, 0.0, 48, 4) * 10
    df = _series_df(spark, a, "a")
    best = forecast.auto_arima(df, "key", p_values=(0, 1), q_values=(0, 1), d_values=(1,), seasonal_d_values=(0,))
    rows = best.collect()
    assert len(rows) == 1 and rows[0]["d"] == 1
    out = forecast.forecast_by_key(df, "key", horizon=2)
    assert out.columns == ["key", "date", "forecast", "lower", "upper"] and out.count() == 2


def test_seasonal_forecast_equals_plain_recursion(spark):
    """Seasonal AR and MA terms: u and w carried forward by hand."""
    y = [int(v) for v in 100 + 20 * np.sin(np.arange(72) * np.pi / 6) + _simulate(0.3, 0.2, 72, 3)]
    got = forecast.fit_arima(_series_df(spark, y), "key", order=(1, 1, 1), seasonal_p=1, seasonal_q=1)
    r = got.first()
    phi, theta, big_phi, big_theta = r["phi"][0], r["theta"][0], r["seasonal_phi"][0], r["seasonal_theta"][0]
    w = list(np.diff(np.asarray(y, float)))
    u = []
    for t, x in enumerate(w):
        u.append(x - (big_phi * w[t - 12] + big_theta * u[t - 12] if t >= 12 else 0.0))
    assert [x["resid"] for x in r["resid"]][0] == pytest.approx(u[0])
    level, out = float(y[-1]), []
    for h in range(15):
        u.append(phi * u[-1] + (theta * r["last_shocks"][-1] if h == 0 else 0.0))
        w.append(u[-1] + big_phi * w[-12] + big_theta * u[-13])
        level += w[-1]
        out.append(level)
    means = [x["mean"] for x in forecast.forecast_from_params(got, "key", 15).orderBy("step").collect()]
    # Shocks of the last season are known to their innovations only.
    np.testing.assert_allclose(means, out, rtol=1e-3)


def _seasonal_series(n, seed, phi=0.0, theta=0.0, big_phi=0.0, big_theta=0.0, d=0, seasonal_d=0, scale=100.0):
    rng = np.random.default_rng(seed)
    e = rng.normal(0, 1, n + 200)
    u, w = np.zeros(n + 200), np.zeros(n + 200)
    for t in range(13, n + 200):
        u[t] = phi * u[t - 1] + e[t] + theta * e[t - 1]
        w[t] = big_phi * w[t - 12] + u[t] + big_theta * u[t - 12]
    y = w[200:] * scale
    if seasonal_d:
        y = np.r_[400 * np.sin(np.arange(12) * np.pi / 6), y]
        for t in range(12, len(y)):
            y[t] += y[t - 12]
    for _ in range(d):
        y = np.cumsum(y)
    return y + 5000


def test_auto_arima_recovers_planted_orders(spark):
    planted = {
        "ar1": ((1, 0, 0, 0, 0, 0), dict(phi=0.7)),
        "ma1": ((0, 1, 1, 0, 0, 0), dict(theta=0.6, d=1)),
        "ar2": ((1, 1, 0, 0, 0, 0), dict(phi=0.6, d=1)),
        "sar": ((0, 0, 0, 1, 0, 0), dict(big_phi=0.7)),
        "sar_ar": ((1, 0, 0, 1, 0, 0), dict(phi=0.5, big_phi=0.5)),
        "sma": ((0, 0, 0, 0, 1, 1), dict(big_theta=-0.6, seasonal_d=1)),
    }
    df = None
    for i, (key, (_, options)) in enumerate(planted.items()):
        part = _series_df(spark, _seasonal_series(240, 11 + i, **options), key, start=(1990, 1))
        df = part if df is None else df.unionByName(part)
    names = ("p", "d", "q", "seasonal_p", "seasonal_d", "seasonal_q")
    got = {r["key"]: tuple(r[n] for n in names) for r in forecast.auto_arima(df, "key", criterion="bic").collect()}
    assert {k: got[k] for k in planted} == {k: o for k, (o, _) in planted.items()}


def test_kpss_and_strength_by_hand(spark):
    y = _simulate(0.2, 0.0, 60, 9)
    e = y - y.mean()
    lags = int(3 * np.sqrt(60) / 13)
    s2 = e @ e / 60 + 2 * sum((1 - k / (lags + 1)) * (e[k:] @ e[:-k]) / 60 for k in range(1, lags + 1))
    want = float(np.sum(np.cumsum(e) ** 2) / 3600 / s2)
    season = 10 * np.sin(np.arange(60) * np.pi / 6) + y
    trend = np.array([(season[t - 6 : t + 6].mean() + season[t - 5 : t + 7].mean()) / 2 for t in range(6, 54)])
    x = season[6:54] - trend
    rest = x - np.array([x[i % 12 :: 12].mean() for i in range(48)])
    df = spark.createDataFrame([([float(v) for v in y], [float(v) for v in season])], "y array<double>, s array<double>")
    got = df.select(likelihood.kpss(F.col("y")), likelihood.seasonal_strength(F.col("s"), 12), likelihood.kpss(F.array(F.lit(3.0), F.lit(3.0), F.lit(3.0)))).first()
    assert got[0] == pytest.approx(want, rel=1e-9) and got[1] == pytest.approx(1 - rest.var() / x.var(), rel=1e-9) and got[2] == 0.0


def test_series_are_collected_once(spark):
    """No copy of a series per order: one exchange of the input, no generator."""
    df = _series_df(spark, range(60))
    plan = forecast.auto_arima(df, "key")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Generate" not in plan and "Expand" not in plan


def test_orders_outside_the_family_are_refused(spark):
    for order in ((3, 0, 0), (0, 0, 2)):
        with pytest.raises(ValueError):
            forecast.fit_arima(_series_df(spark, [1, 2, 3]), "key", order=order)


def test_residuals_align_with_months(spark):
    vals = _simulate(0.4, 0.1, 30, 5) * 10
    params = forecast.fit_arima(_series_df(spark, vals), "key")
    res = forecast.residuals(params, "key").orderBy("month").collect()
    # One month goes to the difference.
    assert len(res) == 29 and res[0]["month"] == dt.date(2020, 2, 1)
    table = series.standardized_residuals(forecast.residuals(params, "key"), "key", "month", "resid")
    assert table.filter((F.col("bucket") < 0) | (F.col("bucket") > 9)).count() == 0
    z = sorted(r["theoretical_quantile"] for r in table.collect())
    assert z == pytest.approx([NormalDist().inv_cdf(i / 30) for i in range(1, 30)], abs=1e-6)


def test_density_and_acf_bands(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(5, 2, 80)
    df = spark.createDataFrame([("k", i, float(v)) for i, v in enumerate(x)], "key string, t int, v double")
    z, h = (x - x.mean()) / x.std(ddof=1), 80**-0.2
    rows = series.residual_density(df, "key", "v").orderBy("x").collect()
    want = [np.mean(np.exp(-(((g - z) / h) ** 2) / 2)) / h / np.sqrt(2 * np.pi) for g in np.linspace(-3.92, 3.92, 50)]
    np.testing.assert_allclose([r["density"] for r in rows], want, rtol=1e-9)
    acf = series.acf_diagnostics(df, "key", "t", "v", 4).orderBy("lag").collect()
    e = x - x.mean()
    r = np.array([e[k:] @ e[:-k] / (e @ e) for k in range(1, 5)])
    np.testing.assert_allclose([a["band"] for a in acf], 1.959963984540054 * np.sqrt((1 + 2 * np.r_[0, np.cumsum(r**2)[:-1]]) / 80), rtol=1e-9)
    np.testing.assert_allclose([a["ljung_box"] for a in acf], 80 * 82 * np.cumsum(r**2 / (80 - np.arange(1, 5))), rtol=1e-9)
    whole = series.acf_diagnostics(df, None, "t", "v", 4).orderBy("lag").collect()
    assert [a["p"] for a in whole] == pytest.approx([a["p"] for a in acf])


def test_fit_runs_no_python(spark):
    plan = forecast.forecast_by_key(_series_df(spark, range(30)), "key")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_complete_months(spark):
    def kept(*days):
        df = spark.createDataFrame([(dt.date(2024, m, d),) for m, d in days], "date date")
        return sorted({r["date"].month for r in series.complete_months(df).collect()})

    assert kept((1, 5), (2, 28), (3, 1)) == [1, 2]
    assert kept((1, 5), (2, 29)) == [1, 2]
    assert kept() == []


from hypothesis import given, settings
from hypothesis import strategies as st


@settings(max_examples=10, deadline=None)
@given(st.lists(st.integers(0, 40), min_size=1, max_size=12, unique=True))
def test_gapfill_row_count_property(spark, offsets):
    # A gap-filled series has exactly months_between(first, last) + 1 rows.
    rows = [("k", dt.date(2020 + o // 12, o % 12 + 1, 1), 1) for o in offsets]
    df = spark.createDataFrame(rows, "key string, month date, n bigint")
    out = series.gapfill(df, "key").collect()
    assert len(out) == max(offsets) - min(offsets) + 1
    assert sum(r["n"] for r in out) == len(offsets)


def test_actual_vs_forecast_full_join(spark):
    actual = spark.createDataFrame(
        [("k", dt.date(2024, 1, 1), 5), ("k", dt.date(2024, 2, 1), 7)], "key string, month date, n bigint"
    )
    fc = spark.createDataFrame(
        [("k", dt.date(2024, 2, 1), 6.0, 4.0, 8.0), ("k", dt.date(2024, 3, 1), 6.5, 3.0, 10.0)],
        "key string, month date, mean double, lower double, upper double",
    )
    rows = sorted(tuple(r) for r in series.actual_vs_forecast(actual, fc, "key").select(
        "month", "actual", "mean", "is_forecast", "forecast_start").collect())
    start = dt.date(2024, 2, 1)
    assert rows == [
        (dt.date(2024, 1, 1), 5, None, False, start),
        (dt.date(2024, 2, 1), 7, 6.0, True, start),
        (dt.date(2024, 3, 1), None, 6.5, True, start),
    ]


def test_null_key_series_meets_its_forecast(spark, monkeypatch):
    actual = spark.createDataFrame(
        [(None, dt.date(2024, 1, 1), 5), (None, dt.date(2024, 2, 1), 7), ("k", dt.date(2024, 2, 1), 8)],
        "key string, month date, n bigint",
    )
    fc = spark.createDataFrame(
        [(None, dt.date(2024, 2, 1), 6.0, 4.0, 8.0), ("k", dt.date(2024, 2, 1), 9.0, 8.0, 10.0)],
        "key string, month date, mean double, lower double, upper double",
    )
    both = series.actual_vs_forecast(actual, fc, "key")
    assert both.columns == ["key", "month", "actual", "mean", "lower", "upper", "is_forecast", "forecast_start"]
    assert {tuple(r)[:4] for r in both.collect()} == {
        (None, dt.date(2024, 1, 1), 5, None), (None, dt.date(2024, 2, 1), 7, 6.0), ("k", dt.date(2024, 2, 1), 8, 9.0)
    }
    months = [dt.date(2020 + m // 12, m % 12 + 1, 1) for m in range(36)]
    rows = [(k, m, 50 + 7 * (i % 5) + i) for k in (None, "k") for i, m in enumerate(months)]
    panel = spark.createDataFrame(rows, "key string, month date, n bigint")
    monkeypatch.setattr(catalog, "_priority_series", lambda *_: panel)
    got = {r["key"]: (r["rmse"], r["mae"]) for r in catalog.q_arima_holdout_metrics(spark, "").collect()}
    assert got.keys() == {None, "k"} and got[None] == got["k"]
