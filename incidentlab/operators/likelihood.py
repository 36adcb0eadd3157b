"""Exact Gaussian likelihood of ARMA models, and its maximum, as expressions
over a series held in one array column (F1, F3).

The model of a (differenced, centred) series w is

    w_t = Phi w_{t-m} + u_t + Theta u_{t-m},
    u_t = phi1 u_{t-1} + phi2 u_{t-2} + e_t + theta e_{t-1}.

u follows from w with the season before the first month taken as zero.  Its
likelihood is exact: the innovations recursion starts at the stationary
variances and runs as one ``aggregate`` over the array, with a state of the two
predicted values and their (co)variances.  With the innovations v and their
variances f (in units of sigma^2), the concentrated likelihood is maximal where

    objective = ln(mean(v^2 / f)) + mean(ln f)

is minimal, and that is the logarithm of the squared length of the scaled innovations
v / sqrt(f) * exp(mean(ln f) / 2), whose derivatives give its gradient and, at the
start, its Gauss-Newton curvature; later steps correct the curvature (BFGS).

The search works on five unbounded numbers x whose hyperbolic tangents are the
partial autocorrelations and the other coefficients, so every value is a
stationary and invertible model.  It starts at the best points of a grid over phi1
and theta in four regions, cut by phi1 = 0 and by phi1 + theta = 0 (where an
ARMA(1, 1) is white noise, a ridge between basins), and makes ROUNDS steps each; a
step that is not better is shortened.  The best end is the fit.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

PLACES = 5  # phi1, phi2, theta, Phi, Theta
START = (-2.3, -1.5, -0.85, -0.4, 0.0, 0.4, 0.85, 1.5, 2.3)
EDGE = 6.0  # |x| at most: coefficients stay below 0.99999
STEP = 1e-6  # for derivatives
ROUNDS = 30
SETTLED = 1e-7  # part of a step at which the search stands still
LEAST = 1e-12  # a variance counts as so much at least


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with ``value`` computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def total(xs: Column) -> Column:
    return F.aggregate(xs, F.lit(0.0), lambda s, x: s + x)


def dot(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: x * y))


def empty() -> Column:
    return F.array().cast("array<double>")


def coefficients(x: Column) -> list[Column]:
    """phi1, phi2, theta, Phi, Theta of a point of the search."""
    r1, r2, theta, big_phi, big_theta = (F.tanh(F.get(x, F.lit(i))) for i in range(PLACES))
    return [r1 * (1 - r2), r2, theta, big_phi, big_theta]


def without_season(w: Column, big_phi: Column, big_theta: Column, m: Column) -> Column:
    """u from w."""

    def step(s: Column, x: Column) -> Column:
        back = F.size(s["u"]) - m
        seen = s["P"] * F.coalesce(F.get(w, back), F.lit(0.0)) + s["Q"] * F.coalesce(F.get(s["u"], back), F.lit(0.0))
        return F.struct(F.array_append(s["u"], x - seen).alias("u"), s["P"].alias("P"), s["Q"].alias("Q"))

    start = F.struct(empty().alias("u"), big_phi.alias("P"), big_theta.alias("Q"))
    return F.when((big_phi == 0) & (big_theta == 0), w).otherwise(F.aggregate(w, start, step, lambda s: s["u"]))


def evaluate(w: Column, x: Column, m: Column, first: Column) -> Column:
    """At x, over the months of w from number ``first`` (0 for all) on: the
    innovations ``v`` and their variances ``f``, ``sigma2``, the ``objective``
    and the ``scaled`` innovations."""
    p1, p2, q, big_phi, big_theta = coefficients(x)
    u = without_season(w, big_phi, big_theta, m)
    u = F.slice(u, first + 1, F.greatest(F.size(w) - first, F.lit(0)))
    # Variance and first covariance of the stationary process.
    spread = (1 - p2 * p2) - p1 * p1 * (1 + p2) / (1 - p2)
    g0 = (p1 * (1 + p2) * q / (1 - p2) + 1 + q * q + q * p1) / spread
    g1 = (p1 * g0 + q) / (1 - p2)

    def state(**fields: Column) -> Column:
        return F.struct(*(c.alias(n) for n, c in fields.items()))

    def step(s: Column, x: Column) -> Column:
        v, f, gain = x - s["a1"], s["p11"], s["p12"] / s["p11"]
        return state(
            a1=s["p1"] * x + s["a2"] + gain * v, a2=s["p2"] * x,
            p11=s["p22"] - gain * s["p12"] + 1, p12=s["q"], p22=s["q"] * s["q"],
            p1=s["p1"], p2=s["p2"], q=s["q"],
            squares=s["squares"] + v * v / f, logs=s["logs"] + F.log(f),
            v=F.array_append(s["v"], v), f=F.array_append(s["f"], f),
        )

    def finish(s: Column) -> Column:
        n = F.greatest(F.size(s["v"]), F.lit(1))
        return state(
            v=s["v"], f=s["f"], sigma2=s["squares"] / n,
            objective=F.log(F.greatest(s["squares"] / n, F.lit(LEAST))) + s["logs"] / n,
            scaled=F.zip_with(s["v"], s["f"], lambda v, f: v / F.sqrt(f) * F.exp(s["logs"] / (2 * n))),
        )

    zero = F.lit(0.0)
    start = state(
        a1=zero, a2=zero, p11=g0, p12=p2 * g1 + q, p22=p2 * p2 * g0 + q * q,
        p1=p1, p2=p2, q=q, squares=zero, logs=zero, v=empty(), f=empty(),
    )
    return F.aggregate(u, start, step, finish)


def reduced(rows: Column) -> Column:
    """The right part of rows (A, B) after A, positive definite, is reduced to
    the identity: A^-1 B."""

    def eliminate(rows: Column, k: Column) -> Column:
        own = F.get(rows, k)
        pivot = F.transform(own, lambda v: v / F.get(own, k))
        return F.transform(
            rows, lambda row, i: F.when(i == k, pivot).otherwise(F.zip_with(row, pivot, lambda a, b: a - F.get(row, k) * b))
        )

    n = F.size(rows)
    solved = F.aggregate(F.sequence(F.lit(0), n - 1), rows, eliminate)
    return F.transform(solved, lambda row: F.slice(row, n + 1, F.size(row) - n))


def maximise(w: Column, active: Column, m: Column, first: Column) -> Column:
    """The fit over the ``active`` places of x (array<int>, 0 to 4; the others
    stay at zero): ``x`` and ``e``, what ``evaluate`` gives there.

    One aggregate; a round is seven of its steps, each of which computes fields
    of the state: the point ``tried``, taken or not, the ``slopes`` there, the
    ``gradient`` and its change ``y``, the inverse curvature ``h`` times that, its
    correction, and the ``next`` point."""
    names = ("x", "e", "part", "fresh", "slopes", "gradient", "y", "hy", "h", "moved", "next", "tried")

    def fields(s: Column, **new: Column) -> Column:
        return F.struct(*(new.get(n, s[n]).alias(n) for n in names))

    def picked(x: Column) -> Column:
        return F.transform(active, lambda j: F.get(x, j))

    def beside(s: Column, j: Column) -> Column:
        return F.transform(s["x"], lambda v, i: F.when(i == j, v + STEP).otherwise(v))

    def slope(s: Column, point: Column) -> Column:
        return F.zip_with(evaluate(w, point, m, first)["scaled"], s["e"]["scaled"], lambda a, b: (a - b) / STEP)

    def gradient(s: Column) -> Column:
        length = F.greatest(dot(s["e"]["scaled"], s["e"]["scaled"]), F.lit(LEAST))
        return F.transform(s["slopes"], lambda a: 2 * dot(a, s["e"]["scaled"]) / length)

    def first_curvature(s: Column) -> Column:
        """Inverse of the Gauss-Newton matrix, its diagonal a little raised."""
        length = F.greatest(dot(s["e"]["scaled"], s["e"]["scaled"]), F.lit(LEAST))
        return reduced(
            F.transform(
                s["slopes"],
                lambda a, i: F.concat(
                    F.transform(s["slopes"], lambda b, k: 2 * dot(a, b) / length * F.when(i == k, 1.001).otherwise(1.0) + F.when(i == k, 1e-9).otherwise(0.0)),
                    F.transform(s["slopes"], lambda _, k: F.when(i == k, 1.0).otherwise(0.0)),
                ),
            )
        )

    def corrected(s: Column) -> Column:
        sy = dot(s["moved"], s["y"])

        def cell(v: Column, i: Column, k: Column) -> Column:
            a, b = F.get(s["moved"], i), F.get(s["moved"], k)
            cross = a * F.get(s["hy"], k) + F.get(s["hy"], i) * b
            return v - cross / sy + (1 + dot(s["y"], s["hy"]) / sy) * a * b / sy

        return F.when(sy > 1e-14, F.transform(s["h"], lambda row, i: F.transform(row, lambda v, k: cell(v, i, k)))).otherwise(s["h"])

    def next_point(s: Column) -> Column:
        def moved(v: Column, i: Column) -> Column:
            row = F.get(s["h"], F.array_position(active, i).cast("int") - 1)
            change = F.when(F.array_contains(active, i), -s["part"] * dot(row, s["gradient"])).otherwise(0.0)
            return F.greatest(F.lit(-EDGE), F.least(F.lit(EDGE), v + change))

        return F.transform(s["x"], moved)

    def step(s: Column, k: Column) -> Column:
        change = F.zip_with(picked(s["next"]), picked(s["x"]), lambda a, b: a - b)
        taken = fields(s, x=s["next"], e=s["tried"], moved=change, part=F.lit(1.0), fresh=F.lit(True))
        return (
            F.when(s["part"] < SETTLED, s)
            .when(k % 7 == 0, fields(s, tried=evaluate(w, s["next"], m, first)))
            .when(
                k % 7 == 1,
                F.when(s["tried"]["objective"] < s["e"]["objective"], taken).otherwise(
                    fields(s, part=s["part"] / 4, fresh=F.lit(False))
                ),
            )
            .when(k % 7 == 6, fields(s, next=next_point(s)))
            .when(~s["fresh"], s)
            .when(k % 7 == 2, fields(s, slopes=F.transform(F.transform(active, lambda j: beside(s, j)), lambda p: slope(s, p))))
            .when(k % 7 == 3, fields(s, y=F.zip_with(gradient(s), s["gradient"], lambda a, b: a - b), gradient=gradient(s)))
            .when(F.size(s["h"]) == 0, F.when(k % 7 == 5, fields(s, h=first_curvature(s))).otherwise(s))
            .when(k % 7 == 4, fields(s, hy=F.transform(s["h"], lambda row: dot(row, s["y"]))))
            .otherwise(fields(s, h=corrected(s)))
        )

    def allowed(g: Column) -> Column:
        return (F.array_contains(active, 0) | (g[0] == 0)) & (F.array_contains(active, 2) | (g[2] == 0))

    grid = F.expr("array(" + ", ".join(f"array({a}D, 0D, {b}D, 0D, 0D)" for a in START for b in START) + ")")
    points = F.transform(
        F.filter(grid, allowed), lambda g: F.struct(evaluate(w, g, m, first)["objective"].alias("q"), g.alias("x"))
    )

    def starts(points: Column) -> Column:
        def best(right: bool, above: bool) -> Column:
            def inside(p: Column) -> Column:
                a, b = p["x"][0] >= 0, p["x"][0] + p["x"][2] >= 0
                return (a if right else ~a) & (b if above else ~b)

            return F.array_min(F.filter(points, inside))["x"]

        return F.array_compact(F.array(*(best(right, above) for right in (True, False) for above in (True, False))))

    nothing = F.struct(
        empty().alias("v"), empty().alias("f"), F.lit(0.0).alias("sigma2"), F.lit(1e300).alias("objective"), empty().alias("scaled")
    )
    origin, none = F.array(*(F.lit(0.0) for _ in range(PLACES))), F.array().cast("array<array<double>>")
    steps = F.sequence(F.lit(0), F.when(F.size(active) > 0, 7 * ROUNDS + 1).otherwise(1))

    def searched(x: Column) -> Column:
        begin = dict(
            x=origin, e=nothing, part=F.lit(1.0), fresh=F.lit(False), slopes=none, gradient=empty(), y=empty(), hy=empty(), h=none,
            moved=empty(), next=x, tried=nothing,
        )
        end = F.aggregate(steps, F.struct(*(begin[n].alias(n) for n in names)), step)
        return let(end, lambda s: F.struct(s["e"]["objective"].alias("q"), s["x"].alias("x"), s["e"].alias("e")))

    return F.array_min(F.transform(let(points, starts), searched))


def minus_two_log_likelihood(objective: Column, n: Column) -> Column:
    return n * (objective + (math.log(2 * math.pi) + 1))


def difference(xs: Column, lag: Column) -> Column:
    """x_t - x_{t - lag}; empty where the series is not longer than the lag."""
    n = F.greatest(F.size(xs) - lag, F.lit(0))
    return F.zip_with(F.slice(xs, lag + 1, n), F.slice(xs, F.lit(1), n), lambda a, b: a - b)


def mean(xs: Column) -> Column:
    return total(xs) / F.greatest(F.size(xs), F.lit(1))


def centred(xs: Column) -> Column:
    return let(mean(xs), lambda mu: F.transform(xs, lambda x: x - mu))


def kpss(xs: Column) -> Column:
    """KPSS statistic for a constant level: partial sums of the centred values
    over the long-run variance, Bartlett weights up to lag 3 sqrt(n) / 13."""

    def of(e: Column) -> Column:
        n = F.size(e)
        lags = F.floor(3 * F.sqrt(n) / 13).cast("int")
        sums = F.aggregate(
            e,
            F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("q")),
            lambda a, x: F.struct((a["s"] + x).alias("s"), (a["q"] + (a["s"] + x) * (a["s"] + x)).alias("q")),
        )["q"]

        def covariance(k: Column) -> Column:
            return dot(F.slice(e, k + 1, n - k), F.slice(e, F.lit(1), n - k)) / n

        weighted = F.transform(F.sequence(F.lit(1), lags), lambda k: (1 - k / (lags + 1)) * covariance(k))
        long_run = covariance(F.lit(0)) + 2 * F.when(lags > 0, total(weighted)).otherwise(0.0)
        return F.coalesce(F.try_divide(sums / (n * n), F.when(long_run > LEAST, long_run)), F.lit(0.0))

    return F.when(F.size(xs) > 2, let(centred(xs), of)).otherwise(F.lit(0.0))


def seasonal_strength(xs: Column, m: int) -> Column:
    """1 - var(remainder) / var(detrended), at least 0, of a classical
    decomposition: the trend is the centred average over a season, the season
    the mean of its months.  0 for a series of less than three seasons."""
    half, other = m // 2, 1 - m % 2  # an even season averages two windows

    def of(detrended: Column) -> Column:
        def remainder(x: Column, t: Column) -> Column:
            same = F.filter(detrended, lambda _, s: F.pmod(s, F.lit(m)) == F.pmod(t, F.lit(m)))
            return x - mean(same)

        spread = let(centred(detrended), lambda e: dot(e, e))
        left = let(centred(F.transform(detrended, remainder)), lambda e: dot(e, e))
        return F.greatest(F.lit(0.0), 1 - F.coalesce(F.try_divide(left, F.when(spread > LEAST, spread)), F.lit(1.0)))

    def smooth(t: Column) -> Column:
        return (mean(F.slice(xs, t - half, F.lit(m))) + mean(F.slice(xs, t - half + other, F.lit(m)))) / 2

    months = F.sequence(F.lit(half + 1), F.size(xs) - half)
    detrended = F.transform(months, lambda t: F.get(xs, t - 1) - smooth(t))
    return F.when(F.size(xs) >= 3 * m, let(detrended, of)).otherwise(F.lit(0.0))
