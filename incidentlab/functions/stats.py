"""Special functions as column expressions: log gamma, the regularised upper
incomplete gamma (chi-square tails, on the log scale) and the normal quantile."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

_SHIFT = 10  # Stirling's series is used from here on
#: Coefficients of 1/y, 1/y^3, ... in Stirling's series.
_STIRLING = (1 / 12, -1 / 360, 1 / 1260, -1 / 1680, 1 / 1188, -691 / 360360)

#: Rational approximation of the normal quantile (algorithm AS 241),
#: numerator and denominator, lowest power first, for the middle and the two tails.
_MIDDLE = (
    (3.3871328727963666080e0, 1.3314166789178437745e2, 1.9715909503065514427e3, 1.3731693765509461125e4,
     4.5921953931549871457e4, 6.7265770927008700853e4, 3.3430575583588128105e4, 2.5090809287301226727e3),
    (1.0, 4.2313330701600911252e1, 6.8718700749205790830e2, 5.3941960214247511077e3,
     2.1213794301586595867e4, 3.9307895800092710610e4, 2.8729085735721942674e4, 5.2264952788528545610e3),
)
_TAIL = (
    (1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0, 3.64784832476320460504e0,
     1.27045825245236838258e0, 2.41780725177450611770e-1, 2.27238449892691845833e-2, 7.74545014278341407640e-4),
    (1.0, 2.05319162663775882187e0, 1.67638483018380384940e0, 6.89767334985100004550e-1,
     1.48103976427480074590e-1, 1.51986665636164571966e-2, 5.47593808499534494600e-4, 1.05075007164441684324e-9),
)
_FAR_TAIL = (
    (6.65790464350110377720e0, 5.46378491116411436990e0, 1.78482653991729133580e0, 2.96560571828504891230e-1,
     2.65321895265761230930e-2, 1.24266094738807843860e-3, 2.71155556874348757815e-5, 2.01033439929228813265e-7),
    (1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2,
     7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7, 2.04426310338993978564e-15),
)


def log_gamma(a: Column) -> Column:
    """ln of the gamma function, for a > 0."""
    y = a + _SHIFT
    series = sum((F.lit(c) / F.pow(y, F.lit(2 * k + 1)) for k, c in enumerate(_STIRLING)), F.lit(0.0))
    steps = sum((F.log(a + i) for i in range(1, _SHIFT)), F.log(a))
    return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + series - steps


def log_gamma_q(a: Column, x: Column) -> Column:
    """ln of the regularised upper incomplete gamma function Q(a, x), a > 0:
    by the series of P below x = a + 1, by the continued fraction (modified
    Lentz) from there on, both with enough terms for the size of a."""
    terms = F.sequence(F.lit(1), F.ceil(60 + 14 * F.sqrt(a)).cast("int"))
    log_front = a * F.log(x) - x - log_gamma(a)

    def add(s: Column, k: Column) -> Column:
        term = s["term"] * x / (a + k)
        return F.struct(term.alias("term"), (s["total"] + term).alias("total"))

    one = F.lit(1.0)
    lower = F.aggregate(terms, F.struct(one.alias("term"), one.alias("total")), add, lambda s: s["total"])
    by_series = F.log1p(-F.exp(log_front + F.log(lower) - F.log(a)))

    def continued(s: Column, k: Column) -> Column:
        up, b = -k * (k - a), x + 1 - a + 2 * k
        d = 1 / (up * s["d"] + b)
        c = b + up / s["c"]
        return F.struct(c.alias("c"), d.alias("d"), (s["h"] * c * d).alias("h"))

    d0 = 1 / (x + 1 - a)
    begin = F.struct(F.lit(1e300).alias("c"), d0.alias("d"), d0.alias("h"))
    by_fraction = log_front + F.log(F.aggregate(terms, begin, continued, lambda s: s["h"]))
    return F.when(x <= 0, F.lit(0.0)).when(x < a + 1, by_series).otherwise(by_fraction)


def chi2_log_sf(x: Column, dof: Column) -> Column:
    """ln of the chi-square tail beyond x; NaN without a degree of freedom."""
    x, dof = x.cast("double"), dof.cast("double")
    known = x.isNotNull() & ~F.isnan(x) & dof.isNotNull() & (dof > 0)
    return F.when(known, log_gamma_q(dof / 2, x / 2)).otherwise(F.lit(float("nan")))


def chi2_sf(x: Column, dof: Column) -> Column:
    return F.exp(chi2_log_sf(x, dof))


def _ratio(parts: tuple, r: Column) -> Column:
    def polynomial(cs: tuple) -> Column:
        out = F.lit(cs[-1])
        for c in reversed(cs[:-1]):
            out = out * r + c
        return out

    return polynomial(parts[0]) / polynomial(parts[1])


def normal_quantile(p: Column) -> Column:
    """z with a standard normal probability p below it; null outside (0, 1)."""
    q = p - 0.5
    near = 0.180625 - q * q
    r = F.sqrt(-F.log(F.least(p, 1 - p)))
    tail = F.when(r <= 5, _ratio(_TAIL, r - 1.6)).otherwise(_ratio(_FAR_TAIL, r - 5))
    z = F.when(F.abs(q) <= 0.425, q * _ratio(_MIDDLE, near)).otherwise(F.signum(q) * tail)
    return F.when((p > 0) & (p < 1), z)
