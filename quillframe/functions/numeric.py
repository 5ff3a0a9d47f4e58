"""Arithmetic with floor division, logs and special functions."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lanczos coefficients for g = 7.
LANCZOS = (
    0.99999999999980993, 676.5203681218851, -1259.1392167224028, 771.32342877765313, -176.61502916214059,
    12.507343278686905, -0.13857109526572012, 9.9843695780195716e-6, 1.5056327351493116e-7,
)


def floor_div(a: Column, b: Column) -> Column:
    """Quotient rounded down; null for a zero divisor."""
    return F.when(b != 0, F.floor(F.try_divide(a, b)))


def floor_mod(a: Column, b: Column) -> Column:
    """Remainder with the sign of the divisor."""
    return a - b * floor_div(a, b)


def logaddexp(a: Column, b: Column) -> Column:
    """log(exp(a) + exp(b)) without overflow."""
    return F.greatest(a, b) + F.log1p(F.exp(-F.abs(a - b)))


def ln_gamma(x: Column) -> Column:
    """Natural log of the gamma function for x > 0, as a generated-code expression."""
    z = x - 1
    series = F.lit(LANCZOS[0])
    for i, c in enumerate(LANCZOS[1:], start=1):
        series = series + F.lit(c) / (z + i)
    t = z + 7.5
    return F.when(x > 0, 0.5 * math.log(2 * math.pi) + (z + 0.5) * F.ln(t) - t + F.ln(series))


def gamma(x: Column) -> Column:
    return F.exp(ln_gamma(x))


def beta(a: Column, b: Column) -> Column:
    return F.exp(ln_gamma(a) + ln_gamma(b) - ln_gamma(a + b))


# Coefficients of algorithm AS 241 (percentage points of the normal distribution), highest power first.
AS241_CENTRE = (
    (2509.0809287301226727, 33430.575583588128105, 67265.770927008700853, 45921.953931549871457, 13731.693765509461125,
     1971.5909503065514427, 133.14166789178437745, 3.387132872796366608),
    (5226.495278852854561, 28729.085735721942674, 39307.89580009271061, 21213.794301586595867, 5394.1960214247511077,
     687.1870074920579083, 42.313330701600911252, 1.0))
AS241_SIDE = (
    (7.7454501427834140764e-4, 0.0227238449892691845833, 0.24178072517745061177, 1.27045825245236838258, 3.64784832476320460504,
     5.7694972214606914055, 4.6303378461565452959, 1.42343711074968357734),
    (1.05075007164441684324e-9, 5.475938084995344946e-4, 0.0151986665636164571966, 0.14810397642748007459, 0.68976733498510000455,
     1.6763848301838038494, 2.05319162663775882187, 1.0))
AS241_TAIL = (
    (2.01033439929228813265e-7, 2.71155556874348757815e-5, 0.0012426609473880784386, 0.026532189526576123093, 0.29656057182850489123,
     1.7848265399172913358, 5.4637849111641143699, 6.6579046435011037772),
    (2.04426310338993978564e-15, 1.4215117583164458887e-7, 1.8463183175100546818e-5, 7.868691311456132591e-4, 0.0148753612908506148525,
     0.13692988092273580531, 0.59983220655588793769, 1.0))

# Maclaurin coefficients of erf(x) exp(x^2) sqrt(pi) / (2 x) in powers of x^2: 2^n / (2n + 1)!!, highest first.
ERF_SERIES = [1.0]
for _n in range(1, 61):
    ERF_SERIES.insert(0, ERF_SERIES[0] * 2 / (2 * _n + 1))
#: Where the series hands over to the continued fraction of the complement, and the levels of that fraction.
ERF_SPLIT, ERFC_LEVELS = 2.0, 80


def _bound(c: Column, f) -> Column:
    """f of a column that is computed once, however often f names it."""
    return F.transform(F.array(c.cast("double")), f)[0]


def _erf_near(x: Column) -> Column:
    series = F.aggregate(F.lit(ERF_SERIES), F.lit(0.0), lambda s, c: s * x * x + c)
    return 2 / math.sqrt(math.pi) * x * F.exp(-x * x) * series


def _erfc_far(x: Column) -> Column:
    """Complement for x >= ERF_SPLIT: exp(-x^2) / sqrt(pi) / (x + (1/2) / (x + (2/2) / (x + ...)))."""
    levels = F.lit([k / 2 for k in range(ERFC_LEVELS, 0, -1)])
    return F.exp(-x * x) / math.sqrt(math.pi) / F.aggregate(levels, x, lambda s, k: x + k / s)


def erf(c: Column) -> Column:
    return _bound(c, lambda x: F.when(F.abs(x) < ERF_SPLIT, _erf_near(x)).otherwise(F.signum(x) * (1 - _erfc_far(F.abs(x)))))


def erfc(c: Column) -> Column:
    """1 - erf, without cancellation for large arguments."""
    return _bound(c, lambda x: F.when(F.abs(x) < ERF_SPLIT, 1 - _erf_near(x)).when(x > 0, _erfc_far(x)).otherwise(2 - _erfc_far(-x)))


def _ratio(r: Column, coefficients) -> Column:
    above, below = (reduce(lambda s, c: s * r + c, line[1:], F.lit(line[0])) for line in coefficients)
    return above / below


def _quantile(q: Column, tail: Column) -> Column:
    """Normal quantile of q + 1/2, where ``tail`` is the smaller of the two probabilities."""
    r = F.sqrt(-F.ln(tail))
    outer = F.when(r <= 5, _ratio(r - 1.6, AS241_SIDE)).otherwise(_ratio(r - 5, AS241_TAIL))
    return F.when(F.abs(q) <= 0.425, q * _ratio(0.180625 - q * q, AS241_CENTRE)).otherwise(F.signum(q) * outer)


def erfinv(c: Column) -> Column:
    """Inverse of erf: infinite at -1 and 1, NaN beyond."""
    inside = _quantile(c / 2, (1 - F.abs(c)) / 2) / math.sqrt(2)
    return F.when(F.abs(c) < 1, inside).when(F.abs(c) == 1, F.signum(c) * float("inf")).when(c.isNotNull(), float("nan"))


def normal_quantile(c: Column) -> Column:
    """Inverse of the standard normal distribution function; NaN outside (0, 1)."""
    return F.when((c > 0) & (c < 1), _quantile(c - 0.5, F.least(c, 1 - c))).when(c.isNotNull(), float("nan"))
