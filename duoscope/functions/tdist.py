"""Student-t tail probabilities and quantiles as native Spark expressions.

Spark has no beta / gamma / erf function, so the two-sided p-value of a t statistic,
p = I_{df/(df+t^2)}(df/2, 1/2), is evaluated here as the classic continued fraction
of the regularized incomplete beta function (modified Lentz), written as a fixed
``aggregate(sequence(1, 2*STEPS), ...)`` fold. log-gamma uses the Stirling series
after shifting the argument up by 8. Everything stays a JVM expression: these are
applied to one row per group (already aggregated), never to base rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed numeric constants of the method.
STEPS = 64            # continued-fraction terms (2 updates each); converges well before
TINY = 1e-300         # Lentz guard against division by zero
HALF_LOG_2PI = 0.5 * math.log(2.0 * math.pi)
SHIFT = 8             # lgamma(z) = stirling(z + SHIFT) - log(z (z+1) ... (z+SHIFT-1))


def _lit(v) -> Column:
    return F.lit(float(v))


def lgamma(z: Column) -> Column:
    """log Gamma(z) for z > 0 (absolute error ~1e-11)."""
    w = z + _lit(SHIFT)
    prod = z
    for i in range(1, SHIFT):
        prod = prod * (z + _lit(i))
    w2 = w * w
    series = (_lit(1 / 12) - (_lit(1 / 360) - (_lit(1 / 1260) - _lit(1 / 1680) / w2) / w2) / w2) / w
    stirling = (w - _lit(0.5)) * F.log(w) - w + _lit(HALF_LOG_2PI) + series
    return stirling - F.log(prod)


def _guard(v: Column) -> Column:
    return F.when(F.abs(v) < _lit(TINY), _lit(TINY)).otherwise(v)


def _betacf(a: Column, b: Column, x: Column) -> Column:
    """Continued fraction part of I_x(a, b) (converges for x < (a+1)/(a+b+2))."""
    d0 = _lit(1.0) / _guard(_lit(1.0) - (a + b) * x / (a + _lit(1.0)))
    init = F.struct(_lit(1.0).alias("c"), d0.alias("d"), d0.alias("h"))

    def step(acc, k):
        m = F.ceil(k / F.lit(2)).cast("double")
        odd = (k % F.lit(2)) == F.lit(1)
        aa_odd = m * (b - m) * x / ((a - _lit(1.0) + _lit(2.0) * m) * (a + _lit(2.0) * m))
        aa_even = -(a + m) * (a + b + m) * x / ((a + _lit(2.0) * m) * (a + _lit(1.0) + _lit(2.0) * m))
        aa = F.when(odd, aa_odd).otherwise(aa_even)
        dn = _lit(1.0) / _guard(_lit(1.0) + aa * acc["d"])
        cn = _guard(_lit(1.0) + aa / acc["c"])
        return F.struct(cn.alias("c"), dn.alias("d"), (acc["h"] * dn * cn).alias("h"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(2 * STEPS)), init, step)["h"]


def betainc(a: Column, b: Column, x: Column, y: Column | None = None) -> Column:
    """Regularized incomplete beta I_x(a, b); ``y`` = 1 - x if known more exactly."""
    if y is None:
        y = _lit(1.0) - x
    log_front = lgamma(a + b) - lgamma(a) - lgamma(b) + a * F.log(x) + b * F.log(y)
    direct = F.exp(log_front) * _betacf(a, b, x) / a
    mirrored = _lit(1.0) - F.exp(log_front) * _betacf(b, a, y) / b
    use_direct = x < (a + _lit(1.0)) / (a + b + _lit(2.0))
    return (F.when(x <= _lit(0.0), _lit(0.0))
            .when(y <= _lit(0.0), _lit(1.0))
            .when(use_direct, direct)
            .otherwise(mirrored))


def t_two_sided_p(t: Column, df: Column) -> Column:
    """P(|T| >= |t|) for Student t with ``df`` degrees of freedom; NULL if undefined."""
    t = t.cast("double")
    df = df.cast("double")
    t2 = t * t
    x = df / (df + t2)
    y = t2 / (df + t2)
    p = betainc(df / _lit(2.0), _lit(0.5), x, y)
    return (F.when(t.isNull() | df.isNull() | (df <= _lit(0.0)) | F.isnan(t), F.lit(None).cast("double"))
            .when(F.abs(t) == _lit(float("inf")), _lit(0.0))
            .otherwise(F.least(_lit(1.0), F.greatest(_lit(0.0), p))))


def t_density(t: Column, df: Column) -> Column:
    """Student-t density."""
    half = (df + _lit(1.0)) / _lit(2.0)
    log_c = lgamma(half) - lgamma(df / _lit(2.0)) - _lit(0.5) * F.log(df * _lit(math.pi))
    return F.exp(log_c - half * F.log1p(t * t / df))


def _cornish_fisher(alpha: float, df: Column) -> Column:
    """Start value for t_{1-alpha/2, df} from the normal quantile (good for df >= 3)."""
    from statistics import NormalDist
    z = NormalDist().inv_cdf(1.0 - alpha / 2.0)
    g1 = (z ** 3 + z) / 4.0
    g2 = (5 * z ** 5 + 16 * z ** 3 + 3 * z) / 96.0
    g3 = (3 * z ** 7 + 19 * z ** 5 + 17 * z ** 3 - 15 * z) / 384.0
    g4 = (79 * z ** 9 + 776 * z ** 7 + 1482 * z ** 5 - 1920 * z ** 3 - 945 * z) / 92160.0
    return _lit(z) + _lit(g1) / df + _lit(g2) / (df * df) + _lit(g3) / (df * df * df) \
        + _lit(g4) / (df * df * df * df)


def t_quantile_two_sided(alpha: float, df: Column, newton_steps: int = 4) -> Column:
    """q with P(|T| >= q) = alpha (q = t_{1-alpha/2, df}).

    Closed forms for df = 1 and 2; otherwise a Cornish-Fisher start refined by Newton
    steps on the two-sided p (dp/dq = -2 f(q)), folded with ``aggregate`` so the
    expression does not grow with the number of steps.
    """
    df = df.cast("double")
    one = _lit(1.0 - alpha)
    q1 = F.tan(_lit(math.pi / 2.0) * one)
    q2 = one * F.sqrt(_lit(2.0) / (_lit(1.0) - one * one))

    def step(q, _k):
        return q + (t_two_sided_p(q, df) - _lit(alpha)) / (_lit(2.0) * t_density(q, df))

    newton = F.aggregate(F.sequence(F.lit(1), F.lit(newton_steps)), _cornish_fisher(alpha, df), step)
    return (F.when(df.isNull() | (df <= _lit(0.0)), F.lit(None).cast("double"))
            .when(df == _lit(1.0), q1)
            .when(df == _lit(2.0), q2)
            .otherwise(newton))
