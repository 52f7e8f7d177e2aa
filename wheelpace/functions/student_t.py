"""Two-sided p-value of Student's t: for one aggregated test statistic, and as a column for any number of them."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _beta_fraction(x: float, a: float, b: float) -> float:
    """Continued fraction of the incomplete beta function, evaluated from its convergents.

    The convergents A/B are rescaled in every step, so neither part can overflow.
    """
    tiny = 1e-15
    a_old, b_old, a_now, b_now = 1.0, 0.0, 1.0, 1.0
    value = 1.0
    for step in range(1, 100_000):
        m = step // 2
        if step % 2:
            term = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        else:
            term = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        a_old, a_now = a_now, a_now + term * a_old
        b_old, b_now = b_now, b_now + term * b_old
        if b_now:
            a_old, b_old, a_now, b_now = a_old / b_now, b_old / b_now, a_now / b_now, 1.0
            if abs(a_now - value) <= tiny * abs(a_now):
                return 1.0 / a_now
            value = a_now
    return 1.0 / value


def regularized_beta(x: float, a: float, b: float) -> float:
    """I_x(a, b) on [0, 1]."""
    if x <= 0.0 or x >= 1.0:
        return 0.0 if x <= 0.0 else 1.0
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - regularized_beta(1.0 - x, b, a)
    log_front = (math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
                 + a * math.log(x) + b * math.log1p(-x))
    return math.exp(log_front) * _beta_fraction(x, a, b) / a


def two_sided_p(t: float | None, dof: float | None) -> float | None:
    """P(|T| >= |t|) for ``dof`` degrees of freedom; None when either is undefined."""
    if t is None or dof is None or math.isnan(t) or math.isnan(dof):
        return None
    if math.isinf(t):
        return 0.0
    if dof > 1e6:
        # The beta function loses digits here while the error of this normal form is of order 1/dof**2.
        z = abs(t) * (1.0 - 0.25 / dof) / math.sqrt(1.0 + t * t / (2.0 * dof))
        return math.erfc(z / math.sqrt(2.0))
    return regularized_beta(dof / (dof + t * t), dof / 2.0, 0.5)


# --- as a column ----------------------------------------------------------------------------------

# Coefficients of Lanczos' approximation of the gamma function for g = 7.
_LANCZOS = (0.99999999999980993, 676.5203681218851, -1259.1392167224028, 771.32342877765313, -176.61502916214059,
            12.507343278686905, -0.13857109526572012, 9.9843695780195716e-6, 1.5056327351493116e-7)
# Of the series of gamma(a + 1/2) / gamma(a) / sqrt(a) in powers of 1/a.
_HALF_STEP = (1.0, -1 / 8, 1 / 128, 5 / 1024, -21 / 32768, -399 / 262144, 869 / 4194304)
#: From here on the series has all digits.
_SERIES_FROM = 40


def _log_gamma(z: str) -> str:
    """Lanczos' approximation as SQL, for numbers from 1/2 on."""
    terms = " + ".join(f"({c!r}D / ({z} + {i - 1}))" for i, c in enumerate(_LANCZOS) if i)
    return f"({0.5 * math.log(2 * math.pi)!r}D + ({z} - 0.5D) * ln({z} + 6.5D) - ({z} + 6.5D) + ln({_LANCZOS[0]!r}D + {terms}))"


def _fraction(x: str, a: str, b: str, steps: str) -> str:
    """The continued fraction of the incomplete beta function as SQL; every step scales the last denominator to 1."""
    m = "(i div 2)"
    odd = f"-(({a} + {m}) * ({a} + {b} + {m}) * {x}) / (({a} + 2 * {m}) * ({a} + 2 * {m} + 1))"
    even = f"({m} * ({b} - {m}) * {x}) / (({a} + 2 * {m} - 1) * ({a} + 2 * {m}))"
    term = f"if(i % 2 = 1, {odd}, {even})"
    step = (f"element_at(transform(array({term}), term -> element_at(transform(array(1D + term * s.d), d -> "
            "named_struct('n', (s.n + term * s.o) / d, 'o', s.n / d, 'd', 1D / d)), 1)), 1)")
    return f"aggregate(sequence(1, {steps}), named_struct('n', 1D, 'o', 1D, 'd', 0D), (s, i) -> {step}, s -> 1D / s.n)"


def with_two_sided_p(df: DataFrame, t: str, dof: str, out: str) -> DataFrame:
    """``df`` with the column ``out``: :func:`two_sided_p` of every row, in Spark.

    The number of steps follows from the degrees of freedom, as the fraction needs about their root.
    """
    names = {k: f"{out}_{k}" for k in ("a", "x", "y", "front", "steps")}
    a, x, y = names["a"], names["x"], names["y"]
    series = " + ".join(f"{c!r}D / pow({a}, {i})" for i, c in enumerate(_HALF_STEP))
    ratio = (f"if({a} >= {_SERIES_FROM}, 0.5D * ln({a}) + ln({series}), "
             f"{_log_gamma(f'({a} + 0.5D)')} - {_log_gamma(a)})")
    df = df.withColumns({a: F.col(dof) / 2, x: F.expr(f"{dof} / ({dof} + {t} * {t})"), y: F.expr(f"{t} * {t} / ({dof} + {t} * {t})")})
    df = df.withColumns({
        names["front"]: F.expr(f"exp({ratio} - {math.lgamma(0.5)!r}D + {a} * -log1p({t} * {t} / {dof}) + 0.5D * ln({y}))"),
        names["steps"]: F.expr(f"cast(200 + 4 * sqrt({a}) as int)")})
    p = (f"case when {t} is null or {dof} is null or isnan({t}) or isnan({dof}) then null "
         f"when abs({t}) = double('infinity') then 0D when {t} = 0 then 1D "
         f"when {x} <= ({a} + 1) / ({a} + 2.5D) then {names['front']} * {_fraction(x, a, '0.5D', names['steps'])} / {a} "
         f"else 1D - {names['front']} * {_fraction(y, '0.5D', a, names['steps'])} / 0.5D end")
    return df.withColumn(out, F.expr(p)).drop(*names.values())
