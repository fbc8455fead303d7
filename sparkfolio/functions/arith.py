"""Arithmetic helpers.

``round_half`` is the one rounding rule used by every operator and by the
oracle SQL: ``round(x * 10^d) / 10^d``.  Rounding a double to an integer is
unambiguous (a decimal text ``k.5`` names exactly the binary tie), so Spark
and other engines agree bit-for-bit, whereas ``round(x, d)`` on the decimal
text of ``x`` (Spark) and on ``x * 10^d`` (others) can differ on near-ties
such as 0.285.  Halves round away from zero.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half(c, digits: int = 0) -> Column:
    x = _col(c)
    if digits == 0:
        return F.round(x, 0)
    k = float(10 ** digits)
    return F.round(x * F.lit(k), 0) / F.lit(k)


def round_sql(expr: str, digits: int = 0) -> str:
    """The same rule as SQL text (used by oracle queries)."""
    if digits == 0:
        return f"ROUND({expr})"
    k = 10 ** digits
    return f"(ROUND(({expr}) * {k}.0) / {k}.0)"


# The mini engine's Series arithmetic by a scalar.  ``*`` and ``/`` round
# to 4 places, ``+`` and ``-`` do not.
def mul(c, k) -> Column:
    return round_half(_col(c) * (k if isinstance(k, Column) else F.lit(float(k))), 4)


def div(c, k) -> Column:
    den = k if isinstance(k, Column) else F.lit(float(k))
    return round_half(F.try_divide(_col(c), den), 4)


def add(c, k) -> Column:
    return _col(c) + (k if isinstance(k, Column) else F.lit(float(k)))


def sub(c, k) -> Column:
    return _col(c) - (k if isinstance(k, Column) else F.lit(float(k)))


def scale(c, unit: float = 1e8) -> Column:
    """Unit scaling (hundreds of millions by default)."""
    return _col(c) / F.lit(float(unit))


# Fixed value: the ratio epsilon of the KPI tables.
EPS = 1e-9


def eps_ratio(num, den, eps: float = EPS) -> Column:
    """C17: ``num / (den + eps)``; NULL propagates; ``den = -eps`` -> NULL."""
    return F.try_divide(_col(num), _col(den) + F.lit(eps))


def sigmoid_dot(weights: list[float], features: list[Column], intercept: float) -> Column:
    """``1 / (1 + exp(-(b + sum w_i x_i)))`` as one codegen'd expression."""
    z = reduce(lambda acc, wx: acc + F.lit(float(wx[0])) * wx[1],
               zip(weights, features), F.lit(float(intercept)))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
