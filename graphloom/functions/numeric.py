"""Arithmetic and math functions on typed columns.  Unbound in, unbound out."""

from __future__ import annotations

from pyspark.sql import Column, functions as F



def _n(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x) if isinstance(x, (int, float)) else F.col(x)


def add(a, b) -> Column:
    """``+``; integers stay integers, timestamps take intervals; an overflow is unbound and never fails the job."""
    return F.try_add(_n(a), _n(b))


def subtract(a, b) -> Column:
    """``-``; the difference of two timestamps is a day-time interval."""
    return F.try_subtract(_n(a), _n(b))


def multiply(a, b) -> Column:
    return F.try_multiply(_n(a), _n(b))


def negate(a) -> Column:
    """Unary minus; the lowest integer has no opposite and gives unbound."""
    return F.try_multiply(_n(a), F.lit(-1))


def divide(a, b, zero_is_unbound: bool = True) -> Column:
    """``/`` is always a double; division by zero is unbound, or INF/NaN on request."""
    a, b = _n(a).cast("double"), _n(b).cast("double")
    if zero_is_unbound:
        return F.try_divide(a, b)
    special = (
        F.when((a == 0) | F.isnan(a), F.lit(float("nan")))
        .when(a > 0, F.lit(float("inf")))
        .when(a < 0, F.lit(float("-inf")))
    )
    return F.when(b == 0, special).otherwise(F.try_divide(a, b))


def absolute(x) -> Column:
    x = _n(x)
    # Adding zero turns -0.0 into 0.0.
    return F.when(x < 0, negate(x)).otherwise(F.try_add(x, F.lit(0)))


def _whole_numbers(x: Column, whole: bool, rounded: Column) -> Column:
    return x if whole else rounded


def ceil(x, whole: bool = False) -> Column:
    """CEIL; ``whole`` says that the column already holds integers."""
    x = _n(x)
    return _whole_numbers(x, whole, _keep_special(x, F.ceil(x)))


def floor(x, whole: bool = False) -> Column:
    x = _n(x)
    return _whole_numbers(x, whole, _keep_special(x, F.floor(x)))


def round_half_up(x, whole: bool = False) -> Column:
    """ROUND: halves go towards positive infinity, so -1.5 gives -1."""
    x = _n(x)
    return _whole_numbers(x, whole, _keep_special(x, F.floor(x + F.lit(0.5))))


def _keep_special(x: Column, rounded: Column) -> Column:
    """Doubles of 2^53 and more are whole already; NaN and infinities stay as they are."""
    return F.when(F.abs(x) < F.lit(2.0 ** 53), rounded.cast("double")).otherwise(x)


def log(x) -> Column:
    """Natural logarithm: 0 gives -INF and negative numbers NaN."""
    x = _n(x).cast("double")
    return F.when(x > 0, F.ln(x)).when(x == 0, F.lit(float("-inf"))).when(x.isNotNull(), F.lit(float("nan")))


def exp(x) -> Column:
    return F.exp(_n(x))


def sqrt(x) -> Column:
    return F.sqrt(_n(x))


def sin(x) -> Column:
    return F.sin(_n(x))


def cos(x) -> Column:
    return F.cos(_n(x))


def tan(x) -> Column:
    return F.tan(_n(x))


def power(x, y) -> Column:
    return F.pow(_n(x), _n(y))


def rand(seed: int | None = None) -> Column:
    return F.rand(seed)


