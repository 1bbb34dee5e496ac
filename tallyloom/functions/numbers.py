"""Numeric and array helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def integer_quotient(numerator: Column, denominator: Column) -> Column:
    """Whole-number division, null where the denominator is zero."""
    return F.call_function("div", numerator, F.nullif(denominator, F.lit(0).cast("long")))


def half_up_ratio(part: Column, whole: Column, decimals: int) -> Column:
    """``part / whole`` rounded half up to ``decimals`` places, for counts.

    The rounding is done on integers, so exact halves never depend on how a
    binary fraction happens to be stored.
    """
    scale = 10**decimals
    part, whole = part.cast("long"), whole.cast("long")
    return integer_quotient(part * (2 * scale) + whole, whole * 2) / F.lit(float(scale))


def hit_rate(made: Column, attempts: Column) -> Column:
    """Share of attempts that were made; 0 when there was no attempt."""
    return F.when(attempts > 0, made / attempts).otherwise(F.lit(0.0))


def fixed_text(number: Column, decimals: int) -> Column:
    """Number as text with a fixed count of decimals."""
    return F.format_string(f"%.{decimals}f", number)


def sign(number: Column) -> Column:
    """-1, 0 or 1."""
    return F.signum(number).cast("int")


def logistic(x: Column) -> Column:
    """Logistic function of ``x``."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, value: total + value)


def dot(a: Column, b: Column) -> Column:
    """Inner product of two arrays of doubles."""
    return _total(F.zip_with(a, b, lambda x, y: x * y))


def squared_distance(a: Column, b: Column) -> Column:
    """Squared Euclidean distance of two arrays of doubles."""
    return _total(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)))


def outer_product(a: Column, b: Column) -> Column:
    """All products ``a[i] * b[j]``, row by row, as one flat array."""
    return F.flatten(F.transform(a, lambda x: F.transform(b, lambda y: x * y)))


def bilinear(a: Column, weights: Sequence[Sequence[float]], b: Column) -> Column:
    """``a' W b`` for a small weight matrix known to the driver."""
    flat = F.array(*[F.lit(float(w)) for row in weights for w in row])
    return dot(flat, outer_product(a, b))
