"""Vector arithmetic on ``ARRAY<FLOAT|DOUBLE>`` columns with built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    """Inner product in double precision.

    The arrays are widened as a whole, since casting inside the function would
    be done per element. Writing the products out term by term was measured
    three times slower: the generated method is too large to be compiled.
    """
    products = F.zip_with(a.cast("array<double>"), b.cast("array<double>"), lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def l2_norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def l2_normalize(v: Column) -> Column:
    """Scale to length 1; a zero vector stays zero.

    The outer ``transform`` only binds the length to a name: written into the
    inner function, it would be computed again for every component.
    """

    def scale(length: Column) -> Column:
        return F.transform(v, lambda x: F.when(length > 0, x.cast("double") / length).otherwise(F.lit(0.0)))

    return F.transform(F.array(l2_norm(v)), scale)[0]


def is_finite(v: Column) -> Column:
    """True when no component is null, NaN or infinite."""
    return F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))


def is_unit(v: Column, tolerance: float) -> Column:
    return F.abs(l2_norm(v) - 1.0) <= F.lit(tolerance)


def all_close(a: Column, b: Column, atol: float, rtol: float = 1e-5) -> Column:
    """Same length and ``|a - b| <= atol + rtol * |b|`` for every component."""
    within = F.zip_with(a, b, lambda x, y: F.abs(x - y) <= F.lit(atol) + F.lit(rtol) * F.abs(y))
    return (F.size(a) == F.size(b)) & F.forall(within, lambda ok: F.coalesce(ok, F.lit(False)))
