"""Sums of doubles that do not depend on the order in which rows and partial sums meet.

A value is cut into three whole numbers: its floor, and two digits of base 2^30 after the
point. Whole numbers add up the same way in any order, so a total over partitions, days, files
or micro-batches is the same to the last bit. What lies beyond 2^-60 is cut off row by row. Values
must stay under 2^62 in size, and a key may have up to 2^33 rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_BITS = 30
_BASE = float(1 << _BITS)
_PARTS = ("whole", "fine", "finer")


def _cut(value: Column) -> tuple[Column, Column, Column]:
    """The three digits. Each step is exact: a double less its floor, and a power of two times a double, are doubles."""
    whole = F.floor(value)
    scaled = (value - whole.cast("double")) * _BASE
    fine = F.floor(scaled)
    finer = F.floor((scaled - fine.cast("double")) * _BASE)
    return whole, fine, finer


def exact_sum(value: Column) -> Column:
    """Aggregate: the sums of the digits of all values, as a struct; null where there is no value."""
    return F.struct(*(F.sum(digit).alias(name) for digit, name in zip(_cut(value.cast("double")), _PARTS, strict=True)))


def merged(sums: Column) -> Column:
    """Aggregate: the total of several such structs."""
    return F.struct(*(F.sum(sums[name]).alias(name) for name in _PARTS))


def as_double(sums: Column) -> Column:
    """The double that a struct of sums stands for: digits are carried over first, so equal totals give equal doubles."""
    low = F.lit((1 << _BITS) - 1).cast("bigint")
    fine = sums["fine"] + F.shiftright(sums["finer"], _BITS)
    whole = sums["whole"] + F.shiftright(fine, _BITS)
    rest = F.shiftleft(fine.bitwiseAND(low), _BITS) + sums["finer"].bitwiseAND(low)
    return whole.cast("double") + rest.cast("double") / F.lit(_BASE * _BASE)
