"""Numeric tests used by the JSON profiler."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from citeweave.functions.text import col


def is_integral(x: Column | str) -> Column:
    """``round(x) == x``; half-away-from-zero rounding is irrelevant for this equality."""
    x = col(x)
    return F.round(x) == x


def is_float32(x: Column | str) -> Column:
    """True when the double survives a round trip through a 32-bit float unchanged."""
    x = col(x)
    return x.cast("float").cast("double") == x


# Bounds of the integer types a profile can report.
_SIGNED = [("int8", -128, 127), ("int16", -32768, 32767), ("int32", -2147483648, 2147483647)]
_UNSIGNED = [("uint8", 255), ("uint16", 65535), ("uint32", 4294967295)]


def narrowest_type(integral: Column, float32: Column, lo: Column, hi: Column,
                   max_only: bool = False) -> Column:
    """Smallest type that holds every value seen at a path.

    Integral with a negative minimum: the smallest signed type holding both bounds (with
    ``max_only`` only the maximum is checked, as the original tool did). Integral and non-negative:
    the smallest unsigned type holding the maximum. Otherwise float32 or float64.
    """
    signed = None
    for name, lower, upper in _SIGNED:
        fits = (hi <= upper) if max_only else ((hi <= upper) & (lo >= lower))
        signed = (F.when(fits, F.lit(name)) if signed is None else signed.when(fits, F.lit(name)))
    signed = signed.otherwise(F.lit("int64"))
    unsigned = None
    for name, upper in _UNSIGNED:
        fits = hi <= upper
        unsigned = (F.when(fits, F.lit(name)) if unsigned is None
                    else unsigned.when(fits, F.lit(name)))
    unsigned = unsigned.otherwise(F.lit("uint64"))
    return (F.when(integral & (lo < 0), signed)
            .when(integral, unsigned)
            .when(float32, F.lit("float32"))
            .otherwise(F.lit("float64")))
