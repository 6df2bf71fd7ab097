"""Number expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A double has 53 bits; 40 of them are twelve decimal digits.
_DROPPED_BITS = 13


def twelve_digits(c: Column) -> Column:
    """``c`` to about twelve significant digits, however small it is.

    Adding and taking away a multiple of ``c`` rounds off its last bits;
    rounding to a number of decimals would make all tiny values equal.
    """
    scaled = c * F.lit(float((1 << _DROPPED_BITS) + 1))
    return scaled - (scaled - c)
