"""Decimal rounding of binary doubles, exact to the last bit.

Spark's ``round`` works on the shortest decimal text of a double and sends ties
upward; the results to match round the exact binary value and send true ties to
the even digit.  The two differ on values such as 2.675.  The expression below
gets the exact rule from plain double arithmetic: the product ``x * 10^n`` is
split into its rounded part and its rounding error (Dekker's two-product), and
the error decides the cases that look like ties.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPLITTER = 134217729.0  # 2^27 + 1
_WHOLE = 2.0**52


def split_constant(value: float) -> tuple[float, float]:
    """Split a constant into two halves whose products are exact."""
    scaled = _SPLITTER * value
    high = scaled - (scaled - value)
    return high, value - high


def round_exact(value: Column, digits: int) -> Column:
    """Round a double column to ``digits`` decimals, ties of the exact value to even.

    Exact while ``|x| * 10^digits`` is below 2^50.  From 2^52 on neighbouring
    doubles lie about as far apart as the wanted decimals, so the value itself is
    the answer.  In between the result may be off by one unit of the last digit.
    """
    scale = float(10**digits)
    scale_high, scale_low = split_constant(scale)
    x = value.cast("double")
    product = x * scale
    nearest = F.rint(product)
    # the rounded product looks like a tie: its rounding error tells which side it is on
    high = x * _SPLITTER - (x * _SPLITTER - x)
    low = x - high
    error = ((high * scale_high - product) + high * scale_low + low * scale_high) + low * scale_low
    tie = F.rint(product + F.signum(error) * 0.25)
    rounded = F.when(F.abs(product - nearest) != 0.5, nearest).otherwise(tie) / scale
    return F.when(F.abs(product) < _WHOLE, rounded).otherwise(x)
