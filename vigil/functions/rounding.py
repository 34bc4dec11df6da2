"""Two rules of rounding a double to decimals, as column expressions.

They differ at halves.  ``scaled`` is the rule of array libraries: multiply, round
half to even, divide.  ``exact`` rounds the number that the double stands for,
as printing it with that many decimals does: 0.65875 is a little less than its
name says and becomes 0.6587.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPLIT = 134217729.0       # 2**27 + 1 cuts a double into two halves of 26 bits


def scaled(c: Column, digits: int) -> Column:
    scale = F.lit(10.0 ** digits)
    return F.rint(c.cast("double") * scale) / scale


def exact(c: Column, digits: int) -> Column:
    """Round half to even of the exact binary value.

    The product with the scale is taken with its rounding error (the halves' products are exact), so a product that
    falls on a half tells on which side the exact one lies.  For values below 2**52 over the scale; larger ones have
    no decimals left and stay.
    """
    x, scale = c.cast("double"), 10.0 ** digits
    t = x * F.lit(_SPLIT)
    high = t - (t - x)
    low = x - high
    u = scale * _SPLIT
    scale_high = u - (u - scale)
    scale_low = scale - scale_high
    p = x * F.lit(scale)
    error = ((high * F.lit(scale_high) - p) + high * F.lit(scale_low) + low * F.lit(scale_high)) + low * F.lit(scale_low)
    below = F.floor(p).cast("double")
    half = (p - below) == F.lit(0.5)
    rounded = F.when(half & (error > 0), below + 1).when(half & (error < 0), below).otherwise(F.rint(p))
    return F.when(F.abs(p) < F.lit(2.0 ** 52), rounded / F.lit(scale)).otherwise(x)
