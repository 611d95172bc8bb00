"""Rounding that agrees with Python's ``round``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_exact(value: Column, digits: int = 3) -> Column:
    """Round by the exact binary value, ties to even, for values well below 2**20.

    Spark's ``round`` and ``bround`` look at the shortest decimal form instead, and so differ on
    doubles that lie just beside a decimal tie, 0.0125 being one. Splitting the value in a float
    and a remainder keeps both products below free of error, which makes the comparison exact.
    """
    scale = 10**digits
    high = value.cast("float").cast("double")
    low = value - high
    floor = F.floor(value * scale)
    beyond_tie = (high * (2 * scale) - (2 * floor + 1)) + low * (2 * scale)
    up = F.when(beyond_tie > 0, 1).when(beyond_tie < 0, 0).otherwise(F.pmod(floor, F.lit(2)))
    return (floor + up) / F.lit(float(scale))
