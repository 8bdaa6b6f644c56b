"""Rounding as numpy does it: scale, nearest integer with ties to even, scale back."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_even(value: Column | str, digits: int = 0) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    if digits == 0:
        return F.rint(value)
    return F.rint(value * float(10 ** digits)) / float(10 ** digits)
