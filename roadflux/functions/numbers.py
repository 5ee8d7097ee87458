"""Small numeric helpers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def guarded_ratio(top: Column, bottom: Column, digits: int) -> Column:
    """top / bottom rounded, or 0.0 unless the divisor is positive."""
    safe = F.when(bottom > 0, bottom)
    return F.when(safe.isNotNull(), F.round(top / safe, digits)).otherwise(F.lit(0.0))


def settled(value: Column, digits: int) -> Column:
    """Round a mean or sum of inexact values so that every run gives the same result.

    Its last bits depend on the order rows arrive in; dropping them first keeps
    a value on a half from falling to either side.
    """
    return F.round(F.round(value, 10), digits)


def percent(part: Column, whole: Column) -> Column:
    return F.try_divide(part, whole) * 100


def shown(value: Column, digits: int) -> Column:
    """Fixed-point text of a number, the same for doubles and decimals."""
    return F.round(value, digits).cast(f"decimal(20,{digits})").cast("string")
