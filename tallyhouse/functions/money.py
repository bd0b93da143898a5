"""Rounding and summing of money held as doubles with two decimals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_away(value: Column, places: int = 0) -> Column:
    """Round the scaled *binary* value, halves away from zero.

    Spark's own ``round`` goes through the decimal text of the double, which gives
    another answer when the binary value lies just off a half, and costs a
    BigDecimal per row. ``rint`` only differs from half-away on exact halves, and
    an exact half plus or minus 0.5 is exact, so this stays in primitive codegen.
    """
    scale = float(10**places)
    scaled = value * F.lit(scale) if places else value
    nearest = F.rint(scaled)
    away = F.when(
        F.abs(scaled - nearest) == 0.5, scaled + F.signum(scaled) * 0.5
    ).otherwise(nearest)
    # adding 0.0 turns a negative zero into zero
    return (away / F.lit(scale) if places else away) + F.lit(0.0)


def cents(amount: Column) -> Column:
    """Whole cents of an amount that is already rounded to two places."""
    return F.rint(amount * 100.0).cast("bigint")


def money_sum(amount: Column) -> Column:
    """Exact sum of two-decimal amounts.

    Adding cents as integers does not depend on the order in which tasks deliver
    rows, so retries and lost executors cannot change a total, and no cent is lost
    however many rows are added (overflow raises under ANSI).
    """
    return F.sum(cents(amount)) / 100.0


def percent_of(part: Column, whole: Column, scale_first: bool = False) -> Column:
    """Share in percent with two places; NULL when the whole is zero.

    The two orders of the same arithmetic can fall on either side of a half, so the
    caller says which one its figure is defined by.
    """
    if scale_first:
        return round_half_away(F.try_divide(part * 100.0, whole), 2)
    return round_half_away(F.try_divide(part, whole) * 100.0, 2)
