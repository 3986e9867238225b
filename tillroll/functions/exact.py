"""Ratios rounded half away from zero in integer arithmetic.

Averages and percentages are the only places where the result could depend on
how an engine divides; computing them on whole numbers removes that freedom.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F

WHOLE = "decimal(38,0)"
MONEY = "decimal(18,2)"


def cents(amount: Column) -> Column:
    """Money with two decimals as a whole number of cents."""
    return (amount * 100).cast("bigint")


def ratio(numerator: Column, denominator: Column, places: int, factor: int = 1) -> Column:
    """``factor * numerator / denominator`` to ``places``; NULL on a zero denominator."""
    top = numerator.cast(WHOLE)
    bottom = F.nullif(denominator.cast(WHOLE), F.lit(0).cast(WHOLE))
    scale = F.lit(2 * factor * 10**places).cast("decimal(12,0)")
    # floor(x + 1/2) on the absolute value, then the sign again
    whole = F.call_function("div", F.abs(top) * scale + bottom, bottom * 2)
    signed = F.when(top < 0, -whole).otherwise(whole).cast("decimal(20,0)")
    if places:
        signed = signed * F.lit(Decimal(1).scaleb(-places))
    return signed.cast(MONEY)


def percent(part: Column, total: Column, places: int) -> Column:
    return ratio(part, total, places, factor=100)


def average(column: str | Column, places: int) -> Column:
    """Aggregate: rounded mean of a whole-number column."""
    column = F.col(column) if isinstance(column, str) else column
    return ratio(F.sum(column), F.count(column), places)


def average_money(column: str | Column, places: int) -> Column:
    """Aggregate: rounded mean of a money column."""
    column = F.col(column) if isinstance(column, str) else column
    return ratio(cents(F.sum(column)), F.count(column) * 100, places)


def count_where(condition: Column) -> Column:
    """Aggregate: number of rows where the condition is true, zero on no rows."""
    return F.count_if(condition).cast("bigint")
