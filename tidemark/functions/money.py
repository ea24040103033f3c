"""Decimal arithmetic that rounds once, half up."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def cents_to_dollars(cents: Column | str, precision: int = 2) -> Column:
    """An amount in cents as ``decimal(18, precision)`` currency units."""
    return (_col(cents).cast("decimal(20,0)") / F.lit(100)).cast(f"decimal(18,{precision})")


def exact_avg(value: Column | str, result: str = "decimal(10,2)") -> Column:
    """Average of an integer or two-place decimal column, rounded once.

    The built-in decimal average first rounds to four more places, so casting
    it again can round twice; the quotient of sum and count keeps full
    precision, and shares the sum with other aggregates of the same column.
    """
    value = _col(value)
    return (F.sum(value).cast("decimal(20,2)") / F.nullif(F.count(value), F.lit(0))).cast(result)


def percent_change(current: Column, previous: Column) -> Column:
    """``(current - previous) / previous`` in percent, NULL for a zero base."""
    base = F.nullif(previous, F.lit(0).cast("decimal(18,2)"))
    return ((current - previous) / base * F.lit(100)).cast("decimal(18,2)")


def safe_add(*values: Column | str) -> Column:
    """Sum of columns, NULLs counting as zero."""
    total = F.coalesce(_col(values[0]), F.lit(0))
    for value in values[1:]:
        total = total + F.coalesce(_col(value), F.lit(0))
    return total
