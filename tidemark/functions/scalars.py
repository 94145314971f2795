"""Small column expressions; all stay in generated JVM code."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add, or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalised(text: Column) -> Column:
    """Status text as compared everywhere: no outer blanks, lower case."""
    return F.lower(F.trim(text))


def blank_to_missing(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def month_start(moment: Column) -> Column:
    """First day of the month, as a DATE (``date_trunc`` would give a timestamp)."""
    return F.trunc(moment, "month")


def or_zero(value: Column, type_: str) -> Column:
    return F.coalesce(value, F.lit(0)).cast(type_)


def not_listed(value: Column, listed: Sequence[str]) -> Column:
    """True for a missing value as well: ``NULL NOT IN (...)`` alone would be NULL."""
    if not listed:
        return F.lit(True)
    return value.isNull() | ~value.isin(list(listed))


def sum_where(condition: Column, value: Column) -> Column:
    """Conditional sum that is 0 both for a missing value and for an empty group."""
    return F.coalesce(F.sum(F.when(condition, F.coalesce(value, F.lit(0)))), F.lit(0))


def percent(part: Column, whole: Column) -> Column:
    """``100 * part / whole`` to two places, half up, in whole-number arithmetic.

    Staying in integers keeps the rounding the same on every engine.
    """
    doubled, by = part * 20000 + whole, whole * 2
    hundredths = (doubled - doubled % by) / by
    return (hundredths.cast("decimal(18,2)") / 100).cast("decimal(7,2)")


def any_of(conditions: Sequence[Column]) -> Column:
    return reduce(or_, conditions, F.lit(False))


def total_of(values: Sequence[Column]) -> Column:
    return reduce(add, values)
