"""Rates, means and totals used by the marts and the reports over them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HUNDRED = 100.0


def as_column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def percent(part: str | Column, whole: str | Column, digits: int | None = 2) -> Column:
    """``part`` as a percentage of ``whole``; NULL where ``whole`` is zero."""
    ratio = F.lit(HUNDRED) * as_column(part) / F.nullif(as_column(whole), F.lit(0))
    return ratio if digits is None else F.round(ratio, digits)


def percent_at_least_one(part: str | Column, whole: str | Column) -> Column:
    """Percentage whose denominator is lifted to one, so an empty whole gives 0."""
    return F.round(F.lit(HUNDRED) * as_column(part) / F.greatest(as_column(whole), F.lit(1)), 2)


def positive_mean(value: str | Column, keep: Column | None = None, digits: int = 2) -> Column:
    """Mean over strictly positive values only, optionally within ``keep``."""
    value = as_column(value)
    wanted = value > 0 if keep is None else (value > 0) & keep
    return F.round(F.avg(F.when(wanted, value)), digits)


def hundredths(value: str | Column) -> Column:
    """A two-decimal mart column as an exact decimal."""
    return as_column(value).cast("decimal(18,2)")


def mean(value: str | Column) -> Column:
    """Unrounded mean of a two-decimal mart column.

    The sum is exact, so the result does not depend on the order in which
    partitions are merged.
    """
    return F.sum(hundredths(value)).cast("double") / F.nullif(F.count(as_column(value)), F.lit(0))


def rounded_mean(value: str | Column, digits: int = 2) -> Column:
    """Mean of a two-decimal mart column, halves rounded up.

    Divided in decimal: a mean that lies on a half is not pushed below it by
    binary division.
    """
    return F.round(F.avg(hundredths(value)), digits).cast("double")


def total(value: str | Column) -> Column:
    """Sum that is zero, not NULL, when every input is NULL."""
    summed = F.sum(as_column(value))
    return F.coalesce(summed, F.lit(0))
