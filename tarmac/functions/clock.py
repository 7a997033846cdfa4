"""ISO time texts, HHMM clock integers, weekdays, risk bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tarmac.functions.measures import as_column

# Lower bound of the on-time probability, band, colour.
RISK_BANDS = [
    (0.80, "Low", "green"),
    (0.60, "Medium", "orange"),
    (0.40, "High", "red"),
]
WORST_BAND = ("Severe", "darkred")


# The two accepted time texts.
ISO_DATE = r"^\d{4}-\d{2}-\d{2}$"
ISO_TIMESTAMP = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}$"


def iso_date(text: str | Column) -> Column:
    """``yyyy-MM-dd`` as a date; any other text is NULL."""
    text = as_column(text)
    return F.when(F.rlike(text, F.lit(ISO_DATE)), text.try_cast("date"))


def iso_timestamp(text: str | Column) -> Column:
    """``yyyy-MM-ddTHH:mm:ss`` as wall-clock time, free of any time zone."""
    text = as_column(text)
    return F.when(F.rlike(text, F.lit(ISO_TIMESTAMP)), text.try_cast("timestamp_ntz"))


def clock_hour(hhmm: str | Column) -> Column:
    """Hour of an HHMM integer; 2400 is hour 24 and matches no observation."""
    return F.floor(as_column(hhmm) / 100).cast("int")


def arrival_date(date: str | Column, dep: str | Column, arr: str | Column) -> Column:
    """Next day when the scheduled arrival clock is before the departure clock."""
    date = as_column(date)
    return F.when(as_column(arr) < as_column(dep), F.date_add(date, 1)).otherwise(date)


def sunday_first(iso_weekday: str | Column) -> Column:
    """Monday-first number 1…7 → Sunday-first number 1…7."""
    return (F.pmod(as_column(iso_weekday), F.lit(7)) + 1).cast("int")


def risk_level(on_time: str | Column) -> Column:
    return _band(as_column(on_time), 1, WORST_BAND[0])


def risk_color(on_time: str | Column) -> Column:
    return _band(as_column(on_time), 2, WORST_BAND[1])


def _band(on_time: Column, slot: int, worst: str) -> Column:
    chain = None
    for band in RISK_BANDS:
        wanted = on_time >= F.lit(band[0])
        chain = F.when(wanted, band[slot]) if chain is None else chain.when(wanted, band[slot])
    return chain.otherwise(worst)
