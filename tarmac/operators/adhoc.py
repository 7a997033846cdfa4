"""Ad-hoc questions over the marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac import dims
from tarmac.dims import CAUSE_LABELS
from tarmac.functions.measures import percent, positive_mean, rounded_mean
from tarmac.operators.keys import largest
from tarmac.operators.marts import flights_counted, flown


def annual_trend(monthly: DataFrame) -> DataFrame:
    """Mean monthly rate, flights and cancellations per year."""
    return (
        monthly.groupBy("YEAR")
        .agg(
            rounded_mean("DELAY_RATE").alias("AVG_ANNUAL_DELAY_RATE"),
            F.sum("TOTAL_FLIGHTS").alias("TOTAL_ANNUAL_FLIGHTS"),
            F.sum("TOTAL_CANCELLED").alias("TOTAL_CANCELLATIONS"),
        )
        .orderBy("YEAR")
    )


def most_delayed_airlines(airlines: DataFrame, n: int = 10) -> DataFrame:
    by_airline = airlines.groupBy("AIRLINE_CODE").agg(
        rounded_mean("DELAY_RATE").alias("AVG_DELAY_RATE"),
        rounded_mean("AVG_DEP_DELAY_MIN").alias("AVG_DELAY_MINUTES"),
        F.sum("TOTAL_FLIGHTS").alias("TOTAL_FLIGHTS"),
    )
    return largest(by_airline, n, "AVG_DELAY_RATE", "AIRLINE_CODE")


def month_of_year_pattern(monthly: DataFrame) -> DataFrame:
    return (
        monthly.groupBy("MONTH")
        .agg(
            rounded_mean("DELAY_RATE").alias("AVG_DELAY_RATE"),
            rounded_mean("AVG_DEP_DELAY_MIN").alias("AVG_DELAY_MIN"),
            rounded_mean("WEATHER_DELAY_SHARE").alias("AVG_WEATHER_SHARE"),
        )
        .orderBy("MONTH")
    )


def worst_airports(airports: DataFrame, n: int = 20, more_than: int = 1000) -> DataFrame:
    by_airport = airports.groupBy("AIRPORT", "CITY", "STATE").agg(
        rounded_mean("DEP_DELAY_RATE").alias("AVG_DEP_DELAY_RATE"),
        rounded_mean("AVG_DEP_DELAY_MIN").alias("AVG_DELAY_MINUTES"),
        F.sum("DEP_FLIGHTS").alias("TOTAL_DEP_FLIGHTS"),
    )
    busy = by_airport.where(F.col("TOTAL_DEP_FLIGHTS") > more_than)
    return largest(busy, n, "AVG_DEP_DELAY_RATE", "AIRPORT", "CITY", "STATE")


def cause_composition(causes: DataFrame) -> DataFrame:
    """Four causes as a percentage of the five-cause total, per year."""
    every = sum(F.col(name) for name, _ in CAUSE_LABELS)
    shown = {
        "CARRIER_PCT": "CARRIER_DELAY_TOTAL_MIN",
        "WEATHER_PCT": "WEATHER_DELAY_TOTAL_MIN",
        "NAS_PCT": "NAS_DELAY_TOTAL_MIN",
        "LATE_AIRCRAFT_PCT": "LATE_AIRCRAFT_DELAY_TOTAL_MIN",
    }
    parts = [percent(F.sum(source), F.sum(every)).alias(name) for name, source in shown.items()]
    return causes.groupBy("YEAR").agg(*parts).orderBy("YEAR")


def months_with_cancel_rate(monthly: DataFrame, first_year: int = 2019, last_year: int = 2022) -> DataFrame:
    """Month rows of a year range, by default around the 2020 traffic slump."""
    return (
        monthly.where(F.col("YEAR").between(first_year, last_year))
        .select(
            "YEAR",
            "MONTH",
            "TOTAL_FLIGHTS",
            "TOTAL_CANCELLED",
            percent("TOTAL_CANCELLED", "TOTAL_FLIGHTS").alias("CANCEL_RATE"),
            "DELAY_RATE",
            "AVG_DEP_DELAY_MIN",
        )
        .orderBy("YEAR", "MONTH")
    )


def busiest_routes(routes: DataFrame, n: int = 25, more_than: int = 5000) -> DataFrame:
    by_route = routes.groupBy("ROUTE").agg(
        F.sum("TOTAL_FLIGHTS").alias("TOTAL_FLIGHTS"),
        rounded_mean("DELAY_RATE").alias("AVG_DELAY_RATE"),
        rounded_mean("AVG_DEP_DELAY_MIN").alias("AVG_DELAY_MIN"),
        rounded_mean("AVG_DISTANCE", 0).alias("DISTANCE_MILES"),
    )
    return largest(by_route.where(F.col("TOTAL_FLIGHTS") > more_than), n, "TOTAL_FLIGHTS", "ROUTE")


def weekday_pattern(flights: DataFrame) -> DataFrame:
    """By day of week, Monday first, straight from the flights."""
    by_day = (
        flown(flights)
        .groupBy("DAY_OF_WEEK")
        .agg(
            flights_counted().alias("TOTAL_FLIGHTS"),
            percent(F.count_if("IS_DEP_DELAYED"), flights_counted()).alias("DELAY_RATE"),
            positive_mean("DEP_DELAY_MIN").alias("AVG_DELAY_MIN"),
        )
    )
    named = by_day.join(F.broadcast(dims.weekdays(flights.sparkSession)), "DAY_OF_WEEK", "left")
    return named.select("DAY_OF_WEEK", "DAY_NAME", "TOTAL_FLIGHTS", "DELAY_RATE", "AVG_DELAY_MIN").orderBy("DAY_OF_WEEK")
