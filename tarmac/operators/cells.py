"""Monthly marts from one pass over the flights.

Every monthly mart is made of counts and sums.  ``flight_cells`` takes them once
by month, airline, route and cancellation; the marts are then roll-ups of that
far smaller table.  A full refresh reads the flights once instead of once per
mart.  The results equal the direct queries in ``marts``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.dims import CAUSE_LABELS
from tarmac.functions.measures import percent
from tarmac.operators.marts import MIN_ROUTE_FLIGHTS

CELL_KEYS = [
    "YEAR", "MONTH", "AIRLINE_CODE", "ORIGIN", "ORIGIN_CITY", "ORIGIN_STATE", "DEST", "IS_CANCELLED",
]
CAUSES = [name.removesuffix("_TOTAL_MIN") for name, _ in CAUSE_LABELS]


def flight_cells(flights: DataFrame) -> DataFrame:
    """Counts and sums per cell; a cell never mixes cancelled and flown flights."""
    late = F.col("IS_DEP_DELAYED")
    dep, arr = F.col("DEP_DELAY_MIN"), F.col("ARR_DELAY_MIN")
    return flights.groupBy(*CELL_KEYS).agg(
        F.count(F.lit(1)).alias("N"),
        F.count_if(late).alias("DEP_LATE"),
        F.count_if("IS_ARR_DELAYED").alias("ARR_LATE"),
        F.count_if(~late & ~F.col("IS_CANCELLED")).alias("ON_TIME"),
        F.sum(dep).alias("DEP_MIN"),
        F.sum(F.when(dep > 0, dep)).alias("DEP_POSITIVE_MIN"),
        F.count_if(dep > 0).alias("DEP_POSITIVE"),
        F.sum(F.when(arr > 0, arr)).alias("ARR_POSITIVE_MIN"),
        F.count_if(arr > 0).alias("ARR_POSITIVE"),
        F.sum("DISTANCE").alias("MILES"),
        F.count("DISTANCE").alias("MILES_KNOWN"),
        *[F.sum(cause).alias(cause) for cause in CAUSES],
        *[F.count_if(late & (F.col(cause) > 0)).alias(f"LATE_{cause}") for cause in CAUSES],
        *[F.sum(F.when(late, F.col(cause))).alias(f"LATE_{cause}_MIN") for cause in CAUSES],
    )


def ratio(part: str, whole: str, keep: Column | None = None) -> Column:
    """Rounded mean as a ratio of summed cells."""
    def summed(name: str) -> Column:
        return F.sum(name if keep is None else F.when(keep, F.col(name)))

    return F.round(summed(part) / F.nullif(summed(whole), F.lit(0)), 2)


def flown(cells: DataFrame) -> DataFrame:
    return cells.where(~F.col("IS_CANCELLED"))


def delay_trends_monthly(cells: DataFrame) -> DataFrame:
    def share(cause: str) -> Column:
        return percent(F.sum(cause), F.sum("DEP_MIN")).alias(f"{cause}_SHARE")

    return (
        flown(cells)
        .groupBy("YEAR", "MONTH")
        .agg(
            F.sum("N").alias("TOTAL_FLIGHTS"),
            F.sum("DEP_LATE").alias("TOTAL_DELAYED"),
            F.lit(0).cast("bigint").alias("TOTAL_CANCELLED"),
            percent(F.sum("DEP_LATE"), F.sum("N")).alias("DELAY_RATE"),
            ratio("DEP_POSITIVE_MIN", "DEP_POSITIVE").alias("AVG_DEP_DELAY_MIN"),
            ratio("ARR_POSITIVE_MIN", "ARR_POSITIVE").alias("AVG_ARR_DELAY_MIN"),
            share("CARRIER_DELAY"),
            share("WEATHER_DELAY"),
            share("NAS_DELAY"),
        )
    )


def airline_performance(cells: DataFrame) -> DataFrame:
    cancelled = F.sum(F.when(F.col("IS_CANCELLED"), F.col("N")).otherwise(0))
    counts = {
        "DELAYED_FLIGHTS": F.sum("DEP_LATE"),
        "CANCELLED_FLIGHTS": cancelled,
        "ON_TIME_FLIGHTS": F.sum("ON_TIME"),
    }
    rates = zip(["DELAY_RATE", "CANCEL_RATE", "ON_TIME_RATE"], counts.values())
    operated = ~F.col("IS_CANCELLED")
    return cells.groupBy("YEAR", "MONTH", "AIRLINE_CODE").agg(
        F.sum("N").alias("TOTAL_FLIGHTS"),
        *[count.alias(name) for name, count in counts.items()],
        *[percent(count, F.sum("N")).alias(name) for name, count in rates],
        ratio("DEP_POSITIVE_MIN", "DEP_POSITIVE", operated).alias("AVG_DEP_DELAY_MIN"),
        ratio("ARR_POSITIVE_MIN", "ARR_POSITIVE", operated).alias("AVG_ARR_DELAY_MIN"),
    )


def airport_stats(cells: DataFrame) -> DataFrame:
    place = [F.col("ORIGIN").alias("AIRPORT"), F.col("ORIGIN_CITY").alias("CITY"), F.col("ORIGIN_STATE").alias("STATE")]
    departures = cells.groupBy("YEAR", "MONTH", *place).agg(
        F.sum("N").alias("DEP_FLIGHTS"),
        F.sum("DEP_LATE").alias("DEP_DELAYED"),
        F.sum(F.when(F.col("IS_CANCELLED"), F.col("N")).otherwise(0)).alias("DEP_CANCELLED"),
        ratio("DEP_POSITIVE_MIN", "DEP_POSITIVE").alias("AVG_DEP_DELAY_MIN"),
    )
    arrivals = (
        flown(cells)
        .groupBy("YEAR", "MONTH", F.col("DEST").alias("AIRPORT"))
        .agg(
            F.sum("N").alias("ARR_FLIGHTS"),
            F.sum("ARR_LATE").alias("ARR_DELAYED"),
            ratio("ARR_POSITIVE_MIN", "ARR_POSITIVE").alias("AVG_ARR_DELAY_MIN"),
        )
    )
    return departures.join(arrivals, ["YEAR", "MONTH", "AIRPORT"], "left").select(
        "YEAR", "MONTH", "AIRPORT", "CITY", "STATE", "DEP_FLIGHTS", "ARR_FLIGHTS",
        "DEP_DELAYED", "ARR_DELAYED", "DEP_CANCELLED", "AVG_DEP_DELAY_MIN", "AVG_ARR_DELAY_MIN",
        percent("DEP_DELAYED", "DEP_FLIGHTS").alias("DEP_DELAY_RATE"),
        percent("ARR_DELAYED", "ARR_FLIGHTS").alias("ARR_DELAY_RATE"),
    )


def delay_cause_breakdown(cells: DataFrame) -> DataFrame:
    return (
        flown(cells)
        .where(F.col("DEP_LATE") > 0)
        .groupBy("YEAR", "MONTH")
        .agg(
            *[F.sum(f"LATE_{cause}").alias(f"{cause}_FLIGHTS") for cause in CAUSES],
            *[
                F.round(F.coalesce(F.sum(f"LATE_{cause}_MIN"), F.lit(0.0)), 2).alias(f"{cause}_TOTAL_MIN")
                for cause in CAUSES
            ],
        )
    )


def route_performance(cells: DataFrame, min_flights: int = MIN_ROUTE_FLIGHTS) -> DataFrame:
    routes = (
        flown(cells)
        .groupBy("YEAR", "MONTH", "ORIGIN", "DEST")
        .agg(
            F.sum("N").alias("TOTAL_FLIGHTS"),
            F.sum("DEP_LATE").alias("DELAYED_FLIGHTS"),
            percent(F.sum("DEP_LATE"), F.sum("N")).alias("DELAY_RATE"),
            ratio("DEP_POSITIVE_MIN", "DEP_POSITIVE").alias("AVG_DEP_DELAY_MIN"),
            ratio("MILES", "MILES_KNOWN").alias("AVG_DISTANCE"),
        )
    )
    return routes.where(F.col("TOTAL_FLIGHTS") >= min_flights).select(
        "YEAR", "MONTH", "ORIGIN", "DEST", F.concat("ORIGIN", F.lit("-"), "DEST").alias("ROUTE"),
        "TOTAL_FLIGHTS", "DELAYED_FLIGHTS", "DELAY_RATE", "AVG_DEP_DELAY_MIN", "AVG_DISTANCE",
    )
