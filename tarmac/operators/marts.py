"""The eight aggregate tables.

Signature: ``name(flights, target_date=None)``.  A date narrows the input to its
month (its day for the daily trend), so an incremental run reads one partition.
Every aggregate is a hash aggregate with a partial step before the shuffle.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.dims import CAUSE_LABELS
from tarmac.functions.measures import percent, positive_mean
from tarmac.sources.tables import has_values

MIN_ROUTE_FLIGHTS = 10


def in_month(flights: DataFrame, date: dt.date | None) -> DataFrame:
    if date is None:
        return flights
    return flights.where((F.col("YEAR") == date.year) & (F.col("MONTH") == date.month))


def flown(flights: DataFrame) -> DataFrame:
    """Flights known not to be cancelled; an unknown flag drops out too."""
    return flights.where(~F.col("IS_CANCELLED"))


def flights_counted() -> Column:
    return F.count(F.lit(1))


def trend_measures(total: Column | None = None) -> list[Column]:
    total = flights_counted() if total is None else total

    def share(cause: str) -> Column:
        return percent(F.sum(cause), F.sum("DEP_DELAY_MIN"))

    return [
        total.alias("TOTAL_FLIGHTS"),
        F.count_if("IS_DEP_DELAYED").alias("TOTAL_DELAYED"),
        F.count_if("IS_CANCELLED").alias("TOTAL_CANCELLED"),
        percent(F.count_if("IS_DEP_DELAYED"), total).alias("DELAY_RATE"),
        positive_mean("DEP_DELAY_MIN").alias("AVG_DEP_DELAY_MIN"),
        positive_mean("ARR_DELAY_MIN").alias("AVG_ARR_DELAY_MIN"),
        share("CARRIER_DELAY").alias("CARRIER_DELAY_SHARE"),
        share("WEATHER_DELAY").alias("WEATHER_DELAY_SHARE"),
        share("NAS_DELAY").alias("NAS_DELAY_SHARE"),
    ]


def trend(flights: DataFrame, keys: list[str], count_cancelled: bool) -> DataFrame:
    """Trend measures of flown flights; ``count_cancelled`` counts the cancelled ones in the same pass.

    Cancelled flights then stay in the groups with their measures blanked, and
    a group without a flown flight is left out as ever.
    """
    if not count_cancelled:
        return flown(flights).groupBy(*keys).agg(*trend_measures())
    operated = ~F.col("IS_CANCELLED")
    names = [f.name for f in flights.schema.fields if f.name not in (*keys, "IS_CANCELLED")]
    blanked = flights.withColumns({name: F.when(operated, F.col(name)) for name in names})
    return blanked.groupBy(*keys).agg(*trend_measures(F.count_if(operated))).where("TOTAL_FLIGHTS > 0")


def delay_trends_monthly(
    flights: DataFrame, target_date: dt.date | None = None, count_cancelled: bool = False
) -> DataFrame:
    """By year and month.  TOTAL_CANCELLED is zero by construction: cancelled
    flights are filtered out first.  ``count_cancelled`` gives the real count."""
    return trend(in_month(flights, target_date), ["YEAR", "MONTH"], count_cancelled)


def delay_trends_daily(
    flights: DataFrame, target_date: dt.date | None = None, count_cancelled: bool = False
) -> DataFrame:
    if target_date is not None:
        flights = flights.where(F.col("FLIGHT_DATE") == F.lit(target_date))
    return trend(flights, ["FLIGHT_DATE"], count_cancelled)


def airline_performance(flights: DataFrame, target_date: dt.date | None = None) -> DataFrame:
    """By year, month, airline; cancelled flights stay in the denominator."""
    on_time = ~F.col("IS_DEP_DELAYED") & ~F.col("IS_CANCELLED")
    operated = ~F.col("IS_CANCELLED")
    counts = {
        "DELAYED_FLIGHTS": F.count_if("IS_DEP_DELAYED"),
        "CANCELLED_FLIGHTS": F.count_if("IS_CANCELLED"),
        "ON_TIME_FLIGHTS": F.count_if(on_time),
    }
    rates = zip(["DELAY_RATE", "CANCEL_RATE", "ON_TIME_RATE"], counts.values())
    return (
        in_month(flights, target_date)
        .groupBy("YEAR", "MONTH", "AIRLINE_CODE")
        .agg(
            flights_counted().alias("TOTAL_FLIGHTS"),
            *[count.alias(name) for name, count in counts.items()],
            *[percent(count, flights_counted()).alias(name) for name, count in rates],
            positive_mean("DEP_DELAY_MIN", operated).alias("AVG_DEP_DELAY_MIN"),
            positive_mean("ARR_DELAY_MIN", operated).alias("AVG_ARR_DELAY_MIN"),
        )
    )


def airport_stats(flights: DataFrame, target_date: dt.date | None = None) -> DataFrame:
    """Departures with the arrivals of their airport and month, from one scan.

    A flight is a row at each end; departures include cancelled flights,
    arrivals do not.  The ends meet after they have been aggregated, as rows of
    one airport and month.
    """
    flights = in_month(flights, target_date)
    nowhere = F.lit(None).cast("string")
    ends = F.array(
        F.struct(
            F.lit("dep").alias("END"), F.col("ORIGIN").alias("AIRPORT"), F.col("ORIGIN_CITY").alias("CITY"),
            F.col("ORIGIN_STATE").alias("STATE"), F.col("IS_DEP_DELAYED").alias("LATE"), F.col("DEP_DELAY_MIN").alias("MINUTES"),
        ),
        F.struct(
            F.lit("arr").alias("END"), F.col("DEST").alias("AIRPORT"), nowhere.alias("CITY"),
            nowhere.alias("STATE"), F.col("IS_ARR_DELAYED").alias("LATE"), F.col("ARR_DELAY_MIN").alias("MINUTES"),
        ),
    )
    rows = flights.select("YEAR", "MONTH", "IS_CANCELLED", F.inline(ends))
    counted = (
        rows.where((F.col("END") == "dep") | ~F.col("IS_CANCELLED"))
        .groupBy("YEAR", "MONTH", "AIRPORT", "CITY", "STATE", "END")
        .agg(
            flights_counted().alias("FLIGHTS"),
            F.count_if("LATE").alias("DELAYED"),
            F.count_if("IS_CANCELLED").alias("DEP_CANCELLED"),
            positive_mean("MINUTES").alias("MEAN_MIN"),
        )
    )
    place = Window.partitionBy("YEAR", "MONTH", "AIRPORT")
    known = F.col("YEAR").isNotNull() & F.col("MONTH").isNotNull() & F.col("AIRPORT").isNotNull()
    arrived = {"ARR_FLIGHTS": "FLIGHTS", "ARR_DELAYED": "DELAYED", "AVG_ARR_DELAY_MIN": "MEAN_MIN"}
    both = counted.withColumns(
        {name: F.max(F.when((F.col("END") == "arr") & known, F.col(of))).over(place) for name, of in arrived.items()}
    ).where(F.col("END") == "dep")
    both = both.withColumnsRenamed({"FLIGHTS": "DEP_FLIGHTS", "DELAYED": "DEP_DELAYED", "MEAN_MIN": "AVG_DEP_DELAY_MIN"})
    return both.select(
        "YEAR", "MONTH", "AIRPORT", "CITY", "STATE", "DEP_FLIGHTS", "ARR_FLIGHTS",
        "DEP_DELAYED", "ARR_DELAYED", "DEP_CANCELLED", "AVG_DEP_DELAY_MIN", "AVG_ARR_DELAY_MIN",
        percent("DEP_DELAYED", "DEP_FLIGHTS").alias("DEP_DELAY_RATE"),
        percent("ARR_DELAYED", "ARR_FLIGHTS").alias("ARR_DELAY_RATE"),
    )


def delay_cause_breakdown(flights: DataFrame, target_date: dt.date | None = None) -> DataFrame:
    """By year and month over delayed flights: flights and minutes per cause."""
    causes = [name.removesuffix("_TOTAL_MIN") for name, _ in CAUSE_LABELS]
    delayed = flown(in_month(flights, target_date)).where("IS_DEP_DELAYED")
    return delayed.groupBy("YEAR", "MONTH").agg(
        *[F.count_if(F.col(cause) > 0).alias(f"{cause}_FLIGHTS") for cause in causes],
        *[F.round(F.sum(F.coalesce(cause, F.lit(0.0))), 2).alias(f"{cause}_TOTAL_MIN") for cause in causes],
    )


def route_performance(
    flights: DataFrame, target_date: dt.date | None = None, min_flights: int = MIN_ROUTE_FLIGHTS
) -> DataFrame:
    """By year, month and route; routes with few flights are left out."""
    routes = (
        flown(in_month(flights, target_date))
        .groupBy("YEAR", "MONTH", "ORIGIN", "DEST")
        .agg(
            flights_counted().alias("TOTAL_FLIGHTS"),
            F.count_if("IS_DEP_DELAYED").alias("DELAYED_FLIGHTS"),
            percent(F.count_if("IS_DEP_DELAYED"), flights_counted()).alias("DELAY_RATE"),
            positive_mean("DEP_DELAY_MIN").alias("AVG_DEP_DELAY_MIN"),
            F.round(F.avg("DISTANCE"), 2).alias("AVG_DISTANCE"),
        )
    )
    return routes.where(F.col("TOTAL_FLIGHTS") >= min_flights).select(
        "YEAR", "MONTH", "ORIGIN", "DEST", F.concat("ORIGIN", F.lit("-"), "DEST").alias("ROUTE"),
        "TOTAL_FLIGHTS", "DELAYED_FLIGHTS", "DELAY_RATE", "AVG_DEP_DELAY_MIN", "AVG_DISTANCE",
    )


def airport_nas_status(nas: DataFrame) -> DataFrame:
    """By date and airport over rows with a delay."""
    return (
        nas.where("HAS_DELAY")
        .dropna(subset=["FETCH_DATE", "IATA_CODE"])
        .groupBy("FETCH_DATE", "IATA_CODE")
        .agg(
            F.count_distinct("DELAY_TYPE").alias("DELAY_PROGRAMS"),
            F.max("AVG_DELAY_MIN").alias("MAX_AVG_DELAY_MIN"),
            F.bool_or(F.col("DELAY_TYPE") == "GroundDelay").alias("HAS_GROUND_DELAY"),
            F.bool_or(F.col("DELAY_TYPE") == "GroundStop").alias("HAS_GROUND_STOP"),
        )
    )


def weather_delay_correlation(flights: DataFrame) -> DataFrame:
    """By year, month and origin, over flights with origin weather.

    Delay means count every flight, zeros included; DELAY_RATE is a fraction.
    """
    return (
        flown(flights)
        .where(F.col("ORIGIN_TEMP_C").isNotNull())
        .groupBy("YEAR", "MONTH", F.col("ORIGIN").alias("IATA_CODE"))
        .agg(
            F.avg("ORIGIN_TEMP_C").alias("AVG_TEMP_C"),
            F.avg("ORIGIN_WIND_SPEED_KMH").alias("AVG_WIND_SPEED_KMH"),
            F.avg("ORIGIN_VISIBILITY_M").alias("AVG_VISIBILITY_M"),
            F.count_if(F.col("ORIGIN_SNOWFALL_CM") > 0).alias("SNOW_FLIGHT_COUNT"),
            F.avg("DEP_DELAY_MIN").alias("AVG_DEP_DELAY_MIN"),
            F.avg(F.col("IS_DEP_DELAYED").cast("int")).alias("DELAY_RATE"),
        )
    )


def weather_ready(flights: DataFrame) -> bool:
    """Whether the weather mart has input: column present and some row filled."""
    return has_values(flights, "ORIGIN_TEMP_C")
