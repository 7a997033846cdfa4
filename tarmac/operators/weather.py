"""Hourly weather: flatten documents, then join to flights at both ends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac import dims
from tarmac.functions.clock import arrival_date, clock_hour, iso_date
from tarmac.operators.keys import one_per_key
from tarmac.schemas import HOURLY_ARRAYS, HOURLY_FIELDS
from tarmac.sources.tables import add_missing_columns

ORIGIN_FIELDS = [
    "TEMP_C", "PRECIP_MM", "SNOWFALL_CM", "WIND_SPEED_KMH",
    "WIND_GUST_KMH", "VISIBILITY_M", "CLOUD_COVER_PCT", "WEATHER_CODE",
]
DEST_FIELDS = ["TEMP_C", "PRECIP_MM", "WIND_SPEED_KMH", "VISIBILITY_M", "WEATHER_CODE"]


def explode_hours(documents: DataFrame) -> DataFrame:
    """Parallel hourly arrays → one row per hour; short or absent arrays give NULLs."""
    fields = [f.name for f in HOURLY_ARRAYS.fields]
    arrays = documents.select(
        "iata_code",
        *[F.coalesce(f"hourly.{f.name}", F.array().cast(f.dataType)).alias(f.name) for f in HOURLY_ARRAYS.fields],
    )
    return arrays.select("iata_code", F.inline(F.arrays_zip(*fields)))


def hourly_columns(hours: DataFrame) -> DataFrame:
    """Output names and types; date parts are cut from the local ISO text."""

    def part(start: int, length: int) -> Column:
        return F.substring("time", start, length)

    return hours.select(
        F.upper("iata_code").alias("IATA_CODE"),
        F.col("time").alias("OBS_TIMESTAMP"),
        iso_date(part(1, 10)).alias("OBS_DATE"),
        part(1, 4).try_cast("int").alias("YEAR"),
        part(6, 2).try_cast("int").alias("MONTH"),
        part(12, 2).try_cast("int").alias("OBS_HOUR"),
        *[F.col(field).try_cast(kind).alias(name) for field, name, kind in HOURLY_FIELDS],
    )


def with_time_and_airport(hours: DataFrame) -> DataFrame:
    return hours.dropna(subset=["OBS_TIMESTAMP", "IATA_CODE"])


def clean_weather(documents: DataFrame, year: int | None = None) -> DataFrame:
    """Documents → one row per airport and timestamp, optionally one year."""
    hours = with_time_and_airport(hourly_columns(explode_hours(documents)))
    if year is not None:
        hours = hours.where(F.col("YEAR") == year)
    return one_per_key(hours, ["IATA_CODE", "OBS_TIMESTAMP"])


HOUR_KEYS = {"_airport": "IATA_CODE", "_date": "OBS_DATE", "_hour": "OBS_HOUR"}


def first_observations(weather: DataFrame, fields: list[str]) -> DataFrame:
    """``_airport``, ``_date``, ``_hour`` and the fields, underscored, of the first observation in each hour."""
    first = weather.groupBy(*[F.col(name).alias(alias) for alias, name in HOUR_KEYS.items()]).agg(
        F.min(F.struct(*[name for name in ("OBS_TIMESTAMP",) if name in weather.columns], *fields)).alias("first")
    )
    return first.select(*HOUR_KEYS, *[F.col(f"first.{name}").alias(f"_{name}") for name in fields])


def filled_from(flights: DataFrame, obs: DataFrame, keys: Column, side: str, fields: list[str]) -> DataFrame:
    """Left join ``obs`` on ``keys``; fill only rows whose temperature is NULL."""
    matched = keys & F.col(f"{side}_TEMP_C").isNull()
    hit = F.col("_airport").isNotNull()
    joined = flights.join(obs, matched, "left")
    filled = {f"{side}_{name}": F.when(hit, F.col(f"_{name}")).otherwise(F.col(f"{side}_{name}")) for name in fields}
    return joined.withColumns(filled).select(flights.columns)


def fill_weather(
    flights: DataFrame, weather: DataFrame, side: str, fields: list[str], keys: list[Column], broadcast: bool = False
) -> DataFrame:
    """Left join on airport, date, hour; fill only rows whose temperature is NULL.

    Of several observations in one hour the first by timestamp counts (by value
    where there is none), so no flight is doubled.  Only the needed columns travel, and the aggregate leaves
    them partitioned as the join needs them.  Airport, date and hour together
    spread the flights; a key that is still hot is split by AQE's skew join.
    With ``broadcast`` the flights stay where they are; the caller has counted
    the observations.
    """
    airport, date, hour = keys
    matched = (airport == F.col("_airport")) & (date == F.col("_date")) & (hour == F.col("_hour"))
    first = first_observations(weather, fields)
    return filled_from(
        add_missing_columns(flights), F.broadcast(first) if broadcast else first, matched, side, fields
    )


def with_origin_weather(flights: DataFrame, weather: DataFrame, broadcast: bool = False) -> DataFrame:
    """Weather at the origin in the hour of scheduled departure."""
    keys = [F.col("ORIGIN"), F.col("FLIGHT_DATE"), clock_hour("SCHEDULED_DEP")]
    return fill_weather(flights, weather, "ORIGIN", ORIGIN_FIELDS, keys, broadcast)


def with_destination_weather(flights: DataFrame, weather: DataFrame, broadcast: bool = False) -> DataFrame:
    """Weather at the destination in the hour of scheduled arrival.

    Overnight flights look at the next day; a missing arrival counts as hour 0.
    """
    keys = [
        F.col("DEST"),
        arrival_date("FLIGHT_DATE", "SCHEDULED_DEP", "SCHEDULED_ARR"),
        clock_hour(F.coalesce("SCHEDULED_ARR", F.lit(0))),
    ]
    return fill_weather(flights, weather, "DEST", DEST_FIELDS, keys, broadcast)


def with_weather(flights: DataFrame, weather: DataFrame, broadcast: bool = False) -> DataFrame:
    return with_destination_weather(with_origin_weather(flights, weather, broadcast), weather, broadcast)


def fill_status(flights: DataFrame, since_year: int = 2025) -> DataFrame:
    """How many flights have weather at each end."""
    return flights.where(F.col("YEAR") >= since_year).agg(
        F.count(F.lit(1)).alias("TOTAL_FLIGHTS"),
        F.count("ORIGIN_TEMP_C").alias("ORIGIN_FILLED"),
        F.count("DEST_TEMP_C").alias("DEST_FILLED"),
        F.count_if(F.col("ORIGIN_TEMP_C").isNull()).alias("ORIGIN_NULL"),
    )


def with_coordinates(airports: DataFrame, column: str = "IATA_CODE") -> DataFrame:
    """Coordinates by code, ignoring case; unknown airports drop out."""
    sites = (
        dims.airports(airports.sparkSession)
        .where("HAS_COORDINATES")
        .select(F.col("IATA_CODE").alias("SITE_CODE"), "LATITUDE", "LONGITUDE", "TIME_ZONE")
    )
    return airports.join(F.broadcast(sites), F.upper(column) == F.col("SITE_CODE")).drop("SITE_CODE")


def fetch_grid(airports: DataFrame, first_year: int, last_year: int) -> DataFrame:
    """Airport × year: the weather documents that should exist."""
    years = F.sequence(F.lit(first_year), F.lit(last_year))
    return with_coordinates(airports).select("*", F.explode(years).alias("YEAR"))
