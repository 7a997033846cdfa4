"""On-time rows: rename, type, clean, and project to the staging shape."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.functions.clock import iso_date
from tarmac.functions.text import blank_to_null
from tarmac.operators.keys import one_per_rare_key
from tarmac.schemas import (
    FLIGHT_CORE_COLUMNS,
    FLIGHT_DELAY_COLUMNS,
    FLIGHT_TEXT_COLUMNS,
    FLIGHT_TYPES,
    RENAMES,
)
from tarmac.session import wide

SOURCE_TAG = "BTS"  # fixed value

# Staging name of a raw column, where it differs.
STAGING_NAMES = {
    "IATA_CODE_REPORTING_AIRLINE": "AIRLINE_CODE",
    "ORIGIN_CITY_NAME": "ORIGIN_CITY",
    "DEST_CITY_NAME": "DEST_CITY",
    "CRS_DEP_TIME": "SCHEDULED_DEP",
    "DEP_TIME": "ACTUAL_DEP",
    "DEP_DELAY_MINUTES": "DEP_DELAY_MIN",
    "CRS_ARR_TIME": "SCHEDULED_ARR",
    "ARR_TIME": "ACTUAL_ARR",
    "ARR_DELAY_MINUTES": "ARR_DELAY_MIN",
    "CANCELLATION_CODE": "CANCEL_CODE",
    "CRS_ELAPSED_TIME": "SCHEDULED_ELAPSED",
    "ACTUAL_ELAPSED_TIME": "ACTUAL_ELAPSED",
}
FLAGS = {
    "IS_DEP_DELAYED": "DEP_DEL15",
    "IS_ARR_DELAYED": "ARR_DEL15",
    "IS_CANCELLED": "CANCELLED",
    "IS_DIVERTED": "DIVERTED",
}


def rename_columns(rows: DataFrame) -> DataFrame:
    """Source names → internal names; absent names are skipped."""
    return wide(rows).withColumnsRenamed(RENAMES)


def known_columns(rows: DataFrame) -> DataFrame:
    """The known columns that exist, in table order."""
    return rows.select([name for name in FLIGHT_TYPES if name in rows.columns])


def typed(name: str) -> Column:
    """Cast one text column; text that does not fit becomes NULL.

    Integers arrive as "0.00", so they pass through double.
    """
    value, kind = F.col(name), FLIGHT_TYPES[name]
    if kind == "int":
        value = value.try_cast("double").try_cast("int")
    elif kind == "double":
        value = value.try_cast("double")
    elif kind == "date":
        value = iso_date(value)
    return value.alias(name)


def cast_columns(rows: DataFrame) -> DataFrame:
    return wide(rows).select([typed(name) for name in rows.columns])


def with_core_keys(rows: DataFrame) -> DataFrame:
    """Rows that have airline, date, origin and destination.

    Runs before trimming: a key of blanks only is still a key here.
    """
    return rows.dropna(subset=FLIGHT_CORE_COLUMNS)


def trim_text(rows: DataFrame) -> DataFrame:
    """Trim the text columns and turn blanks into NULL."""
    present = [name for name in FLIGHT_TEXT_COLUMNS if name in rows.columns]
    return rows.withColumns({name: blank_to_null(F.trim(name)) for name in present})


def void_cancelled_delays(rows: DataFrame) -> DataFrame:
    """NULL delay columns on cancelled flights; a NULL flag leaves them alone."""
    present = [name for name in FLIGHT_DELAY_COLUMNS if name in rows.columns]
    cancelled = F.coalesce(F.col("CANCELLED") == 1, F.lit(False))
    return rows.withColumns({name: F.when(~cancelled, F.col(name)) for name in present})


def tag_source(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"_SOURCE": F.lit(SOURCE_TAG), "_LOAD_TS": F.current_timestamp()})


def clean_flights(source: DataFrame) -> DataFrame:
    """Source rows → raw-layer rows, without the load clock."""
    rows = cast_columns(known_columns(rename_columns(source)))
    return void_cancelled_delays(trim_text(with_core_keys(rows)))


def flight_id() -> Column:
    """airline_number_yyyyMMdd_origin_dest with placeholders for missing parts."""
    # The placeholders XX, 0 and XXX.
    return F.concat_ws(
        "_",
        F.coalesce("IATA_CODE_REPORTING_AIRLINE", F.lit("XX")),
        F.coalesce("FLIGHT_NUMBER", F.lit("0")),
        F.date_format("FLIGHT_DATE", "yyyyMMdd"),
        F.coalesce("ORIGIN", F.lit("XXX")),
        F.coalesce("DEST", F.lit("XXX")),
    )


def staging_flights(raw: DataFrame, source_tag: str = SOURCE_TAG) -> DataFrame:
    """Raw-layer rows → the staging columns, flags as booleans."""
    raw_names = {staging: name for name, staging in STAGING_NAMES.items()}
    listing = [
        "FLIGHT_DATE", "YEAR", "MONTH", "DAY_OF_MONTH", "DAY_OF_WEEK", "QUARTER",
        "AIRLINE_CODE", "FLIGHT_NUMBER", "TAIL_NUMBER",
        "ORIGIN", "ORIGIN_CITY", "ORIGIN_STATE", "DEST", "DEST_CITY", "DEST_STATE",
        "SCHEDULED_DEP", "ACTUAL_DEP", "DEP_DELAY_MIN", "IS_DEP_DELAYED",
        "SCHEDULED_ARR", "ACTUAL_ARR", "ARR_DELAY_MIN", "IS_ARR_DELAYED",
        "IS_CANCELLED", "CANCEL_CODE", "IS_DIVERTED",
        "SCHEDULED_ELAPSED", "ACTUAL_ELAPSED", "AIR_TIME", "DISTANCE",
        "CARRIER_DELAY", "WEATHER_DELAY", "NAS_DELAY", "SECURITY_DELAY", "LATE_AIRCRAFT_DELAY",
    ]

    def staged(name: str) -> Column:
        value = F.col(FLAGS[name]) == 1 if name in FLAGS else F.col(raw_names.get(name, name))
        return value.alias(name)

    return wide(raw).select(flight_id().alias("FLIGHT_ID"), *map(staged, listing), F.lit(source_tag).alias("DATA_SOURCE"))


def stamp_load(rows: DataFrame) -> DataFrame:
    return rows.withColumn("_LOAD_TS", F.current_timestamp())


def deduplicate_flights(flights: DataFrame) -> DataFrame:
    """One row per FLIGHT_ID; not part of the default load.

    The id is nearly unique, so rows of ids that occur once stay where they
    are.  The rows are read several times: pass a stored table.
    """
    return one_per_rare_key(flights, "FLIGHT_ID")
