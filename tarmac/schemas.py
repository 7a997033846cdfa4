"""Declared schemas.  No source infers one."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

TYPES = {
    "string": StringType(),
    "int": IntegerType(),
    "bigint": LongType(),
    "double": DoubleType(),
    "boolean": BooleanType(),
    "date": DateType(),
    "timestamp": TimestampType(),
    "timestamp_ntz": TimestampNTZType(),
}


def columns(listing: str) -> StructType:
    """``"A int, B string"`` as a schema, without a running session."""
    pairs = [part.split() for part in listing.split(",")]
    return StructType([StructField(name, TYPES[kind]) for name, kind in pairs])


# On-time source column, internal name, internal type.
FLIGHT_SOURCE_COLUMNS = [
    ("Year", "YEAR", "int"),
    ("Quarter", "QUARTER", "int"),
    ("Month", "MONTH", "int"),
    ("DayofMonth", "DAY_OF_MONTH", "int"),
    ("DayOfWeek", "DAY_OF_WEEK", "int"),
    ("FlightDate", "FLIGHT_DATE", "date"),
    ("Reporting_Airline", "REPORTING_AIRLINE", "string"),
    ("IATA_CODE_Reporting_Airline", "IATA_CODE_REPORTING_AIRLINE", "string"),
    ("Tail_Number", "TAIL_NUMBER", "string"),
    ("Flight_Number_Reporting_Airline", "FLIGHT_NUMBER", "string"),
    ("OriginAirportID", "ORIGIN_AIRPORT_ID", "int"),
    ("Origin", "ORIGIN", "string"),
    ("OriginCityName", "ORIGIN_CITY_NAME", "string"),
    ("OriginState", "ORIGIN_STATE", "string"),
    ("OriginStateName", "ORIGIN_STATE_NAME", "string"),
    ("DestAirportID", "DEST_AIRPORT_ID", "int"),
    ("Dest", "DEST", "string"),
    ("DestCityName", "DEST_CITY_NAME", "string"),
    ("DestState", "DEST_STATE", "string"),
    ("DestStateName", "DEST_STATE_NAME", "string"),
    ("CRSDepTime", "CRS_DEP_TIME", "int"),
    ("DepTime", "DEP_TIME", "double"),
    ("DepDelay", "DEP_DELAY", "double"),
    ("DepDelayMinutes", "DEP_DELAY_MINUTES", "double"),
    ("DepDel15", "DEP_DEL15", "int"),
    ("TaxiOut", "TAXI_OUT", "double"),
    ("WheelsOff", "WHEELS_OFF", "double"),
    ("WheelsOn", "WHEELS_ON", "double"),
    ("TaxiIn", "TAXI_IN", "double"),
    ("CRSArrTime", "CRS_ARR_TIME", "int"),
    ("ArrTime", "ARR_TIME", "double"),
    ("ArrDelay", "ARR_DELAY", "double"),
    ("ArrDelayMinutes", "ARR_DELAY_MINUTES", "double"),
    ("ArrDel15", "ARR_DEL15", "int"),
    ("Cancelled", "CANCELLED", "int"),
    ("CancellationCode", "CANCELLATION_CODE", "string"),
    ("Diverted", "DIVERTED", "int"),
    ("CRSElapsedTime", "CRS_ELAPSED_TIME", "double"),
    ("ActualElapsedTime", "ACTUAL_ELAPSED_TIME", "double"),
    ("AirTime", "AIR_TIME", "double"),
    ("Flights", "FLIGHTS", "int"),
    ("Distance", "DISTANCE", "double"),
    ("DistanceGroup", "DISTANCE_GROUP", "int"),
    ("CarrierDelay", "CARRIER_DELAY", "double"),
    ("WeatherDelay", "WEATHER_DELAY", "double"),
    ("NASDelay", "NAS_DELAY", "double"),
    ("SecurityDelay", "SECURITY_DELAY", "double"),
    ("LateAircraftDelay", "LATE_AIRCRAFT_DELAY", "double"),
]

# Text columns that are trimmed and blank-checked, delay columns
# voided on cancelled flights, columns a flight must have.
FLIGHT_TEXT_COLUMNS = [
    "REPORTING_AIRLINE",
    "IATA_CODE_REPORTING_AIRLINE",
    "TAIL_NUMBER",
    "FLIGHT_NUMBER",
    "ORIGIN",
    "DEST",
    "CANCELLATION_CODE",
]
FLIGHT_DELAY_COLUMNS = ["DEP_DELAY", "ARR_DELAY", "DEP_DELAY_MINUTES", "ARR_DELAY_MINUTES"]
FLIGHT_CORE_COLUMNS = ["IATA_CODE_REPORTING_AIRLINE", "FLIGHT_DATE", "ORIGIN", "DEST"]

RENAMES = {source: name for source, name, _ in FLIGHT_SOURCE_COLUMNS}
FLIGHT_TYPES = {name: kind for _, name, kind in FLIGHT_SOURCE_COLUMNS}

SOURCE_CSV = StructType([StructField(source, StringType()) for source, _, _ in FLIGHT_SOURCE_COLUMNS])

RAW_FLIGHTS = columns(
    ", ".join(f"{name} {kind}" for name, kind in FLIGHT_TYPES.items()) + ", _LOAD_TS timestamp, _SOURCE string"
)

STAGING_FLIGHTS = columns(
    "FLIGHT_ID string, FLIGHT_DATE date, YEAR int, MONTH int, DAY_OF_MONTH int, DAY_OF_WEEK int, QUARTER int,"
    " AIRLINE_CODE string, FLIGHT_NUMBER string, TAIL_NUMBER string,"
    " ORIGIN string, ORIGIN_CITY string, ORIGIN_STATE string, DEST string, DEST_CITY string, DEST_STATE string,"
    " SCHEDULED_DEP int, ACTUAL_DEP double, DEP_DELAY_MIN double, IS_DEP_DELAYED boolean,"
    " SCHEDULED_ARR int, ACTUAL_ARR double, ARR_DELAY_MIN double, IS_ARR_DELAYED boolean,"
    " IS_CANCELLED boolean, CANCEL_CODE string, IS_DIVERTED boolean,"
    " SCHEDULED_ELAPSED double, ACTUAL_ELAPSED double, AIR_TIME double, DISTANCE double,"
    " CARRIER_DELAY double, WEATHER_DELAY double, NAS_DELAY double, SECURITY_DELAY double,"
    " LATE_AIRCRAFT_DELAY double, DATA_SOURCE string, _LOAD_TS timestamp"
)

# Weather columns the two weather joins add to a flight.
FLIGHT_WEATHER = columns(
    "ORIGIN_TEMP_C double, ORIGIN_PRECIP_MM double, ORIGIN_SNOWFALL_CM double, ORIGIN_WIND_SPEED_KMH double,"
    " ORIGIN_WIND_GUST_KMH double, ORIGIN_VISIBILITY_M double, ORIGIN_CLOUD_COVER_PCT double,"
    " ORIGIN_WEATHER_CODE int, DEST_TEMP_C double, DEST_PRECIP_MM double, DEST_WIND_SPEED_KMH double,"
    " DEST_VISIBILITY_M double, DEST_WEATHER_CODE int"
)

# One line of a delay-program snapshot; times arrive as text.
NAS_SNAPSHOT = columns(
    "SNAPSHOT_TS string, FETCH_DATE string, IATA_CODE string, HAS_DELAY boolean, DELAY_COUNT int,"
    " DELAY_TYPE string, REASON string, AVG_DELAY_MIN int, MIN_DELAY_MIN int, MAX_DELAY_MIN int,"
    " TREND string, END_TIME string, WEATHER_TEMP_F double, WEATHER_VIS_MI double,"
    " WEATHER_WIND string, WEATHER_CONDITION string"
)
NAS_STATUS = columns(
    "SNAPSHOT_TS timestamp_ntz, FETCH_DATE date, IATA_CODE string, HAS_DELAY boolean, DELAY_COUNT int,"
    " DELAY_TYPE string, REASON string, AVG_DELAY_MIN int, MIN_DELAY_MIN int, MAX_DELAY_MIN int,"
    " TREND string, END_TIME string, WEATHER_TEMP_F double, WEATHER_VIS_MI double,"
    " WEATHER_WIND string, WEATHER_CONDITION string, _LOAD_TS timestamp"
)

# Hourly array in the weather document, output column, output type.
HOURLY_FIELDS = [
    ("temperature_2m", "TEMP_C", "double"),
    ("precipitation", "PRECIP_MM", "double"),
    ("rain", "RAIN_MM", "double"),
    ("snowfall", "SNOWFALL_CM", "double"),
    ("snow_depth", "SNOW_DEPTH_CM", "double"),
    ("wind_speed_10m", "WIND_SPEED_KMH", "double"),
    ("wind_gusts_10m", "WIND_GUST_KMH", "double"),
    ("wind_direction_10m", "WIND_DIR_DEG", "double"),
    ("visibility", "VISIBILITY_M", "double"),
    ("cloud_cover", "CLOUD_COVER_PCT", "double"),
    ("weather_code", "WEATHER_CODE", "int"),
    ("pressure_msl", "PRESSURE_HPA", "double"),
]
HOURLY_ARRAYS = StructType(
    [StructField("time", ArrayType(StringType()))]
    + [StructField(field, ArrayType(DoubleType())) for field, _, _ in HOURLY_FIELDS]
)
WEATHER_DOCUMENT = StructType([StructField("iata_code", StringType()), StructField("hourly", HOURLY_ARRAYS)])
WEATHER_HOURLY = columns(
    "IATA_CODE string, OBS_TIMESTAMP string, OBS_DATE date, YEAR int, MONTH int, OBS_HOUR int, "
    + ", ".join(f"{name} {kind}" for _, name, kind in HOURLY_FIELDS)
    + ", _LOAD_TS timestamp"
)

# Landing tables for aircraft positions and flights; nothing reads them yet.
OPENSKY_STATES = columns(
    "FETCH_DATE date, ICAO24 string, CALLSIGN string, ORIGIN_COUNTRY string, TIME_POSITION bigint,"
    " LAST_CONTACT bigint, LONGITUDE double, LATITUDE double, BARO_ALTITUDE double, ON_GROUND boolean,"
    " VELOCITY double, TRUE_TRACK double, VERTICAL_RATE double, SQUAWK string, SPI boolean,"
    " POSITION_SOURCE int, _LOAD_TS timestamp"
)
OPENSKY_FLIGHTS = columns(
    "FETCH_DATE date, ICAO24 string, FIRST_SEEN bigint, EST_DEPARTURE_AIRPORT string, LAST_SEEN bigint,"
    " EST_ARRIVAL_AIRPORT string, CALLSIGN string, EST_DEPARTURE_AIRPORT_HORIZ_DIST int,"
    " EST_DEPARTURE_AIRPORT_VERT_DIST int, EST_ARRIVAL_AIRPORT_HORIZ_DIST int,"
    " EST_ARRIVAL_AIRPORT_VERT_DIST int, DEPARTURE_AIRPORT_CANDIDATES_COUNT int,"
    " ARRIVAL_AIRPORT_CANDIDATES_COUNT int, _LOAD_TS timestamp"
)

_TREND = (
    "TOTAL_FLIGHTS bigint, TOTAL_DELAYED bigint, TOTAL_CANCELLED bigint, DELAY_RATE double, AVG_DEP_DELAY_MIN double,"
    " AVG_ARR_DELAY_MIN double, CARRIER_DELAY_SHARE double, WEATHER_DELAY_SHARE double, NAS_DELAY_SHARE double"
)
_CAUSES = ["CARRIER_DELAY", "WEATHER_DELAY", "NAS_DELAY", "SECURITY_DELAY", "LATE_AIRCRAFT_DELAY"]

# Marts: columns as the operators give them, and the stamp of the refresh.
MARTS = {
    "delay_trends_monthly": f"YEAR int, MONTH int, {_TREND}",
    "delay_trends_daily": f"FLIGHT_DATE date, {_TREND}, YEAR int, MONTH int",
    "airline_performance": (
        "YEAR int, MONTH int, AIRLINE_CODE string, TOTAL_FLIGHTS bigint, DELAYED_FLIGHTS bigint, CANCELLED_FLIGHTS bigint,"
        " ON_TIME_FLIGHTS bigint, DELAY_RATE double, CANCEL_RATE double, ON_TIME_RATE double,"
        " AVG_DEP_DELAY_MIN double, AVG_ARR_DELAY_MIN double"
    ),
    "airport_stats": (
        "YEAR int, MONTH int, AIRPORT string, CITY string, STATE string, DEP_FLIGHTS bigint, ARR_FLIGHTS bigint,"
        " DEP_DELAYED bigint, ARR_DELAYED bigint, DEP_CANCELLED bigint, AVG_DEP_DELAY_MIN double,"
        " AVG_ARR_DELAY_MIN double, DEP_DELAY_RATE double, ARR_DELAY_RATE double"
    ),
    "delay_cause_breakdown": (
        "YEAR int, MONTH int, "
        + ", ".join(f"{cause}_FLIGHTS bigint" for cause in _CAUSES)
        + ", "
        + ", ".join(f"{cause}_TOTAL_MIN double" for cause in _CAUSES)
    ),
    "route_performance": (
        "YEAR int, MONTH int, ORIGIN string, DEST string, ROUTE string, TOTAL_FLIGHTS bigint, DELAYED_FLIGHTS bigint,"
        " DELAY_RATE double, AVG_DEP_DELAY_MIN double, AVG_DISTANCE double"
    ),
    "airport_nas_status": (
        "FETCH_DATE date, IATA_CODE string, DELAY_PROGRAMS bigint, MAX_AVG_DELAY_MIN int,"
        " HAS_GROUND_DELAY boolean, HAS_GROUND_STOP boolean"
    ),
    "weather_delay_correlation": (
        "YEAR int, MONTH int, IATA_CODE string, AVG_TEMP_C double, AVG_WIND_SPEED_KMH double, AVG_VISIBILITY_M double,"
        " SNOW_FLIGHT_COUNT bigint, AVG_DEP_DELAY_MIN double, DELAY_RATE double"
    ),
}

# Layer tables: schema and the columns a table is partitioned by on disk.
LAYER_TABLES = {
    "raw.on_time": (RAW_FLIGHTS, ["YEAR", "MONTH"]),
    "raw.nas_status": (NAS_STATUS, ["FETCH_DATE"]),
    "raw.airport_weather_hourly": (WEATHER_HOURLY, ["YEAR", "MONTH"]),
    "raw.opensky_states": (OPENSKY_STATES, ["FETCH_DATE"]),
    "raw.opensky_flights": (OPENSKY_FLIGHTS, ["FETCH_DATE"]),
    "staging.flights": (StructType(STAGING_FLIGHTS.fields + FLIGHT_WEATHER.fields), ["YEAR", "MONTH"]),
    **{
        f"analytics.{name}": (columns(f"{listing}, _UPDATED_TS timestamp"), ["YEAR", "MONTH"] if "YEAR int" in listing else [])
        for name, listing in MARTS.items()
    },
}
