"""Stand-in tables of the engine's input shapes, derived from the given tables.

The expressions are plain SQL that Spark and DuckDB read alike; ``{DOW}`` is the
one spelling that differs.  See FIXTURES.md.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.functions.text import delay_minutes, delay_type
from tarmac.schemas import FLIGHT_SOURCE_COLUMNS, HOURLY_FIELDS
from tarmac.session import wide

AIRPORTS = "'ATLDFWDENORDLAXCLTLASPHXMCOSEA'"
NAS_AIRPORTS = "'ATLDFWDENORDLAXCLTLASPHXMCOSEAMEMONT'"
DOW = {"spark": "weekday(l_shipdate)+1", "duckdb": "isodow(l_shipdate)"}

LINEITEM = "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_returnflag l_shipdate".split()

HELPERS = {
    "ok": "CAST(s_nationkey % 10 AS INT)",
    "dk": "CAST(c_nationkey % 10 AS INT)",
    "canc": "CASE WHEN l_returnflag='R' AND l_linenumber=1 THEN 1 ELSE 0 END",
    "dv": "CASE WHEN l_returnflag='N' AND l_linenumber=7 THEN 1 ELSE 0 END",
    "depm": "GREATEST(l_quantity-30,0)*4",
    "arrm": "GREATEST(l_quantity-32+l_linenumber,0)*4",
    "ci": "CAST(l_linenumber % 5 AS INT)",
}


def _airport(key: str) -> str:
    return f"SUBSTR({AIRPORTS}, 3*{key}+1, 3)"


def _cause(main: int, side: int) -> str:
    return f"CASE WHEN canc=1 OR arrm<15 THEN NULL WHEN ci={main} THEN arrm-5 WHEN ci={side} THEN 5 ELSE 0 END"


ARRIVAL_HOUR = "((l_orderkey*7 + CAST(l_quantity AS INT) % 9 + 1) % 24)*100"
SPAN = "((ok*37+dk*53) % 50)"

FLIGHTS = {
    "FLIGHT_DATE": "CAST(l_shipdate AS DATE)",
    "YEAR": "CAST(EXTRACT(YEAR FROM l_shipdate) AS INT)",
    "MONTH": "CAST(EXTRACT(MONTH FROM l_shipdate) AS INT)",
    "DAY_OF_MONTH": "CAST(EXTRACT(DAY FROM l_shipdate) AS INT)",
    "DAY_OF_WEEK": "CAST({DOW} AS INT)",
    "QUARTER": "CAST(EXTRACT(QUARTER FROM l_shipdate) AS INT)",
    "AIRLINE_CODE": "CONCAT('C', CAST(l_suppkey % 14 AS VARCHAR(4)))",
    "FLIGHT_NUMBER": "CAST(l_partkey % 5 + 100 AS VARCHAR(9))",
    "TAIL_NUMBER": "CONCAT('N', CAST(l_suppkey AS VARCHAR(9)))",
    "ORIGIN": _airport("ok"),
    "ORIGIN_CITY": "CONCAT('City', CAST(ok AS VARCHAR(2)), ', S', CAST(ok % 4 AS VARCHAR(2)))",
    "ORIGIN_STATE": "CONCAT('S', CAST(ok % 4 AS VARCHAR(2)))",
    "DEST": _airport("dk"),
    "DEST_CITY": "CONCAT('City', CAST(dk AS VARCHAR(2)), ', S', CAST(dk % 4 AS VARCHAR(2)))",
    "DEST_STATE": "CONCAT('S', CAST(dk % 4 AS VARCHAR(2)))",
    "SCHEDULED_DEP": "CAST((l_orderkey*7 % 24)*100 + l_partkey % 60 AS INT)",
    "ACTUAL_DEP": "CASE WHEN canc=1 THEN NULL ELSE CAST((l_orderkey*7 % 24)*100 + l_partkey % 60 AS DOUBLE) END",
    "DEP_DELAY_MIN": "CASE WHEN canc=1 THEN NULL ELSE depm END",
    "IS_DEP_DELAYED": "CASE WHEN canc=1 THEN NULL ELSE depm >= 15 END",
    "SCHEDULED_ARR": f"CASE WHEN l_partkey % 101 = 0 THEN NULL ELSE CAST({ARRIVAL_HOUR} + l_partkey % 60 AS INT) END",
    "ACTUAL_ARR": f"CASE WHEN canc=1 THEN NULL ELSE CAST({ARRIVAL_HOUR} AS DOUBLE) END",
    "ARR_DELAY_MIN": "CASE WHEN canc=1 THEN NULL ELSE arrm END",
    "IS_ARR_DELAYED": "CASE WHEN canc=1 THEN NULL ELSE arrm >= 15 END",
    "IS_CANCELLED": "canc=1",
    "CANCEL_CODE": "CASE WHEN canc=1 THEN SUBSTR('ABCD', CAST(l_partkey % 4 + 1 AS INT), 1) END",
    "IS_DIVERTED": "dv=1",
    "SCHEDULED_ELAPSED": f"CAST(65 + {SPAN}*5 AS DOUBLE)",
    "ACTUAL_ELAPSED": f"CASE WHEN canc=1 THEN NULL ELSE CAST(65 + {SPAN}*5 AS DOUBLE) + arrm - depm END",
    "AIR_TIME": f"CASE WHEN canc=1 THEN NULL ELSE CAST(35 + {SPAN}*5 AS DOUBLE) END",
    "DISTANCE": f"CAST(200 + {SPAN}*40 AS DOUBLE)",
    "CARRIER_DELAY": _cause(0, 4),
    "WEATHER_DELAY": _cause(1, 0),
    "NAS_DELAY": _cause(2, 1),
    "SECURITY_DELAY": _cause(3, 2),
    "LATE_AIRCRAFT_DELAY": _cause(4, 3),
    "DATA_SOURCE": "'FX'",
}

# The flag columns, written once and shared by the string-typed source shape.
SOURCE_ROWS = {
    "Year": "CAST(CAST(EXTRACT(YEAR FROM l_shipdate) AS INT) AS VARCHAR(9))",
    "Month": "CAST(CAST(EXTRACT(MONTH FROM l_shipdate) AS INT) AS VARCHAR(9))",
    "FlightDate": "CASE WHEN l_partkey % 89 = 0 THEN NULL ELSE CAST(CAST(l_shipdate AS DATE) AS VARCHAR(10)) END",
    "IATA_CODE_Reporting_Airline": (
        "CASE WHEN l_partkey % 53 = 0 THEN NULL WHEN l_partkey % 59 = 0 THEN '  '"
        " ELSE CONCAT(' C', CAST(l_suppkey % 14 AS VARCHAR(4)), ' ') END"
    ),
    "Flight_Number_Reporting_Airline": (
        "CASE WHEN l_partkey % 61 = 0 THEN '' ELSE CAST(l_partkey % 5 + 100 AS VARCHAR(9)) END"
    ),
    "Origin": f"CONCAT({_airport('ok')}, ' ')",
    "Dest": f"CASE WHEN l_partkey % 67 = 0 THEN '   ' ELSE {_airport('dk')} END",
    "DepDelayMinutes": (
        "CASE WHEN l_partkey % 97 = 0 THEN 'n/a' ELSE CONCAT(CAST(CAST(depm AS INT) AS VARCHAR(9)), '.00') END"
    ),
    "DepDel15": "CASE WHEN canc=1 THEN NULL WHEN depm >= 15 THEN '1.00' ELSE '0.00' END",
    "Cancelled": "CASE WHEN canc=1 THEN '1.00' ELSE '0.00' END",
    "Unused_Extra": "'x'",
}



def _source_text(place: int, name: str, kind: str) -> str:
    """A rule for the source columns that need no shape of their own: padded, blank and absent text, decimal numbers."""
    if kind == "string":
        return (
            f"CASE WHEN l_partkey % {71 + place} = 0 THEN '  ' WHEN l_partkey % {131 + place} = 0 THEN NULL"
            f" ELSE CONCAT(' {name[:4]}', CAST(l_partkey % 9 AS VARCHAR(9)), ' ') END"
        )
    if kind == "int":
        return f"CASE WHEN l_partkey % {149 + place} = 0 THEN 'n/a' ELSE CONCAT(CAST((l_orderkey + {place}) % 28 + 1 AS VARCHAR(9)), '.00') END"
    return f"CASE WHEN l_partkey % {151 + place} = 0 THEN '' ELSE CONCAT(CAST(CAST(arrm AS INT) + {place} AS VARCHAR(9)), '.50') END"


SHAPED = set(SOURCE_ROWS)  # columns with an expression of their own
SOURCE_ROWS = {
    **{
        source: SOURCE_ROWS.get(source, _source_text(place, source, kind))
        for place, (source, _, kind) in enumerate(FLIGHT_SOURCE_COLUMNS)
    },
    "Unused_Extra": "'x'",
}


def _picked(text: str, index: str, texts: list[str]) -> str:
    """``text``, taken from its first few values where ``index`` is one of theirs; forming it anew takes most of the time."""
    listed = ", ".join(f"'{value}'" for value in texts)
    return f"COALESCE(get(array({listed}), CAST({index} AS INT)), {text})"


DELAY_TEXTS = 128  # minutes of the delays that most rows have


def _source_pick(place: int, name: str, kind: str) -> str:
    """``_source_text`` as Spark works it out: the same text for every row."""
    before, formed = _source_text(place, name, kind).removesuffix(" END").split(" ELSE ")
    if kind == "string":
        index, texts = "l_partkey % 9", [f" {name[:4]}{n} " for n in range(9)]
    elif kind == "int":
        index, texts = f"(l_orderkey + {place}) % 28", [f"{n + 1}.00" for n in range(28)]
    else:
        index, texts = "arrm", [f"{n + place}.50" for n in range(DELAY_TEXTS)]
    return f"{before} ELSE {_picked(formed, index, texts)} END"


SOURCE_ROWS_PICKED = SOURCE_ROWS | {
    source: _source_pick(place, source, kind)
    for place, (source, _, kind) in enumerate(FLIGHT_SOURCE_COLUMNS)
    if source not in SHAPED
}

MINUTES_TEXT = "CONCAT(CAST(CAST(FLOOR(value) AS INT) AS VARCHAR(9)),' minutes')"
NAS = {
    "event_id": "event_id",
    "SNAPSHOT_TS": "ts",
    "FETCH_DATE": "CAST(ts AS DATE)",
    "IATA_CODE": f"SUBSTR({NAS_AIRPORTS}, CAST(3*(user_id%12)+1 AS INT), 3)",
    "HAS_DELAY": "value >= 20",
    "TYPE_NAME": (
        "CASE WHEN value < 20 THEN NULL WHEN event_type='error' THEN 'Ground Stop Programs'"
        " WHEN event_type='click' THEN 'Ground Delay Programs'"
        " WHEN event_type='view' THEN 'General Arrival/Departure Delay Info'"
        " WHEN event_type='signup' THEN 'Airport Closures' ELSE 'Airspace Flow Programs' END"
    ),
    "AVG_TXT": (
        "CASE WHEN value < 20 THEN NULL WHEN event_id%7=0 THEN CAST(CAST(FLOOR(value) AS INT) AS VARCHAR(9))"
        " WHEN value>=60 THEN CONCAT(CAST(CAST(FLOOR(value/60) AS INT) AS VARCHAR(9)),' hour and ',"
        "CAST(CAST(FLOOR(value) AS INT)%60 AS VARCHAR(9)),' minutes')"
        f" WHEN event_id%11=0 THEN '0 minutes' ELSE {MINUTES_TEXT} END"
    ),
    "MAX_TXT": "CASE WHEN value < 20 THEN NULL ELSE CONCAT(CAST(CAST(FLOOR(value*2) AS INT) AS VARCHAR(9)),' min') END",
    "DELAY_COUNT": "CASE WHEN value < 20 THEN 0 ELSE CAST(event_id % 4 AS INT) END",
    "TREND": "CASE WHEN value < 20 THEN NULL WHEN event_id%3=0 THEN 'Increasing' ELSE 'Decreasing' END",
    "REASON": "props",
    "TEMP_TXT": "CONCAT(CAST(event_id%60-20 AS VARCHAR(9)), '.5 F (', CAST(event_id%40 AS VARCHAR(9)), ' C)')",
    "VIS_TXT": "CASE WHEN event_id%13=0 THEN 'unlimited' ELSE CONCAT(CAST(event_id%10 AS VARCHAR(9)), '.25 miles') END",
}

WEATHER = {
    "temperature_2m": "CAST((k*37+doy*3+h*5)%45-10 AS DOUBLE)",
    "precipitation": "CAST((k+h)%4 AS DOUBLE)",
    "rain": "CAST((k+h)%2 AS DOUBLE)",
    "snowfall": "CASE WHEN (k*37+doy*3+h*5)%45 < 5 THEN CAST((k+h)%3 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END",
    "wind_speed_10m": "CAST((k*13+h*7+doy)%60 AS DOUBLE)",
    "wind_gusts_10m": "CAST((k*13+h*7+doy)%60+10 AS DOUBLE)",
    "visibility": "CAST(10000-((k*13+doy*17+h*101)%9000) AS DOUBLE)",
    "cloud_cover": "CAST((k*11+h*4+doy)%101 AS DOUBLE)",
    "weather_code": "CAST((k+doy+h)%100 AS DOUBLE)",
}
UNDATED_EVERY = 97  # every such snapshot line has no date
RAIN_HOURS = 12  # the rain array is shorter than the others; three arrays are absent


def expressions(table: dict[str, str], engine: str) -> list[str]:
    return [f"{text.replace('{DOW}', DOW[engine])} AS {name}" for name, text in table.items()]


# -- Spark side --------------------------------------------------------------

_stored: dict[tuple[str, str], str] = {}
_makers: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def storable(make: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """A stand-in that is derived at each use, or read where it has been stored."""
    _makers[make.__name__] = make

    @wraps(make)
    def stand_in(spark: SparkSession, folder: str) -> DataFrame:
        path = _stored.get((make.__name__, folder))
        return spark.read.parquet(path) if path else make(spark, folder)

    return stand_in


def store(spark: SparkSession, folder: str, path: str) -> None:
    """Write the stand-ins of a folder once, so that what is measured after it are the operators."""
    for name, make in _makers.items():
        make(spark, folder).write.parquet(f"{path}/{name}")
        _stored[name, folder] = f"{path}/{name}"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def base(spark: SparkSession, folder: str) -> DataFrame:
    # the customers meet the orders first, so the lines are moved for the orders alone
    orders = table(spark, folder, "orders").join(table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    joined = (
        table(spark, folder, "lineitem")
        .join(orders.select("o_orderkey", "c_nationkey"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, folder, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    )
    return wide(joined).selectExpr(*LINEITEM, *expressions(HELPERS, "spark"))


@storable
def flights(spark: SparkSession, folder: str) -> DataFrame:
    return base(spark, folder).selectExpr(*expressions(FLIGHTS, "spark"))


def flights_by_month(spark: SparkSession, folder: str) -> DataFrame:
    """``flights``, those of a month together and in their order, for a table that is stored by month.

    They are moved and sorted as lines, which are a fraction of a flight.
    """
    months = {name: FLIGHTS[name] for name in ("YEAR", "MONTH")}
    lines = base(spark, folder).selectExpr("*", *expressions(months, "spark")).hint("rebalance", *months)
    return lines.sortWithinPartitions(*months).selectExpr(*expressions(FLIGHTS | {n: n for n in months}, "spark"))


@storable
def source_rows(spark: SparkSession, folder: str) -> DataFrame:
    return source_shape(base(spark, folder))


def source_shape(lines: DataFrame) -> DataFrame:
    """Rows of ``base`` as source rows."""
    return lines.selectExpr(*expressions(SOURCE_ROWS_PICKED, "spark"))


def source_rows_by_month(spark: SparkSession, folder: str) -> DataFrame:
    """``source_rows``, those of a month together: lines are moved and sorted, as a source row takes many times their bytes."""
    months = {name: SOURCE_ROWS_PICKED[name] for name in ("Year", "Month")}
    lines = base(spark, folder).selectExpr("*", *expressions(months, "spark")).repartition(*months)
    return lines.sortWithinPartitions(*months).selectExpr(*expressions(SOURCE_ROWS_PICKED | {n: n for n in months}, "spark"))


@storable
def nas_text(spark: SparkSession, folder: str) -> DataFrame:
    return wide(table(spark, folder, "events")).selectExpr(*expressions(NAS, "spark"))


@storable
def nas(spark: SparkSession, folder: str) -> DataFrame:
    """Status rows: program codes and minutes already parsed."""
    return nas_text(spark, folder).select(
        "event_id",
        "SNAPSHOT_TS",
        "FETCH_DATE",
        "IATA_CODE",
        "HAS_DELAY",
        "DELAY_COUNT",
        F.when(F.col("HAS_DELAY"), delay_type("TYPE_NAME")).alias("DELAY_TYPE"),
        "REASON",
        delay_minutes("AVG_TXT").alias("AVG_DELAY_MIN"),
        F.lit(None).cast("int").alias("MIN_DELAY_MIN"),
        delay_minutes("MAX_TXT").alias("MAX_DELAY_MIN"),
        "TREND",
        F.lit(None).cast("string").alias("END_TIME"),
        F.lit(None).cast("double").alias("WEATHER_TEMP_F"),
        F.lit(None).cast("double").alias("WEATHER_VIS_MI"),
        F.lit(None).cast("string").alias("WEATHER_WIND"),
        F.lit(None).cast("string").alias("WEATHER_CONDITION"),
    )


@storable
def nas_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Status rows as snapshot lines: times as ISO text, airports in odd case."""
    return nas(spark, folder).select(
        F.date_format("SNAPSHOT_TS", "yyyy-MM-dd'T'HH:mm:ss").alias("SNAPSHOT_TS"),
        F.when(F.col("event_id") % UNDATED_EVERY != 0, F.col("FETCH_DATE").cast("string")).alias("FETCH_DATE"),
        F.concat(F.lit(" "), F.lower("IATA_CODE")).alias("IATA_CODE"),
        "HAS_DELAY", "DELAY_COUNT", "DELAY_TYPE", "REASON", "AVG_DELAY_MIN", "MIN_DELAY_MIN", "MAX_DELAY_MIN",
        "TREND", "END_TIME", "WEATHER_TEMP_F", "WEATHER_VIS_MI", "WEATHER_WIND", "WEATHER_CONDITION",
    )


@storable
def weather_documents(spark: SparkSession, folder: str) -> DataFrame:
    """One nested document per airport and flight date, with gaps.

    Airport 3 comes twice, airport 4 has a second document with observations at
    half past, whose values are those of the next hour, and one document has no
    airport.
    """
    days = table(spark, folder, "lineitem").selectExpr("CAST(l_shipdate AS DATE) AS d").distinct()
    places = days.selectExpr("d", "dayofyear(d) AS doy", "explode(sequence(0, 9)) AS k")
    # a handful of dates lands in one partition; real documents arrive as many files
    places = places.repartition(spark.sparkContext.defaultParallelism, "d", "k")

    def documents(rows: DataFrame, minute: str, shift: int) -> DataFrame:
        arrays = []
        for field, _, _ in HOURLY_FIELDS:
            if field in WEATHER:
                last = RAIN_HOURS - 1 if field == "rain" else 23
                arrays.append(f"'{field}', transform(sequence({shift}, {last + shift}), h -> {WEATHER[field]})")
            else:
                arrays.append(f"'{field}', CAST(NULL AS ARRAY<DOUBLE>)")
        stamp = f"CONCAT(CAST(d AS STRING), 'T', LPAD(CAST(h AS STRING), 2, '0'), ':{minute}')"
        time = f"transform(sequence(0, 23), h -> {stamp})"
        return rows.selectExpr(
            f"CASE WHEN k >= 0 THEN lower(SUBSTR({AIRPORTS}, 3*k+1, 3)) END AS iata_code",
            f"named_struct('time', {time}, {', '.join(arrays)}) AS hourly",
        )

    places = places.where("(k + doy) % 11 <> 0")
    whole = documents(places.union(places.where("k = 3")).union(places.where("k = 5").selectExpr("d", "doy", "-1")), "00", 0)
    return whole.unionByName(documents(places.where("k = 4"), "30", 1))
