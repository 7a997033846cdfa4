"""The SQL twins of the registered queries, for DuckDB on the same tables.

``TABLES`` holds named subqueries; a query gets the ones it mentions, directly
or through others, as its WITH list.
"""

from __future__ import annotations

import re

from checks import stand_ins
from checks.registry import (
    ABSENT_IN_ODD_YEARS,
    BUSY_AIRPORT,
    BUSY_ROUTE,
    CARRIERS,
    DAY,
    FEW_YEARS,
    GROUNDED,
    MONTH,
    REQUESTED,
    ROUTE,
    SAMPLE_KEYS,
    YEARS,
    stored_model,
)
from checks.stand_ins import FLIGHTS, HELPERS, LINEITEM, NAS, RAIN_HOURS, SOURCE_ROWS, UNDATED_EVERY, WEATHER, expressions
from tarmac.dims import AIRLINE_NAMES, AIRPORT_SITES, CAUSE_LABELS, MONTH_LABELS, NAS_AIRPORTS, NO_WEATHER_AIRPORTS
from tarmac.dims import WEEKDAY_NAMES
from tarmac.operators.features import CATEGORICAL_FEATURES, LABELS, NUMERIC_FEATURES, SEED, WEATHER_FEATURES, WEATHER_SOURCES
from tarmac.operators.flight_cleaning import FLAGS, STAGING_NAMES
from tarmac.operators.tree_rows import Node, margin_text
from tarmac.operators.weather import DEST_FIELDS, ORIGIN_FIELDS
from tarmac.schemas import (
    FLIGHT_DELAY_COLUMNS,
    FLIGHT_SOURCE_COLUMNS,
    FLIGHT_TEXT_COLUMNS,
    FLIGHT_TYPES,
    HOURLY_FIELDS,
    STAGING_FLIGHTS,
)


def listing(table: dict[str, str]) -> str:
    return ", ".join(expressions(table, "duckdb"))


def half_up(value: str, digits: int = 2) -> str:
    return f"CAST(ROUND(CAST({value} AS DECIMAL(28,10)), {digits}) AS DOUBLE)"


def pct(part: str, whole: str, digits: int = 2) -> str:
    return half_up(f"(CAST(100 AS DOUBLE) * {part} / NULLIF({whole}, 0))", digits)


def mean(column: str) -> str:
    return f"(CAST(SUM(CAST({column} AS DECIMAL(18,2))) AS DOUBLE) / NULLIF(COUNT({column}), 0))"


def positive(column: str, extra: str = "") -> str:
    return half_up(f"AVG(CASE WHEN {column} > 0{extra} THEN {column} END)")


def total(column: str) -> str:
    return f"COALESCE(CAST(SUM({column}) AS BIGINT), 0) AS {column}"


def minutes_total(column: str) -> str:
    return f"COALESCE(SUM({column}), 0) AS {column}"


def count_if(condition: str) -> str:
    return f"COUNT(CASE WHEN {condition} THEN 1 END)"


def text_minutes(text: str) -> str:
    def part(pattern: str) -> str:
        return f"COALESCE(TRY_CAST(regexp_extract(lower({text}), '{pattern}', 1) AS INT), 0)"

    worded = f"({part('([0-9]+)\\s*hour')} * 60 + {part('([0-9]+)\\s*min')})"
    bare = f"TRY_CAST(regexp_extract({text}, '^\\s*([0-9]+)\\s*$', 1) AS INT)"
    return f"CASE WHEN {text} IS NULL THEN NULL WHEN {worded} > 0 THEN {worded} ELSE {bare} END"


def program_type(name: str) -> str:
    def has(word: str) -> str:
        return f"lower({name}) LIKE '%{word}%'"

    return (
        f"CASE WHEN {has('ground delay')} OR {has('gdp')} THEN 'GroundDelay'"
        f" WHEN {has('ground stop')} OR {has('gsp')} THEN 'GroundStop'"
        f" WHEN {has('arrival')} AND {has('departure')} THEN 'ArriveDepart'"
        f" WHEN {has('closure')} THEN 'Closure' WHEN {has('airspace')} THEN 'Airspace'"
        f" ELSE COALESCE(NULLIF(substr(regexp_replace({name}, '^\\s+|\\s+$', '', 'g'), 1, 30), ''), 'Unknown') END"
    )


def literal(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).upper()
    return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else str(value)


def values(rows: list[tuple], names: str) -> str:
    body = ", ".join("(" + ", ".join(map(literal, row)) + ")" for row in rows)
    return f"SELECT * FROM (VALUES {body}) AS v({names})"


CAUSES = [name for name, _ in CAUSE_LABELS]
ALL_CAUSES = "(" + " + ".join(CAUSES) + ")"
OPERATED = " AND NOT IS_CANCELLED"
ON_TIME = "NOT IS_DEP_DELAYED AND NOT IS_CANCELLED"
IN_YEARS = f"YEAR BETWEEN {YEARS[0]} AND {YEARS[1]}"
TREND = f"""COUNT(*) AS TOTAL_FLIGHTS, {count_if('IS_DEP_DELAYED')} AS TOTAL_DELAYED,
    {count_if('IS_CANCELLED')} AS TOTAL_CANCELLED, {pct(count_if('IS_DEP_DELAYED'), 'COUNT(*)')} AS DELAY_RATE,
    {positive('DEP_DELAY_MIN')} AS AVG_DEP_DELAY_MIN, {positive('ARR_DELAY_MIN')} AS AVG_ARR_DELAY_MIN,
    {pct('SUM(CARRIER_DELAY)', 'SUM(DEP_DELAY_MIN)')} AS CARRIER_DELAY_SHARE,
    {pct('SUM(WEATHER_DELAY)', 'SUM(DEP_DELAY_MIN)')} AS WEATHER_DELAY_SHARE,
    {pct('SUM(NAS_DELAY)', 'SUM(DEP_DELAY_MIN)')} AS NAS_DELAY_SHARE"""
SITES = {site[0]: site for site in AIRPORT_SITES}
AIRPORT_ROWS = [
    (code, *(SITES[code][1:] if code in SITES else (None,) * 4), code in SITES,
     code in SITES and code not in NO_WEATHER_AIRPORTS, code in NAS_AIRPORTS)
    for code in [*SITES, *[c for c in NAS_AIRPORTS if c not in SITES]]
]

#: Target, source and type of the columns that are loaded by name.
LOADED_FROM = [
    ("YEAR", "Year", "INT"),
    ("FLIGHT_DATE", "FlightDate", "DATE"),
    ("FLIGHT_NUMBER", "Flight_Number_Reporting_Airline", "VARCHAR"),
    ("ORIGIN", "Origin", "VARCHAR"),
    ("DEP_DELAY_MINUTES", "DepDelayMinutes", "DOUBLE"),
    ("DISTANCE", "Distance", "DOUBLE"),
]

CORE = "IATA_CODE_REPORTING_AIRLINE IS NOT NULL AND FLIGHT_DATE IS NOT NULL AND ORIGIN IS NOT NULL AND DEST IS NOT NULL"


def trimmed(name: str) -> str:
    return f"NULLIF(trim({name}), '') AS {name}"


def voided(name: str) -> str:
    return f"CASE WHEN CANCELLED = 1 THEN NULL ELSE {name} END AS {name}"


def cast_text(source: str, name: str, kind: str) -> str:
    number = f"TRY_CAST({source} AS DOUBLE)"
    shapes = {"int": f"TRY_CAST({number} AS INT)", "double": number, "date": f"CAST({source} AS DATE)", "string": source}
    return f"{shapes[kind]} AS {name}"


RENAMED = ", ".join(f"{source} AS {name}" for source, name, _ in FLIGHT_SOURCE_COLUMNS)
VOIDED = ", ".join(map(voided, FLIGHT_DELAY_COLUMNS))
CLEAN = ", ".join(
    trimmed(name) if name in FLIGHT_TEXT_COLUMNS else voided(name) if name in FLIGHT_DELAY_COLUMNS else name
    for name in FLIGHT_TYPES
)
RAW_NAMES = {staging: name for name, staging in STAGING_NAMES.items()}
STAGED = [name for name in STAGING_FLIGHTS.names if name != "_LOAD_TS"]
STAGED_PARTS = ", ".join(
    f"{FLAGS[name]} = 1 AS {name}" if name in FLAGS else f"{RAW_NAMES.get(name, name)} AS {name}"
    for name in STAGED
    if name not in ("FLIGHT_ID", "DATA_SOURCE")
)
WX_VALUES = ", ".join(
    (
        f"CASE WHEN hour < {RAIN_HOURS} THEN {WEATHER[field]} END AS {name}"
        if field == "rain"
        else f"CAST({WEATHER.get(field, 'NULL')} AS {kind}) AS {name}"
    )
    for field, name, kind in HOURLY_FIELDS
)
OBSERVED = "IATA_CODE, OBS_DATE, OBS_HOUR"

DEST_JOIN = """ FROM {} f LEFT JOIN wx_hours w ON f.DEST = w.IATA_CODE
        AND CASE WHEN f.SCHEDULED_ARR < f.SCHEDULED_DEP THEN f.FLIGHT_DATE + 1 ELSE f.FLIGHT_DATE END = w.OBS_DATE
        AND COALESCE(f.SCHEDULED_ARR, 0) // 100 = w.OBS_HOUR"""

#: Worked out once per query: several later subqueries read them.
MATERIALIZED = {"fx_wx", "wx_hours", "fx_flights", "f_origin"}

TABLES: dict[str, str] = {
    "fx_base": f"""SELECT {', '.join(LINEITEM)}, {listing(HELPERS)}
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey
        JOIN customer ON o_custkey = c_custkey""",
    "fx_flights": f"SELECT {listing(FLIGHTS)} FROM fx_base",
    "fx_raw": f"SELECT {listing(SOURCE_ROWS)} FROM fx_base",
    "fx_nas": f"SELECT {listing(NAS)} FROM events",
    "fx_status": f"""SELECT event_id, SNAPSHOT_TS, FETCH_DATE, IATA_CODE, HAS_DELAY, DELAY_COUNT,
        CASE WHEN HAS_DELAY THEN {program_type('TYPE_NAME')} END AS DELAY_TYPE, REASON,
        {text_minutes('AVG_TXT')} AS AVG_DELAY_MIN, CAST(NULL AS INT) AS MIN_DELAY_MIN,
        {text_minutes('MAX_TXT')} AS MAX_DELAY_MIN, TREND, CAST(NULL AS VARCHAR) AS END_TIME,
        CAST(NULL AS DOUBLE) AS WEATHER_TEMP_F, CAST(NULL AS DOUBLE) AS WEATHER_VIS_MI,
        CAST(NULL AS VARCHAR) AS WEATHER_WIND, CAST(NULL AS VARCHAR) AS WEATHER_CONDITION FROM fx_nas""",
    "wx_places": f"""SELECT d, k, dayofyear(d) AS doy, SUBSTR({stand_ins.AIRPORTS}, CAST(3*k+1 AS INT), 3) AS code
        FROM (SELECT d, unnest(range(10)) AS k FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem))
        WHERE (k + dayofyear(d)) % 11 <> 0""",
    "fx_wx": f"""SELECT code AS IATA_CODE,
        CONCAT(CAST(d AS VARCHAR), 'T', LPAD(CAST(hour AS VARCHAR), 2, '0'), minute) AS OBS_TIMESTAMP, d AS OBS_DATE,
        CAST(EXTRACT(YEAR FROM d) AS INT) AS YEAR, CAST(EXTRACT(MONTH FROM d) AS INT) AS MONTH,
        CAST(hour AS INT) AS OBS_HOUR, {WX_VALUES}
        FROM (SELECT *, hour + shift AS h FROM (
            SELECT *, unnest(range(24)) AS hour FROM (
                SELECT *, ':00' AS minute, 0 AS shift FROM wx_places UNION ALL
                SELECT *, ':30' AS minute, 1 AS shift FROM wx_places WHERE k = 4)))""",
    "wx_hours": f"""SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (
        PARTITION BY {OBSERVED} ORDER BY OBS_TIMESTAMP) AS rn FROM fx_wx) WHERE rn = 1""",
    "typed": f"SELECT {', '.join(cast_text(*column) for column in FLIGHT_SOURCE_COLUMNS)} FROM fx_raw",
    "cleaned": f"SELECT {CLEAN} FROM typed WHERE {CORE}",
    "staged": f"""SELECT CONCAT(COALESCE(IATA_CODE_REPORTING_AIRLINE, 'XX'), '_', COALESCE(FLIGHT_NUMBER, '0'), '_',
        strftime(FLIGHT_DATE, '%Y%m%d'), '_', COALESCE(ORIGIN, 'XXX'), '_', COALESCE(DEST, 'XXX')) AS FLIGHT_ID,
        {STAGED_PARTS}, 'BTS' AS DATA_SOURCE FROM cleaned""",
    "by_name": "SELECT "
    + ", ".join(
        f"{source} AS {name}" if kind == "VARCHAR" else f"TRY_CAST(NULLIF(trim({source}), '') AS {kind}) AS {name}"
        for name, source, kind in LOADED_FROM
    )
    + ", "
    + " OR ".join(
        f"(NULLIF(trim({source}), '') IS NOT NULL AND TRY_CAST(NULLIF(trim({source}), '') AS {kind}) IS NULL)"
        for _, source, kind in LOADED_FROM
        if kind != "VARCHAR"
    )
    + " AS IS_BAD FROM fx_raw",
    "m_monthly": f"SELECT YEAR, MONTH, {TREND} FROM fx_flights WHERE NOT IS_CANCELLED GROUP BY YEAR, MONTH",
    "m_daily": f"SELECT FLIGHT_DATE, {TREND} FROM fx_flights WHERE NOT IS_CANCELLED GROUP BY FLIGHT_DATE",
    "m_cancelled": f"SELECT YEAR, MONTH, {count_if('IS_CANCELLED')} AS N FROM fx_flights GROUP BY YEAR, MONTH",
    "m_monthly_counted": """SELECT m.* REPLACE (COALESCE(c.N, 0) AS TOTAL_CANCELLED)
        FROM m_monthly m LEFT JOIN m_cancelled c USING (YEAR, MONTH)""",
    "m_airlines": f"""SELECT YEAR, MONTH, AIRLINE_CODE, COUNT(*) AS TOTAL_FLIGHTS,
        {count_if('IS_DEP_DELAYED')} AS DELAYED_FLIGHTS, {count_if('IS_CANCELLED')} AS CANCELLED_FLIGHTS,
        {count_if(ON_TIME)} AS ON_TIME_FLIGHTS, {pct(count_if('IS_DEP_DELAYED'), 'COUNT(*)')} AS DELAY_RATE,
        {pct(count_if('IS_CANCELLED'), 'COUNT(*)')} AS CANCEL_RATE, {pct(count_if(ON_TIME), 'COUNT(*)')} AS ON_TIME_RATE,
        {positive('DEP_DELAY_MIN', OPERATED)} AS AVG_DEP_DELAY_MIN,
        {positive('ARR_DELAY_MIN', OPERATED)} AS AVG_ARR_DELAY_MIN
        FROM fx_flights GROUP BY YEAR, MONTH, AIRLINE_CODE""",
    "m_departures": f"""SELECT YEAR, MONTH, ORIGIN AS AIRPORT, ORIGIN_CITY AS CITY, ORIGIN_STATE AS STATE,
        COUNT(*) AS DEP_FLIGHTS, {count_if('IS_DEP_DELAYED')} AS DEP_DELAYED,
        {count_if('IS_CANCELLED')} AS DEP_CANCELLED, {positive('DEP_DELAY_MIN')} AS AVG_DEP_DELAY_MIN
        FROM fx_flights GROUP BY ALL""",
    "m_arrivals": f"""SELECT YEAR, MONTH, DEST AS AIRPORT, COUNT(*) AS ARR_FLIGHTS,
        {count_if('IS_ARR_DELAYED')} AS ARR_DELAYED, {positive('ARR_DELAY_MIN')} AS AVG_ARR_DELAY_MIN
        FROM fx_flights WHERE NOT IS_CANCELLED GROUP BY ALL""",
    "m_airports": f"""SELECT YEAR, MONTH, AIRPORT, CITY, STATE, DEP_FLIGHTS, ARR_FLIGHTS, DEP_DELAYED, ARR_DELAYED,
        DEP_CANCELLED, AVG_DEP_DELAY_MIN, AVG_ARR_DELAY_MIN, {pct('DEP_DELAYED', 'DEP_FLIGHTS')} AS DEP_DELAY_RATE,
        {pct('ARR_DELAYED', 'ARR_FLIGHTS')} AS ARR_DELAY_RATE
        FROM m_departures LEFT JOIN m_arrivals USING (YEAR, MONTH, AIRPORT)""",
    "m_causes": "SELECT YEAR, MONTH, "
    + ", ".join(f"{count_if(c.removesuffix('_TOTAL_MIN') + ' > 0')} AS {c.replace('TOTAL_MIN', 'FLIGHTS')}" for c in CAUSES)
    + ", "
    + ", ".join(f"{half_up(f'SUM(COALESCE({c.removesuffix('_TOTAL_MIN')}, 0))')} AS {c}" for c in CAUSES)
    + " FROM fx_flights WHERE IS_DEP_DELAYED AND NOT IS_CANCELLED GROUP BY YEAR, MONTH",
    "m_routes": f"""SELECT YEAR, MONTH, ORIGIN, DEST, CONCAT(ORIGIN, '-', DEST) AS ROUTE, COUNT(*) AS TOTAL_FLIGHTS,
        {count_if('IS_DEP_DELAYED')} AS DELAYED_FLIGHTS, {pct(count_if('IS_DEP_DELAYED'), 'COUNT(*)')} AS DELAY_RATE,
        {positive('DEP_DELAY_MIN')} AS AVG_DEP_DELAY_MIN, {half_up('AVG(DISTANCE)')} AS AVG_DISTANCE
        FROM fx_flights WHERE NOT IS_CANCELLED GROUP BY YEAR, MONTH, ORIGIN, DEST HAVING COUNT(*) >= 10""",
    "m_status": """SELECT FETCH_DATE, IATA_CODE, COUNT(DISTINCT DELAY_TYPE) AS DELAY_PROGRAMS,
        MAX(AVG_DELAY_MIN) AS MAX_AVG_DELAY_MIN, BOOL_OR(DELAY_TYPE = 'GroundDelay') AS HAS_GROUND_DELAY,
        BOOL_OR(DELAY_TYPE = 'GroundStop') AS HAS_GROUND_STOP FROM fx_status
        WHERE HAS_DELAY AND FETCH_DATE IS NOT NULL AND IATA_CODE IS NOT NULL GROUP BY FETCH_DATE, IATA_CODE""",
    "lines": f"""SELECT * REPLACE (CAST(date_trunc('second', SNAPSHOT_TS) AS TIMESTAMP) AS SNAPSHOT_TS,
        CASE WHEN event_id % {UNDATED_EVERY} <> 0 THEN FETCH_DATE END AS FETCH_DATE) FROM fx_status""",
    "programs": """SELECT * EXCLUDE (event_id, rn) FROM (
        SELECT * EXCLUDE (event_id), event_id, ROW_NUMBER() OVER (
            PARTITION BY FETCH_DATE, IATA_CODE, DELAY_TYPE ORDER BY SNAPSHOT_TS DESC NULLS LAST,
            HAS_DELAY NULLS FIRST, DELAY_COUNT NULLS FIRST, REASON NULLS FIRST, AVG_DELAY_MIN NULLS FIRST,
            MAX_DELAY_MIN NULLS FIRST, TREND NULLS FIRST) AS rn
        FROM lines WHERE FETCH_DATE IS NOT NULL AND IATA_CODE IS NOT NULL AND DELAY_TYPE IS NOT NULL
        UNION ALL
        SELECT * EXCLUDE (event_id), event_id, ROW_NUMBER() OVER (
            PARTITION BY FETCH_DATE, IATA_CODE ORDER BY SNAPSHOT_TS DESC NULLS LAST,
            HAS_DELAY NULLS FIRST, DELAY_COUNT NULLS FIRST, REASON NULLS FIRST, AVG_DELAY_MIN NULLS FIRST,
            MAX_DELAY_MIN NULLS FIRST, TREND NULLS FIRST) AS rn
        FROM lines WHERE DELAY_TYPE IS NULL) WHERE rn = 1""",
    "d_airports": values(
        AIRPORT_ROWS,
        "IATA_CODE, LATITUDE, LONGITUDE, TIME_ZONE, AIRPORT_NAME, HAS_COORDINATES, HAS_WEATHER, IN_NAS_FEED",
    ),
    "d_airlines": values(AIRLINE_NAMES, "AIRLINE_CODE, NAME"),
    "d_months": values(list(enumerate(MONTH_LABELS, 1)), "MONTH, MONTH_LABEL"),
    "d_weekdays": values(list(enumerate(WEEKDAY_NAMES, 1)), "DAY_OF_WEEK, DAY_NAME"),
    "r_airlines": f"""SELECT AIRLINE_CODE, {total('TOTAL_FLIGHTS')}, {total('DELAYED_FLIGHTS')},
        {total('CANCELLED_FLIGHTS')}, {total('ON_TIME_FLIGHTS')}, {mean('AVG_DEP_DELAY_MIN')} AS AVG_DEP_DELAY_MIN,
        {mean('AVG_ARR_DELAY_MIN')} AS AVG_ARR_DELAY_MIN FROM m_airlines WHERE {IN_YEARS} GROUP BY AIRLINE_CODE""",
    "r_airlines_top": f"""SELECT r.*, {pct('DELAYED_FLIGHTS', 'TOTAL_FLIGHTS')} AS DELAY_RATE,
        {pct('CANCELLED_FLIGHTS', 'TOTAL_FLIGHTS')} AS CANCEL_RATE, {pct('ON_TIME_FLIGHTS', 'TOTAL_FLIGHTS')} AS ON_TIME_RATE,
        COALESCE(NAME || ' (' || AIRLINE_CODE || ')', AIRLINE_CODE) AS AIRLINE_NAME
        FROM r_airlines r LEFT JOIN d_airlines USING (AIRLINE_CODE) ORDER BY TOTAL_FLIGHTS DESC, AIRLINE_CODE LIMIT 10""",
    "r_airports": f"""SELECT *, {pct('DEP_DELAYED', 'GREATEST(DEP_FLIGHTS, 1)')} AS DEP_DELAY_RATE,
        {pct('ARR_DELAYED', 'GREATEST(ARR_FLIGHTS, 1)')} AS ARR_DELAY_RATE,
        {pct('DEP_CANCELLED', 'GREATEST(DEP_FLIGHTS, 1)')} AS CANCEL_RATE,
        CONCAT(AIRPORT, ' — ', split_part(CITY, ',', 1)) AS LABEL
        FROM (SELECT AIRPORT, CITY, STATE, {total('DEP_FLIGHTS')}, {total('ARR_FLIGHTS')}, {total('DEP_DELAYED')},
            {total('ARR_DELAYED')}, {total('DEP_CANCELLED')}, {mean('AVG_DEP_DELAY_MIN')} AS AVG_DEP_DELAY_MIN,
            {mean('AVG_ARR_DELAY_MIN')} AS AVG_ARR_DELAY_MIN FROM m_airports WHERE YEAR >= 1990
            GROUP BY AIRPORT, CITY, STATE) WHERE DEP_FLIGHTS >= {BUSY_AIRPORT}""",
    "r_all_routes": f"""SELECT ORIGIN, DEST, ROUTE, {total('TOTAL_FLIGHTS')}, {total('DELAYED_FLIGHTS')},
        {half_up(mean('AVG_DEP_DELAY_MIN'), 1)} AS AVG_DEP_DELAY_MIN, {half_up(mean('AVG_DISTANCE'), 0)} AS AVG_DISTANCE,
        {pct('SUM(DELAYED_FLIGHTS)', 'GREATEST(SUM(TOTAL_FLIGHTS), 1)')} AS DELAY_RATE
        FROM m_routes WHERE YEAR >= 1990 GROUP BY ORIGIN, DEST, ROUTE""",
    "r_routes": f"SELECT * FROM r_all_routes WHERE TOTAL_FLIGHTS >= {BUSY_ROUTE}",
    "r_route_months": f"""SELECT YEAR, MONTH, CAST(SUM(TOTAL_FLIGHTS) AS BIGINT) AS TOTAL_FLIGHTS,
        CAST(SUM(DELAYED_FLIGHTS) AS BIGINT) AS DELAYED_FLIGHTS,
        {pct('SUM(DELAYED_FLIGHTS)', 'SUM(TOTAL_FLIGHTS)')} AS DELAY_RATE,
        {half_up(mean('AVG_DEP_DELAY_MIN'))} AS AVG_DEP_DELAY_MIN
        FROM m_routes WHERE ROUTE = '{'-'.join(ROUTE)}' AND {IN_YEARS} GROUP BY YEAR, MONTH""",
    "r_causes": f"SELECT YEAR, {', '.join(map(minutes_total, CAUSES))} FROM m_causes WHERE {IN_YEARS} GROUP BY YEAR",
    "a_severe": """SELECT * FROM fx_status WHERE HAS_DELAY
        AND (COALESCE(AVG_DELAY_MIN, 0) >= 45 OR COALESCE(DELAY_COUNT, 0) >= 3)""",
    "a_ground": "SELECT * FROM fx_status WHERE HAS_DELAY AND DELAY_TYPE IN ('GroundStop', 'GroundDelay', 'Airspace')",
    "a_few": f"SELECT * FROM a_ground WHERE DELAY_TYPE = '{GROUNDED[0]}'",
    "a_other": """SELECT * FROM a_severe s WHERE NOT EXISTS (
        SELECT 1 FROM a_few g WHERE g.FETCH_DATE = s.FETCH_DATE AND g.IATA_CODE = s.IATA_CODE)""",
    "a_days": f"""SELECT FETCH_DATE, COUNT(*) AS TOTAL_RECORDS, {count_if('HAS_DELAY')} AS DELAYED_RECORDS,
        {half_up('COALESCE(AVG(CASE WHEN HAS_DELAY THEN COALESCE(AVG_DELAY_MIN, 0) END), 0)', 1)}
        AS AVG_DELAY_ACROSS_DELAYED FROM fx_status GROUP BY FETCH_DATE""",
    "f_origin": "SELECT f.*, "
    + ", ".join(f"w.{name} AS ORIGIN_{name}" for name in ORIGIN_FIELDS)
    + """ FROM fx_flights f LEFT JOIN wx_hours w ON f.ORIGIN = w.IATA_CODE AND f.FLIGHT_DATE = w.OBS_DATE
        AND f.SCHEDULED_DEP // 100 = w.OBS_HOUR""",
    "f_both": "SELECT f.*, " + ", ".join(f"w.{name} AS DEST_{name}" for name in DEST_FIELDS) + DEST_JOIN.format("f_origin"),
    "f_dest": "SELECT f.*, " + ", ".join(f"w.{name} AS DEST_{name}" for name in DEST_FIELDS) + DEST_JOIN.format("fx_flights"),
    "x_weather": f"""SELECT CAST(SCHEDULED_DEP // 100 AS INT) AS DEP_HOUR,
        CAST(dayofweek(FLIGHT_DATE) + 1 AS INT) AS DEP_DOW, MONTH AS DEP_MONTH, COALESCE(DISTANCE, 0) AS FLIGHT_DISTANCE,
        COALESCE(SCHEDULED_ELAPSED, 0) AS SCHED_ELAPSED_MIN, """
    + ", ".join(
        f"CAST(COALESCE({source}, {default}) AS {'INT' if name.endswith('CODE') else 'DOUBLE'}) AS {name}"
        for name, source, default in WEATHER_SOURCES
    )
    + """, AIRLINE_CODE AS OP_CARRIER, ORIGIN, DEST, CAST(IS_DEP_DELAYED AS INT) AS LABEL_CLASS,
        GREATEST(0, COALESCE(DEP_DELAY_MIN, 0)) AS LABEL_REG FROM f_both
        WHERE NOT IS_CANCELLED AND FLIGHT_DATE >= DATE '2000-01-01' AND FLIGHT_DATE < DATE '2025-01-01'""",
    "x_plain": """SELECT CAST(SCHEDULED_DEP // 100 AS INT) AS DEP_HOUR, CAST(dayofweek(FLIGHT_DATE) + 1 AS INT) AS DEP_DOW,
        MONTH AS DEP_MONTH, COALESCE(DISTANCE, 0) AS FLIGHT_DISTANCE, COALESCE(SCHEDULED_ELAPSED, 0) AS SCHED_ELAPSED_MIN,
        AIRLINE_CODE AS OP_CARRIER, ORIGIN, DEST, CAST(IS_DEP_DELAYED AS INT) AS LABEL_CLASS,
        GREATEST(0, COALESCE(DEP_DELAY_MIN, 0)) AS LABEL_REG FROM fx_flights WHERE NOT IS_CANCELLED""",
    "x_labelled": """SELECT * REPLACE (LEAST(GREATEST(LABEL_REG, 0), 300) AS LABEL_REG) FROM x_weather
        WHERE LABEL_CLASS IS NOT NULL AND LABEL_REG IS NOT NULL""",
    "x_plain_labelled": """SELECT * REPLACE (LEAST(GREATEST(LABEL_REG, 0), 300) AS LABEL_REG) FROM x_plain
        WHERE LABEL_CLASS IS NOT NULL AND LABEL_REG IS NOT NULL""",
    "e_long": " UNION ALL ".join(
        f"SELECT '{name}' AS FEATURE, {name} AS VALUE, DEP_MONTH % 5 AS FOLD,"
        " CAST(LABEL_CLASS AS DOUBLE) AS y_class, CAST(LABEL_REG AS DOUBLE) AS y_reg FROM x_labelled"
        for name in ("OP_CARRIER", "ORIGIN", "DEST")
    ),
    "c_carriers": f"SELECT SUBSTR({CARRIERS}, CAST(2*(l_suppkey % 14)+1 AS INT), 2) AS AIRLINE_CODE, l_orderkey FROM lineitem",
    "c_requested": f"""SELECT CAST(EXTRACT(YEAR FROM m) AS INT) AS YEAR, CAST(EXTRACT(MONTH FROM m) AS INT) AS MONTH
        FROM (SELECT unnest(generate_series(DATE '{REQUESTED[0]}-01', DATE '{REQUESTED[1]}-01', INTERVAL 1 MONTH)) AS m)""",
    "c_present": "SELECT DISTINCT YEAR, MONTH, TRUE AS PRESENT FROM fx_flights",
}



def out_of_fold(y: str) -> str:
    """Mean over the other folds, shrunk to their overall mean."""
    sums = f"COUNT(*) AS n, SUM({y}) AS s, SUM({y} * {y}) AS q"
    return f"""SELECT FEATURE, VALUE, FOLD, ROUND(COALESCE(trust * m + (1 - trust) * level, m, level), 9) AS ENCODING
        FROM (SELECT *, gv * n / NULLIF(gv * n + v, 0) AS trust FROM (
        SELECT FEATURE, VALUE, FOLD, n, gs / gn AS level, gq / gn - (gs / gn) * (gs / gn) AS gv,
            s / NULLIF(n, 0) AS m, GREATEST(q / NULLIF(n, 0) - (s / NULLIF(n, 0)) * (s / NULLIF(n, 0)), 0) AS v
        FROM (SELECT o.FEATURE, o.VALUE, o.FOLD, t.n - o.n AS n, t.s - o.s AS s, t.q - o.q AS q,
                a.n - f.n AS gn, a.s - f.s AS gs, a.q - f.q AS gq
            FROM (SELECT FEATURE, VALUE, FOLD, {sums} FROM e_long GROUP BY ALL) o
            JOIN (SELECT FEATURE, VALUE, {sums} FROM e_long GROUP BY ALL) t ON o.FEATURE = t.FEATURE AND o.VALUE = t.VALUE
            JOIN (SELECT FEATURE, FOLD, {sums} FROM e_long GROUP BY ALL) f ON o.FEATURE = f.FEATURE AND o.FOLD = f.FOLD
            JOIN (SELECT FEATURE, {sums} FROM e_long GROUP BY ALL) a ON o.FEATURE = a.FEATURE)))"""


JOIN_KEYS = "FLIGHT_DATE, ORIGIN, DEST, SCHEDULED_DEP, SCHEDULED_ARR, TAIL_NUMBER"
ANOMALY = "event_id, FETCH_DATE, IATA_CODE, DELAY_COUNT, DELAY_TYPE, AVG_DELAY_MIN"
WX_COLUMNS = "IATA_CODE, OBS_TIMESTAMP, OBS_DATE, YEAR, MONTH, OBS_HOUR, " + ", ".join(n for _, n, _ in HOURLY_FIELDS)
LATEST = "(SELECT MAX(FETCH_DATE) FROM m_status)"
SUM_FLIGHTS = "CAST(SUM(TOTAL_FLIGHTS) AS BIGINT)"
SEASON = f"{half_up(mean('DELAY_RATE'))} AS AVG_DELAY_RATE"


def in_range(mart: str) -> str:
    return f"SELECT '{{0}}' AS MART, MIN(YEAR) AS MIN_Y, MAX(YEAR) AS MAX_Y FROM {mart}"


FLIGHT_NAMES = {source: name for source, name, _ in FLIGHT_SOURCE_COLUMNS}
ABSENT = ", ".join(f"NULL AS {FLIGHT_NAMES[source]}" for source in ABSENT_IN_ODD_YEARS)
BROKEN = f"YEAR = {MONTH.year} AND MONTH = {MONTH.month}"
NEW_DAY = f"""SELECT * REPLACE (DELAY_COUNT + 100 AS DELAY_COUNT) FROM programs
    WHERE FETCH_DATE = DATE '{DAY}' AND HAS_DELAY"""
OTHER_DAYS = f"SELECT * FROM programs WHERE FETCH_DATE <> DATE '{DAY}'"
OTHER_MONTHS = f"SELECT * FROM m_monthly_counted WHERE NOT ({BROKEN})"


def hashed(names: list[str]) -> str:
    """The bucket of a row below a hundred, as ``hash_bucket`` has it."""
    text = f"concat_ws('|', {', '.join(f'CAST({name} AS VARCHAR)' for name in names)}, '{SEED}')"
    return f"(CAST(('0x' || substr(md5({text}), 1, 8)) AS BIGINT) % 100)"


def numbered(names: list[str]) -> str:
    """The number of a row, as ``row_number_of`` has it."""
    text = ", ".join(f"COALESCE(CAST({name} AS VARCHAR), chr(8709))" for name in sorted(names))
    return f"CAST(('0x' || substr(md5(concat_ws('|', {text})), 1, 15)) AS BIGINT)"


MODEL_COLUMNS = NUMERIC_FEATURES + WEATHER_FEATURES + CATEGORICAL_FEATURES + LABELS
SPLIT = f"""(SELECT *, ROW_NUMBER() OVER (PARTITION BY LABEL_CLASS ORDER BY {numbered(MODEL_COLUMNS)})
    > (COUNT(*) OVER (PARTITION BY LABEL_CLASS) * 80 + 50) // 100 AS IS_VALIDATION FROM x_labelled)"""

HOURLY_STAMP = "strftime(date_trunc('hour', SNAPSHOT_TS), '%Y-%m-%dT%H:%M:%S')"
FED = f"""SELECT {{STAMP}} AS SNAPSHOT_TS, CAST(FETCH_DATE AS VARCHAR) AS FETCH_DATE, IATA_CODE, TRUE AS HAS_DELAY,
    1 AS DELAY_COUNT, {program_type('TYPE_NAME')} AS DELAY_TYPE, COALESCE({{REASON}}, '') AS REASON,
    {text_minutes('AVG_TXT')} AS AVG_DELAY_MIN, CAST(NULL AS INT) AS MIN_DELAY_MIN, {text_minutes('MAX_TXT')} AS MAX_DELAY_MIN,
    COALESCE(TREND, '') AS TREND, '' AS END_TIME, CAST(NULL AS DOUBLE) AS WEATHER_TEMP_F, CAST(NULL AS DOUBLE) AS WEATHER_VIS_MI,
    CAST(NULL AS VARCHAR) AS WEATHER_WIND, CAST(NULL AS VARCHAR) AS WEATHER_CONDITION FROM fx_nas WHERE HAS_DELAY"""


def stored_scores() -> str:
    """The stored trees over the plain features, as ``tree_rows.score`` has it."""
    model = stored_model()
    parts = []
    for prefix, means in (("clf_", model["class_means"]), ("reg_", model["minute_means"])):
        for feature in CATEGORICAL_FEATURES:
            own = {value: mean for name, value, mean in means if name == feature}
            known = " ".join(f"WHEN {literal(value)} THEN CAST({mean!r} AS DOUBLE)" for value, mean in own.items() if value is not None)
            parts.append(f"CASE {feature} {known} ELSE CAST({own[None]!r} AS DOUBLE) END AS {prefix}{feature}_mean")
    trees = {name: margin_text([Node(*node) for node in model[name]]) for name in ("classifier", "regressor")}
    steps = " ".join(["WHEN 1 - q >= {}e0 THEN '{}'"] * 3)

    def risk(*bands: str) -> str:
        pairs = [x for pair in zip(("0.8", "0.6", "0.4"), bands) for x in pair]
        return f"CASE {steps.format(*pairs)} ELSE '{bands[-1]}' END"

    return f"""SELECT * EXCLUDE (q, m), round(1 - q, 4) AS ON_TIME_PROBABILITY, q AS DELAY_PROBABILITY,
        round(m, 1) AS PREDICTED_DELAY_MIN, round(q * m, 1) AS EXPECTED_DELAY_MIN, {risk('Low', 'Medium', 'High', 'Severe')} AS RISK_LEVEL,
        {risk('green', 'orange', 'red', 'darkred')} AS RISK_COLOR
        FROM (SELECT * EXCLUDE ({', '.join(f'{p}{f}_mean' for p in ('clf_', 'reg_') for f in CATEGORICAL_FEATURES)}),
            round(1 / (1 + exp(-2 * ({trees['classifier']}))), 4) AS q, least(greatest({trees['regressor']}, 0), 300) AS m
            FROM (SELECT *, {', '.join(parts)} FROM x_plain_labelled))"""


SQL: dict[str, str] = {
    # cleaning
    "renamed_known_columns": f"SELECT {RENAMED} FROM fx_raw",
    "typed_columns": "SELECT * FROM typed",
    "rows_with_core_keys": f"SELECT * FROM typed WHERE {CORE}",
    "trimmed_text": f"SELECT * REPLACE ({', '.join(map(trimmed, FLIGHT_TEXT_COLUMNS))}) FROM typed",
    "cancelled_delays_voided": f"SELECT * REPLACE ({VOIDED}) FROM typed",
    "cleaned_flights": "SELECT * FROM cleaned",
    "staging_rows": f"SELECT {', '.join(STAGED)} FROM staged",
    "deduplicated_flights": f"""SELECT {', '.join(STAGED)} FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY FLIGHT_ID
        ORDER BY {numbered(STAGED)}) AS rn FROM staged) WHERE rn = 1""",
    "csv_scan": f"""SELECT {CLEAN} FROM (SELECT * REPLACE ({ABSENT}) FROM typed WHERE YEAR % 2 = 1
        UNION ALL SELECT * FROM typed WHERE YEAR % 2 = 0) WHERE {CORE}""",
    "archives_loaded": f"SELECT * FROM cleaned WHERE NOT ({BROKEN})",
    "archives_that_failed": f"""SELECT DISTINCT CONCAT('ontime_', CAST(YEAR AS VARCHAR), '_',
        LPAD(CAST(MONTH AS VARCHAR), 2, '0'), '.zip') AS ARCHIVE FROM typed WHERE {BROKEN}""",
    "rows_by_source_tag": "SELECT 'BTS' AS _SOURCE, COUNT(*) AS N, COUNT(*) AS STAMPED FROM cleaned",
    "guard_answers": """SELECT COUNT(*) AS N, COUNT(DISTANCE) > 0 AS HAS_DISTANCE, FALSE AS HAS_WEATHER, FALSE AS HAS_OTHER,
        COUNT(*) > 0 AS READY FROM fx_flights""",
    "raw_parquet_batch": "SELECT * FROM cleaned",
    "rows_loaded_by_name": "SELECT * EXCLUDE (IS_BAD) FROM by_name WHERE NOT IS_BAD",
    "load_counts": f"SELECT {count_if('NOT IS_BAD')} AS ROWS_LOADED, {count_if('IS_BAD')} AS ERRORS_SEEN FROM by_name",
    # marts
    "delay_trends_monthly": "SELECT * FROM m_monthly",
    "delay_trends_monthly_counting_cancelled": "SELECT * FROM m_monthly_counted",
    "delay_trends_daily": "SELECT * FROM m_daily",
    "airline_performance": "SELECT * FROM m_airlines",
    "airport_stats": "SELECT * FROM m_airports",
    "delay_cause_breakdown": "SELECT * FROM m_causes",
    "route_performance": "SELECT * FROM m_routes",
    "airport_nas_status": "SELECT * FROM m_status",
    "weather_delay_correlation": f"""SELECT YEAR, MONTH, ORIGIN AS IATA_CODE, AVG(ORIGIN_TEMP_C) AS AVG_TEMP_C,
        AVG(ORIGIN_WIND_SPEED_KMH) AS AVG_WIND_SPEED_KMH, AVG(ORIGIN_VISIBILITY_M) AS AVG_VISIBILITY_M,
        {count_if('ORIGIN_SNOWFALL_CM > 0')} AS SNOW_FLIGHT_COUNT, AVG(DEP_DELAY_MIN) AS AVG_DEP_DELAY_MIN,
        AVG(CAST(IS_DEP_DELAYED AS INT)) AS DELAY_RATE FROM f_origin
        WHERE NOT IS_CANCELLED AND ORIGIN_TEMP_C IS NOT NULL GROUP BY YEAR, MONTH, ORIGIN""",
    "delay_trends_of_one_month": f"SELECT * FROM m_monthly WHERE YEAR = {MONTH.year} AND MONTH = {MONTH.month}",
    "mart_month_refreshed_on_disk": f"{OTHER_MONTHS} UNION ALL SELECT * FROM m_monthly WHERE {BROKEN}",
    "mart_month_emptied_on_disk": OTHER_MONTHS,
    "mart_month_replaced": f"""SELECT * FROM m_monthly_counted WHERE NOT (YEAR = {MONTH.year} AND MONTH = {MONTH.month})
        UNION ALL SELECT * FROM m_monthly WHERE YEAR = {MONTH.year} AND MONTH = {MONTH.month}""",
    "delay_trends_from_cells": "SELECT * FROM m_monthly",
    "airline_performance_from_cells": "SELECT * FROM m_airlines",
    "airport_stats_from_cells": "SELECT * FROM m_airports",
    "delay_causes_from_cells": "SELECT * FROM m_causes",
    "route_performance_from_cells": "SELECT * FROM m_routes",
    "distinct_tails_from_sketches": """SELECT YEAR, COUNT(DISTINCT TAIL_NUMBER) AS TAILS, TRUE AS WITHIN_ERROR
        FROM fx_flights GROUP BY YEAR""",
    "airlines_of_years_from_sketches": "SELECT YEAR, COUNT(DISTINCT AIRLINE_CODE) AS N_AIRLINES FROM fx_flights GROUP BY YEAR",
    "programs_of_airports_from_sketches": """SELECT IATA_CODE, COUNT(DISTINCT DELAY_TYPE) AS DELAY_PROGRAMS FROM fx_status
        WHERE HAS_DELAY AND FETCH_DATE IS NOT NULL AND IATA_CODE IS NOT NULL GROUP BY IATA_CODE""",
    "mart_set_refreshed": "SELECT *, 'refreshed' AS OUTCOME FROM m_airlines",
    "mart_truncated_and_reloaded": "SELECT * FROM m_status",
    # ad-hoc
    "annual_trend": f"""SELECT YEAR, {half_up(mean('DELAY_RATE'))} AS AVG_ANNUAL_DELAY_RATE,
        {SUM_FLIGHTS} AS TOTAL_ANNUAL_FLIGHTS, CAST(SUM(TOTAL_CANCELLED) AS BIGINT) AS TOTAL_CANCELLATIONS
        FROM m_monthly GROUP BY YEAR ORDER BY YEAR""",
    "most_delayed_airlines": f"""SELECT AIRLINE_CODE, {half_up(mean('DELAY_RATE'))} AS AVG_DELAY_RATE,
        {half_up(mean('AVG_DEP_DELAY_MIN'))} AS AVG_DELAY_MINUTES, {SUM_FLIGHTS} AS TOTAL_FLIGHTS
        FROM m_airlines GROUP BY AIRLINE_CODE ORDER BY AVG_DELAY_RATE DESC, AIRLINE_CODE LIMIT 10""",
    "month_of_year_pattern": f"""SELECT MONTH, {SEASON}, {half_up(mean('AVG_DEP_DELAY_MIN'))} AS AVG_DELAY_MIN,
        {half_up(mean('WEATHER_DELAY_SHARE'))} AS AVG_WEATHER_SHARE FROM m_monthly GROUP BY MONTH ORDER BY MONTH""",
    "worst_airports": f"""SELECT AIRPORT, CITY, STATE, {half_up(mean('DEP_DELAY_RATE'))} AS AVG_DEP_DELAY_RATE,
        {half_up(mean('AVG_DEP_DELAY_MIN'))} AS AVG_DELAY_MINUTES, CAST(SUM(DEP_FLIGHTS) AS BIGINT) AS TOTAL_DEP_FLIGHTS
        FROM m_airports GROUP BY AIRPORT, CITY, STATE HAVING SUM(DEP_FLIGHTS) > 1000
        ORDER BY AVG_DEP_DELAY_RATE DESC, AIRPORT, CITY, STATE LIMIT 20""",
    "cause_composition": f"""SELECT YEAR, {pct('SUM(CARRIER_DELAY_TOTAL_MIN)', f'SUM({ALL_CAUSES})')} AS CARRIER_PCT,
        {pct('SUM(WEATHER_DELAY_TOTAL_MIN)', f'SUM({ALL_CAUSES})')} AS WEATHER_PCT,
        {pct('SUM(NAS_DELAY_TOTAL_MIN)', f'SUM({ALL_CAUSES})')} AS NAS_PCT,
        {pct('SUM(LATE_AIRCRAFT_DELAY_TOTAL_MIN)', f'SUM({ALL_CAUSES})')} AS LATE_AIRCRAFT_PCT
        FROM m_causes GROUP BY YEAR ORDER BY YEAR""",
    "months_with_cancel_rate": f"""SELECT YEAR, MONTH, TOTAL_FLIGHTS, TOTAL_CANCELLED,
        {pct('TOTAL_CANCELLED', 'TOTAL_FLIGHTS')} AS CANCEL_RATE, DELAY_RATE, AVG_DEP_DELAY_MIN
        FROM m_monthly WHERE {IN_YEARS} ORDER BY YEAR, MONTH""",
    "busiest_routes": f"""SELECT ROUTE, {SUM_FLIGHTS} AS TOTAL_FLIGHTS, {half_up(mean('DELAY_RATE'))} AS AVG_DELAY_RATE,
        {half_up(mean('AVG_DEP_DELAY_MIN'))} AS AVG_DELAY_MIN, {half_up(mean('AVG_DISTANCE'), 0)} AS DISTANCE_MILES
        FROM m_routes GROUP BY ROUTE HAVING SUM(m_routes.TOTAL_FLIGHTS) > {BUSY_ROUTE}
        ORDER BY 2 DESC, ROUTE LIMIT 25""",
    "weekday_pattern": f"""SELECT DAY_OF_WEEK, DAY_NAME, COUNT(*) AS TOTAL_FLIGHTS,
        {pct(count_if('IS_DEP_DELAYED'), 'COUNT(*)')} AS DELAY_RATE, {positive('DEP_DELAY_MIN')} AS AVG_DELAY_MIN
        FROM fx_flights LEFT JOIN d_weekdays USING (DAY_OF_WEEK) WHERE NOT IS_CANCELLED GROUP BY ALL""",
    # dashboard
    "home_totals": f"""SELECT {SUM_FLIGHTS} AS TOTAL_FLIGHTS, {SEASON},
        {half_up(mean('AVG_DEP_DELAY_MIN'))} AS AVG_DEP_DELAY_MIN, {half_up(mean('AVG_ARR_DELAY_MIN'))} AS AVG_ARR_DELAY_MIN,
        MIN(YEAR) || ' – ' || MAX(YEAR) AS YEAR_RANGE, COUNT(DISTINCT YEAR) AS YEARS_COVERED FROM m_monthly""",
    "airline_count": "SELECT COUNT(DISTINCT AIRLINE_CODE) AS N_AIRLINES FROM m_airlines",
    "home_annual": f"""SELECT YEAR, {SUM_FLIGHTS} AS TOTAL_FLIGHTS, CAST(SUM(TOTAL_DELAYED) AS BIGINT) AS TOTAL_DELAYED,
        CAST(SUM(TOTAL_CANCELLED) AS BIGINT) AS TOTAL_CANCELLED,
        {pct('SUM(m_monthly.TOTAL_DELAYED)', 'SUM(m_monthly.TOTAL_FLIGHTS)')} AS DELAY_RATE,
        {half_up(mean('m_monthly.AVG_DEP_DELAY_MIN'))} AS AVG_DEP_DELAY_MIN FROM m_monthly GROUP BY YEAR""",
    "home_seasonal": f"""SELECT MONTH, {SEASON}, {half_up(mean('AVG_DEP_DELAY_MIN'))} AS AVG_DEP_DELAY_MIN, MONTH_LABEL
        FROM m_monthly JOIN d_months USING (MONTH) GROUP BY MONTH, MONTH_LABEL""",
    "year_ranges": " UNION ALL ".join(
        in_range(mart).format(name)
        for name, mart in [
            ("trends", "m_monthly"),
            ("airlines", "m_airlines"),
            ("airports", "m_airports"),
            ("causes", "m_causes"),
            ("routes", "m_routes"),
        ]
    ),
    "rows_of_years": f"SELECT * FROM m_airlines WHERE YEAR BETWEEN {FEW_YEARS[0]} AND {FEW_YEARS[1]}",
    "trend_months": f"""SELECT * EXCLUDE (TOTAL_CANCELLED), CONCAT(YEAR, '-', LPAD(CAST(MONTH AS VARCHAR), 2, '0')) AS PERIOD
        FROM m_monthly WHERE {IN_YEARS}""",
    "trend_years": f"""SELECT YEAR, {SUM_FLIGHTS} AS TOTAL_FLIGHTS, CAST(SUM(TOTAL_DELAYED) AS BIGINT) AS TOTAL_DELAYED,
        {mean('AVG_DEP_DELAY_MIN')} AS AVG_DEP_DELAY_MIN,
        {pct('SUM(m_monthly.TOTAL_DELAYED)', 'SUM(m_monthly.TOTAL_FLIGHTS)')} AS DELAY_RATE
        FROM m_monthly WHERE {IN_YEARS} GROUP BY YEAR""",
    "trend_lines_per_year": f"""SELECT YEAR, MONTH, DELAY_RATE, MONTH_LABEL FROM m_monthly JOIN d_months USING (MONTH)
        WHERE YEAR BETWEEN {FEW_YEARS[0]} AND {FEW_YEARS[1]}""",
    "trend_lines_of_many_years": f"""SELECT MONTH, {mean('DELAY_RATE')} AS AVG_DELAY_RATE,
        {mean('AVG_DEP_DELAY_MIN')} AS AVG_DEP_DELAY_MIN, MONTH_LABEL FROM m_monthly JOIN d_months USING (MONTH)
        GROUP BY MONTH, MONTH_LABEL""",
    "trend_cause_shares": f"""SELECT YEAR, {mean('CARRIER_DELAY_SHARE')} AS CARRIER, {mean('WEATHER_DELAY_SHARE')} AS WEATHER,
        {mean('NAS_DELAY_SHARE')} AS NAS FROM m_monthly WHERE {IN_YEARS} GROUP BY YEAR""",
    "airline_summary": "SELECT * FROM r_airlines_top",
    "airline_years": f"""SELECT YEAR, AIRLINE_CODE, {pct('SUM(DELAYED_FLIGHTS)', 'SUM(TOTAL_FLIGHTS)')} AS DELAY_RATE,
        COALESCE(NAME, AIRLINE_CODE) AS AIRLINE_LABEL FROM m_airlines LEFT JOIN d_airlines USING (AIRLINE_CODE)
        WHERE {IN_YEARS} AND AIRLINE_CODE IN (SELECT AIRLINE_CODE FROM r_airlines
            ORDER BY TOTAL_FLIGHTS DESC, AIRLINE_CODE LIMIT 8) GROUP BY YEAR, AIRLINE_CODE, NAME""",
    "airline_table": """SELECT AIRLINE_NAME AS "Airline", TOTAL_FLIGHTS AS "Total Flights",
        ON_TIME_RATE AS "On-Time Rate (%)", DELAY_RATE AS "Delay Rate (%)", CANCEL_RATE AS "Cancel Rate (%)",
        AVG_DEP_DELAY_MIN AS "Avg Dep Delay (min)", AVG_ARR_DELAY_MIN AS "Avg Arr Delay (min)" FROM r_airlines_top""",
    "airport_summary": "SELECT * FROM r_airports",
    "busiest_airports": "SELECT * FROM r_airports ORDER BY DEP_FLIGHTS DESC, AIRPORT, CITY LIMIT 5",
    "most_delayed_airports": "SELECT * FROM r_airports ORDER BY DEP_DELAY_RATE DESC, AIRPORT, CITY LIMIT 5",
    "airport_comparison": """SELECT AIRPORT, LABEL, STATE, DEP_FLIGHTS, DEP_DELAY_RATE, ARR_DELAY_RATE,
        GREATEST(MAX(DEP_DELAY_RATE) OVER (), MAX(ARR_DELAY_RATE) OVER ()) AS MAX_RATE
        FROM (SELECT * FROM r_airports ORDER BY DEP_FLIGHTS DESC, AIRPORT, CITY LIMIT 60)""",
    "states": f"""SELECT STATE, CAST(SUM(DEP_FLIGHTS) AS BIGINT) AS DEP_FLIGHTS,
        CAST(SUM(DEP_DELAYED) AS BIGINT) AS DEP_DELAYED,
        {pct('SUM(r_airports.DEP_DELAYED)', 'GREATEST(SUM(r_airports.DEP_FLIGHTS), 1)')} AS DEP_DELAY_RATE
        FROM r_airports GROUP BY STATE""",
    "airport_table": """SELECT AIRPORT AS "Code", CITY AS "City", STATE AS "State", DEP_FLIGHTS AS "Dep Flights",
        ARR_FLIGHTS AS "Arr Flights", DEP_DELAY_RATE AS "Dep Delay %", ARR_DELAY_RATE AS "Arr Delay %",
        CANCEL_RATE AS "Cancel %", AVG_DEP_DELAY_MIN AS "Avg Dep Delay (min)",
        AVG_ARR_DELAY_MIN AS "Avg Arr Delay (min)" FROM r_airports""",
    "cause_totals": "SELECT CAUSE, TOTAL_MIN, "
    + f"COALESCE({pct('TOTAL_MIN', 'SUM(TOTAL_MIN) OVER ()', 1)}, 0) AS PCT, "
    + "TOTAL_MIN = MAX(TOTAL_MIN) OVER () AS IS_TOP FROM ("
    + " UNION ALL ".join(
        f"SELECT '{label}' AS CAUSE, COALESCE(SUM({name}), 0) AS TOTAL_MIN FROM m_causes WHERE {IN_YEARS}"
        for name, label in CAUSE_LABELS
    )
    + ")",
    "cause_years": "SELECT * FROM r_causes",
    "cause_year_shares": "SELECT YEAR, "
    + ", ".join(f'{pct(name, ALL_CAUSES, 1)} AS "{label}_PCT"' for name, label in CAUSE_LABELS)
    + " FROM r_causes",
    "cause_months": "SELECT MONTH, MONTH_LABEL, "
    + ", ".join(f"{half_up(mean(name), 0)} AS {name}" for name in CAUSES)
    + f" FROM m_causes JOIN d_months USING (MONTH) WHERE {IN_YEARS} GROUP BY MONTH, MONTH_LABEL",
    "route_summary": "SELECT * FROM r_routes",
    "most_delayed_routes": "SELECT * FROM r_routes ORDER BY DELAY_RATE DESC, ROUTE LIMIT 10",
    "busiest_route_rows": "SELECT * FROM r_routes ORDER BY TOTAL_FLIGHTS DESC, ROUTE LIMIT 10",
    "routes_by_distance": """SELECT ROUTE, AVG_DISTANCE, DELAY_RATE, TOTAL_FLIGHTS, AVG_DEP_DELAY_MIN
        FROM r_all_routes ORDER BY TOTAL_FLIGHTS DESC, ROUTE LIMIT 200""",
    "route_months": "SELECT * FROM r_route_months",
    "route_years": f"""SELECT YEAR, {SUM_FLIGHTS} AS TOTAL_FLIGHTS, {mean('DELAY_RATE')} AS DELAY_RATE,
        {mean('AVG_DEP_DELAY_MIN')} AS AVG_DEP_DELAY_MIN FROM r_route_months GROUP BY YEAR""",
    "route_names": "SELECT DISTINCT ROUTE FROM r_routes",
    "default_route": "SELECT ROUTE FROM r_routes ORDER BY ROUTE = 'LAX-JFK' DESC, ROUTE LIMIT 1",
    "routes_found": """SELECT ROUTE AS "Route", TOTAL_FLIGHTS AS "Total Flights", DELAY_RATE AS "Delay Rate (%)",
        AVG_DEP_DELAY_MIN AS "Avg Dep Delay (min)", AVG_DISTANCE AS "Avg Distance (mi)" FROM r_routes
        WHERE contains(ROUTE, 'LAX')""",
    "route_history": f"""SELECT ORIGIN, DEST, AVG_DEP_DELAY_MIN, TOTAL_FLIGHTS FROM m_routes
        WHERE ORIGIN = '{ROUTE[0]}' AND DEST = '{ROUTE[1]}' ORDER BY YEAR DESC, MONTH DESC LIMIT 1""",
    "flights_with_route_history": """SELECT FLIGHT_DATE, f.ORIGIN, f.DEST, TAIL_NUMBER,
        r.AVG_DEP_DELAY_MIN AS ROUTE_AVG_DEP_DELAY_MIN, r.TOTAL_FLIGHTS AS ROUTE_TOTAL_FLIGHTS FROM fx_flights f
        LEFT JOIN (SELECT *, ROW_NUMBER() OVER (PARTITION BY ORIGIN, DEST ORDER BY YEAR DESC, MONTH DESC) AS rn FROM m_routes) r
        ON f.ORIGIN = r.ORIGIN AND f.DEST = r.DEST AND r.rn = 1""",
    # labels and text
    "airline_labels": """SELECT AIRLINE_CODE, l_orderkey, COALESCE(NAME || ' (' || AIRLINE_CODE || ')', AIRLINE_CODE) AS LABEL,
        AIRLINE_CODE AS CODE FROM c_carriers LEFT JOIN d_airlines USING (AIRLINE_CODE)""",
    "airport_labels": """SELECT event_id, COALESCE(n.IATA_CODE || ' — ' || AIRPORT_NAME, n.IATA_CODE) AS LABEL,
        n.IATA_CODE AS CODE FROM fx_nas n LEFT JOIN d_airports d ON n.IATA_CODE = d.IATA_CODE""",
    "minutes_from_text": f"SELECT event_id, AVG_TXT, {text_minutes('AVG_TXT')} AS MINUTES FROM fx_nas",
    "program_types": f"""SELECT event_id, {program_type('TYPE_NAME')} AS DELAY_TYPE,
        {program_type('REASON')} AS OTHER_TYPE FROM fx_nas""",
    "weather_numbers": """SELECT event_id, TRY_CAST(regexp_extract(TEMP_TXT, '([-0-9.]+)', 1) AS DOUBLE) AS TEMP_F,
        TRY_CAST(NULLIF(regexp_extract(VIS_TXT, '([0-9.]+)', 1), '') AS DOUBLE) AS VIS_MI FROM fx_nas""",
    "risk_bands": """SELECT l_orderkey, l_quantity / 50 AS ON_TIME,
        CASE WHEN l_quantity / 50 >= 0.8e0 THEN 'Low' WHEN l_quantity / 50 >= 0.6e0 THEN 'Medium'
            WHEN l_quantity / 50 >= 0.4e0 THEN 'High' ELSE 'Severe' END AS RISK_LEVEL,
        CASE WHEN l_quantity / 50 >= 0.8e0 THEN 'green' WHEN l_quantity / 50 >= 0.6e0 THEN 'orange'
            WHEN l_quantity / 50 >= 0.4e0 THEN 'red' ELSE 'darkred' END AS RISK_COLOR FROM lineitem""",
    "weekdays_from_sunday": """SELECT FLIGHT_DATE, CAST(dayofweek(FLIGHT_DATE) + 1 AS INT) AS DEP_DOW, COUNT(*) AS N
        FROM fx_flights GROUP BY ALL""",
    "airport_dimension": """SELECT n.IATA_CODE, COUNT(*) AS N, CAST(LATITUDE AS DOUBLE) AS LATITUDE,
        CAST(LONGITUDE AS DOUBLE) AS LONGITUDE, TIME_ZONE, AIRPORT_NAME, HAS_COORDINATES, HAS_WEATHER, IN_NAS_FEED
        FROM fx_nas n LEFT JOIN d_airports d ON n.IATA_CODE = d.IATA_CODE GROUP BY ALL""",
    "label_dimensions": """SELECT MONTH, DAY_OF_WEEK, COUNT(*) AS N, MONTH_LABEL, DAY_NAME FROM fx_flights
        JOIN d_months USING (MONTH) JOIN d_weekdays USING (DAY_OF_WEEK) GROUP BY ALL""",
    # weather
    "hourly_weather": f"SELECT {WX_COLUMNS} FROM fx_wx",
    "hourly_weather_of_one_year": f"SELECT {WX_COLUMNS} FROM fx_wx WHERE YEAR = 1998",
    "weather_document_scan": f"SELECT {WX_COLUMNS} FROM fx_wx",
    "origin_weather": f"SELECT {JOIN_KEYS}, " + ", ".join(f"ORIGIN_{n}" for n in ORIGIN_FIELDS) + " FROM f_origin",
    "destination_weather": f"SELECT {JOIN_KEYS}, " + ", ".join(f"DEST_{n}" for n in DEST_FIELDS) + " FROM f_dest",
    "weather_from_buckets": f"SELECT {JOIN_KEYS}, "
    + ", ".join([*(f"ORIGIN_{n}" for n in ORIGIN_FIELDS), *(f"DEST_{n}" for n in DEST_FIELDS)])
    + " FROM f_both",
    "weather_files_counted": "SELECT COUNT(*) AS ROWS_WRITTEN, COUNT(*) AS ROWS_READ, CAST(26 AS BIGINT) AS FILES FROM fx_wx",
    "weather_fill_status": f"""SELECT COUNT(*) AS TOTAL_FLIGHTS, COUNT(ORIGIN_TEMP_C) AS ORIGIN_FILLED,
        COUNT(DEST_TEMP_C) AS DEST_FILLED, {count_if('ORIGIN_TEMP_C IS NULL')} AS ORIGIN_NULL
        FROM f_both WHERE YEAR >= 1998""",
    "weather_load_counts": """SELECT COUNT(*) AS ROWS_LOADED, CAST(0 AS BIGINT) AS ERRORS_SEEN,
        COUNT(*) AS ROWS_STORED FROM fx_wx""",
    "stored_weather_filled": f"""SELECT 'before' AS AT, COUNT(*) AS TOTAL_FLIGHTS, CAST(0 AS BIGINT) AS ORIGIN_FILLED,
        CAST(0 AS BIGINT) AS DEST_FILLED, COUNT(*) AS ORIGIN_NULL FROM fx_flights WHERE YEAR >= 1998 UNION ALL
        SELECT 'after', COUNT(*), COUNT(ORIGIN_TEMP_C), COUNT(DEST_TEMP_C), {count_if('ORIGIN_TEMP_C IS NULL')}
        FROM f_both WHERE YEAR >= 1998""",
    "airport_coordinates": """SELECT DISTINCT lower(n.IATA_CODE) AS IATA_CODE, CAST(LATITUDE AS DOUBLE) AS LATITUDE,
        CAST(LONGITUDE AS DOUBLE) AS LONGITUDE, TIME_ZONE FROM fx_nas n JOIN d_airports d ON n.IATA_CODE = d.IATA_CODE
        WHERE HAS_COORDINATES""",
    "weather_fetch_grid": f"""SELECT o.IATA_CODE, TIME_ZONE, CAST(y AS INT) AS YEAR
        FROM (SELECT DISTINCT ORIGIN AS IATA_CODE FROM fx_flights) o JOIN d_airports d ON o.IATA_CODE = d.IATA_CODE,
        range({YEARS[0]}, {YEARS[1] + 1}) AS r(y)""",
    # months
    "month_sequence": """SELECT CAST(EXTRACT(YEAR FROM m) AS INT) AS YEAR, CAST(EXTRACT(MONTH FROM m) AS INT) AS MONTH
        FROM (SELECT unnest(generate_series(date_trunc('month', MIN(FLIGHT_DATE)), date_trunc('month', MAX(FLIGHT_DATE)),
            INTERVAL 1 MONTH)) AS m FROM fx_flights)""",
    "missing_months": """SELECT YEAR, MONTH FROM c_requested r WHERE NOT EXISTS (
        SELECT 1 FROM c_present p WHERE p.YEAR = r.YEAR AND p.MONTH = r.MONTH)""",
    "month_coverage": f"""SELECT COUNT(*) AS MONTHS_REQUESTED, COUNT(PRESENT) AS MONTHS_PRESENT,
        {count_if('PRESENT IS NULL')} AS MONTHS_MISSING FROM c_requested LEFT JOIN c_present USING (YEAR, MONTH)""",
    # delay programs
    "cleaned_nas": "SELECT * FROM programs",
    "snapshot_scan": "SELECT * FROM programs",
    "snapshot_scan_of_one_date": f"SELECT * FROM programs WHERE FETCH_DATE = DATE '{DAY}'",
    "dated_files": "SELECT FETCH_DATE AS DATE_KEY, FETCH_DATE, COUNT(*) AS N FROM programs GROUP BY FETCH_DATE",
    "programs_from_xml": FED.format(STAMP=HOURLY_STAMP, REASON="regexp_replace(left(REASON, 500), '$', '')"),
    "programs_from_aggregate_json": FED.format(STAMP=HOURLY_STAMP, REASON="left(REASON, 500)"),
    "programs_from_airport_json": f"""SELECT strftime(SNAPSHOT_TS, '%Y-%m-%dT%H:%M:%S') AS SNAPSHOT_TS,
        CAST(FETCH_DATE AS VARCHAR) AS FETCH_DATE, IATA_CODE, HAS_DELAY, CASE WHEN HAS_DELAY THEN DELAY_COUNT ELSE 0 END AS DELAY_COUNT,
        CASE WHEN HAS_DELAY THEN {program_type('TYPE_NAME')} END AS DELAY_TYPE,
        CASE WHEN HAS_DELAY THEN left(COALESCE(REASON, ''), 500) END AS REASON, {text_minutes('AVG_TXT')} AS AVG_DELAY_MIN,
        CAST(NULL AS INT) AS MIN_DELAY_MIN, {text_minutes('MAX_TXT')} AS MAX_DELAY_MIN,
        CASE WHEN HAS_DELAY THEN COALESCE(TREND, '') END AS TREND, CASE WHEN HAS_DELAY THEN '' END AS END_TIME,
        TRY_CAST(regexp_extract(TEMP_TXT, '(-?[0-9]+(\\.[0-9]+)?)', 1) AS DOUBLE) AS WEATHER_TEMP_F,
        TRY_CAST(NULLIF(regexp_extract(VIS_TXT, '([0-9]+(\\.[0-9]+)?)', 1), '') AS DOUBLE) AS WEATHER_VIS_MI,
        TREND AS WEATHER_WIND, CAST(NULL AS VARCHAR) AS WEATHER_CONDITION FROM fx_nas""",
    "completed_snapshot": """SELECT FETCH_DATE, IATA_CODE, HAS_DELAY, DELAY_COUNT, DELAY_TYPE, AVG_DELAY_MIN
        FROM fx_status WHERE HAS_DELAY UNION ALL
        SELECT FETCH_DATE, IATA_CODE, FALSE, 0, NULL, NULL FROM (SELECT DISTINCT FETCH_DATE FROM fx_status WHERE HAS_DELAY) d,
            (SELECT IATA_CODE FROM d_airports WHERE IN_NAS_FEED) a
        WHERE NOT EXISTS (SELECT 1 FROM fx_status s WHERE s.HAS_DELAY AND s.FETCH_DATE = d.FETCH_DATE
            AND s.IATA_CODE = a.IATA_CODE)""",
    "date_replaced": f"{OTHER_DAYS} UNION ALL {NEW_DAY}",
    "date_replaced_on_disk": f"{OTHER_DAYS} UNION ALL {NEW_DAY}",
    "date_emptied_on_disk": OTHER_DAYS,
    "loads_cut_short": f"""SELECT 'stopped' AS STATE, FETCH_DATE, COUNT(*) AS N FROM programs GROUP BY FETCH_DATE UNION ALL
        SELECT 'loaded', FETCH_DATE, COUNT(*) FROM ({OTHER_DAYS} UNION ALL {NEW_DAY}) GROUP BY FETCH_DATE UNION ALL
        SELECT 'mart', FLIGHT_DATE, TOTAL_FLIGHTS FROM m_daily""",
    "feed_summary": """SELECT COUNT(DISTINCT IATA_CODE) AS AIRPORTS_FETCHED,
        COUNT(DISTINCT CASE WHEN HAS_DELAY THEN IATA_CODE END) AS AIRPORTS_WITH_DELAY FROM fx_status""",
    "status_totals": f"""SELECT COUNT(DISTINCT IATA_CODE) AS AIRPORTS_WITH_DELAY,
        {count_if('HAS_GROUND_STOP')} AS TOTAL_GROUND_STOPS, {count_if('HAS_GROUND_DELAY')} AS TOTAL_GROUND_DELAYS,
        MAX(MAX_AVG_DELAY_MIN) AS WORST_AVG_DELAY_MIN FROM m_status WHERE FETCH_DATE = {LATEST}""",
    "active_programs": f"""SELECT IATA_CODE AS "Airport", DELAY_TYPE AS "Type", AVG_DELAY_MIN AS "Avg Delay (min)",
        TREND AS "Trend", REASON AS "Reason" FROM fx_status WHERE FETCH_DATE = {LATEST} AND HAS_DELAY""",
    "programs_by_date": """SELECT FETCH_DATE, CAST(SUM(DELAY_PROGRAMS) AS BIGINT) AS TOTAL_PROGRAMS
        FROM m_status GROUP BY FETCH_DATE""",
    "programs_by_type": """SELECT DELAY_TYPE AS "Delay Type", COUNT(*) AS "Occurrences" FROM fx_status
        WHERE HAS_DELAY GROUP BY DELAY_TYPE""",
    "latest_status_rows": f"""SELECT event_id, FETCH_DATE, IATA_CODE, HAS_DELAY, DELAY_TYPE, AVG_DELAY_MIN, TREND
        FROM fx_status WHERE FETCH_DATE = {LATEST}""",
    "day_records": f"""SELECT FETCH_DATE, IATA_CODE, HAS_DELAY, DELAY_COUNT, DELAY_TYPE, REASON, AVG_DELAY_MIN
        FROM fx_status WHERE FETCH_DATE = DATE '{DAY}'""",
    "severe_delays": f"SELECT {ANOMALY} FROM a_severe",
    "ground_programs": f"SELECT {ANOMALY} FROM a_ground",
    "other_severe_delays": f"SELECT {ANOMALY} FROM a_other",
    "day_summary": "SELECT * FROM a_days",
    "daily_digest": """
        SELECT FETCH_DATE, 'header' AS SECTION, 'date ' || FETCH_DATE || '; records ' || TOTAL_RECORDS || '; with delay '
            || DELAYED_RECORDS || '; mean delay ' || AVG_DELAY_ACROSS_DELAYED || ' min' AS LINE FROM a_days
        UNION ALL
        SELECT FETCH_DATE, 'program', IATA_CODE || '; type ' || DELAY_TYPE || '; mean delay '
            || COALESCE(CAST(AVG_DELAY_MIN AS VARCHAR), 'N/A') || ' min; reason ' || COALESCE(REASON, 'unknown') FROM a_few
        UNION ALL
        SELECT FETCH_DATE, 'severe', IATA_CODE || '; mean delay ' || COALESCE(CAST(AVG_DELAY_MIN AS VARCHAR), 'N/A')
            || ' min; max delay ' || COALESCE(CAST(MAX_DELAY_MIN AS VARCHAR), 'N/A') || ' min; weather N/A; reason '
            || substr(COALESCE(REASON, 'unknown'), 1, 80)
        FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY FETCH_DATE ORDER BY COALESCE(AVG_DELAY_MIN, 0) DESC,
            IATA_CODE, DELAY_TYPE, REASON) AS rn FROM a_other) WHERE rn <= 10
        UNION ALL
        SELECT DISTINCT FETCH_DATE, 'clear', 'no unusual delays, operations normal' FROM fx_status s
        WHERE NOT EXISTS (SELECT 1 FROM a_few g WHERE g.FETCH_DATE = s.FETCH_DATE)
            AND NOT EXISTS (SELECT 1 FROM a_other o WHERE o.FETCH_DATE = s.FETCH_DATE)""",
    # streams
    "snapshot_stream_keys": "SELECT * FROM programs",
    "snapshot_stream_table": "SELECT * FROM programs",
    "late_files_repaired": "SELECT * FROM programs",
    "late_rows_diverted": """SELECT FETCH_DATE, COUNT(*) AS LATE_ROWS, CAST(0 AS BIGINT) AS WITHOUT_REPAIR FROM lines
        WHERE FETCH_DATE < DATE '2024-01-09' GROUP BY FETCH_DATE""",
    "daily_count_stream": """SELECT CAST(SNAPSHOT_TS AS DATE) AS DAY, COUNT(*) AS PROGRAMS FROM lines
        WHERE HAS_DELAY AND FETCH_DATE IS NOT NULL GROUP BY ALL""",
    # split and sample
    "split_summary": f"""SELECT LABEL_CLASS, {count_if('NOT IS_VALIDATION')} AS TRAIN_ROWS,
        {count_if('IS_VALIDATION')} AS VALIDATION_ROWS FROM {SPLIT} GROUP BY LABEL_CLASS""",
    "split_rows": f"SELECT * FROM {SPLIT}",
    "flight_sample": f"""SELECT FLIGHT_DATE, ORIGIN, DEST, TAIL_NUMBER FROM fx_flights
        WHERE {hashed(SAMPLE_KEYS)} < 10""",
    # models
    "stored_tree_scores": stored_scores(),
    "stored_tree_metrics": f"""SELECT round((n - alarms - (pos - hits)) / n, 6) AS ACCURACY,
        round(2 * hits / NULLIF(hits + alarms + pos, 0), 6) AS F1,
        round((ranks - pos * (pos + 1) / 2) / NULLIF(pos * (n - pos), 0), 6) AS AUC_ROC,
        round(sqrt(squares / n), 4) AS RMSE, round(misses / n, 4) AS MAE, n AS "ROWS" FROM (
        SELECT COUNT(*) AS n, SUM(LABEL_CLASS) AS pos, {count_if('LABEL_CLASS = 1 AND DELAY_PROBABILITY >= 0.5')} AS hits,
            {count_if('LABEL_CLASS = 0 AND DELAY_PROBABILITY >= 0.5')} AS alarms,
            SUM(CASE WHEN LABEL_CLASS = 1 THEN mean_rank END) AS ranks,
            SUM((PREDICTED_DELAY_MIN - LABEL_REG) * (PREDICTED_DELAY_MIN - LABEL_REG)) AS squares,
            SUM(abs(PREDICTED_DELAY_MIN - LABEL_REG)) AS misses FROM (
            SELECT *, (MIN(place) OVER same + MAX(place) OVER same) / 2.0 AS mean_rank FROM (
                SELECT *, ROW_NUMBER() OVER (ORDER BY DELAY_PROBABILITY) AS place FROM ({stored_scores()}))
            WINDOW same AS (PARTITION BY DELAY_PROBABILITY)))""",
    "model_features": "SELECT * FROM x_weather",
    "model_features_without_weather": "SELECT * FROM x_plain",
    "labelled_rows": "SELECT * FROM x_labelled",
    "class_balance": """SELECT AVG(LABEL_CLASS) AS POSITIVE_RATE, CAST(SUM(LABEL_CLASS) AS BIGINT) AS DELAYED,
        COUNT(LABEL_CLASS) AS TOTAL FROM x_labelled""",
    "class_weight": f"""SELECT {count_if('LABEL_CLASS = 0')} AS NEGATIVE, {count_if('LABEL_CLASS = 1')} AS POSITIVE,
        CAST({count_if('LABEL_CLASS = 0')} AS DOUBLE) / GREATEST({count_if('LABEL_CLASS = 1')}, 1) AS SCALE_POSITIVE
        FROM x_labelled""",
    "out_of_fold_delay_rates": out_of_fold("y_class"),
    "out_of_fold_delay_minutes": out_of_fold("y_reg"),
    "category_values": """SELECT DISTINCT 'OP_CARRIER' AS FEATURE, OP_CARRIER AS VALUE FROM x_labelled
        UNION ALL SELECT DISTINCT 'ORIGIN', ORIGIN FROM x_labelled UNION ALL SELECT DISTINCT 'DEST', DEST FROM x_labelled""",
    "feature_rows": "SELECT DEP_HOUR, DEP_DOW, DEP_MONTH, FLIGHT_DISTANCE, SCHED_ELAPSED_MIN, "
    + ", ".join(
        f"CAST({default} AS {'INT' if name.endswith('CODE') else 'DOUBLE'}) AS {name}"
        for name, _, default in WEATHER_SOURCES
    )
    + ", OP_CARRIER, ORIGIN, DEST, CAST(0 AS DOUBLE) AS EXTRA_FEATURE FROM x_plain",
}

SQL["digest_files"] = f"SELECT FETCH_DATE, LINE FROM ({SQL['daily_digest']})"
# the same queries with limits below the number of rows
for shorter, longer, old, new in [
    ("worst_three_airports", "worst_airports", "LIMIT 20", "LIMIT 3"),
    ("five_busiest_routes", "busiest_routes", "LIMIT 25", "LIMIT 5"),
    ("airport_comparison_of_five", "airport_comparison", "LIMIT 60", "LIMIT 5"),
    ("twenty_routes_by_distance", "routes_by_distance", "LIMIT 200", "LIMIT 20"),
]:
    assert old in SQL[longer]
    SQL[shorter] = SQL[longer].replace(old, new)
SQL["default_route_listed"] = "SELECT DISTINCT 'LAX-JFK' AS ROUTE FROM r_routes WHERE ROUTE LIKE 'LAX-%'"


def needed(sql: str) -> list[str]:
    """Named subqueries that ``sql`` uses, in the order of ``TABLES``."""
    found: set[str] = set()
    open_texts = [sql]
    while open_texts:
        words = set(re.findall(r"\w+", open_texts.pop()))
        fresh = (words & TABLES.keys()) - found
        found |= fresh
        open_texts += [TABLES[name] for name in fresh]
    return [name for name in TABLES if name in found]


def oracle_sql() -> dict[str, str]:
    texts = {}
    for name, sql in SQL.items():
        parts = ",\n".join(
            f"{table} AS {'MATERIALIZED ' if table in MATERIALIZED else ''}({TABLES[table]})" for table in needed(sql)
        )
        texts[name] = f"WITH {parts}\n{sql}" if parts else sql
    return texts
