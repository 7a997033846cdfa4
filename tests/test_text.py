from pyspark.sql import functions as F

from tarmac.functions.clock import arrival_date, clock_hour, iso_date, iso_timestamp, risk_level, sunday_first
from tarmac.functions.text import (
    code_and_name,
    code_from_label,
    delay_minutes,
    delay_type,
    first_text,
    name_and_code,
    temperature,
    visibility,
)
from tests.conftest import rows


def apply(spark, function, given):
    frame = spark.createDataFrame([(at, value) for at, value in enumerate(given)], "at int, text string")
    return [row[0] for row in rows(frame.orderBy("at").select(function("text")))]


def test_delay_minutes(spark):
    given = ["1 hour and 5 minutes", "45 minutes", "2 Hours", "0 minutes", " 30 ", "0", "", None, "soon", "90mins", "1.5"]
    assert apply(spark, delay_minutes, given) == [65, 45, 120, None, 30, 0, None, None, None, 90, None]


def test_delay_type_first_rule_wins(spark):
    given = [
        "Ground Delay Programs", "gdp at noon", "Ground Stop", "GSP", "General Arrival/Departure Delay Info",
        "Arrival only", "Airport Closures", "Airspace Flow", "Ground delay and ground stop", "  ", "x" * 40, None,
    ]
    assert apply(spark, delay_type, given) == [
        "GroundDelay", "GroundDelay", "GroundStop", "GroundStop", "ArriveDepart",
        "Arrival only", "Closure", "Airspace", "GroundDelay", "Unknown", "x" * 30, "Unknown",
    ]


def test_first_text(spark):
    given = ['["72.0 F (22.2 C)", "x"]', " calm ", "", "[]", None, '[" "]']
    assert apply(spark, first_text, given) == ["72.0 F (22.2 C)", "calm", None, None, None, None]


def test_weather_numbers(spark):
    assert apply(spark, temperature, ['["-4.5 F"]', "72", "none", "1.2.3", None]) == [-4.5, 72.0, None, None, None]
    assert apply(spark, visibility, ['["10.00"]', "-3 miles", "unlimited", None]) == [10.0, 3.0, None, None]


def test_labels_and_back(spark):
    frame = spark.createDataFrame(
        [("AA", "American Airlines"), ("ZZ", None), ("TW", "Trans World Airlines (TWA)")], "code string, name string"
    )
    labelled = frame.select("code", name_and_code("name", "code").alias("a"), code_and_name("code", "name").alias("b"))
    got = labelled.select("code", "a", "b", code_from_label("a"), code_from_label("b"))
    assert rows(got.orderBy("code")) == [
        ("AA", "American Airlines (AA)", "AA — American Airlines", "AA", "AA"),
        ("TW", "Trans World Airlines (TWA) (TW)", "TW — Trans World Airlines (TWA)", "TW", "TW"),
        ("ZZ", "ZZ", "ZZ", "ZZ", "ZZ"),
    ]


def test_airport_name_with_brackets(spark):
    label = F.lit("SNA — John Wayne (Orange County)")
    assert rows(spark.range(1).select(code_from_label(label))) == [("SNA",)]


def test_clock(spark):
    frame = spark.createDataFrame([(0,), (5,), (959,), (2359,), (2400,), (None,)], "t int")
    assert [row[0] for row in rows(frame.select(clock_hour("t")))] == [0, 0, 9, 23, 24, None]


def test_arrival_date(spark):
    frame = spark.sql(
        "SELECT * FROM VALUES (DATE'2024-12-31', 2300, 100), (DATE'2024-02-28', 2200, 30), (DATE'2024-05-01', 900, 1100),"
        " (DATE'2024-05-01', 900, 900), (DATE'2024-05-01', NULL, 100), (DATE'2024-05-01', 900, NULL) AS t(d, dep, arr)"
    )
    got = [str(row[0]) for row in rows(frame.select(arrival_date("d", "dep", "arr")))]
    assert got == ["2025-01-01", "2024-02-29", "2024-05-01", "2024-05-01", "2024-05-01", "2024-05-01"]


def test_weekday_and_risk(spark):
    assert [r[0] for r in rows(spark.range(1, 8).select(sunday_first("id")))] == [2, 3, 4, 5, 6, 7, 1]
    frame = spark.createDataFrame([(1.0,), (0.8,), (0.79,), (0.6,), (0.4,), (0.39,), (0.0,)], "p double")
    assert [r[0] for r in rows(frame.select(risk_level("p")))] == [
        "Low", "Low", "Medium", "Medium", "High", "Severe", "Severe",
    ]


def test_iso_texts(spark):
    given = ["2024-01-31", "2024-02-30", "2024-1-5", "31/01/2024", "2024-01-31T00:00:00", " 2024-01-31", "", None]
    assert [str(v) for v in apply(spark, iso_date, given)] == ["2024-01-31"] + ["None"] * 7
    given = ["2024-03-10T02:30:00", "2024-03-10 02:30:00", "2024-03-10T02:30", "2024-03-10T02:30:00Z", "x", None]
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")  # this hour is skipped there
    try:
        shown = [str(v) for v in apply(spark, iso_timestamp, given)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert shown == ["2024-03-10 02:30:00"] + ["None"] * 5


def test_an_unknown_program_name_may_stay_whole(spark):
    long_name = "Some Program Of A Name That Is Longer Than The Column"
    frame = spark.createDataFrame([(long_name,)], "name string")
    assert rows(frame.select(delay_type("name"), delay_type("name", None))) == [(long_name[:30], long_name)]
