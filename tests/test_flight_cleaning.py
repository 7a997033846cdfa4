import datetime as dt

from pyspark.sql import functions as F

from tarmac.operators import flight_cleaning as cleaning
from tarmac.schemas import RAW_FLIGHTS, STAGING_FLIGHTS
from tarmac.sources.tables import add_missing_columns
from tests.conftest import one, rows

SOURCE = (
    "FlightDate string, IATA_CODE_Reporting_Airline string, Flight_Number_Reporting_Airline string,"
    " Origin string, Dest string, DepDelayMinutes string, DepDel15 string, Cancelled string"
)


def source(spark, *lines):
    return spark.createDataFrame(list(lines), SOURCE)


GOOD = ("2024-01-31", "AA", "100", "ATL", "LAX", "12.00", "0.00", "0.00")


def staged(frame):
    return cleaning.staging_flights(add_missing_columns(cleaning.clean_flights(frame), RAW_FLIGHTS))


def test_types_and_bad_text(spark):
    frame = source(spark, GOOD, ("31/01/2024", "AA", "1", "ATL", "LAX", "n/a", "1.00", ""))
    typed = cleaning.cast_columns(cleaning.known_columns(cleaning.rename_columns(frame)))
    assert rows(typed.select("FLIGHT_DATE", "DEP_DELAY_MINUTES", "DEP_DEL15", "CANCELLED")) == [
        (dt.date(2024, 1, 31), 12.0, 0, 0),
        (None, None, 1, None),
    ]


def test_null_keys_drop_but_blank_keys_stay(spark):
    blank = ("2024-01-31", "  ", "", "   ", "LAX", "1.00", "0.00", "0.00")
    missing = ("2024-01-31", None, "1", "ATL", "LAX", "1.00", "0.00", "0.00")
    frame = staged(source(spark, blank, missing))
    assert one(frame.select("FLIGHT_ID", "AIRLINE_CODE", "ORIGIN")) == ("XX_0_20240131_XXX_LAX", None, None)


def test_cancelled_flag_decides_on_delays(spark):
    lines = [GOOD[:5] + ("7.00", "0.00", flag) for flag in ("1.00", "0.00", None)]
    cleaned = cleaning.clean_flights(source(spark, *lines))
    assert rows(cleaned.select("CANCELLED", "DEP_DELAY_MINUTES")) == [(1, None), (0, 7.0), (None, 7.0)]


def test_flags_keep_nulls(spark):
    lines = [GOOD[:6] + (flag, "0.00") for flag in ("1.00", "0.00", None)]
    assert [r[0] for r in rows(staged(source(spark, *lines)).select("IS_DEP_DELAYED"))] == [True, False, None]


def test_staging_shape(spark):
    frame = cleaning.stamp_load(staged(source(spark, GOOD)))
    assert frame.columns == STAGING_FLIGHTS.names
    assert [f.dataType for f in frame.schema.fields] == [f.dataType for f in STAGING_FLIGHTS.fields]


def test_cleaning_twice_changes_nothing(spark):
    once = cleaning.clean_flights(source(spark, GOOD, ("2024-02-01", " DL ", "", "JFK ", "SEA", "0.00", "0.00", "1.00")))
    again = cleaning.void_cancelled_delays(cleaning.trim_text(cleaning.with_core_keys(once)))
    assert rows(once) == rows(again)


def test_source_tag(spark):
    tagged = cleaning.tag_source(source(spark, GOOD))
    row = tagged.select("_SOURCE", "_LOAD_TS").collect()[0]
    assert row[0] == "BTS" and row[1] is not None


def test_deduplication_is_independent_of_order(spark):
    lines = [GOOD[:5] + (f"{at}.00", "0.00", "0.00") for at in (9, 3, 5)]
    kept = [
        rows(cleaning.deduplicate_flights(staged(source(spark, *order))).select("DEP_DELAY_MIN"))
        for order in (lines, lines[::-1])
    ]
    assert kept[0] == kept[1] and len(kept[0]) == 1


def test_hot_flight_id(spark):
    """A third of all rows share one key; every key still gives one row."""
    frame = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 100)).alias("FLIGHT_ID"),
        F.col("id").alias("N"),
    )
    kept = cleaning.deduplicate_flights(frame)
    assert kept.count() == frame.select("FLIGHT_ID").distinct().count()
    assert kept.join(frame, ["FLIGHT_ID", "N"], "left_anti").count() == 0
    # equal rows are one row
    assert cleaning.deduplicate_flights(frame.union(frame)).count() == kept.count()
