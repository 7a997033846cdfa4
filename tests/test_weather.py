import datetime as dt

from pyspark.sql import functions as F

from checks import registry, stand_ins
from tarmac.operators import weather
from tarmac.plans import weather_history
from tarmac.schemas import HOURLY_FIELDS, WEATHER_DOCUMENT, WEATHER_HOURLY
from tarmac.sources.tables import add_missing_columns
from tarmac.sources.versions import VersionedTable
from tests.conftest import one, plan, rows


def documents(spark, *given):
    full = []
    for code, hourly in given:
        full.append((code, {"time": None, **{field: None for field, _, _ in HOURLY_FIELDS}, **hourly}))
    return spark.createDataFrame(full, WEATHER_DOCUMENT)


def test_unequal_arrays_and_missing_times(spark):
    frame = documents(
        spark,
        ("atl", {"time": ["2024-01-05T00:00", "2024-01-05T01:00"], "temperature_2m": [1.5], "rain": [], "weather_code": [3.0, 4.0, 5.0]}),
        ("lax", {"time": [], "temperature_2m": []}),
        (None, {"time": ["2024-01-05T00:00"], "temperature_2m": [1.0]}),
    )
    cleaned = weather.clean_weather(frame)
    # the load stamps its rows; cleaning does not
    fields = [f for f in WEATHER_HOURLY.fields if f.name != "_LOAD_TS"]
    assert [(f.name, f.dataType) for f in cleaned.schema.fields] == [(f.name, f.dataType) for f in fields]
    got = cleaned.select("IATA_CODE", "OBS_DATE", "OBS_HOUR", "TEMP_C", "RAIN_MM", "WEATHER_CODE").orderBy("OBS_HOUR")
    assert rows(got) == [
        ("ATL", dt.date(2024, 1, 5), 0, 1.5, None, 3),
        ("ATL", dt.date(2024, 1, 5), 1, None, None, 4),
    ]


def test_duplicates_and_year(spark):
    hour = {"time": ["2024-01-05T00:00"], "temperature_2m": [2.0]}
    frame = documents(spark, ("atl", hour), ("ATL", {**hour, "temperature_2m": [1.0]}), ("ATL", {**hour, "time": ["2023-12-31T23:00"]}))
    assert sorted(rows(weather.clean_weather(frame).select("YEAR", "TEMP_C"))) == [(2023, 2.0), (2024, 1.0)]
    assert rows(weather.clean_weather(frame, 2023).select("YEAR", "MONTH", "OBS_HOUR")) == [(2023, 12, 23)]


def observations(spark, *given):
    """(airport, date, hour, temperature)"""
    frame = spark.createDataFrame(list(given), "IATA_CODE string, OBS_DATE string, OBS_HOUR int, TEMP_C double")
    rest = {name: F.lit(1).cast(kind) for _, name, kind in HOURLY_FIELDS if name != "TEMP_C"}
    return frame.withColumn("OBS_DATE", F.to_date("OBS_DATE")).withColumns(rest)


def flights(spark, *given):
    frame = spark.createDataFrame(
        list(given), "N int, ORIGIN string, DEST string, FLIGHT_DATE string, SCHEDULED_DEP int, SCHEDULED_ARR int, YEAR int"
    )
    return frame.withColumn("FLIGHT_DATE", F.to_date("FLIGHT_DATE"))


def test_origin_hours(spark):
    obs = observations(spark, ("ATL", "2024-01-05", 0, 1.0), ("ATL", "2024-01-05", 23, 2.0), ("ATL", "2024-01-06", 0, 3.0))
    given = [(at, "ATL", "LAX", "2024-01-05", dep, None, 2024) for at, dep in enumerate([0, 5, 2359, 2400, None, 1200])]
    joined = weather.with_origin_weather(flights(spark, *given), obs).orderBy("N")
    assert [r[0] for r in rows(joined.select("ORIGIN_TEMP_C"))] == [1.0, 1.0, 2.0, None, None, None]


def test_destination_dates(spark):
    obs = observations(
        spark, ("LAX", "2024-12-31", 0, 1.0), ("LAX", "2025-01-01", 1, 2.0), ("LAX", "2024-12-31", 23, 3.0), ("LAX", "2024-03-01", 0, 4.0)
    )
    given = [
        (0, "ATL", "LAX", "2024-12-31", 2300, 100, 2024),
        (1, "ATL", "LAX", "2024-12-31", 2200, 2330, 2024),
        (2, "ATL", "LAX", "2024-12-31", 2300, None, 2024),
        (3, "ATL", "LAX", "2024-02-29", 2300, 30, 2024),
        (4, "ATL", "SEA", "2024-12-31", 2300, 100, 2024),
    ]
    joined = weather.with_destination_weather(flights(spark, *given), obs).orderBy("N")
    assert [r[0] for r in rows(joined.select("DEST_TEMP_C"))] == [2.0, 3.0, 1.0, 4.0, None]


def test_only_empty_rows_are_filled(spark):
    obs = observations(spark, ("ATL", "2024-01-05", 8, 1.0))
    given = flights(spark, (0, "ATL", "LAX", "2024-01-05", 800, 1000, 2024), (1, "ATL", "LAX", "2024-01-05", 830, 1000, 2024))
    given = given.withColumn("ORIGIN_TEMP_C", F.when(F.col("N") == 0, F.lit(77.0)))
    given = given.withColumn("ORIGIN_PRECIP_MM", F.lit(5.0))
    joined = weather.with_origin_weather(given, obs).orderBy("N")
    assert rows(joined.select("ORIGIN_TEMP_C", "ORIGIN_PRECIP_MM")) == [(77.0, 5.0), (1.0, 1.0)]
    # a row without a match keeps what it had
    missed = weather.with_origin_weather(given, observations(spark, ("BOS", "2024-01-05", 8, 1.0))).orderBy("N")
    assert rows(missed.select("ORIGIN_TEMP_C", "ORIGIN_PRECIP_MM")) == [(77.0, 5.0), (None, 5.0)]


def test_join_keeps_row_count_on_a_hot_key(spark):
    obs = observations(spark, ("ATL", "2024-01-05", 8, 1.0), ("ATL", "2024-01-05", 9, 2.0))
    given = spark.range(3000).select(
        F.col("id").cast("int").alias("N"), F.lit("ATL").alias("ORIGIN"), F.lit("LAX").alias("DEST"),
        F.to_date(F.lit("2024-01-05")).alias("FLIGHT_DATE"),
        F.when(F.col("id") % 3 == 0, 800).otherwise((F.col("id") % 24 * 100).cast("int")).alias("SCHEDULED_DEP"),
        F.lit(None).cast("int").alias("SCHEDULED_ARR"), F.lit(2024).alias("YEAR"),
    )
    joined = weather.with_weather(given, obs)
    filled = given.where("SCHEDULED_DEP IN (800, 900)").count()
    assert one(weather.fill_status(joined, 2024)) == (3000, filled, 0, 3000 - filled)


def test_coordinates_ignore_case_and_drop_unknown(spark):
    frame = spark.createDataFrame([("atl",), ("MEM",), ("Sea",)], "IATA_CODE string")
    assert sorted(r[0] for r in rows(weather.with_coordinates(frame).select("IATA_CODE"))) == ["Sea", "atl"]
    assert weather.fetch_grid(frame, 2000, 2025).count() == 2 * 26


def test_stored_months_are_filled_where_they_lie(spark, small, tmp_path, monkeypatch):
    """Few observations move no flight; more than may be broadcast give the same rows."""
    hourly = registry.hourly(spark, small)
    stored, moved = [], []
    prepare = VersionedTable.prepare

    def seen(table, filled, by=(), rebalance=True):
        text = plan(filled, "simple")
        moved.append(rebalance or "SortMergeJoin" in text or "ShuffledHashJoin" in text)
        return prepare(table, filled, by, rebalance)

    for most in (10_000_000, 0):
        path = str(tmp_path / f"staging-{most}")
        table = VersionedTable(spark, path)
        table.replace(add_missing_columns(registry.flights(spark, small)), ["YEAR", "MONTH"])
        monkeypatch.setattr(VersionedTable, "prepare", seen)
        options = {} if most else {"broadcast_rows": 0}
        report = weather_history.fill_stored_weather(spark, path, hourly, 1998, **options)
        monkeypatch.undo()
        names = sorted(table.read().columns)
        stored.append((rows(report), sorted(map(repr, rows(table.read().select(names))))))
    assert stored[0] == stored[1] and stored[0][0][1][2] > 0
    assert moved == [False, True]


def test_flights_are_brought_together_as_lines(spark, small):
    by_month, whole = stand_ins.flights_by_month(spark, small), stand_ins.flights(spark, small)
    assert by_month.schema == whole.schema
    assert by_month.exceptAll(whole).isEmpty() and whole.exceptAll(by_month).isEmpty()
    (moved,) = [line for line in plan(by_month).split("\n\n") if "REBALANCE" in line and "Arguments" in line]
    assert "ORIGIN_CITY" not in moved
