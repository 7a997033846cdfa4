import datetime as dt

from pyspark.sql import functions as F

from tarmac import dims
from tarmac.operators import anomalies, marts, nas
from tarmac.sources.tables import replace_date
from tests.conftest import one, rows

D1, D2 = dt.date(2024, 1, 5), dt.date(2024, 1, 6)
LINES = "SNAPSHOT_TS string, FETCH_DATE string, IATA_CODE string, HAS_DELAY boolean, DELAY_TYPE string, AVG_DELAY_MIN int"
STATUS = "FETCH_DATE date, IATA_CODE string, HAS_DELAY boolean, DELAY_COUNT int, DELAY_TYPE string, AVG_DELAY_MIN int, REASON string"


def lines(spark, *given):
    from tarmac.schemas import NAS_SNAPSHOT
    from tarmac.sources.tables import add_missing_columns

    return add_missing_columns(spark.createDataFrame(list(given), LINES), NAS_SNAPSHOT)


def status(spark, *given):
    frame = spark.createDataFrame(list(given), STATUS)
    absent = {"MAX_DELAY_MIN": "int", "TREND": "string", "END_TIME": "string", "WEATHER_CONDITION": "string",
              "WEATHER_TEMP_F": "double", "WEATHER_WIND": "string"}
    return frame.withColumns({name: F.lit(None).cast(kind) for name, kind in absent.items()})


def test_latest_snapshot_wins_in_any_order(spark):
    given = [
        ("2024-01-05T06:00:00", "2024-01-05", " atl", True, "GroundStop", 10),
        ("2024-01-05T09:00:00", "2024-01-05", "ATL ", True, "GroundStop", 20),
        ("2024-01-05T07:00:00", "2024-01-05", "ATL", True, "GroundStop", 99),
    ]
    for order in (given, given[::-1]):
        cleaned = nas.clean_nas(lines(spark, *order))
        assert rows(cleaned.select("IATA_CODE", "AVG_DELAY_MIN")) == [("ATL", 20)]


def test_null_keys_in_both_branches(spark):
    given = [
        ("2024-01-05T06:00:00", None, "ATL", True, "GroundStop", 1),
        ("2024-01-05T06:00:00", "2024-01-05", None, True, "GroundStop", 1),
        ("2024-01-05T06:00:00", "not a date", "ATL", False, None, None),
        ("2024-01-05T06:00:00", None, "ATL", False, None, None),
        ("2024-01-05T06:00:00", "2024-01-05", None, False, None, None),
        ("2024-01-05T06:00:00", "2024-01-05", "LAX", False, None, None),
    ]
    cleaned = nas.clean_nas(lines(spark, *given))
    got = sorted(rows(cleaned.select("FETCH_DATE", "IATA_CODE", "DELAY_TYPE")), key=str)
    assert got == sorted([(None, "ATL", None), (D1, None, None), (D1, "LAX", None)], key=str)


def test_complete_snapshot(spark):
    given = status(spark, (D1, "ATL", True, 1, "GroundStop", 9, "x"), (D1, "ATL", True, 1, "Closure", None, "x"),
                   (D2, "XXX", True, 1, "Closure", 5, "x"))
    counts = nas.complete_snapshot(given).groupBy("FETCH_DATE", "HAS_DELAY").count()
    n = len(dims.NAS_AIRPORTS)
    assert n == 50
    assert sorted(rows(counts)) == [(D1, False, n - 1), (D1, True, 2), (D2, False, n), (D2, True, 1)]


def test_replace_date_drops_undated_rows_and_is_idempotent(spark):
    table = status(spark, (D1, "ATL", True, 1, "A", 1, ""), (None, "BOS", True, 1, "A", 1, ""), (D2, "LAX", True, 1, "A", 1, ""))
    new = status(spark, (D1, "DEN", True, 1, "B", 2, ""), (None, "SEA", True, 1, "B", 2, ""))
    once = replace_date(table, new, D1)
    assert sorted(rows(once.select("IATA_CODE"))) == [("DEN",), ("LAX",), ("SEA",)]
    twice = replace_date(once, new, D1)
    assert sorted(rows(twice.select("IATA_CODE"))) == [("DEN",), ("LAX",), ("SEA",)]


def test_status_mart_and_latest(spark):
    table = status(
        spark,
        (D1, "ATL", True, 1, "GroundStop", 30, ""), (D2, "ATL", True, 1, "GroundStop", 30, ""),
        (D2, "ATL", True, 1, "GroundDelay", None, ""), (D2, "ATL", True, 1, "GroundDelay", 70, ""),
        (D2, "LAX", True, 1, "Closure", None, ""), (D2, "SEA", False, 0, None, None, ""),
        (D2, "DEN", None, 0, "Closure", 3, ""), (None, "SFO", True, 1, "Closure", 3, ""),
    )
    mart = marts.airport_nas_status(table)
    assert sorted(rows(mart)) == [
        (D1, "ATL", 1, 30, False, True), (D2, "ATL", 2, 70, True, True), (D2, "LAX", 1, None, False, False),
    ]
    assert one(nas.status_totals(mart)) == (2, 1, 1, 70)
    assert [r[:3] for r in rows(nas.active_programs(table, mart))] == [
        ("ATL", "GroundDelay", 70), ("ATL", "GroundStop", 30), ("ATL", "GroundDelay", None), ("LAX", "Closure", None),
    ]
    assert one(nas.feed_summary(table)) == (5, 3)


def test_anomalies(spark):
    table = status(
        spark,
        (D1, "ATL", True, 1, "GroundStop", 50, "fog"), (D1, "ATL", True, 1, "Closure", 45, "snow"),
        (D1, "LAX", True, 3, "Closure", None, None), (D1, "DEN", True, 2, "Closure", 44, "x"),
        (D1, "SEA", False, 9, None, 99, "x"), (D2, "BOS", False, 0, None, None, None),
    )
    assert sorted(r[1] for r in rows(anomalies.severe(table).select("FETCH_DATE", "IATA_CODE"))) == ["ATL", "ATL", "LAX"]
    assert rows(anomalies.ground_programs(table).select("IATA_CODE")) == [("ATL",)]
    assert rows(anomalies.other_severe(table).select("IATA_CODE")) == [("LAX",)]
    assert sorted(rows(anomalies.day_summary(table))) == [(D1, 5, 4, 34.8), (D2, 1, 0, 0.0)]
    assert [r[0] for r in rows(anomalies.day_records(table, D1).select("IATA_CODE"))] == ["SEA", "ATL", "ATL", "DEN", "LAX"]
    lines = anomalies.digest(table).orderBy("FETCH_DATE", *anomalies.digest_order()).select("SECTION", "LINE")
    assert rows(lines) == [
        ("header", "date 2024-01-05; records 5; with delay 4; mean delay 34.8 min"),
        ("program", "ATL; type GroundStop; mean delay 50 min; reason fog"),
        ("severe", "LAX; mean delay N/A min; max delay N/A min; weather N/A; reason unknown"),
        ("header", "date 2024-01-06; records 1; with delay 0; mean delay 0.0 min"),
        ("clear", "no unusual delays, operations normal"),
    ]


def test_digest_lists_ten_severe_rows_per_day_on_a_hot_day(spark):
    table = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(D1)).otherwise(F.date_add(F.lit(D2), (F.col("id") % 50).cast("int"))).alias("FETCH_DATE"),
        F.concat(F.lit("A"), F.col("id")).alias("IATA_CODE"),
        F.lit(True).alias("HAS_DELAY"), F.lit(1).alias("DELAY_COUNT"), F.lit("Closure").alias("DELAY_TYPE"),
        (F.col("id") % 400 + 45).cast("int").alias("AVG_DELAY_MIN"), F.lit("r" * 200).alias("REASON"),
        *[F.lit(None).cast("string").alias(name) for name in ("TREND", "END_TIME", "WEATHER_CONDITION", "WEATHER_WIND")],
        F.lit(None).cast("int").alias("MAX_DELAY_MIN"), F.lit(None).cast("double").alias("WEATHER_TEMP_F"),
    )
    severe = anomalies.digest(table).where("SECTION = 'severe'")
    assert {n for _, n in rows(severe.groupBy("FETCH_DATE").count())} == {10}
    assert severe.where(~F.endswith("LINE", F.lit("reason " + "r" * 80))).count() == 0
