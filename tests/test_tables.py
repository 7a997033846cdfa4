import datetime as dt
import gzip
import os

import pytest
from pyspark.sql import functions as F

from checks import stand_ins
from tarmac import schemas
from tarmac.plans.daily_status import load_day, write_digest
from tarmac.operators import marts
from tarmac.plans.mart_refresh import FLIGHT_MARTS, MART_SETS, refresh
from tarmac.session import shared_folder, shuffle_width, work_path
from tarmac.sources import landed, tables
from tests.conftest import one, rows

D1, D2 = dt.date(2024, 1, 5), dt.date(2024, 1, 6)


def dated(spark, *given):
    return spark.createDataFrame(list(given), "FETCH_DATE date, IATA_CODE string, N int")


def parquet_files(path):
    return [name for _, _, names in os.walk(path) for name in names if name.endswith(".parquet")]


def test_load_by_name(spark):
    frame = spark.createDataFrame(
        [("1", "2024-01-05", "2.5"), ("x", "2024-01-05", "1"), (None, None, None), (" ", "", "")], "year string, Flight_Date string, extra string"
    )
    schema = schemas.columns("YEAR int, FLIGHT_DATE date, DISTANCE double")
    loaded = tables.load_by_name(frame, schema)
    assert rows(tables.loaded_rows(loaded)) == [(1, D1, None), (None, None, None), (None, None, None)]
    assert one(tables.load_report(loaded)) == (3, 1)
    named = tables.load_by_name(frame.withColumn("file", F.lit("a")), schema).withColumn("file", F.lit("a"))
    assert one(tables.load_report(named, "file")) == (1, 3, 1)


def test_write_counted(spark, tmp_path):
    path = str(tmp_path / "out")
    assert tables.write_counted(spark.range(1000), path, files=26) == 1000
    assert len(parquet_files(path)) == 26
    assert tables.write_counted(spark.range(10), path) == 10
    assert spark.read.parquet(path).count() == 10


def test_date_stays_in_the_file_body(spark, tmp_path):
    path = str(tmp_path / "dated")
    tables.write_dated(dated(spark, (D1, "ATL", 1), (D2, "LAX", 2)), path)
    body = spark.read.parquet(f"{path}/DATE_KEY=2024-01-05")
    assert rows(body.select("FETCH_DATE", "IATA_CODE")) == [(D1, "ATL")]


def test_replacing_a_date_on_disk(spark, tmp_path):
    path = str(tmp_path / "table")
    schema = dated(spark, (D1, "x", 1)).schema
    tables.write_replacing_date(dated(spark, (D1, "ATL", 1), (None, "BOS", 1)), path, D1)
    tables.write_replacing_date(dated(spark, (D2, "LAX", 1)), path, D2)
    assert sorted(r[1] for r in rows(tables.read_dated(spark, path, schema))) == ["ATL", "LAX"]
    for _ in range(2):
        tables.write_replacing_date(dated(spark, (D1, "DEN", 2), (None, "SEA", 2)), path, D1)
    got = {r[1]: (r[0], r[2]) for r in rows(tables.read_dated(spark, path, schema).select("FETCH_DATE", "IATA_CODE", "N"))}
    assert got == {"DEN": (D1, 2), "LAX": (D2, 1), "SEA": (None, 2)}


def test_an_empty_day_and_an_empty_month_are_replaced(spark, tmp_path):
    path = str(tmp_path / "table")
    schema = dated(spark, (D1, "x", 1)).schema
    tables.write_replacing_date(dated(spark, (D1, "ATL", 1), (D2, "LAX", 1)), path, D1)
    for _ in range(2):
        tables.write_replacing_date(dated(spark, (D2, "SEA", 1)).where("N > 1"), path, D1)
    assert rows(tables.read_dated(spark, path, schema).select("IATA_CODE")) == [("LAX",)]
    mart = spark.createDataFrame([(2024, 1, 5), (2024, 2, 6)], "YEAR int, MONTH int, N int")
    tables.refresh_mart(mart, f"{path}-mart", ["YEAR", "MONTH"])
    tables.refresh_mart(mart.where("N > 9"), f"{path}-mart", month=dt.date(2024, 2, 1))
    stored = tables.read_mart(spark, f"{path}-mart", mart.schema)
    assert rows(stored.select("YEAR", "MONTH", "N")) == [(2024, 1, 5)]


def test_rows_of_other_dates_are_not_doubled_by_a_retry(spark, tmp_path):
    path = str(tmp_path / "table")
    schema = dated(spark, (D1, "x", 1)).schema
    tables.write_replacing_date(dated(spark, (D2, "LAX", 1)), path, D2)
    for _ in range(2):
        tables.write_replacing_date(dated(spark, (D1, "ATL", 1), (D2, "SEA", 1)), path, D1)
    got = sorted(r[0] for r in rows(tables.read_dated(spark, path, schema).select("IATA_CODE")))
    assert got == ["ATL", "LAX", "SEA"]


def test_month_refresh_keeps_other_months(spark, tmp_path):
    path = str(tmp_path / "mart")
    mart = spark.createDataFrame([(2024, 1, 5), (2024, 2, 6)], "YEAR int, MONTH int, N int")
    tables.refresh_mart(mart, path, ["YEAR", "MONTH"])
    tables.refresh_mart(mart.where("MONTH = 2").withColumn("N", F.lit(99)), path, ["YEAR", "MONTH"], month=dt.date(2024, 2, 1))
    stored = tables.read_mart(spark, path)
    assert sorted(rows(stored.select("YEAR", "MONTH", "N"))) == [(2024, 1, 5), (2024, 2, 99)]
    assert stored.where(F.col(tables.STAMP).isNull()).count() == 0
    tables.refresh_mart(mart.where("MONTH = 1"), path, ["YEAR", "MONTH"])
    assert rows(tables.read_mart(spark, path).select("MONTH")) == [(1,)]


def test_unpartitioned_refresh_truncates(spark, tmp_path):
    path = str(tmp_path / "mart")
    tables.refresh_mart(spark.range(5), path)
    tables.refresh_mart(spark.range(2), path)
    assert tables.read_mart(spark, path).count() == 2


def test_guards(spark):
    frame = spark.createDataFrame([(1, None)], "A int, ORIGIN_TEMP_C double")
    assert tables.has_column(frame, "origin_temp_c") and not tables.has_column(frame, "B")
    assert not tables.has_values(frame, "ORIGIN_TEMP_C") and not tables.has_values(frame, "B")
    assert tables.has_values(frame, "A")
    assert tables.is_ready(frame) and not tables.is_ready(frame.where("A > 1"))


def test_missing_columns(spark):
    frame = tables.add_missing_columns(spark.createDataFrame([(1.0,)], "origin_temp_c double"))
    assert len(frame.columns) == len(schemas.FLIGHT_WEATHER)
    assert one(frame.select("ORIGIN_TEMP_C", "DEST_WEATHER_CODE")) == (1.0, None)
    assert tables.add_missing_columns(frame).columns == frame.columns


def test_layer_tables(spark):
    names = ["staging.flights", "raw.opensky_states"]
    for _ in range(2):
        tables.create_layer_tables(spark, names)
    assert len(spark.table("staging.flights").columns) == 38 + 13
    assert spark.table("raw.opensky_states").count() == 0
    for name in names:
        spark.sql(f"DROP TABLE {name}")


def test_mart_tables_have_the_columns_of_the_marts(spark, small):
    names = [f"analytics.{name}" for name in schemas.MARTS]
    tables.create_layer_tables(spark, names)
    assert len(names) == 8
    flights, nas = stand_ins.flights(spark, small), stand_ins.nas(spark, small)
    made = {name: query(flights) for name, query in FLIGHT_MARTS.items()}
    made["airport_nas_status"] = marts.airport_nas_status(nas)
    made["weather_delay_correlation"] = marts.weather_delay_correlation(tables.add_missing_columns(flights))
    for name, mart in made.items():
        declared = {f.name: f.dataType for f in schemas.columns(schemas.MARTS[name]).fields}
        assert declared == {f.name: f.dataType for f in mart.schema.fields}, name
        assert set(spark.table(f"analytics.{name}").columns) == {*declared, tables.STAMP}
        spark.sql(f"DROP TABLE analytics.{name}")


def test_csv_scan_is_all_text(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Year,FlightDate\n2024,2024-01-05\n,\n")
    frame = landed.read_source_csv(spark, str(tmp_path), schemas.columns("Year string, FlightDate string"))
    assert sorted(rows(frame), key=str) == sorted([("2024", "2024-01-05"), (None, None)], key=str)


def test_csv_columns_go_by_header_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Unknown,FlightDate,Year,\nx,2024-01-05,2024,\n")
    (tmp_path / "b.csv").write_text("Year\n2023\n")
    frame = landed.read_source_csv(spark, str(tmp_path))
    assert frame.columns == schemas.SOURCE_CSV.names
    got = sorted(rows(frame.select("Year", "FlightDate", "Dest")))
    assert got == [("2023", None, None), ("2024", "2024-01-05", None)]


def test_mart_sets(spark, small, tmp_path):
    path = str(tmp_path / "marts")
    flights, status = stand_ins.flights(spark, small), stand_ins.nas(spark, small)
    outcome = refresh(flights, status, path)
    assert list(outcome) == MART_SETS["all"]
    assert outcome.pop("weather_delay_correlation") == "skipped: no weather joined"
    assert set(outcome.values()) == {"refreshed"}

    def stored():
        return sorted(rows(tables.read_mart(spark, f"{path}/airline_performance").drop(tables.STAMP)), key=str)

    before = stored()
    assert set(refresh(flights, status, path, "all", dt.date(1998, 5, 20)).values()) <= {"refreshed", "skipped: no weather joined"}
    assert stored() == before
    assert tables.read_mart(spark, f"{path}/delay_trends_daily").count() == flights.where("NOT IS_CANCELLED").select("FLIGHT_DATE").distinct().count()


def test_one_failing_mart_does_not_stop_the_rest(spark, small, tmp_path):
    flights = stand_ins.flights(spark, small).drop("DISTANCE")
    outcome = refresh(flights, None, str(tmp_path / "marts"))
    assert outcome["route_performance"].startswith("failed")
    assert outcome["airport_nas_status"].startswith("skipped")
    assert outcome["delay_cause_breakdown"] == "refreshed"


def test_daily_load_and_digest(spark, small, tmp_path):
    lines = stand_ins.nas_lines(spark, small)
    feed, table, report = (str(tmp_path / name) for name in ("feed", "table", "report"))
    lines.withColumn("day", F.col("FETCH_DATE")).write.partitionBy("day").json(feed)
    for day in sorted(os.listdir(feed)):
        if day.startswith("day="):
            os.rename(f"{feed}/{day}", f"{feed}/{day.removeprefix('day=')}")
    for date in (D1, D2, D1):
        status = load_day(spark, feed, table, date)
    assert sorted(r[0] for r in rows(status.select("FETCH_DATE").distinct())) == [D1, D2]
    write_digest(status, report)
    text = spark.read.text(f"{report}/FETCH_DATE=2024-01-05")
    assert text.where("value LIKE 'date 2024-01-05%'").count() == 1
    assert text.where("value LIKE '%type GroundStop%'").count() > 0


class Named:
    """Stands for a session whose settings and master are given."""

    def __init__(self, master, folder):
        settings = {"spark.checkpoint.dir": folder} if folder else {}
        self.conf = type("Conf", (), {"get": lambda _, key, default=None: settings.get(key, default)})()
        self.sparkContext = type("Context", (), {"master": master, "applicationId": "app-1"})()


def test_shared_folder_is_the_named_one():
    cluster = Named("yarn", "hdfs://cluster/shared/")
    assert shared_folder(cluster) == "hdfs://cluster/shared"
    assert work_path(cluster, "x").startswith("hdfs://cluster/shared/x-")


def test_shared_folder_must_be_named_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Named("yarn", None))


def test_local_folder_is_kept_for_the_session():
    alone = Named("local[2]", None)
    assert shared_folder(alone) == shared_folder(alone)


def test_shuffle_width():
    assert shuffle_width(0, 8) == 16
    assert shuffle_width(10 * 1024**4, 4000) == 54614
    assert shuffle_width(100 * 1024**4, 4000) == 546_134


def test_compressed_csv_goes_by_header_name(spark, tmp_path):
    plain, packed = "Unknown,FlightDate,Year,\n" + "x,2024-01-05,2024,\n" * 9_000, gzip.compress(b"Year,Dest\n2023,LAX\n")
    (tmp_path / "a.csv.gz").write_bytes(gzip.compress(plain.encode()))
    (tmp_path / "b.csv.gz").write_bytes(packed)
    (tmp_path / "c.csv").write_text("Dest,Year\nORD,2022\n")
    assert landed.first_line(f"file:{tmp_path}/a.csv.gz") == ("Unknown,FlightDate,Year,", landed.HEAD_BYTES)
    frame = landed.read_source_csv(spark, str(tmp_path))
    got = rows(frame.groupBy("Year", "FlightDate", "Dest").count())
    assert sorted(got, key=str) == [("2022", None, "ORD", 1), ("2023", None, "LAX", 1), ("2024", "2024-01-05", None, 9_000)]


def test_rows_whose_tasks_hold_few_partitions_are_not_sorted(spark, tmp_path, monkeypatch):
    """Rows of a month that come without order are written as they come, and settings are as before."""
    key, seen = "spark.sql.maxConcurrentOutputFileWriters", []
    before, real = spark.conf.get(key, None), type(spark.range(0).write).parquet
    monkeypatch.setattr(type(spark.range(0).write), "parquet", lambda self, *given, **named: seen.append(spark.conf.get(key, None)) or real(self, *given, **named))
    few = spark.range(0, 3000, 1, 3).selectExpr("id", "id % 2 AS m")
    many = spark.range(0, 4000, 1, 1).selectExpr("id", f"id % {3 * tables.OPEN_FILES} AS m")
    for frame, n, months in ((few, 3000, 2), (many, 4000, 3 * tables.OPEN_FILES)):
        path = str(tmp_path / str(months))
        tables.write_partitions(frame, path, ["m"], rebalance=False)
        stored = spark.read.parquet(path)
        assert (stored.count(), stored.distinct().count(), stored.select("m").distinct().count()) == (n, n, months)
    tables.write_partitions(few, str(tmp_path / "moved"), ["m"])
    assert seen == [str(tables.OPEN_FILES)] * 2 + [before] and spark.conf.get(key, None) == before
