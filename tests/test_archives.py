import io
import zipfile

import pyarrow.parquet as pq
import pytest

from tarmac.plans import flight_history
from tarmac.plans.flight_history import build_staging, load_archives
from tarmac.schemas import SOURCE_CSV
from tarmac.sources import archives
from tarmac.sources.versions import read_versioned
from tests.conftest import rows

HEADER = "Year,Month,DayofMonth,FlightDate,IATA_CODE_Reporting_Airline,Flight_Number_Reporting_Airline,Origin,Dest,Cancelled,DepDel15,DepDelayMinutes,Extra"


def csv(year, month, n):
    body = [f"{year},{month},{d},{year}-{month:02d}-{d:02d},AA,{d},ATL,\"LAX\",0.00,1.00,20.00,x" for d in range(1, n + 1)]
    return "\n".join([HEADER, *body]) + "\n"


def write_zip(path, members):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, text in members.items():
            archive.writestr(name, text)
    path.write_bytes(buffer.getvalue())


@pytest.fixture()
def folder(tmp_path):
    landed = tmp_path / "landed"
    landed.mkdir()
    write_zip(landed / "ontime_2023_12.zip", {"a.csv": csv(2023, 12, 4), "b.csv": csv(1999, 1, 9)})
    write_zip(landed / "ontime_2024_01.zip", {"readme.html": "x", "on_time.csv": csv(2024, 1, 5)})
    write_zip(landed / "ontime_2024_02.zip", {"readme.html": "no table"})
    (landed / "ontime_2024_03.zip").write_bytes(b"this is no archive")
    write_zip(landed / "other_2024_01.zip", {"on_time.csv": csv(2024, 1, 7)})
    return str(landed)


@pytest.mark.parametrize(
    ("year", "month", "names"),
    [
        (None, None, ["ontime_2023_12.zip", "ontime_2024_01.zip", "ontime_2024_02.zip", "ontime_2024_03.zip"]),
        (2024, None, ["ontime_2024_01.zip", "ontime_2024_02.zip", "ontime_2024_03.zip"]),
        (2024, 1, ["ontime_2024_01.zip"]),
        (None, 12, ["ontime_2023_12.zip"]),
    ],
)
def test_listing(spark, folder, year, month, names):
    listed = archives.list_archives(spark, folder, year, month).select("ARCHIVE").orderBy("ARCHIVE")
    assert [row[0] for row in rows(listed)] == names


def test_first_csv_of_each_archive(spark, folder, tmp_path):
    unpacked = archives.unpack(archives.list_archives(spark, folder), str(tmp_path / "unpacked"))
    flights = archives.unpacked_rows(unpacked)
    assert flights.columns == ["ARCHIVE", *SOURCE_CSV.names]
    counts = flights.groupBy("ARCHIVE", "Year").count().orderBy("ARCHIVE")
    assert rows(counts) == [("ontime_2023_12.zip", "2023", 4), ("ontime_2024_01.zip", "2024", 5)]
    assert rows(flights.select("Dest", "Tail_Number").distinct()) == [("LAX", None)]


def test_bad_archive_is_a_row_and_does_not_stop_the_rest(spark, folder, tmp_path):
    unpacked = archives.unpack(archives.list_archives(spark, folder), str(tmp_path / "unpacked"))
    errors = rows(archives.archive_errors(unpacked))
    assert [name for name, _ in errors] == ["ontime_2024_03.zip"]
    assert "BadZipFile" in errors[0][1]


def test_chunks_cover_the_whole_member(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(archives, "ROWS_PER_CHUNK", 7)
    write_zip(tmp_path / "ontime_2024_01.zip", {"t.csv": csv(2024, 1, 31)})
    content = (tmp_path / "ontime_2024_01.zip").read_bytes()
    sizes = [len(chunk) for chunk in archives._member_chunks(content)]
    assert sizes == [7, 7, 7, 7, 3]


def test_load_and_stage(spark, folder, tmp_path):
    raw, staging = str(tmp_path / "raw"), str(tmp_path / "staging")
    ((name, problem),) = rows(load_archives(spark, folder, raw, str(tmp_path / "errors")))
    assert name == "ontime_2024_03.zip" and problem.startswith("BadZipFile")
    stored = spark.read.parquet(raw)
    assert stored.count() == 9
    build_staging(stored, staging)
    flights = read_versioned(spark, staging)
    assert sorted(rows(flights.groupBy("YEAR", "MONTH").count())) == [(2023, 12, 4), (2024, 1, 5)]
    # loading one month again replaces that month only
    assert rows(load_archives(spark, folder, raw, str(tmp_path / "errors"), 2024, 1)) == []
    assert spark.read.parquet(raw).count() == 9


def test_ragged_lines_are_kept(spark, tmp_path):
    lines = csv(2024, 1, 5).splitlines()
    lines[2] += ",surplus,more"
    lines[3] = "2024,1,3,2024-01-03,AA"
    write_zip(tmp_path / "ontime_2024_01.zip", {"t.csv": "\n".join(lines) + "\n"})
    flights = archives.unpacked_rows(archives.unpack(archives.list_archives(spark, str(tmp_path)), str(tmp_path / "unpacked")))
    got = rows(flights.select("DayofMonth", "Dest").orderBy("DayofMonth"))
    assert got == [("1", "LAX"), ("2", "LAX"), ("3", None), ("4", "LAX"), ("5", "LAX")]


def test_an_archive_that_ends_early_leaves_its_month_alone(spark, tmp_path):
    landed, raw, errors = tmp_path / "landed", str(tmp_path / "raw"), str(tmp_path / "errors")
    landed.mkdir()
    write_zip(landed / "ontime_2024_01.zip", {"t.csv": csv(2024, 1, 31)})
    assert load_archives(spark, str(landed), raw, errors).count() == 0
    whole = (landed / "ontime_2024_01.zip").read_bytes()
    damaged = bytearray(whole)
    damaged[80] ^= 0xFF  # inside the member: its checksum no longer fits
    for broken in (whole[:200], bytes(damaged)):
        (landed / "ontime_2024_01.zip").write_bytes(broken)
        assert load_archives(spark, str(landed), raw, errors).count() == 1
        assert spark.read.parquet(raw).count() == 31


def test_staging_with_weather_and_deduplication(spark, folder, tmp_path):
    from pyspark.sql import functions as F

    from tarmac.schemas import FLIGHT_WEATHER, STAGING_FLIGHTS, WEATHER_HOURLY
    from tarmac.sources.tables import add_missing_columns

    raw, staging = str(tmp_path / "raw"), str(tmp_path / "staging")
    load_archives(spark, folder, raw, str(tmp_path / "errors"))
    stored = spark.read.parquet(raw).withColumn("CRS_DEP_TIME", F.lit(815))
    obs = add_missing_columns(
        spark.createDataFrame([("ATL", 8, 3.5)], "IATA_CODE string, OBS_HOUR int, TEMP_C double").withColumn(
            "OBS_DATE", F.to_date(F.lit("2024-01-02"))
        ),
        WEATHER_HOURLY,
    )
    build_staging(stored.unionByName(stored), staging, weather=obs, dedup=True)
    flights = read_versioned(spark, staging)
    assert flights.count() == 9
    assert set(flights.columns) == {*STAGING_FLIGHTS.names, *FLIGHT_WEATHER.names}
    assert rows(flights.where("ORIGIN_TEMP_C = 3.5").select("FLIGHT_ID")) == [("AA_2_20240102_ATL_LAX",)]


def test_an_archive_is_unpacked_once(tmp_path, monkeypatch):
    write_zip(tmp_path / "ontime_2024_01.zip", {"t.csv": csv(2024, 1, 31)})
    whole = (tmp_path / "ontime_2024_01.zip").read_bytes()
    opened = []
    real = zipfile.ZipFile.open
    monkeypatch.setattr(zipfile.ZipFile, "open", lambda self, member, *a, **b: opened.append(str(member)) or real(self, member, *a, **b))
    _, place, n, problem = archives.unpack_one("a.zip", whole, f"file://{tmp_path}/out")
    assert (n, problem, len(opened)) == (31, None, 1) and place
    damaged = bytearray(whole)
    damaged[80] ^= 0xFF
    _, place, n, problem = archives.unpack_one("b.zip", bytes(damaged), f"file://{tmp_path}/out")
    assert place is None and n == 0 and problem and len(opened) == 2
    assert len(list((tmp_path / "out" / "rows").iterdir())) == 1
    assert archives.unpack_one("c.zip", b"", f"file://{tmp_path}/out")[1] is None


@pytest.mark.parametrize("block", [1, 40, 1 << 20])
def test_members_are_cut_block_by_block(monkeypatch, block):
    monkeypatch.setattr(archives, "BLOCK_CHARACTERS", block)
    lines = ["Year,Other,Origin,Dest", "2024,x,ATL,LAX", "2024,x,,LAX,surplus", "", "2024,x", "2024,x,é,  "]
    quoted = ['2024,"a ""b"", c",ATL,"L', 'AX"', "2025,x,DEN,ORD"]
    for end in ("\n", "\r\n"):
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w") as archive:
            archive.writestr("a.csv", end.join(lines + quoted))
        found = [row for part in archives._member_chunks(buffer.getvalue()) for row in part.to_pylist()]
        got = sorted((row["Year"], row["Origin"] or "", row["Dest"] or "") for row in found)
        assert got == sorted(
            [("2024", "ATL", "LAX"), ("2024", "", "LAX"), ("2024", "", ""), ("2024", "é", "  "),
             ("2024", "ATL", f"L{end}AX"), ("2025", "DEN", "ORD")]
        )
        assert {row["Tail_Number"] for row in found} == {None}


def test_unpacked_rows_go_when_the_raw_layer_has_them(spark, folder, tmp_path, monkeypatch):
    monkeypatch.setattr(flight_history, "work_path", lambda session, name: (tmp_path / name).as_uri())
    written = []
    real = flight_history.write_partitions

    def write(*given, **named):
        written.extend(pq.ParquetFile(file).metadata.row_group(0).column(0).compression for file in (tmp_path / "unpacked/rows").iterdir())
        return real(*given, **named)

    monkeypatch.setattr(flight_history, "write_partitions", write)
    errors = load_archives(spark, folder, str(tmp_path / "raw"), str(tmp_path / "errors"))
    assert written == ["ZSTD", "ZSTD"] and not (tmp_path / "unpacked").exists()
    assert errors.count() == 1 and spark.read.parquet(str(tmp_path / "raw")).count() == 9
