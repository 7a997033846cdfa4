"""Versioned tables: loads that stop early, loads at the same time, pruned reads."""

import re

import pytest
from pyspark.sql import functions as F

from tarmac.sources import tables
from tarmac.sources.versions import VersionedTable, partition_of, read_versioned
from tests.conftest import plan, rows

SCHEMA = "FETCH_DATE date, IATA_CODE string, N int"


def frame(spark, *given):
    return spark.createDataFrame(list(given), "day string, IATA_CODE string, N int").select(
        F.col("day").cast("date").alias("FETCH_DATE"), "IATA_CODE", "N"
    )


def shown(spark, path):
    return sorted((str(d), c, n) for d, c, n in rows(read_versioned(spark, path, frame(spark, ("2024-01-01", "x", 1)).schema)))


def test_a_load_that_stops_early_is_not_seen(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "table")
    table = VersionedTable(spark, path)
    table.replace(frame(spark, ("2024-01-05", "ATL", 1), ("2024-01-06", "LAX", 2)), ["FETCH_DATE"])
    before = shown(spark, path)
    table.prepare(frame(spark, ("2024-01-05", "ATL", 9)), ["FETCH_DATE"])
    assert shown(spark, path) == before

    def stop(*_, **__):
        raise OSError("lost")

    monkeypatch.setattr(VersionedTable, "commit", stop)
    with pytest.raises(OSError):
        tables.write_replacing_date(frame(spark, ("2024-01-05", "ATL", 7)), path, __import__("datetime").date(2024, 1, 5))
    with pytest.raises(OSError):
        tables.refresh_mart(frame(spark), path, ["FETCH_DATE"])
    monkeypatch.undo()
    assert shown(spark, path) == before
    table.replace(frame(spark, ("2024-01-05", "SEA", 3)), ["FETCH_DATE"])
    assert shown(spark, path) == [("2024-01-05", "SEA", 3), ("2024-01-06", "LAX", 2)]


def test_of_two_loads_at_once_one_fails_whole(spark, tmp_path):
    path = str(tmp_path / "table")
    table = VersionedTable(spark, path)
    table.replace(frame(spark, ("2024-01-05", "ATL", 1)), ["FETCH_DATE"])
    slow = table.prepare(frame(spark, ("2024-01-05", "ATL", 2)), ["FETCH_DATE"])
    table.replace(frame(spark, ("2024-01-05", "ATL", 3)), ["FETCH_DATE"])
    with pytest.raises(RuntimeError, match="finished first"):
        table.commit(*slow, by=["FETCH_DATE"])
    assert shown(spark, path) == [("2024-01-05", "ATL", 3)]


def test_readers_keep_the_version_they_began_with(spark, tmp_path):
    path = str(tmp_path / "table")
    table = VersionedTable(spark, path)
    table.replace(frame(spark, ("2024-01-05", "ATL", 1), (None, "SEA", 4)), ["FETCH_DATE"])
    begun = table.read(frame(spark).schema)
    table.replace(frame(spark, ("2024-01-05", "ATL", 2)), ["FETCH_DATE"], removed=[partition_of(FETCH_DATE=None)])
    assert sorted(r.N for r in begun.collect()) == [1, 4]
    assert shown(spark, path) == [("2024-01-05", "ATL", 2)]
    assert len(table.forget_unused()) == 1 and shown(spark, path) == [("2024-01-05", "ATL", 2)]


def test_a_merge_reads_the_dates_it_changes(spark, tmp_path):
    path = str(tmp_path / "table")
    table = VersionedTable(spark, path)
    table.replace(frame(spark, *[(f"2024-01-{day:02d}", "ATL", day) for day in range(1, 29)]), ["FETCH_DATE"])
    read = []
    table.merge(frame(spark, ("2024-01-05", "LAX", 1), (None, "SEA", 2)), "FETCH_DATE", lambda all_rows: read.append(all_rows) or all_rows)
    files = read[0].inputFiles()
    assert len(files) == 1 and "FETCH_DATE=2024-01-05" in files[0]
    assert len(shown(spark, path)) == 30
    # a filter on the date prunes folders of the whole table, too
    text = plan(table.read(read[0].schema).where("FETCH_DATE = DATE '2024-01-07'"))
    assert re.search(r"PartitionFilters: \[[^]]*FETCH_DATE", text)


def test_an_empty_table(spark, tmp_path):
    path = str(tmp_path / "table")
    assert shown(spark, path) == []
    VersionedTable(spark, path).replace(frame(spark), ["FETCH_DATE"])
    assert shown(spark, path) == []
    VersionedTable(spark, path).replace(frame(spark, ("2024-01-05", "ATL", 1)))
    assert shown(spark, path) == [("2024-01-05", "ATL", 1)]


def test_a_merge_works_its_rows_out_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    given = frame(spark, *[(f"2024-01-{day:02d}", "ATL", day) for day in range(1, 11)])
    path = str(tmp_path / "table")
    VersionedTable(spark, path).merge(given.mapInArrow(count, given.schema), "FETCH_DATE", lambda all_rows: all_rows)
    assert seen.value == 10 and len(shown(spark, path)) == 10
