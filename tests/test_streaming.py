import itertools
import json

from pyspark.sql import functions as F

from checks import registry, stand_ins
from tarmac.operators.nas import clean_nas
from tarmac.sources.landed import read_nas_snapshots
from tarmac.sources.tables import read_dated
from tarmac.streaming import nas_feed
from tests.conftest import rows


def land(folder, date, *lines):
    day = folder / date
    day.mkdir(parents=True, exist_ok=True)
    body = [
        {"SNAPSHOT_TS": f"{date}T{time}", "FETCH_DATE": date, "IATA_CODE": code, "HAS_DELAY": kind is not None,
         "DELAY_TYPE": kind, "AVG_DELAY_MIN": minutes}
        for time, code, kind, minutes in lines
    ]
    (day / "snapshot.json").write_text("\n".join(map(json.dumps, body)) + "\n")


def drain(query):
    query.awaitTermination()
    assert query.exception() is None


def test_typed_rows_without_keys_are_dropped(spark, tmp_path):
    feed = tmp_path / "feed"
    land(feed, "2024-01-05", ("06:00:00", None, "GroundStop", 1), ("06:00:00", None, None, None))
    stream = nas_feed.clean_lines(nas_feed.snapshot_stream(spark, str(feed)))
    drain(nas_feed.append_to(stream, str(tmp_path / "out"), str(tmp_path / "state")))
    assert rows(spark.read.parquet(str(tmp_path / "out")).select("DELAY_TYPE", "IATA_CODE")) == [(None, None)]


def test_stream_table_equals_batch_and_a_rerun_replaces(spark, tmp_path):
    feed, out, state = tmp_path / "feed", str(tmp_path / "out"), str(tmp_path / "state")
    land(feed, "2024-01-05", ("06:00:00", "ATL", "GroundStop", 1), ("09:00:00", "ATL", "GroundStop", 5))
    land(feed, "2024-01-06", ("06:00:00", "ATL", "Closure", 3))

    def run():
        stream = nas_feed.clean_lines(nas_feed.snapshot_stream(spark, str(feed)))
        drain(nas_feed.replace_dates_in(stream, out, state))
        return read_dated(spark, out, stream.schema)

    def shown(frame):
        return sorted(rows(frame.select("FETCH_DATE", "IATA_CODE", "DELAY_TYPE", "AVG_DELAY_MIN")), key=str)

    assert shown(run()) == shown(clean_nas(read_nas_snapshots(spark, str(feed))))
    # a second file of a date adds to it and leaves the other alone
    late = feed / "2024-01-05" / "again.json"
    late.write_text(json.dumps({"SNAPSHOT_TS": "2024-01-05T20:00:00", "FETCH_DATE": "2024-01-05", "IATA_CODE": "BOS",
                                "HAS_DELAY": True, "DELAY_TYPE": "Closure", "AVG_DELAY_MIN": 9}) + "\n")
    spark.catalog.refreshByPath(out)
    got = [row[1:] for row in shown(run())]
    assert got == [("ATL", "GroundStop", 5), ("BOS", "Closure", 9), ("ATL", "Closure", 3)]
    assert shown(run()) == shown(clean_nas(read_nas_snapshots(spark, str(feed))))


def test_every_trigger_size_gives_the_batch_table(spark, tmp_path):
    feed = tmp_path / "feed"
    for at, code in enumerate(("ATL", "LAX", "SEA")):
        land(feed, f"2024-01-0{5 + at}", ("06:00:00", code, "GroundStop", at), ("06:00:00", "JFK", "Closure", at))
        # one date in three files, and rows of no date
        extra = feed / f"2024-01-0{5 + at}" / "extra.json"
        body = [
            {"SNAPSHOT_TS": f"2024-01-05T1{at}:00:00", "FETCH_DATE": "2024-01-05", "IATA_CODE": "BOS", "HAS_DELAY": True,
             "DELAY_TYPE": "Closure", "AVG_DELAY_MIN": at},
            {"SNAPSHOT_TS": None, "FETCH_DATE": None, "IATA_CODE": code, "HAS_DELAY": False},
        ]
        extra.write_text("\n".join(map(json.dumps, body)) + "\n")
    batch = clean_nas(read_nas_snapshots(spark, str(feed)))
    for files in (1, 2, None):
        stream = nas_feed.clean_lines(nas_feed.snapshot_stream(spark, str(feed), files))
        out = str(tmp_path / f"out-{files}")
        drain(nas_feed.replace_dates_in(stream, out, str(tmp_path / f"state-{files}")))
        assert sorted(rows(read_dated(spark, out, stream.schema).select(batch.columns)), key=str) == sorted(rows(batch), key=str)
    assert batch.where("FETCH_DATE IS NULL").count() == 3


def test_daily_counts(spark, tmp_path):
    feed = tmp_path / "feed"
    land(feed, "2024-01-05", ("06:00:00", "ATL", "GroundStop", 1), ("23:59:59", "LAX", "Closure", 1), ("06:00:00", "SEA", None, None))
    land(feed, "2024-01-06", ("00:00:00", "ATL", "GroundStop", 3))
    counts = nas_feed.daily_counts(nas_feed.clean_lines(nas_feed.snapshot_stream(spark, str(feed))))
    drain(nas_feed.write_complete(counts, str(tmp_path / "out"), str(tmp_path / "state")))
    got = sorted((str(day), n) for day, n in rows(spark.read.parquet(str(tmp_path / "out"))))
    assert got == [("2024-01-05", 2), ("2024-01-06", 1)]


def test_the_latest_snapshot_wins_over_triggers(spark, tmp_path):
    """Later files bring better, worse and equal snapshots of keys already emitted, and rows without clock or date."""
    feed, out = tmp_path / "feed", str(tmp_path / "out")
    at = itertools.count()

    def put(*rows):
        day = feed / f"{next(at):02d}"
        day.mkdir(parents=True)
        body = [
            {"SNAPSHOT_TS": clock, "FETCH_DATE": date, "IATA_CODE": code, "HAS_DELAY": True, "DELAY_TYPE": kind, "AVG_DELAY_MIN": n}
            for clock, date, code, kind, n in rows
        ]
        (day / "snapshot.json").write_text("\n".join(map(json.dumps, body)) + "\n")

    put(("2024-01-05T06:00:00", "2024-01-05", "ATL", "GroundStop", 1), (None, "2024-01-05", "LAX", "Closure", 2), (None, None, "SEA", None, 3))
    put(("2024-01-05T09:00:00", "2024-01-05", "atl ", "GroundStop", 4), ("2024-01-05T01:00:00", "2024-01-05", "LAX", "Closure", 5))
    put(("2024-01-05T08:00:00", "2024-01-05", "ATL", "GroundStop", 6), ("2024-01-05T01:00:00", "2024-01-05", "LAX", "Closure", 4))
    put(("2024-01-06T08:00:00", None, "SEA", None, 7), ("2024-01-06T08:00:00", "2024-01-06", "ATL", "GroundStop", 8))
    lines = nas_feed.clean_lines(nas_feed.snapshot_stream(spark, str(feed), 1))
    query = nas_feed.latest_into(nas_feed.deduplicated(lines), out, str(tmp_path / "state"))
    drain(query)
    batch = clean_nas(read_nas_snapshots(spark, str(feed)))
    got = sorted(rows(read_dated(spark, out, lines.schema).select(batch.columns)), key=str)
    assert got == sorted(rows(batch), key=str) and len(got) == 4


def test_state_is_bounded_by_the_watermark(spark, tmp_path):
    feed = tmp_path / "feed"
    for day in range(1, 13):
        land(feed, f"2024-01-{day:02d}", *[("06:00:00", f"A{k}", "Closure", k) for k in range(10)])
    lines = nas_feed.clean_lines(nas_feed.snapshot_stream(spark, str(feed), 1))
    query = nas_feed.latest_into(nas_feed.deduplicated(lines, "2 days"), str(tmp_path / "out"), str(tmp_path / "state"))
    drain(query)
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    read = [p["numInputRows"] for p in query.recentProgress]
    # the dates of two days, of the batch and of the one before, whose watermark is not yet in force
    assert max(held) <= 40 + 2 * max(read) < 120, (held, read)
    assert read_dated(spark, str(tmp_path / "out"), lines.schema).count() == 120


def test_late_rows_are_diverted_and_counted(spark, tmp_path):
    feed, out, counts = tmp_path / "feed", str(tmp_path / "out"), str(tmp_path / "counts")

    def run():
        lines = nas_feed.clean_lines(nas_feed.snapshot_stream(spark, str(feed), 1))
        query = nas_feed.latest_into(nas_feed.deduplicated(lines, "1 day"), out, str(tmp_path / "state"))
        drain(query)
        without = sorted({str(r[0]) for r in rows(read_dated(spark, out, lines.schema).select("FETCH_DATE"))})
        drain(nas_feed.repair_late(lines, out, counts, str(tmp_path / "late-state"), 1))
        spark.catalog.refreshByPath(out)
        dropped = sum(p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in query.recentProgress if p["stateOperators"])
        return without, sorted({str(r[0]) for r in rows(read_dated(spark, out, lines.schema).select("FETCH_DATE"))}), dropped

    land(feed, "2024-01-10", ("06:00:00", "ATL", "GroundStop", 1))
    run()
    land(feed, "2024-01-20", ("06:00:00", "ATL", "GroundStop", 1))
    assert run() == (["2024-01-10", "2024-01-20"], ["2024-01-10", "2024-01-20"], 0)
    # on the border: one day back is late, as the watermark has reached it; the day itself is not
    land(feed, "2024-01-05", ("06:00:00", "ATL", "GroundStop", 1), ("07:00:00", "LAX", "GroundStop", 1))
    without, repaired, dropped = run()
    assert without == ["2024-01-10", "2024-01-20"] and repaired == ["2024-01-05", "2024-01-10", "2024-01-20"]
    late = nas_feed.late_counts(spark, counts)
    assert sorted((str(d), n) for d, n in rows(late.select("FETCH_DATE", "LATE_ROWS"))) == [("2024-01-05", 2)]
    land(feed, "2024-01-19", ("06:00:00", "ATL", "GroundStop", 1))
    land(feed, "2024-01-21", ("06:00:00", "ATL", "GroundStop", 1))
    without, repaired, _ = run()
    assert "2024-01-19" in repaired and "2024-01-21" in repaired
    assert run()[1] == repaired
    assert sorted(n for (n,) in rows(nas_feed.late_counts(spark, counts).select("LATE_ROWS"))) == [1, 2]


def test_stream_and_batch_agree_on_the_given_tables(spark, small, tmp_path):
    feed = str(tmp_path / "feed")
    stand_ins.nas_lines(spark, small).withColumn("day", F.col("FETCH_DATE")).write.partitionBy("day").json(feed)
    stream = nas_feed.clean_lines(nas_feed.snapshot_stream(spark, feed))
    drain(nas_feed.replace_dates_in(stream, str(tmp_path / "out"), str(tmp_path / "state")))
    batch = clean_nas(stand_ins.nas_lines(spark, small))
    got = read_dated(spark, str(tmp_path / "out"), stream.schema).select(batch.columns)
    assert sorted(rows(got), key=str) == sorted(rows(batch), key=str)


def test_a_large_landing_is_several_files_and_one_trigger(spark, small, monkeypatch):
    monkeypatch.setattr(registry, "FEED_ROWS", 20)
    path, files = registry.landed_in_turn(spark, small, (1, 2, 3, 0), overlap=False)
    assert files > 1
    lines = stand_ins.nas_lines(spark, small)
    assert spark.read.schema(lines.schema).json(f"{path}/*").exceptAll(lines).isEmpty()
    seen, days = [], F.to_date("SNAPSHOT_TS")

    def note(batch, _):
        seen.append({(row[0].day - 1) // registry.FEED_SPAN for row in batch.select(days).distinct().collect()})

    stream = nas_feed.snapshot_stream(spark, path, files_per_trigger=files).writeStream.foreachBatch(note)
    drain(stream.option("checkpointLocation", registry.work_path(spark, "noted")).trigger(availableNow=True).start())
    assert seen == [{1}, {2}, {3}, {0}]
    few = registry.QUERIES["late_rows_diverted"](spark, small).collect()
    monkeypatch.undo()
    assert sorted(few) == sorted(registry.QUERIES["late_rows_diverted"](spark, small).collect())
