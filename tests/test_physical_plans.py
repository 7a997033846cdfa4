"""The plans are the ones the operators are written for."""

import gzip
import re

import pytest
from pyspark.sql import functions as F

from checks import registry, stand_ins
from tarmac.operators import dashboard, keys, lookup, marts, nas, weather
from tarmac.plans import colocated_weather
from tarmac.session import ensure_checkpoint_dir
from tarmac.sources import landed
from tests.conftest import plan

PYTHON_NODES = re.compile(r"ArrowEvalPython|BatchEvalPython|MapInPandas|FlatMapGroupsInPandas|PythonUDF")
NO_PLAN = {
    # these run writes, streams or training while the frame is built
    "csv_scan", "raw_parquet_batch", "mart_month_refreshed_on_disk", "weather_document_scan", "snapshot_scan",
    "snapshot_scan_of_one_date", "date_replaced_on_disk", "snapshot_stream_keys", "snapshot_stream_table",
    "late_files_repaired", "late_rows_diverted", "loads_cut_short", "archives_loaded", "archives_that_failed",
    "daily_count_stream", "out_of_fold_delay_rates", "out_of_fold_delay_minutes", "delay_scores", "delay_model_metrics",
}


#: A response of a few kilobytes is parsed as XML in Python.
PARSED = {"programs_from_xml"}


@pytest.mark.parametrize("name", [name for name in registry.QUERIES if name not in NO_PLAN | PARSED])
def test_no_python_and_no_cross_join(spark, small, name):
    text = plan(registry.QUERIES[name](spark, small))
    assert not PYTHON_NODES.search(text)
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    # a window without a key would move everything to one task
    assert not re.search(r"Window.*\n.*SinglePartition", text)


def test_trend_scan_reads_only_what_it_needs(spark, small):
    text = plan(marts.delay_trends_monthly(stand_ins.flights(spark, small)))
    (schema,) = re.findall(r"ReadSchema: struct<([^>]*l_quantity[^>]*)>", text)
    assert "l_extendedprice" not in schema and "l_tax" not in schema
    assert text.count("HashAggregate") >= 2  # partial and final


def test_month_filter_reaches_a_partitioned_scan(spark, small, tmp_path):
    path = str(tmp_path / "staging")
    stand_ins.flights(spark, small).write.partitionBy("YEAR", "MONTH").parquet(path)
    stored = spark.read.parquet(path)
    mart = marts.airline_performance(stored, registry.MONTH)
    text = plan(mart)
    assert re.search(r"PartitionFilters: \[.*YEAR#\d+ = 1998.*MONTH#\d+ = 5", text)
    flown = plan(marts.delay_trends_monthly(stored))
    assert re.search(r"PushedFilters: \[.*IsNotNull\(IS_CANCELLED\)", flown)
    assert "ORIGIN_CITY" not in re.findall(r"ReadSchema: struct<([^>]*)>", flown)[0]


def test_deduplication_limits_before_the_shuffle(spark, small):
    for frame in (
        nas.clean_nas(stand_ins.nas_lines(spark, small)),
        weather.clean_weather(stand_ins.weather_documents(spark, small)),
    ):
        text = plan(frame, "simple")
        partial, final = text.rindex(", Partial"), text.index(", Final")
        assert final < text.index("Exchange", final) < partial


def test_rare_repeats_are_removed_without_a_sort(spark, small, monkeypatch):
    ensure_checkpoint_dir(spark)
    stored = registry.staged(spark, small).select(registry.STAGED_SHOWN).checkpoint()
    for limit in (1_000_000, -1):
        frame = keys.one_per_rare_key(stored, "FLIGHT_ID", limit)
        text = plan(frame)
        assert "Window" not in text and not re.search(r"\bSort\b", text)
        assert ("BroadcastHashJoin" in text) == (limit > 0)


def test_stored_buckets_leave_the_flights_unshuffled(spark, small, tmp_path):
    rows = registry.flights(spark, small)
    colocated_weather.store_flights(rows, "plan_flights", str(tmp_path / "f"), buckets=4, slices=3)
    colocated_weather.store_observations(registry.hourly(spark, small), "plan_observations", str(tmp_path / "o"), buckets=4, slices=3)
    try:
        joined = colocated_weather.joined_weather(spark, "plan_flights", "plan_observations")
        joined.sparkSession.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        text = plan(joined, "simple")
        assert "Exchange" not in text and text.count("SortMergeJoin") == 2
        assert joined.count() == rows.count()
    finally:
        spark.sql("DROP TABLE plan_flights")
        spark.sql("DROP TABLE plan_observations")


def test_header_probe_reads_the_head_of_a_file(spark, tmp_path):
    for name, n in (("short", 10), ("long", 200_000)):
        (tmp_path / f"{name}.csv").write_text("Year,Dest\n" + "2024,LAX\n" * n)
    (tmp_path / "empty.csv").write_text("")
    heads = {r.FILE.rsplit("/", 1)[1]: (r.HEADER, r.BYTES_READ) for r in landed.file_heads(spark, str(tmp_path)).collect()}
    assert heads["long.csv"] == ("Year,Dest", landed.HEAD_BYTES) and heads["short.csv"][1] < 200
    assert landed.read_source_csv(spark, str(tmp_path)).where("Dest = 'LAX'").count() == 200_010


def test_small_lookup_leaves_the_flights_unshuffled(spark, small, monkeypatch):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        code = F.concat(F.lit("A"), F.col("id") % 9)
        flights = spark.range(1000).select(code.alias("ORIGIN"), code.alias("DEST"), "id")
        routes = registry.routes(spark, small)
        checked = plan(dashboard.with_route_history(flights, routes), "simple")
        beyond = plan(dashboard.with_route_history(flights, routes, limit=-1), "simple")
        wide = spark.range(10).select((F.col("id") % 9).alias("id"), F.repeat(F.lit("x"), 100_000).alias("note")).distinct()
        monkeypatch.setattr(lookup, "LOOKUP_BYTES", 500_000)
        too_wide = plan(lookup.join_lookup(flights, wide, ["id"]), "simple")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "BroadcastHashJoin" in checked and "hashpartitioning" not in checked
    assert "SortMergeJoin" in beyond and "BroadcastHashJoin" not in beyond
    assert "SortMergeJoin" in too_wide and "BroadcastHashJoin" not in too_wide


def test_top_k_is_taken_per_task_first(spark, small):
    text = plan(dashboard.busiest_route_rows(registry.route_rows(spark, small), 10))
    assert "TakeOrderedAndProject" in text


def test_dimensions_are_broadcast(spark, small):
    text = plan(dashboard.with_airline_label(registry.airlines(spark, small)), "simple")
    assert "BroadcastHashJoin" in text


def test_weather_join_shuffles_on_all_three_keys_when_large(spark, small):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        flights = registry.flights(spark, small)
        text = plan(weather.with_origin_weather(flights, registry.hourly(spark, small)), "simple")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    (keys,) = re.findall(r"hashpartitioning\(([^)]*FLIGHT_DATE[^)]*)", text)[:1]
    assert "ORIGIN" in keys and "SCHEDULED_DEP" in keys
    # the observations of an hour are cut to one, the eight fields and the keys, before they are sent
    assert "PRESSURE_HPA" not in re.sub(r"(?s).*SortMergeJoin", "", text).split("Exchange hashpartitioning(IATA_CODE")[0]


def test_skew_is_split_at_run_time(spark):
    """One key holds a third of the flights; the join splits it."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        n = 400_000
        flights = spark.range(0, n, 1, 16).select(
            F.lit("ATL").alias("ORIGIN"), F.lit("LAX").alias("DEST"), F.rand(1).alias("PAD"),
            F.date_add(F.lit("2024-01-01").cast("date"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 300).cast("int")).alias("FLIGHT_DATE"),
            F.lit(800).alias("SCHEDULED_DEP"), F.lit(None).cast("int").alias("SCHEDULED_ARR"), F.lit(2024).alias("YEAR"),
        )
        obs = spark.range(300).select(
            F.lit("ATL").alias("IATA_CODE"), F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("OBS_DATE"),
            F.lit(8).alias("OBS_HOUR"), *[F.lit(1).cast("int" if name == "WEATHER_CODE" else "double").alias(name) for name in weather.ORIGIN_FIELDS],
        )
        joined = weather.with_origin_weather(flights, obs)
        assert joined.where("ORIGIN_TEMP_C IS NULL").count() == 0
        summed = joined.groupBy("ORIGIN_PRECIP_MM").agg(F.count(F.lit(1)), F.sum("PAD"))
        assert summed.collect()[0][1] == n
        assert "skew=true" in plan(summed, "simple")
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_wide_rows_run_as_compiled_methods(spark, small):
    limit, fresh = "spark.sql.codegen.hugeMethodLimit", spark.newSession()
    assert int(spark.conf.get(limit)) <= 8000
    fresh.conf.set(limit, "65535")  # what Spark starts with
    registry.QUERIES["cleaned_flights"](fresh, small)
    # a stage with a larger method is interpreted by HotSpot unless Spark gives it up
    assert int(fresh.conf.get(limit)) <= 8000


def test_rows_of_common_keys_move_once(spark):
    numbers = spark.range(4000).selectExpr(
        "CASE WHEN id % 50 = 0 THEN NULL ELSE CONCAT('k', CAST(id % 700 AS STRING)) END AS k", "id % 900 AS a", "CAST(id % 3 AS STRING) AS b"
    )
    listed = [tuple(row) for row in numbers.withColumn("n", keys.row_number_of(["k", "a", "b"])).collect()]
    least = {}
    for k, _, _, n in listed:
        least[k] = min(n, least.get(k, n))
    wanted = {(k, a, b) for k, a, b, n in listed if k is not None and n == least[k]}
    for limit in (0, 1_000_000):
        found = keys.one_per_rare_key(numbers, "k", limit)
        got = [tuple(row) for row in found.collect()]
        assert sorted(row for row in got if row[0] is not None) == sorted(wanted)
        assert len([row for row in got if row[0] is None]) == 80  # rows without a key stay
    # keys, the winners' keys and numbers, and once the rows
    assert plan(keys.one_per_rare_key(numbers, "k", 0), "simple").count("Exchange hashpartitioning") == 3


def test_buckets_grow_with_the_flights(spark):
    assert colocated_weather.buckets_for(spark.range(10), least=8) == 8
    assert colocated_weather.buckets_for(spark.range(6_000_000), least=8) == 20


def test_source_texts_are_picked_and_the_same_on_odd_lines(spark, small):
    lines = stand_ins.base(spark, small).selectExpr(
        "CASE WHEN l_orderkey % 7 = 0 THEN -l_orderkey WHEN l_orderkey % 7 <> 1 THEN l_orderkey END AS l_orderkey",
        "CASE WHEN l_orderkey % 5 = 0 THEN -l_partkey WHEN l_orderkey % 5 <> 1 THEN l_partkey END AS l_partkey",
        "CASE WHEN l_orderkey % 3 = 0 THEN arrm * 9 WHEN l_orderkey % 3 = 1 THEN -arrm WHEN l_linenumber <> 2 THEN arrm END AS arrm",
        *[name for name in stand_ins.LINEITEM + list(stand_ins.HELPERS) if name not in ("l_orderkey", "l_partkey", "arrm")],
    )
    plain = lines.selectExpr(*stand_ins.expressions(stand_ins.SOURCE_ROWS, "spark"))
    picked = stand_ins.source_shape(lines)
    assert picked.columns == plain.columns
    assert picked.exceptAll(plain).isEmpty() and plain.exceptAll(picked).isEmpty()
    # forming a text takes most of the time of a row
    assert len(stand_ins.SOURCE_ROWS_PICKED) == len(stand_ins.SOURCE_ROWS)
    assert sum("get(array(" in text for text in stand_ins.SOURCE_ROWS_PICKED.values()) >= 35


def test_lines_are_not_moved_for_the_customers(spark, small):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(stand_ins.base(spark, small))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    moved = re.findall(r"Exchange *\nInput[^:]*: \[([^\]]*)\]\nArguments: hashpartitioning\(o_custkey", text)
    assert moved and not any("l_" in names for names in moved)


def counting(spark, make):
    """``make``, and an accumulator of the rows that are taken from it."""
    seen = spark.sparkContext.accumulator(0)

    def counted(session, folder):
        def count(batches):
            for batch in batches:
                seen.add(batch.num_rows)
                yield batch

        rows = make(session, folder)
        return rows.mapInArrow(count, rows.schema)

    return counted, seen


def test_lines_are_joined_once_for_csv_files_of_two_headers(spark, small, monkeypatch):
    lines = stand_ins.base(spark, small).count()
    made, seen = counting(spark, stand_ins.base)
    monkeypatch.setattr(stand_ins, "base", made)
    registry.QUERIES["csv_scan"](spark, small).collect()
    assert seen.value == lines


@pytest.mark.parametrize("name", ["loads_cut_short", "date_replaced_on_disk", "date_emptied_on_disk"])
def test_lines_are_cleaned_once_for_several_loads(spark, small, monkeypatch, name):
    lines = stand_ins.nas_lines(spark, small).count()
    made, seen = counting(spark, stand_ins.nas_lines)
    monkeypatch.setattr(stand_ins, "nas_lines", made)
    registry.QUERIES[name](spark, small).collect()
    assert seen.value == lines


def test_program_texts_run_as_compiled_methods(spark, small):
    limit, fresh = "spark.sql.codegen.hugeMethodLimit", spark.newSession()
    fresh.conf.set(limit, "65535")
    stand_ins.nas_lines(fresh, small)
    assert int(fresh.conf.get(limit)) <= 8000


def test_archives_move_lines_instead_of_source_rows(spark, small, tmp_path):
    """A source row is over a hundred texts; what is moved and sorted by month is a line of a few numbers."""
    text = plan(registry.landed_archives(spark, small, tmp_path.as_uri()))
    moved = re.findall(r"Exchange *\nInput[^:]*: \[([^\]]*)\]\nArguments: hashpartitioning\(Year", text)
    assert len(moved) == 1 and len(moved[0].split(",")) < 20 and "Tail_Number" not in moved[0]
    assert len(re.findall(r"^\(\d+\) Sort *$", text, re.M)) == 1
    by_month, plain = stand_ins.source_rows_by_month(spark, small), stand_ins.source_rows(spark, small)
    assert by_month.schema == plain.schema and by_month.exceptAll(plain).isEmpty() and plain.exceptAll(by_month).isEmpty()


def test_csv_files_are_compressed_and_of_moderate_size(spark, small, tmp_path, monkeypatch):
    monkeypatch.setattr(registry, "work_path", lambda session, name: (tmp_path / name).as_uri())
    monkeypatch.setattr(registry, "CSV_LINES_PER_FILE", 700)
    found = registry.QUERIES["csv_scan"](spark, small)
    files = sorted((tmp_path / "csv-scan").glob("*/part-*"))
    sizes = [len(gzip.decompress(file.read_bytes()).splitlines()) - 1 for file in files]
    assert all(file.name.endswith(".csv.gz") for file in files) and max(sizes) <= 700
    assert sum(sizes) == stand_ins.base(spark, small).count()
    assert found.count() == registry.cleaned_flights(spark, small).count()
    assert not (tmp_path / "csv-lines").exists()  # read by nothing any more
