"""The registered queries: name → (spark, folder) → DataFrame.

Every query reads the given tables through the stand-ins and runs over all of
their rows.
"""

from __future__ import annotations

import csv
import datetime as dt
import io
import json
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import csv as pa_csv
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import stand_ins
from tarmac import dims
from tarmac.functions.clock import risk_color, risk_level, sunday_first
from tarmac.functions.text import (
    code_and_name,
    code_from_label,
    delay_minutes,
    delay_type,
    name_and_code,
    temperature,
    visibility,
)
from tarmac.operators import adhoc, anomalies, cells, coverage, dashboard, delay_model, features, marts, nas, weather
from tarmac.operators import flight_cleaning as cleaning
from tarmac.operators import sketches, tree_rows
from tarmac.operators.keys import sample_rows
from tarmac.plans import colocated_weather, flight_history, mart_refresh, weather_history
from tarmac.schemas import RAW_FLIGHTS, STAGING_FLIGHTS, WEATHER_HOURLY, columns
from tarmac.session import ensure_checkpoint_dir, remove_path, work_path
from tarmac.sources import landed, nas_feeds, tables
from tarmac.sources.versions import VersionedTable
from tarmac.streaming import nas_feed

Query = Callable[[SparkSession, str], DataFrame]

# Parameters that make thresholds and ranges bite on the stand-ins.
YEARS = (1996, 2000)
FEW_YEARS = (1997, 1999)
BUSY_ROUTE = 500
BUSY_AIRPORT = 4000
ROUTE = ("LAX", "DFW")
MONTH = dt.date(1998, 5, 20)
DAY = dt.date(2024, 1, 9)
REQUESTED = ("1995-01", "2003-12")
# nearly every airport of the stand-in is under some program every day, so the
# severe-but-not-grounded rows are those without this one
GROUNDED = ("GroundStop",)

QUERIES: dict[str, Query] = {}


def register(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


def flights(spark: SparkSession, folder: str) -> DataFrame:
    return stand_ins.flights(spark, folder)


def monthly(spark: SparkSession, folder: str) -> DataFrame:
    return marts.delay_trends_monthly(flights(spark, folder))


def airlines(spark: SparkSession, folder: str) -> DataFrame:
    return marts.airline_performance(flights(spark, folder))


def airports(spark: SparkSession, folder: str) -> DataFrame:
    return marts.airport_stats(flights(spark, folder))


def causes(spark: SparkSession, folder: str) -> DataFrame:
    return marts.delay_cause_breakdown(flights(spark, folder))


def routes(spark: SparkSession, folder: str) -> DataFrame:
    return marts.route_performance(flights(spark, folder))


def hourly(spark: SparkSession, folder: str) -> DataFrame:
    return weather.clean_weather(stand_ins.weather_documents(spark, folder))


def flights_with_weather(spark: SparkSession, folder: str) -> DataFrame:
    return weather.with_weather(flights(spark, folder), hourly(spark, folder))


def status(spark: SparkSession, folder: str) -> DataFrame:
    return marts.airport_nas_status(stand_ins.nas(spark, folder))


# -- cleaning ----------------------------------------------------------------


@register
def renamed_known_columns(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.known_columns(cleaning.rename_columns(stand_ins.source_rows(spark, folder)))


@register
def typed_columns(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.cast_columns(renamed_known_columns(spark, folder))


@register
def rows_with_core_keys(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.with_core_keys(typed_columns(spark, folder))


@register
def trimmed_text(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.trim_text(typed_columns(spark, folder))


@register
def cancelled_delays_voided(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.void_cancelled_delays(typed_columns(spark, folder))


@register
def cleaned_flights(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.clean_flights(stand_ins.source_rows(spark, folder))


def staged(spark: SparkSession, folder: str) -> DataFrame:
    raw = tables.add_missing_columns(cleaned_flights(spark, folder), RAW_FLIGHTS)
    return cleaning.staging_flights(raw)


STAGED_SHOWN = [name for name in STAGING_FLIGHTS.names if name != "_LOAD_TS"]


@register
def staging_rows(spark: SparkSession, folder: str) -> DataFrame:
    return staged(spark, folder).select(STAGED_SHOWN)


@register
def deduplicated_flights(spark: SparkSession, folder: str) -> DataFrame:
    # columns on disk take a fraction of checkpointed rows
    path, rows = work_path(spark, "staged-flights"), staged(spark, folder).select(STAGED_SHOWN)
    tables.write_batch(rows, path)
    return cleaning.deduplicate_flights(spark.read.schema(rows.schema).parquet(path))


CSV_LINES_PER_FILE = 500_000  # a compressed file is read by one task

# columns that files of odd years lack
ABSENT_IN_ODD_YEARS = ["TaxiOut", "DistanceGroup", "NASDelay"]


@register
def csv_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Compressed files of two headers: one with an unknown and a nameless column, one with fewer columns in another order."""
    path, lines = work_path(spark, "csv-scan"), work_path(spark, "csv-lines")
    # the joined lines are few columns; what is made of them is written twice
    tables.write_batch(stand_ins.base(spark, folder), lines)
    rows = stand_ins.source_shape(spark.read.parquet(lines))
    kept = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "emptyValue": ""}
    files = {"header": True, "compression": "gzip", "maxRecordsPerFile": CSV_LINES_PER_FILE}
    even, odd = rows.where("int(Year) % 2 = 0"), rows.where("int(Year) % 2 = 1").drop(*ABSENT_IN_ODD_YEARS)
    even.withColumn("", F.lit(None).cast("string")).write.options(**files, **kept).csv(f"{path}/even")
    odd.select(*reversed(odd.columns)).write.options(**files, **kept).csv(f"{path}/odd")
    remove_path(spark, lines)
    return cleaning.clean_flights(landed.read_source_csv(spark, f"{path}/*"))


def landed_archives(spark: SparkSession, folder: str, path: str) -> DataFrame:
    """The source rows as one ZIP per month; the month of MONTH is cut short and one archive holds no CSV.

    Every hundredth line has surplus fields.  Returns the names written.
    """

    rows = stand_ins.source_rows_by_month(spark, folder)
    header = io.StringIO()
    csv.writer(header, lineterminator="\n").writerow([*rows.columns, ""])

    def pack(month: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # batch by batch, as a month has any number of rows
        name, place = f"ontime_{int(month[0].as_py())}_{int(month[1].as_py()):02d}.zip", tempfile.TemporaryFile()
        plain = pa_csv.WriteOptions(include_header=False, quoting_style="none")
        with place as held:
            with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as archive:
                archive.writestr("readme.html", "about")
                with archive.open("on_time.csv", "w", force_zip64=True) as member:
                    member.write(header.getvalue().encode())
                    at = 0
                    for batch in batches:
                        nameless = pa.nulls(batch.num_rows, pa.string())
                        lines = pa.table([*batch.columns, nameless], [*batch.schema.names, "_nameless"])
                        long = pa.array((np.arange(at, at + batch.num_rows) % 100) == 0)
                        surplus = lines.filter(long)
                        surplus = surplus.append_column("_surplus", pa.array(["surplus"] * len(surplus), pa.string()))
                        for part in (lines.filter(pc.invert(long)), surplus):
                            text = io.BytesIO()
                            pa_csv.write_csv(part, text, plain)
                            member.write(text.getbuffer())
                        at += batch.num_rows
            size = held.tell()
            if (int(month[0].as_py()), int(month[1].as_py())) == (MONTH.year, MONTH.month):
                size //= 2
            system, path_of = fs.FileSystem.from_uri(path)
            system.create_dir(path_of, recursive=True)
            held.seek(0)
            with system.open_output_stream(f"{path_of}/{name}") as out:
                while size:
                    block = held.read(min(size, 1 << 20))
                    out.write(block)
                    size -= len(block)
        yield pa.RecordBatch.from_pydict({"ARCHIVE": [name]})

    return rows.groupBy("Year", "Month").applyInArrow(pack, "ARCHIVE string")


def load_of_archives(spark: SparkSession, folder: str) -> tuple[str, DataFrame]:
    path = work_path(spark, "archives")
    landed_archives(spark, folder, path).write.format("noop").mode("overwrite").save()
    raw = work_path(spark, "raw")
    return raw, flight_history.load_archives(spark, path, raw, work_path(spark, "archive-errors"))


@register
def archives_loaded(spark: SparkSession, folder: str) -> DataFrame:
    raw, _ = load_of_archives(spark, folder)
    return spark.read.schema(RAW_FLIGHTS).parquet(raw).drop("_LOAD_TS", "_SOURCE")


@register
def archives_that_failed(spark: SparkSession, folder: str) -> DataFrame:
    return load_of_archives(spark, folder)[1].select("ARCHIVE")


@register
def rows_by_source_tag(spark: SparkSession, folder: str) -> DataFrame:
    tagged = cleaning.tag_source(cleaned_flights(spark, folder))
    return tagged.groupBy("_SOURCE").agg(F.count(F.lit(1)).alias("N"), F.count("_LOAD_TS").alias("STAMPED"))


@register
def guard_answers(spark: SparkSession, folder: str) -> DataFrame:
    rows = tables.add_missing_columns(flights(spark, folder))
    answers = {
        "HAS_DISTANCE": tables.has_column(rows, "distance") and tables.has_values(rows, "DISTANCE"),
        "HAS_WEATHER": tables.has_values(rows, "ORIGIN_TEMP_C"),
        "HAS_OTHER": tables.has_column(rows, "OTHER"),
        "READY": tables.is_ready(rows),
    }
    return rows.agg(F.count(F.lit(1)).alias("N"), *[F.lit(value).alias(name) for name, value in answers.items()])


@register
def raw_parquet_batch(spark: SparkSession, folder: str) -> DataFrame:
    path = work_path(spark, "raw-batch")
    tables.write_batch(cleaned_flights(spark, folder), path)
    return spark.read.schema(cleaned_flights(spark, folder).schema).parquet(path)


def named_alike(spark: SparkSession, folder: str) -> DataFrame:
    rows = cleaning.rename_columns(stand_ins.source_rows(spark, folder))
    return tables.load_by_name(rows.toDF(*[name.lower() for name in rows.columns]), LOADED)


LOADED = columns("YEAR int, FLIGHT_DATE date, FLIGHT_NUMBER string, ORIGIN string, DEP_DELAY_MINUTES double, DISTANCE double")


@register
def rows_loaded_by_name(spark: SparkSession, folder: str) -> DataFrame:
    return tables.loaded_rows(named_alike(spark, folder))


@register
def load_counts(spark: SparkSession, folder: str) -> DataFrame:
    return tables.load_report(named_alike(spark, folder))


# -- marts -------------------------------------------------------------------


@register
def delay_trends_monthly(spark: SparkSession, folder: str) -> DataFrame:
    return monthly(spark, folder)


@register
def delay_trends_monthly_counting_cancelled(spark: SparkSession, folder: str) -> DataFrame:
    return marts.delay_trends_monthly(flights(spark, folder), count_cancelled=True)


@register
def delay_trends_daily(spark: SparkSession, folder: str) -> DataFrame:
    return marts.delay_trends_daily(flights(spark, folder))


@register
def airline_performance(spark: SparkSession, folder: str) -> DataFrame:
    return airlines(spark, folder)


@register
def airport_stats(spark: SparkSession, folder: str) -> DataFrame:
    return airports(spark, folder)


@register
def delay_cause_breakdown(spark: SparkSession, folder: str) -> DataFrame:
    return causes(spark, folder)


@register
def route_performance(spark: SparkSession, folder: str) -> DataFrame:
    return routes(spark, folder)


@register
def airport_nas_status(spark: SparkSession, folder: str) -> DataFrame:
    return status(spark, folder)


@register
def weather_delay_correlation(spark: SparkSession, folder: str) -> DataFrame:
    joined = weather.with_origin_weather(flights(spark, folder), hourly(spark, folder))
    return marts.weather_delay_correlation(joined)


@register
def delay_trends_of_one_month(spark: SparkSession, folder: str) -> DataFrame:
    return marts.delay_trends_monthly(flights(spark, folder), MONTH)


def mart_with_month(spark: SparkSession, folder: str, fresh: DataFrame) -> DataFrame:
    """The mart with cancellations counted, then one month of it refreshed twice."""
    path = work_path(spark, "mart")
    before = marts.delay_trends_monthly(flights(spark, folder), count_cancelled=True)
    tables.refresh_mart(before, path, ["YEAR", "MONTH"])
    for _ in range(2):
        tables.refresh_mart(fresh, path, month=MONTH)
    return tables.read_mart(spark, path, before.schema)


@register
def mart_month_refreshed_on_disk(spark: SparkSession, folder: str) -> DataFrame:
    return mart_with_month(spark, folder, marts.delay_trends_monthly(flights(spark, folder), MONTH))


@register
def mart_month_emptied_on_disk(spark: SparkSession, folder: str) -> DataFrame:
    return mart_with_month(spark, folder, marts.delay_trends_monthly(flights(spark, folder).where("YEAR < 0")))


@register
def mart_month_replaced(spark: SparkSession, folder: str) -> DataFrame:
    rows = flights(spark, folder)
    return tables.replace_month(
        marts.delay_trends_monthly(rows, count_cancelled=True), marts.delay_trends_monthly(rows, MONTH), MONTH
    )


def flight_cells(spark: SparkSession, folder: str) -> DataFrame:
    return cells.flight_cells(flights(spark, folder))


@register
def delay_trends_from_cells(spark: SparkSession, folder: str) -> DataFrame:
    return cells.delay_trends_monthly(flight_cells(spark, folder))


@register
def airline_performance_from_cells(spark: SparkSession, folder: str) -> DataFrame:
    return cells.airline_performance(flight_cells(spark, folder))


@register
def airport_stats_from_cells(spark: SparkSession, folder: str) -> DataFrame:
    return cells.airport_stats(flight_cells(spark, folder))


@register
def delay_causes_from_cells(spark: SparkSession, folder: str) -> DataFrame:
    return cells.delay_cause_breakdown(flight_cells(spark, folder))


@register
def route_performance_from_cells(spark: SparkSession, folder: str) -> DataFrame:
    return cells.route_performance(flight_cells(spark, folder))


@register
def distinct_tails_from_sketches(spark: SparkSession, folder: str) -> DataFrame:
    """Aircraft per year: the exact count, and whether the union of the stored month sketches is within its error."""
    rows = flights(spark, folder).select("YEAR", "MONTH", "TAIL_NUMBER")
    path = work_path(spark, "sketches")
    tables.write_batch(sketches.sketched_counts(rows, ["YEAR", "MONTH"], "TAIL_NUMBER"), path)
    years = sketches.rolled_up(spark.read.parquet(path), ["YEAR"])
    exact = rows.groupBy("YEAR").agg(F.count_distinct("TAIL_NUMBER").alias("TAILS"))
    near = F.abs(F.col("ESTIMATE") - F.col("TAILS")) <= F.col("TAILS") * sketches.relative_error() + 1
    return exact.join(years, "YEAR").select("YEAR", "TAILS", near.alias("WITHIN_ERROR"))


@register
def airlines_of_years_from_sketches(spark: SparkSession, folder: str) -> DataFrame:
    """Airlines per year; a sketch that has seen so few values is exact."""
    months = sketches.sketched_counts(flights(spark, folder), ["YEAR", "MONTH"], "AIRLINE_CODE")
    return sketches.rolled_up(months, ["YEAR"]).withColumnRenamed("ESTIMATE", "N_AIRLINES")


@register
def programs_of_airports_from_sketches(spark: SparkSession, folder: str) -> DataFrame:
    """Program types per airport over all dates, from the sketches of its days."""
    delayed = stand_ins.nas(spark, folder).where("HAS_DELAY").dropna(subset=["FETCH_DATE", "IATA_CODE"])
    days = sketches.sketched_counts(delayed, ["FETCH_DATE", "IATA_CODE"], "DELAY_TYPE")
    return sketches.rolled_up(days, ["IATA_CODE"]).withColumnRenamed("ESTIMATE", "DELAY_PROGRAMS")


@register
def mart_set_refreshed(spark: SparkSession, folder: str) -> DataFrame:
    path = work_path(spark, "marts")
    outcome = mart_refresh.refresh(flights(spark, folder), None, path, "airline")
    mart = tables.read_mart(spark, f"{path}/airline_performance").drop(tables.STAMP)
    return mart.withColumn("OUTCOME", F.lit(outcome["airline_performance"]))


@register
def mart_truncated_and_reloaded(spark: SparkSession, folder: str) -> DataFrame:
    path, mart = work_path(spark, "mart"), status(spark, folder)
    tables.refresh_mart(mart.withColumn("DELAY_PROGRAMS", F.lit(0).cast("long")), path)
    tables.refresh_mart(mart, path)
    return tables.read_mart(spark, path, mart.schema)


# -- ad-hoc ------------------------------------------------------------------


@register
def annual_trend(spark: SparkSession, folder: str) -> DataFrame:
    return adhoc.annual_trend(monthly(spark, folder))


@register
def most_delayed_airlines(spark: SparkSession, folder: str) -> DataFrame:
    return adhoc.most_delayed_airlines(airlines(spark, folder))


@register
def month_of_year_pattern(spark: SparkSession, folder: str) -> DataFrame:
    return adhoc.month_of_year_pattern(monthly(spark, folder))


@register
def worst_airports(spark: SparkSession, folder: str) -> DataFrame:
    return adhoc.worst_airports(airports(spark, folder))


@register
def cause_composition(spark: SparkSession, folder: str) -> DataFrame:
    return adhoc.cause_composition(causes(spark, folder))


@register
def months_with_cancel_rate(spark: SparkSession, folder: str) -> DataFrame:
    return adhoc.months_with_cancel_rate(monthly(spark, folder), *YEARS)


@register
def busiest_routes(spark: SparkSession, folder: str) -> DataFrame:
    return adhoc.busiest_routes(routes(spark, folder), more_than=BUSY_ROUTE)


@register
def weekday_pattern(spark: SparkSession, folder: str) -> DataFrame:
    return adhoc.weekday_pattern(flights(spark, folder))


# -- dashboard ---------------------------------------------------------------


@register
def home_totals(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard.home_totals(monthly(spark, folder))


@register
def airline_count(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard.airline_count(airlines(spark, folder))


@register
def home_annual(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard.home_annual(monthly(spark, folder))


@register
def home_seasonal(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard.home_seasonal(monthly(spark, folder))


@register
def year_ranges(spark: SparkSession, folder: str) -> DataFrame:
    given = {"trends": monthly, "airlines": airlines, "airports": airports, "causes": causes, "routes": routes}
    ranges = [dashboard.year_range(mart(spark, folder)).withColumn("MART", F.lit(name)) for name, mart in given.items()]
    every = ranges[0]
    for one in ranges[1:]:
        every = every.unionByName(one)
    return every


@register
def rows_of_years(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard.in_years(airlines(spark, folder), *FEW_YEARS)


@register
def trend_months(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard.trend_months(monthly(spark, folder), *YEARS)


@register
def trend_years(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard.trend_years(monthly(spark, folder), *YEARS)


@register
def trend_lines_per_year(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard.trend_lines(monthly(spark, folder), *FEW_YEARS)


@register
def trend_lines_of_many_years(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard.trend_lines(monthly(spark, folder), 1990, 2010)


@register
def trend_cause_shares(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard.trend_cause_shares(monthly(spark, folder), *YEARS)


def airline_rows(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard.airline_summary(airlines(spark, folder), *YEARS, top_n=10)


@register
def airline_summary(spark: SparkSession, folder: str) -> DataFrame:
    return airline_rows(spark, folder)


@register
def airline_years(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard.airline_years(airlines(spark, folder), *YEARS)


@register
def airline_table(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard.airline_table(airline_rows(spark, folder))


def airport_rows(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard.airport_summary(airports(spark, folder), 1990, None, BUSY_AIRPORT)


@register
def airport_summary(spark: SparkSession, folder: str) -> DataFrame:
    return airport_rows(spark, folder)


@register
def busiest_airports(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard.busiest_airports(airport_rows(spark, folder), 5)


@register
def most_delayed_airports(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard.most_delayed_airports(airport_rows(spark, folder), 5)


@register
def airport_comparison(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard.airport_comparison(airport_rows(spark, folder))


@register
def states(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard.states(airport_rows(spark, folder))


@register
def airport_table(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard.airport_table(airport_rows(spark, folder))


@register
def cause_totals(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard.cause_totals(causes(spark, folder), *YEARS)


@register
def cause_years(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard.cause_years(causes(spark, folder), *YEARS)


@register
def cause_year_shares(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard.cause_year_shares(dashboard.cause_years(causes(spark, folder), *YEARS))


@register
def cause_months(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard.cause_months(causes(spark, folder), *YEARS)


def route_rows(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard.route_summary(routes(spark, folder), 1990, None, BUSY_ROUTE)


@register
def route_summary(spark: SparkSession, folder: str) -> DataFrame:
    return route_rows(spark, folder)


@register
def most_delayed_routes(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard.most_delayed_routes(route_rows(spark, folder), 10)


@register
def busiest_route_rows(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard.busiest_route_rows(route_rows(spark, folder), 10)


@register
def routes_by_distance(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard.routes_by_distance(dashboard.route_summary(routes(spark, folder), 1990, None, 1))


@register
def route_months(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard.route_months(routes(spark, folder), "-".join(ROUTE), *YEARS)


@register
def route_years(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard.route_years(route_months(spark, folder))


@register
def route_names(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard.route_names(route_rows(spark, folder))


@register
def default_route(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard.default_route(route_names(spark, folder))


@register
def routes_found(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard.route_table(dashboard.route_search(route_rows(spark, folder), "lax"))


@register
def route_history(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard.route_history(routes(spark, folder), *ROUTE)


@register
def flights_with_route_history(spark: SparkSession, folder: str) -> DataFrame:
    rows = flights(spark, folder).select("FLIGHT_DATE", "ORIGIN", "DEST", "TAIL_NUMBER")
    return dashboard.with_route_history(rows, routes(spark, folder))


# the same with limits below the number of rows


@register
def worst_three_airports(spark: SparkSession, folder: str) -> DataFrame:
    return adhoc.worst_airports(airports(spark, folder), n=3)


@register
def five_busiest_routes(spark: SparkSession, folder: str) -> DataFrame:
    return adhoc.busiest_routes(routes(spark, folder), n=5, more_than=BUSY_ROUTE)


@register
def airport_comparison_of_five(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard.airport_comparison(airport_rows(spark, folder), top_n=5)


@register
def twenty_routes_by_distance(spark: SparkSession, folder: str) -> DataFrame:
    return dashboard.routes_by_distance(dashboard.route_summary(routes(spark, folder), 1990, None, 1), top_n=20)


@register
def default_route_listed(spark: SparkSession, folder: str) -> DataFrame:
    """The list with the default route in it, if any route starts where it does."""
    names = route_names(spark, folder)
    listed = names.where(F.startswith("ROUTE", F.lit("LAX-"))).select(F.lit("LAX-JFK").alias("ROUTE")).distinct()
    return dashboard.default_route(names.union(listed))


# -- labels and text ---------------------------------------------------------


CARRIERS = "'AADLUAWNB6ASNKF9G4HAVXOOMQZZ'"


def carrier_codes(spark: SparkSession, folder: str) -> DataFrame:
    pick = f"SUBSTR({CARRIERS}, CAST(2*(l_suppkey % 14)+1 AS INT), 2)"
    return stand_ins.table(spark, folder, "lineitem").selectExpr(f"{pick} AS AIRLINE_CODE", "l_orderkey")


@register
def airline_labels(spark: SparkSession, folder: str) -> DataFrame:
    labelled = dashboard.with_airline_label(carrier_codes(spark, folder), "LABEL")
    return labelled.withColumn("CODE", code_from_label("LABEL"))


@register
def airport_labels(spark: SparkSession, folder: str) -> DataFrame:
    names = dims.airports(spark).select(F.col("IATA_CODE").alias("code"), "AIRPORT_NAME")
    rows = stand_ins.nas_text(spark, folder).select("event_id", "IATA_CODE")
    joined = rows.join(F.broadcast(names), F.col("IATA_CODE") == F.col("code"), "left")
    label = code_and_name("IATA_CODE", "AIRPORT_NAME")
    return joined.select("event_id", label.alias("LABEL"), code_from_label(label).alias("CODE"))


@register
def minutes_from_text(spark: SparkSession, folder: str) -> DataFrame:
    rows = stand_ins.nas_text(spark, folder)
    return rows.select("event_id", "AVG_TXT", delay_minutes("AVG_TXT").alias("MINUTES"))


@register
def program_types(spark: SparkSession, folder: str) -> DataFrame:
    rows = stand_ins.nas_text(spark, folder)
    return rows.select(
        "event_id", delay_type("TYPE_NAME").alias("DELAY_TYPE"), delay_type("REASON").alias("OTHER_TYPE")
    )


@register
def weather_numbers(spark: SparkSession, folder: str) -> DataFrame:
    rows = stand_ins.nas_text(spark, folder)
    return rows.select("event_id", temperature("TEMP_TXT").alias("TEMP_F"), visibility("VIS_TXT").alias("VIS_MI"))


@register
def risk_bands(spark: SparkSession, folder: str) -> DataFrame:
    on_time = (F.col("l_quantity") / 50).alias("ON_TIME")
    rows = stand_ins.table(spark, folder, "lineitem").select("l_orderkey", on_time)
    return rows.select("*", risk_level("ON_TIME").alias("RISK_LEVEL"), risk_color("ON_TIME").alias("RISK_COLOR"))


@register
def weekdays_from_sunday(spark: SparkSession, folder: str) -> DataFrame:
    rows = flights(spark, folder).select("FLIGHT_DATE", sunday_first("DAY_OF_WEEK").alias("DEP_DOW"))
    return rows.groupBy("FLIGHT_DATE", "DEP_DOW").agg(F.count(F.lit(1)).alias("N"))


@register
def airport_dimension(spark: SparkSession, folder: str) -> DataFrame:
    used = stand_ins.nas_text(spark, folder).groupBy("IATA_CODE").agg(F.count(F.lit(1)).alias("N"))
    return used.join(F.broadcast(dims.airports(spark)), "IATA_CODE", "left")


@register
def label_dimensions(spark: SparkSession, folder: str) -> DataFrame:
    days = flights(spark, folder).groupBy("MONTH", "DAY_OF_WEEK").agg(F.count(F.lit(1)).alias("N"))
    named = dashboard.with_month_label(days)
    return named.join(F.broadcast(dims.weekdays(spark)), "DAY_OF_WEEK", "left")


# -- weather -----------------------------------------------------------------


@register
def hourly_weather(spark: SparkSession, folder: str) -> DataFrame:
    return hourly(spark, folder)


@register
def hourly_weather_of_one_year(spark: SparkSession, folder: str) -> DataFrame:
    return weather.clean_weather(stand_ins.weather_documents(spark, folder), year=1998)


def landed_documents(spark: SparkSession, folder: str) -> str:
    path = work_path(spark, "weather-docs")
    documents = stand_ins.weather_documents(spark, folder)
    year = F.substring(F.get("hourly.time", F.lit(0)), 1, 4)
    # one airport-year per file, as landed: at most 366 daily documents in a list
    listed = documents.groupBy(F.col("iata_code").alias("airport"), year.alias("year")).agg(
        F.concat(
            F.lit("["),
            F.concat_ws(",", F.collect_list(F.to_json(F.struct("iata_code", "hourly")))),
            F.lit("]"),
        ).alias("value")
    )
    listed.write.partitionBy("airport", "year").text(path)
    return f"{path}/*"


@register
def weather_document_scan(spark: SparkSession, folder: str) -> DataFrame:
    return weather.clean_weather(landed.read_weather_documents(spark, landed_documents(spark, folder), "*.txt"))


@register
def weather_files_counted(spark: SparkSession, folder: str) -> DataFrame:
    """A fixed number of files, and the count of the pass that wrote them beside that of a reader."""
    path = work_path(spark, "weather-files")
    written = tables.write_counted(hourly(spark, folder), path, files=26)
    stored = spark.read.schema(hourly(spark, folder).schema).parquet(path)
    return stored.select(F.col("_metadata.file_path").alias("file")).agg(
        F.lit(written).cast("long").alias("ROWS_WRITTEN"),
        F.count(F.lit(1)).alias("ROWS_READ"),
        F.count_distinct("file").alias("FILES"),
    )


@register
def weather_load_counts(spark: SparkSession, folder: str) -> DataFrame:
    """The report of a full reload, with the rows that reading the table back gives."""
    raw = work_path(spark, "weather-raw")
    report = weather_history.load_weather(spark, landed_documents(spark, folder), raw, files="*.txt")
    stored = spark.read.schema(WEATHER_HOURLY).parquet(raw).where("OBS_TIMESTAMP IS NOT NULL").count()
    return report.select("ROWS_LOADED", "ERRORS_SEEN", F.lit(stored).cast("long").alias("ROWS_STORED"))


@register
def stored_weather_filled(spark: SparkSession, folder: str) -> DataFrame:
    """Fill status of the stored flights before and after the fill."""
    path = work_path(spark, "staging")
    rows = tables.add_missing_columns(stand_ins.flights_by_month(spark, folder))
    VersionedTable(spark, path).replace(rows, ["YEAR", "MONTH"], rebalance=False)
    return weather_history.fill_stored_weather(spark, path, hourly(spark, folder), since_year=1998)


WEATHER_KEYS = ["FLIGHT_DATE", "ORIGIN", "DEST", "SCHEDULED_DEP", "SCHEDULED_ARR", "TAIL_NUMBER"]


@register
def origin_weather(spark: SparkSession, folder: str) -> DataFrame:
    joined = weather.with_origin_weather(flights(spark, folder).select(WEATHER_KEYS), hourly(spark, folder))
    return joined.select(*WEATHER_KEYS, *[f"ORIGIN_{name}" for name in weather.ORIGIN_FIELDS])


@register
def destination_weather(spark: SparkSession, folder: str) -> DataFrame:
    joined = weather.with_destination_weather(flights(spark, folder).select(WEATHER_KEYS), hourly(spark, folder))
    return joined.select(*WEATHER_KEYS, *[f"DEST_{name}" for name in weather.DEST_FIELDS])


@register
def weather_from_buckets(spark: SparkSession, folder: str) -> DataFrame:
    """Weather at both ends from tables stored by the same buckets, eight and two slices a date at least."""
    names = []
    rows = flights(spark, folder).select("YEAR", *WEATHER_KEYS)
    buckets = colocated_weather.buckets_for(rows, least=8)
    for kind, store, frame in (
        ("flights", colocated_weather.store_flights, rows),
        ("observations", colocated_weather.store_observations, hourly(spark, folder)),
    ):
        path = work_path(spark, f"bucketed-{kind}")
        names.append(f"{kind}_{path.rsplit('-', 1)[1]}")
        store(frame, names[-1], path, buckets=buckets, slices=2)
    joined = colocated_weather.joined_weather(spark, *names)
    ends = [("ORIGIN", weather.ORIGIN_FIELDS), ("DEST", weather.DEST_FIELDS)]
    return joined.select(*WEATHER_KEYS, *[f"{side}_{name}" for side, fields in ends for name in fields])


@register
def weather_fill_status(spark: SparkSession, folder: str) -> DataFrame:
    return weather.fill_status(flights_with_weather(spark, folder), since_year=1998)


@register
def airport_coordinates(spark: SparkSession, folder: str) -> DataFrame:
    seen = stand_ins.nas_text(spark, folder).select(F.lower("IATA_CODE").alias("IATA_CODE")).distinct()
    return weather.with_coordinates(seen)


@register
def weather_fetch_grid(spark: SparkSession, folder: str) -> DataFrame:
    seen = flights(spark, folder).select(F.col("ORIGIN").alias("IATA_CODE")).distinct()
    return weather.fetch_grid(seen, *YEARS).select("IATA_CODE", "TIME_ZONE", "YEAR")


# -- months ------------------------------------------------------------------


def flight_months(spark: SparkSession, folder: str) -> DataFrame:
    return flights(spark, folder).select("YEAR", "MONTH")


@register
def month_sequence(spark: SparkSession, folder: str) -> DataFrame:
    first_last = flights(spark, folder).agg(
        F.date_format(F.min("FLIGHT_DATE"), "yyyy-MM").alias("START"),
        F.date_format(F.max("FLIGHT_DATE"), "yyyy-MM").alias("END"),
    )
    return coverage.month_sequence(first_last)


def requested_months(spark: SparkSession) -> DataFrame:
    return coverage.month_sequence(spark.createDataFrame([REQUESTED], "START string, END string"))


@register
def missing_months(spark: SparkSession, folder: str) -> DataFrame:
    return coverage.missing_months(requested_months(spark), flight_months(spark, folder))


@register
def month_coverage(spark: SparkSession, folder: str) -> DataFrame:
    return coverage.month_coverage(requested_months(spark), flight_months(spark, folder))


# -- delay programs ----------------------------------------------------------


@register
def cleaned_nas(spark: SparkSession, folder: str) -> DataFrame:
    return nas.clean_nas(stand_ins.nas_lines(spark, folder))


@register
def snapshot_scan(spark: SparkSession, folder: str) -> DataFrame:
    path = work_path(spark, "nas-lines")
    lines = stand_ins.nas_lines(spark, folder)
    lines.withColumn("day", F.col("FETCH_DATE")).write.partitionBy("day").json(path)
    return nas.clean_nas(landed.read_nas_snapshots(spark, path))


@register
def snapshot_scan_of_one_date(spark: SparkSession, folder: str) -> DataFrame:
    path = work_path(spark, "nas-lines")
    lines = stand_ins.nas_lines(spark, folder)
    lines.withColumn("day", F.col("FETCH_DATE")).write.partitionBy("day").json(path)
    return nas.clean_nas(landed.read_nas_snapshots(spark, path, f"day={DAY.isoformat()}"))


@register
def dated_files(spark: SparkSession, folder: str) -> DataFrame:
    """Rows by the date of their folder and the date in the file."""
    path = work_path(spark, "dated")
    tables.write_dated(cleaned_nas(spark, folder), path)
    stored = spark.read.parquet(path)
    return stored.groupBy(F.col("DATE_KEY").cast("date").alias("DATE_KEY"), "FETCH_DATE").agg(F.count(F.lit(1)).alias("N"))


# responses as the feeds send them, one per hour of the snapshot clock; every airspace program
# comes in a list that no feed has had so far
HOUR_STAMP = "date_format(date_trunc('hour', SNAPSHOT_TS), \"yyyy-MM-dd'T'HH:mm:ss\")"


def delayed_events(spark: SparkSession, folder: str) -> DataFrame:
    rows = stand_ins.nas_text(spark, folder).where("HAS_DELAY")
    return rows.withColumns({"STAMP": F.expr(HOUR_STAMP), "DAY": F.col("FETCH_DATE").cast("string")})


def xml_responses(spark: SparkSession, folder: str) -> DataFrame:
    def tag(name: str, text) -> object:
        safe = F.coalesce(text, F.lit(""))
        for mark, code in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
            safe = F.replace(safe, F.lit(mark), F.lit(code))
        return F.concat(F.lit(f"<{name}>"), safe, F.lit(f"</{name}>"))

    deep = F.concat(F.lit("<Arrival_Departure><Range>"), tag("Max", F.col("MAX_TXT")), tag("Trend", F.col("TREND")), F.lit("</Range></Arrival_Departure>"))
    texts = [tag("ARPT", F.concat(F.lit(" "), F.lower("IATA_CODE"))), tag("Reason", F.col("REASON")), tag("Avg", F.col("AVG_TXT")), deep]
    outer = F.when(F.col("TYPE_NAME") == "Airspace Flow Programs", "Unheard_Of_List").otherwise("Ground_Delay_List")
    entry = F.concat(F.lit("<Entry>"), *texts, F.lit("</Entry>"))
    block = F.concat(
        F.lit("<Delay_type>"), tag("Name", F.col("TYPE_NAME")), F.lit("<"), outer, F.lit(">"), entry, F.lit("</"), outer, F.lit("></Delay_type>")
    )
    blocks = delayed_events(spark, folder).withColumn("BLOCK", block).groupBy("STAMP", "DAY")
    body = F.concat(F.lit("<AIRPORT_STATUS>"), F.concat_ws("", F.collect_list("BLOCK")), F.lit("</AIRPORT_STATUS>"))
    return blocks.agg(body.alias("BODY")).withColumnsRenamed({"STAMP": "SNAPSHOT_TS", "DAY": "FETCH_DATE"})


@register
def programs_from_xml(spark: SparkSession, folder: str) -> DataFrame:
    return nas_feeds.rows_from_xml(xml_responses(spark, folder))


@register
def programs_from_airport_json(spark: SparkSession, folder: str) -> DataFrame:
    """One response per airport and event; the wind comes as a list, and a third of the keys in lower case."""
    rows = stand_ins.nas_text(spark, folder)
    program = F.struct(
        F.col("TYPE_NAME").alias("Type"), F.col("AVG_TXT").alias("AvgDelay"), F.col("MAX_TXT").alias("MaxDelay"),
        F.col("TREND").alias("Trend"), F.col("REASON").alias("Reason"),
    )
    sky = F.struct(
        F.array(F.col("TEMP_TXT")).alias("Temp"), F.array(F.col("VIS_TXT")).alias("Visibility"),
        F.array(F.concat(F.lit(" "), F.col("TREND"), F.lit(" "))).alias("Wind"),
    )
    programs = F.when(F.col("HAS_DELAY"), F.array(program)).otherwise(F.array().cast("array<struct<Type:string,AvgDelay:string,MaxDelay:string,Trend:string,Reason:string>>"))
    upper = F.to_json(F.struct(F.col("HAS_DELAY").alias("Delay"), F.col("DELAY_COUNT").alias("DelayCount"), programs.alias("Status"), sky.alias("Weather")))
    lower = F.to_json(F.struct(F.col("HAS_DELAY").alias("delay"), F.col("DELAY_COUNT").alias("delay_count"), programs.alias("status"), sky.alias("weather")))
    responses = rows.select(
        F.date_format("SNAPSHOT_TS", "yyyy-MM-dd'T'HH:mm:ss").alias("SNAPSHOT_TS"),
        F.col("FETCH_DATE").cast("string").alias("FETCH_DATE"),
        F.lower("IATA_CODE").alias("IATA_CODE"),
        F.when(F.col("event_id") % 3 == 0, lower).otherwise(upper).alias("BODY"),
    )
    return nas_feeds.rows_from_airport_json(responses)


@register
def programs_from_aggregate_json(spark: SparkSession, folder: str) -> DataFrame:
    entry = F.struct(
        F.col("IATA_CODE").alias("ARPT"), F.col("REASON").alias("Reason"), F.col("AVG_TXT").alias("Avg"),
        F.col("MAX_TXT").alias("Max"), F.col("TREND").alias("Trend"),
    )
    block = F.struct(F.col("TYPE_NAME").alias("Name"), F.array(entry).alias("airport_closure_list"))
    grouped = delayed_events(spark, folder).withColumn("BLOCK", block).groupBy("STAMP", "DAY")
    body = F.to_json(F.struct(F.struct(F.collect_list("BLOCK").alias("delay_type")).alias("airport_status_information")))
    responses = grouped.agg(body.alias("BODY")).withColumnsRenamed({"STAMP": "SNAPSHOT_TS", "DAY": "FETCH_DATE"})
    return nas_feeds.rows_from_aggregate_json(responses)


@register
def completed_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    delayed = stand_ins.nas(spark, folder).where("HAS_DELAY")
    return nas.complete_snapshot(delayed).select(
        "FETCH_DATE", "IATA_CODE", "HAS_DELAY", "DELAY_COUNT", "DELAY_TYPE", "AVG_DELAY_MIN"
    )


def stored_nas(spark: SparkSession, folder: str) -> DataFrame:
    """The cleaned rows, read from disk: several loads of them clean the lines once."""
    path, rows = work_path(spark, "nas-cleaned"), cleaned_nas(spark, folder)
    tables.write_batch(rows, path)
    return spark.read.schema(rows.schema).parquet(path)


def new_day(rows: DataFrame) -> DataFrame:
    """Other rows of DAY than the stored ones."""
    return rows.where((F.col("FETCH_DATE") == F.lit(DAY)) & F.col("HAS_DELAY")).withColumn(
        "DELAY_COUNT", F.col("DELAY_COUNT") + 100
    )


@register
def date_replaced(spark: SparkSession, folder: str) -> DataFrame:
    rows = cleaned_nas(spark, folder)
    return tables.replace_date(rows, new_day(rows), DAY)


def table_with_day(spark: SparkSession, rows: DataFrame, incoming: DataFrame) -> DataFrame:
    """The stored table after ``incoming`` has replaced DAY, and the same load once more."""
    path = work_path(spark, "nas-table")
    VersionedTable(spark, path).replace(rows.where(F.col("FETCH_DATE").isNotNull()), ["FETCH_DATE"])
    for _ in range(2):
        tables.write_replacing_date(incoming, path, DAY)
    return tables.read_dated(spark, path, rows.schema)


@register
def loads_cut_short(spark: SparkSession, folder: str) -> DataFrame:
    """The table and a mart after loads that were stopped before their last step, and after the loads that followed.

    The stopped load of the table had written other rows for every date, the
    stopped refresh an empty month.
    """
    rows, path = stored_nas(spark, folder), work_path(spark, "nas-table")
    table = VersionedTable(spark, path)
    table.replace(rows, ["FETCH_DATE"])
    table.prepare(rows.where("HAS_DELAY").withColumn("DELAY_COUNT", F.lit(-1)), ["FETCH_DATE"])
    stopped = tables.read_dated(spark, path, rows.schema)
    parts = [stopped.groupBy("FETCH_DATE").agg(F.count(F.lit(1)).alias("N")).select(F.lit("stopped").alias("STATE"), "*")]
    tables.write_replacing_date(new_day(rows), path, DAY)
    loaded = tables.read_dated(spark, path, rows.schema)
    parts.append(loaded.groupBy("FETCH_DATE").agg(F.count(F.lit(1)).alias("N")).select(F.lit("loaded").alias("STATE"), "*"))
    mart, mart_path = marts.delay_trends_daily(flights(spark, folder)), work_path(spark, "mart")
    by_month = mart.withColumns({"YEAR": F.year("FLIGHT_DATE"), "MONTH": F.month("FLIGHT_DATE")})
    tables.refresh_mart(by_month, mart_path, ["YEAR", "MONTH"])
    VersionedTable(spark, mart_path).prepare(by_month.limit(0), ["YEAR", "MONTH"])
    kept = tables.read_mart(spark, mart_path, by_month.schema)
    parts.append(kept.select(F.lit("mart").alias("STATE"), F.col("FLIGHT_DATE").alias("FETCH_DATE"), F.col("TOTAL_FLIGHTS").alias("N")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register
def date_replaced_on_disk(spark: SparkSession, folder: str) -> DataFrame:
    rows = stored_nas(spark, folder)
    return table_with_day(spark, rows, new_day(rows))


@register
def date_emptied_on_disk(spark: SparkSession, folder: str) -> DataFrame:
    rows = stored_nas(spark, folder)
    return table_with_day(spark, rows, rows.where("FETCH_DATE IS NULL AND FETCH_DATE IS NOT NULL"))


@register
def feed_summary(spark: SparkSession, folder: str) -> DataFrame:
    return nas.feed_summary(stand_ins.nas(spark, folder))


@register
def status_totals(spark: SparkSession, folder: str) -> DataFrame:
    return nas.status_totals(status(spark, folder))


@register
def active_programs(spark: SparkSession, folder: str) -> DataFrame:
    return nas.active_programs(stand_ins.nas(spark, folder), status(spark, folder))


@register
def programs_by_date(spark: SparkSession, folder: str) -> DataFrame:
    return nas.programs_by_date(status(spark, folder))


@register
def programs_by_type(spark: SparkSession, folder: str) -> DataFrame:
    return nas.programs_by_type(stand_ins.nas(spark, folder))


@register
def latest_status_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = nas.latest_rows(stand_ins.nas(spark, folder), status(spark, folder))
    return rows.select("event_id", "FETCH_DATE", "IATA_CODE", "HAS_DELAY", "DELAY_TYPE", "AVG_DELAY_MIN", "TREND")


@register
def day_records(spark: SparkSession, folder: str) -> DataFrame:
    rows = anomalies.day_records(stand_ins.nas(spark, folder), DAY)
    return rows.select("FETCH_DATE", "IATA_CODE", "HAS_DELAY", "DELAY_COUNT", "DELAY_TYPE", "REASON", "AVG_DELAY_MIN")


ANOMALY_SHOWN = ["event_id", "FETCH_DATE", "IATA_CODE", "DELAY_COUNT", "DELAY_TYPE", "AVG_DELAY_MIN"]


@register
def severe_delays(spark: SparkSession, folder: str) -> DataFrame:
    return anomalies.severe(stand_ins.nas(spark, folder)).select(ANOMALY_SHOWN)


@register
def ground_programs(spark: SparkSession, folder: str) -> DataFrame:
    return anomalies.ground_programs(stand_ins.nas(spark, folder)).select(ANOMALY_SHOWN)


@register
def other_severe_delays(spark: SparkSession, folder: str) -> DataFrame:
    return anomalies.other_severe(stand_ins.nas(spark, folder), GROUNDED).select(ANOMALY_SHOWN)


@register
def day_summary(spark: SparkSession, folder: str) -> DataFrame:
    return anomalies.day_summary(stand_ins.nas(spark, folder))


@register
def daily_digest(spark: SparkSession, folder: str) -> DataFrame:
    return anomalies.digest(stand_ins.nas(spark, folder), GROUNDED).select("FETCH_DATE", "SECTION", "LINE")


@register
def digest_files(spark: SparkSession, folder: str) -> DataFrame:
    path = work_path(spark, "digest")
    tables.write_report(anomalies.digest(stand_ins.nas(spark, folder), GROUNDED), path, anomalies.digest_order())
    stored = spark.read.schema("LINE string, FETCH_DATE date").text(path)
    return stored.select("FETCH_DATE", "LINE")


# -- streams -----------------------------------------------------------------


def landed_lines(spark: SparkSession, folder: str) -> str:
    path = work_path(spark, "feed")
    lines = stand_ins.nas_lines(spark, folder)
    lines.withColumn("day", F.col("FETCH_DATE")).write.partitionBy("day").json(path)
    return path


def streamed_table(spark: SparkSession, lines: DataFrame) -> DataFrame:
    out, rows = work_path(spark, "stream-table"), nas_feed.clean_lines(lines)
    nas_feed.replace_dates_in(rows, out, work_path(spark, "stream-state")).awaitTermination()
    return tables.read_dated(spark, out, rows.schema)


FEED_SPAN = 8  # days of a landing
FEED_ROWS = 50_000  # lines of the smallest landing to a file


def landed_in_turn(spark: SparkSession, folder: str, order: tuple[int, ...], overlap: bool) -> tuple[str, int]:
    """The lines in landings of eight days each, one after the other in the ``order`` of those spans; and files per landing.

    A landing has one file, or several where there are many lines, and each
    landing the same number of them, so that a trigger of that many files is one
    landing.  With ``overlap`` the second half of every day comes a landing
    later, so that later and better snapshots of a key follow the one already seen.
    """
    path, lines = work_path(spark, "feed"), stand_ins.nas_lines(spark, folder)
    clock = F.col("SNAPSHOT_TS").cast("timestamp_ntz")
    span = F.floor((F.dayofmonth(clock) - 1) / FEED_SPAN)
    if overlap:
        span = span + F.when(F.hour(clock) >= 12, 1).otherwise(0)
    spans = lines.withColumn("span", span)
    counts = {row["span"]: row["count"] for row in spans.groupBy("span").count().collect()}
    # dealt out in turn, this many rows leave no file without any
    files = max(1, min(counts.get(part, 0) for part in order) // FEED_ROWS)
    for at, part in enumerate(order):
        rows = spans.where(F.col("span") == part).drop("span")
        (rows.coalesce(1) if files == 1 else rows.repartition(files)).write.json(f"{path}/{at}")
    return path, files


def latest_table(spark: SparkSession, lines: DataFrame, out: str, delay: str) -> DataFrame:
    rows = nas_feed.clean_lines(lines)
    latest = nas_feed.deduplicated(rows, delay)
    nas_feed.latest_into(latest, out, work_path(spark, "stream-state")).awaitTermination()
    return tables.read_dated(spark, out, rows.schema)


@register
def snapshot_stream_keys(spark: SparkSession, folder: str) -> DataFrame:
    """The latest snapshot per key from the stream's own state; every landing is a trigger of its own."""
    path, files = landed_in_turn(spark, folder, (0, 1, 2, 3, 4), overlap=True)
    lines = nas_feed.snapshot_stream(spark, path, files_per_trigger=files)
    return latest_table(spark, lines, work_path(spark, "stream-table"), "20 days")


def late_feed(spark: SparkSession, folder: str) -> tuple[DataFrame, str, str]:
    """The first days land last, behind the watermark; the table of the stream before their repair."""
    path, files = landed_in_turn(spark, folder, (1, 2, 3, 0), overlap=False)
    out, counts = work_path(spark, "stream-table"), work_path(spark, "late-counts")
    table = latest_table(spark, nas_feed.snapshot_stream(spark, path, files_per_trigger=files), out, "1 day")
    lines = nas_feed.clean_lines(nas_feed.snapshot_stream(spark, path, files_per_trigger=files))
    nas_feed.repair_late(lines, out, counts, work_path(spark, "stream-state"), days=1).awaitTermination()
    return table, out, counts


@register
def late_files_repaired(spark: SparkSession, folder: str) -> DataFrame:
    before, out, _ = late_feed(spark, folder)
    return tables.read_dated(spark, out, before.schema)


@register
def late_rows_diverted(spark: SparkSession, folder: str) -> DataFrame:
    """Rows counted by the repair, and rows of those dates in the stream's table without it."""
    before, _, counts = late_feed(spark, folder)
    diverted = nas_feed.late_counts(spark, counts).drop("BATCH")
    held = before.groupBy("FETCH_DATE").agg(F.count(F.lit(1)).alias("N"))
    return diverted.join(held, "FETCH_DATE", "left").select("FETCH_DATE", "LATE_ROWS", F.coalesce("N", F.lit(0)).alias("WITHOUT_REPAIR"))


@register
def snapshot_stream_table(spark: SparkSession, folder: str) -> DataFrame:
    """Every date is spread over the files, and each file is a trigger of its own."""
    path = work_path(spark, "feed")
    stand_ins.nas_lines(spark, folder).repartition(4).write.json(f"{path}/landed")
    return streamed_table(spark, nas_feed.snapshot_stream(spark, path, files_per_trigger=1))


@register
def daily_count_stream(spark: SparkSession, folder: str) -> DataFrame:
    lines = nas_feed.snapshot_stream(spark, landed_lines(spark, folder))
    out, counts = work_path(spark, "stream-counts"), nas_feed.daily_counts(nas_feed.clean_lines(lines))
    nas_feed.write_complete(counts, out, work_path(spark, "stream-state")).awaitTermination()
    return spark.read.schema(counts.schema).parquet(out)


# -- models ------------------------------------------------------------------


def model_rows(spark: SparkSession, folder: str) -> DataFrame:
    return features.labelled(features.model_features(flights_with_weather(spark, folder)))


@register
def model_features(spark: SparkSession, folder: str) -> DataFrame:
    return features.model_features(flights_with_weather(spark, folder))


@register
def model_features_without_weather(spark: SparkSession, folder: str) -> DataFrame:
    return features.model_features(flights(spark, folder), start=None, end=None)


@register
def labelled_rows(spark: SparkSession, folder: str) -> DataFrame:
    return model_rows(spark, folder)


@register
def class_balance(spark: SparkSession, folder: str) -> DataFrame:
    return features.class_balance(model_rows(spark, folder))


@register
def class_weight(spark: SparkSession, folder: str) -> DataFrame:
    return features.class_weight(model_rows(spark, folder))


@register
def category_values(spark: SparkSession, folder: str) -> DataFrame:
    return features.category_values(model_rows(spark, folder))


@register
def feature_rows(spark: SparkSession, folder: str) -> DataFrame:
    requests = features.model_features(flights(spark, folder), use_weather=False, start=None, end=None)
    names = features.NUMERIC_FEATURES + features.WEATHER_FEATURES + features.CATEGORICAL_FEATURES
    return features.feature_rows(requests, [*names, "EXTRA_FEATURE"])


@register
def split_summary(spark: SparkSession, folder: str) -> DataFrame:
    return features.split_summary(features.with_split(model_rows(spark, folder)))


@register
def split_rows(spark: SparkSession, folder: str) -> DataFrame:
    return features.with_split(model_rows(spark, folder))


def encoded(spark: SparkSession, folder: str, label: str) -> DataFrame:
    folded = model_rows(spark, folder).withColumn("FOLD", F.pmod("DEP_MONTH", F.lit(features.FOLDS)).cast("int"))
    return features.out_of_fold_means(folded, label).withColumn("ENCODING", F.round("ENCODING", 9))


@register
def out_of_fold_delay_rates(spark: SparkSession, folder: str) -> DataFrame:
    return encoded(spark, folder, "LABEL_CLASS")


@register
def out_of_fold_delay_minutes(spark: SparkSession, folder: str) -> DataFrame:
    return encoded(spark, folder, "LABEL_REG")


SAMPLE_KEYS = ["FLIGHT_DATE", "FLIGHT_NUMBER", "ORIGIN", "DEST", "TAIL_NUMBER", "SCHEDULED_DEP"]


@register
def flight_sample(spark: SparkSession, folder: str) -> DataFrame:
    sample = sample_rows(flights(spark, folder), SAMPLE_KEYS, 10, features.SEED)
    return sample.select("FLIGHT_DATE", "ORIGIN", "DEST", "TAIL_NUMBER")


def trained(spark: SparkSession, folder: str):
    ensure_checkpoint_dir(spark)
    rows = features.with_split(model_rows(spark, folder)).checkpoint()
    return rows, *delay_model.fit_both(rows, delay_model.Boosting(), delay_model.Boosting(depth=7))


@register
def delay_scores(spark: SparkSession, folder: str) -> DataFrame:
    rows, classifier, regressor = trained(spark, folder)
    return delay_model.score(rows, classifier, regressor)


@register
def delay_model_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return delay_model.evaluate(*trained(spark, folder))


def stored_model() -> dict:
    """A small fitted ensemble as rows; both engines score these very trees."""
    with open(os.path.join(os.path.dirname(__file__), "stored_model.json")) as file:
        return json.load(file)


def stored_scores(spark: SparkSession, folder: str) -> DataFrame:
    model = stored_model()
    rows = features.labelled(features.model_features(flights(spark, folder), start=None, end=None))
    nodes = {name: [tree_rows.Node(*node) for node in model[name]] for name in ("classifier", "regressor")}
    means = {
        name: spark.createDataFrame([tuple(row) for row in model[name]], "FEATURE string, VALUE string, MEAN double")
        for name in ("class_means", "minute_means")
    }
    return tree_rows.score(rows, **nodes, **means)


@register
def stored_tree_scores(spark: SparkSession, folder: str) -> DataFrame:
    return stored_scores(spark, folder)


@register
def stored_tree_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return tree_rows.metrics(stored_scores(spark, folder))
