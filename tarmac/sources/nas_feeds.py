"""Delay-program feeds as fetched: XML snapshot, per-airport JSON, aggregate JSON.

Each reader takes a frame with one response per row and yields rows in the
snapshot shape.  A response is a few kilobytes, so parsing stays per row.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from itertools import batched
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.functions.text import blank_to_null, delay_minutes, delay_type, first_text, strip, temperature, visibility
from tarmac.schemas import NAS_SNAPSHOT

# Stored lengths of the free-text fields.
LENGTHS = {"REASON": 500, "TREND": 20, "END_TIME": 50, "WEATHER_WIND": 100, "WEATHER_CONDITION": 100}

FIELD_MAP = "map<string,string>"

#: Texts of an entry, and those that may also stand deeper inside it.
ENTRY_TEXTS = ("ARPT", "Reason", "Avg", "Reopen", "EndTime")
ENTRY_RANGES = ("Min", "Max", "Trend")

#: Entries a task hands on at a time.
ENTRIES_PER_PART = 2000


def cut(value: Column, name: str, lengths: Mapping[str, int | None]) -> Column:
    """``value`` at the stored length of column ``name``; whole where that has none."""
    length = lengths.get(name)
    return value if length is None else F.left(value, F.lit(length))


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    """One row per response file: its text as ``BODY``."""
    return spark.read.text(path, wholetext=True).select(F.col("value").alias("BODY"))


def xml_entries(body: str | None) -> Iterator[tuple[str, dict[str, str]]]:
    """Name of its block and texts of every element that has an airport code, in whatever list and at any depth.

    Each element is visited once: what may stand deeper comes up from below.  A
    body that is no XML has no entries.
    """
    try:
        root = ElementTree.fromstring(body or "")
    except ElementTree.ParseError:
        return
    for block in root.findall("Delay_type"):
        name, found = block.findtext("Name") or "Unknown", []
        below: dict[ElementTree.Element, dict[str, str]] = {}
        for element in reversed(list(block.iter())):  # children before their parents, later ones first
            inside: dict[str, str] = {}
            for child in reversed(element):
                inside |= below.pop(child, {})
                if child.tag in ENTRY_RANGES:
                    inside[child.tag] = child.text or ""
            below[element] = inside
            if element is not block and element.find("ARPT") is not None:
                found.append({**{tag: element.findtext(tag) or "" for tag in ENTRY_TEXTS}, **inside})
        for entry in reversed(found):
            yield name, entry


def rows_from_xml(responses: DataFrame, lengths: Mapping[str, int | None] = LENGTHS) -> DataFrame:
    """Columns SNAPSHOT_TS, FETCH_DATE, BODY → one row per airport entry.

    An entry is any element with an airport code below a delay type; one whose
    code is blank gives no row.  ``lengths`` cuts the texts, {} leaves them whole.
    """
    names = [*ENTRY_TEXTS, *ENTRY_RANGES]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # one response at a time, and what it gives in parts: neither the number nor the size of responses adds up
        entries = (
            (stamp.as_py(), date.as_py(), name, *(entry.get(tag, "") for tag in names))
            for batch in batches
            for stamp, date, body in zip(*(batch.column(c) for c in ("SNAPSHOT_TS", "FETCH_DATE", "BODY")))
            for name, entry in xml_entries(body.as_py())
        )
        for found in batched(entries, ENTRIES_PER_PART):
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, pa.string()) for column in zip(*found)], names=["SNAPSHOT_TS", "FETCH_DATE", "name", *names]
            )

    stamps = [F.col(name).cast("string").alias(name) for name in ("SNAPSHOT_TS", "FETCH_DATE", "BODY")]
    shape = ", ".join(f"`{name}` string" for name in ("SNAPSHOT_TS", "FETCH_DATE", "name", *names))
    entries = responses.select(*stamps).mapInArrow(parse, shape)
    rows = entries.select(
        "SNAPSHOT_TS",
        "FETCH_DATE",
        F.upper(strip("ARPT")).alias("IATA_CODE"),
        F.lit(True).alias("HAS_DELAY"),
        F.lit(1).alias("DELAY_COUNT"),
        delay_type("name").alias("DELAY_TYPE"),
        cut(F.col("Reason"), "REASON", lengths).alias("REASON"),
        delay_minutes("Avg").alias("AVG_DELAY_MIN"),
        delay_minutes("Min").alias("MIN_DELAY_MIN"),
        delay_minutes("Max").alias("MAX_DELAY_MIN"),
        cut(F.col("Trend"), "TREND", lengths).alias("TREND"),
        cut(F.coalesce(blank_to_null("Reopen"), F.col("EndTime")), "END_TIME", lengths).alias("END_TIME"),
    )
    return in_snapshot_shape(rows.where(F.col("IATA_CODE") != ""))


def rows_from_airport_json(responses: DataFrame, lengths: Mapping[str, int | None] = LENGTHS) -> DataFrame:
    """Columns SNAPSHOT_TS, FETCH_DATE, IATA_CODE, BODY → one row per program.

    An airport without a delay or without a status list gives one row with
    HAS_DELAY false and its weather.  Both key spellings are accepted.
    """
    weather = either("weather", "Temp", "temp"), either("weather", "Visibility", "visibility")
    opened = responses.withColumn("doc", F.from_json("BODY", FIELD_MAP))
    airports = opened.select(
        "SNAPSHOT_TS",
        "FETCH_DATE",
        F.upper("IATA_CODE").alias("IATA_CODE"),
        F.coalesce(either("doc", "Delay", "delay"), F.lit("false")) != "false",
        F.coalesce(either("doc", "DelayCount", "delay_count").try_cast("int"), F.lit(0)).alias("announced"),
        json_list(either("doc", "Status", "status")).alias("programs"),
        F.from_json(either("doc", "Weather", "weather"), FIELD_MAP).alias("weather"),
    ).toDF("SNAPSHOT_TS", "FETCH_DATE", "IATA_CODE", "delayed", "announced", "programs", "weather")
    listed = F.when(F.col("delayed") & (F.size("programs") > 0), F.col("programs"))
    rows = airports.select("*", F.explode_outer(listed).alias("program"))
    active = F.col("program").isNotNull()
    fields = program_fields("program", lengths=lengths)
    return in_snapshot_shape(
        rows.select(
            "SNAPSHOT_TS",
            "FETCH_DATE",
            "IATA_CODE",
            active.alias("HAS_DELAY"),
            F.when(active, F.col("announced")).otherwise(0).alias("DELAY_COUNT"),
            *[F.when(active, value).alias(name) for name, value in fields.items()],
            temperature(weather[0]).alias("WEATHER_TEMP_F"),
            visibility(weather[1]).alias("WEATHER_VIS_MI"),
            cut(first_text(either("weather", "Wind", "wind")), "WEATHER_WIND", lengths).alias("WEATHER_WIND"),
            cut(first_text(either("weather", "Conditions", "conditions")), "WEATHER_CONDITION", lengths).alias(
                "WEATHER_CONDITION"
            ),
        )
    )


def rows_from_aggregate_json(responses: DataFrame, lengths: Mapping[str, int | None] = LENGTHS) -> DataFrame:
    """Columns SNAPSHOT_TS, FETCH_DATE, BODY → one row per airport entry of every list."""
    opened = responses.withColumn("doc", F.from_json("BODY", FIELD_MAP))
    root = F.coalesce(F.from_json(field("doc", "airport_status_information"), FIELD_MAP), F.col("doc"))
    blocks = opened.withColumn("root", root).select(
        "SNAPSHOT_TS", "FETCH_DATE", F.explode(json_list(field("root", "delay_type"))).alias("block")
    )
    entries = blocks.select(
        "SNAPSHOT_TS",
        "FETCH_DATE",
        delay_type(F.coalesce(field("block", "Name"), F.lit("Unknown"))).alias("DELAY_TYPE"),
        F.explode(json_list(field("block", "airport_closure_list"))).alias("entry"),
    )
    fields = program_fields("entry", minutes=("Avg", "Min", "Max"), lengths=lengths)
    rows = entries.select(
        "SNAPSHOT_TS",
        "FETCH_DATE",
        F.upper(strip(either("entry", "ARPT", "airport"))).alias("IATA_CODE"),
        F.lit(True).alias("HAS_DELAY"),
        F.lit(1).alias("DELAY_COUNT"),
        "DELAY_TYPE",
        *[value.alias(name) for name, value in fields.items() if name != "DELAY_TYPE"],
    )
    return in_snapshot_shape(rows.where(F.col("IATA_CODE") != ""))


def field(column: str, key: str) -> Column:
    return F.try_element_at(F.col(column), F.lit(key))


def either(column: str, key: str, twin: str) -> Column:
    """Value under ``key``, or under its lower-case twin where that is empty."""
    return F.coalesce(blank_to_null(field(column, key)), blank_to_null(field(column, twin)))


def json_list(text: Column) -> Column:
    """A JSON list of objects; anything else is NULL."""
    return F.when(text.startswith("["), F.from_json(text, f"array<{FIELD_MAP}>"))


def program_fields(
    column: str,
    minutes: tuple[str, str, str] = ("AvgDelay", "MinDelay", "MaxDelay"),
    lengths: Mapping[str, int | None] = LENGTHS,
) -> dict[str, Column]:
    def words(key: str, twin: str, name: str) -> Column:
        return cut(F.coalesce(either(column, key, twin), F.lit("")), name, lengths)

    average, least, most = minutes
    return {
        "DELAY_TYPE": delay_type(F.coalesce(either(column, "Type", "type"), F.lit("Unknown"))),
        "REASON": words("Reason", "reason", "REASON"),
        "AVG_DELAY_MIN": delay_minutes(either(column, average, "avg_delay")),
        "MIN_DELAY_MIN": delay_minutes(either(column, least, "min_delay")),
        "MAX_DELAY_MIN": delay_minutes(either(column, most, "max_delay")),
        "TREND": words("Trend", "trend", "TREND"),
        "END_TIME": words("EndTime", "end_time", "END_TIME"),
    }


def in_snapshot_shape(rows: DataFrame) -> DataFrame:
    """All snapshot columns in order; fields a feed does not carry are NULL."""
    present = set(rows.columns)
    return rows.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in NAS_SNAPSHOT.fields
        ]
    )
