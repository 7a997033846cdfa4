"""Daily delay anomalies.  Every function covers any number of days at once."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Thresholds, program codes that count as ground programs, line limits.
DELAY_MINUTES = 45
DELAY_COUNT = 3
GROUND_TYPES = ("GroundStop", "GroundDelay", "Airspace")
SEVERE_LINES = 10
REASON_LENGTH = 80

REPORT_COLUMNS = [
    "IATA_CODE", "HAS_DELAY", "DELAY_COUNT", "DELAY_TYPE", "REASON", "AVG_DELAY_MIN", "MAX_DELAY_MIN",
    "TREND", "END_TIME", "WEATHER_CONDITION", "WEATHER_TEMP_F", "WEATHER_WIND", "FETCH_DATE",
]


def day_records(nas: DataFrame, date: dt.date | None = None) -> DataFrame:
    """Records of one day, or of all days, worst mean delay first."""
    rows = nas if date is None else nas.where(F.col("FETCH_DATE") == F.lit(date))
    worst = F.coalesce("AVG_DELAY_MIN", F.lit(0)).desc()
    return rows.select(REPORT_COLUMNS).orderBy(worst, "FETCH_DATE", "IATA_CODE", "DELAY_TYPE")


def severe(nas: DataFrame, delay_min: int = DELAY_MINUTES, count_min: int = DELAY_COUNT) -> DataFrame:
    """Rows with a long mean delay or many delayed flights."""
    long = F.coalesce("AVG_DELAY_MIN", F.lit(0)) >= delay_min
    many = F.coalesce("DELAY_COUNT", F.lit(0)) >= count_min
    return nas.where(F.col("HAS_DELAY") & (long | many))


def ground_programs(nas: DataFrame, types: Sequence[str] = GROUND_TYPES) -> DataFrame:
    return nas.where(F.col("HAS_DELAY") & F.col("DELAY_TYPE").isin(list(types)))


def other_severe(nas: DataFrame, types: Sequence[str] = GROUND_TYPES, **thresholds: int) -> DataFrame:
    """Severe rows of airports that are under no ground program that day."""
    grounded = ground_programs(nas, types).select("FETCH_DATE", "IATA_CODE").distinct()
    return severe(nas, **thresholds).join(grounded, ["FETCH_DATE", "IATA_CODE"], "left_anti")


def day_summary(nas: DataFrame) -> DataFrame:
    """Rows, delayed rows and the mean delay over delayed rows, per day."""
    delayed = F.coalesce("HAS_DELAY", F.lit(False))
    average = F.avg(F.when(delayed, F.coalesce("AVG_DELAY_MIN", F.lit(0))))
    return nas.groupBy("FETCH_DATE").agg(
        F.count(F.lit(1)).alias("TOTAL_RECORDS"),
        F.count_if(delayed).alias("DELAYED_RECORDS"),
        F.round(F.coalesce(average, F.lit(0.0)), 1).alias("AVG_DELAY_ACROSS_DELAYED"),
    )


def digest(
    nas: DataFrame,
    types: Sequence[str] = GROUND_TYPES,
    severe_lines: int = SEVERE_LINES,
    reason_length: int | None = REASON_LENGTH,
    **thresholds: int,
) -> DataFrame:
    """The daily digest, one row per line.

    Lines are not gathered per day: SECTION and SEQ give their place, and the
    writer sorts by them.  The first ``severe_lines`` severe lines of a day come
    from ``row_number()``, which Spark limits per task before the shuffle; their
    reasons are cut at ``reason_length``, or whole with None.
    """
    reason = F.coalesce("REASON", F.lit("unknown"))
    shown = F.coalesce(F.col("AVG_DELAY_MIN").cast("string"), F.lit("N/A"))
    place = F.concat(
        F.lpad((F.lit(1_000_000) - F.coalesce("AVG_DELAY_MIN", F.lit(0))).cast("string"), 8, "0"),
        F.lit(" "),
        F.coalesce("IATA_CODE", F.lit("")),
    )
    header = day_summary(nas).select(
        "FETCH_DATE",
        F.lit("header").alias("SECTION"),
        F.lit("").alias("SEQ"),
        F.concat_ws(
            "; ",
            F.concat(F.lit("date "), F.col("FETCH_DATE").cast("string")),
            F.concat(F.lit("records "), F.col("TOTAL_RECORDS").cast("string")),
            F.concat(F.lit("with delay "), F.col("DELAYED_RECORDS").cast("string")),
            F.concat(F.lit("mean delay "), F.col("AVG_DELAY_ACROSS_DELAYED").cast("string"), F.lit(" min")),
        ).alias("LINE"),
    )
    grounded = ground_programs(nas, types).select(
        "FETCH_DATE",
        F.lit("program").alias("SECTION"),
        place.alias("SEQ"),
        F.concat_ws(
            "; ",
            "IATA_CODE",
            F.concat(F.lit("type "), F.col("DELAY_TYPE")),
            F.concat(F.lit("mean delay "), shown, F.lit(" min")),
            F.concat(F.lit("reason "), F.coalesce("REASON", F.lit("unknown"))),
        ).alias("LINE"),
    )
    remaining = other_severe(nas, types, **thresholds)
    by_day = Window.partitionBy("FETCH_DATE").orderBy(
        F.coalesce("AVG_DELAY_MIN", F.lit(0)).desc(), "IATA_CODE", "DELAY_TYPE", "REASON"
    )
    first = remaining.withColumn("_rank", F.row_number().over(by_day)).where(F.col("_rank") <= severe_lines)
    listed = first.select(
        "FETCH_DATE",
        F.lit("severe").alias("SECTION"),
        place.alias("SEQ"),
        F.concat_ws(
            "; ",
            "IATA_CODE",
            F.concat(F.lit("mean delay "), shown, F.lit(" min")),
            F.concat(F.lit("max delay "), F.coalesce(F.col("MAX_DELAY_MIN").cast("string"), F.lit("N/A")), F.lit(" min")),
            F.concat(F.lit("weather "), F.coalesce("WEATHER_CONDITION", F.lit("N/A"))),
            F.concat(F.lit("reason "), reason if reason_length is None else F.left(reason, F.lit(reason_length))),
        ).alias("LINE"),
    )
    noted = grounded.select("FETCH_DATE").unionByName(remaining.select("FETCH_DATE")).distinct()
    clear = (
        nas.select("FETCH_DATE")
        .distinct()
        .join(noted, "FETCH_DATE", "left_anti")
        .select(
            "FETCH_DATE",
            F.lit("clear").alias("SECTION"),
            F.lit("").alias("SEQ"),
            F.lit("no unusual delays, operations normal").alias("LINE"),
        )
    )
    return header.unionByName(grounded).unionByName(listed).unionByName(clear)


def digest_order() -> list:
    """Sort columns that put the lines of a day in reading order."""
    rank = F.when(F.col("SECTION") == "header", 0).when(F.col("SECTION") == "program", 1).otherwise(2)
    return [rank, F.col("SEQ")]
