"""Delay-program status: cleaning, completion, and the live page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac import dims
from tarmac.functions.clock import iso_date, iso_timestamp
from tarmac.operators.keys import one_per_key
from tarmac.schemas import NAS_SNAPSHOT


def parse_times(rows: DataFrame) -> DataFrame:
    """ISO text → wall-clock timestamp and date; bad text becomes NULL."""
    return rows.withColumns({"SNAPSHOT_TS": iso_timestamp("SNAPSHOT_TS"), "FETCH_DATE": iso_date("FETCH_DATE")})


def normalise_airport(rows: DataFrame) -> DataFrame:
    return rows.withColumn("IATA_CODE", F.upper(F.trim("IATA_CODE")))


def has_program_key() -> Column:
    """Rows that can be deduplicated by program: all three keys are present."""
    return F.col("FETCH_DATE").isNotNull() & F.col("IATA_CODE").isNotNull() & F.col("DELAY_TYPE").isNotNull()


def deduplicate_programs(rows: DataFrame) -> DataFrame:
    """Typed rows: one per date, airport, type, NULL keys dropped.  Untyped rows:
    one per date and airport, NULL keys kept.  The latest snapshot wins."""
    # NULL is one key to a window, so one pass serves both kinds
    kept = rows.where(has_program_key() | F.col("DELAY_TYPE").isNull())
    return one_per_key(kept, ["FETCH_DATE", "IATA_CODE", "DELAY_TYPE"], [F.col("SNAPSHOT_TS").desc_nulls_last()])


def clean_nas(rows: DataFrame) -> DataFrame:
    """Snapshot lines → status rows, without the load clock."""
    cleaned = normalise_airport(parse_times(rows))
    return deduplicate_programs(cleaned).select(NAS_SNAPSHOT.names)


def complete_snapshot(delayed: DataFrame) -> DataFrame:
    """Add a no-delay row for every feed airport a date does not mention.

    Dates × feed airports is at most fifty rows per date.
    """
    universe = F.array(*[F.lit(code) for code in dims.NAS_AIRPORTS])
    # the airports of a date that are in the feed: at most fifty, whatever the number of rows
    fed = F.when(F.array_contains(universe, F.col("IATA_CODE")), F.col("IATA_CODE"))
    seen = delayed.groupBy("FETCH_DATE").agg(F.collect_set(fed).alias("seen"))
    quiet = seen.select("FETCH_DATE", F.explode(F.array_except(universe, "seen")).alias("IATA_CODE")).withColumns(
        {"HAS_DELAY": F.lit(False), "DELAY_COUNT": F.lit(0)}
    )
    return delayed.unionByName(quiet, allowMissingColumns=True)


def feed_summary(rows: DataFrame) -> DataFrame:
    """Airports seen and airports with a delay."""
    return rows.agg(
        F.count_distinct("IATA_CODE").alias("AIRPORTS_FETCHED"),
        F.count_distinct(F.when(F.col("HAS_DELAY"), F.col("IATA_CODE"))).alias("AIRPORTS_WITH_DELAY"),
    )


def on_latest_date(rows: DataFrame, of: DataFrame | None = None) -> DataFrame:
    """Rows of the latest FETCH_DATE, by default of their own."""
    latest = (rows if of is None else of).agg(F.max("FETCH_DATE")).scalar()
    return rows.where(F.col("FETCH_DATE") == latest)


def status_totals(status: DataFrame) -> DataFrame:
    """Headline numbers of the latest date."""
    return on_latest_date(status).agg(
        F.count_distinct("IATA_CODE").alias("AIRPORTS_WITH_DELAY"),
        F.count_if("HAS_GROUND_STOP").alias("TOTAL_GROUND_STOPS"),
        F.count_if("HAS_GROUND_DELAY").alias("TOTAL_GROUND_DELAYS"),
        F.max("MAX_AVG_DELAY_MIN").alias("WORST_AVG_DELAY_MIN"),
    )


def active_programs(nas: DataFrame, status: DataFrame) -> DataFrame:
    """Delay rows of the mart's latest date, worst first."""
    return (
        on_latest_date(nas, status)
        .where("HAS_DELAY")
        .orderBy(F.col("AVG_DELAY_MIN").desc_nulls_last(), "IATA_CODE")
        .select(
            F.col("IATA_CODE").alias("Airport"),
            F.col("DELAY_TYPE").alias("Type"),
            F.col("AVG_DELAY_MIN").alias("Avg Delay (min)"),
            F.col("TREND").alias("Trend"),
            F.col("REASON").alias("Reason"),
        )
    )


def programs_by_date(status: DataFrame) -> DataFrame:
    return status.groupBy("FETCH_DATE").agg(F.sum("DELAY_PROGRAMS").alias("TOTAL_PROGRAMS")).orderBy("FETCH_DATE")


def programs_by_type(nas: DataFrame) -> DataFrame:
    return (
        nas.where("HAS_DELAY")
        .groupBy(F.col("DELAY_TYPE").alias("Delay Type"))
        .agg(F.count(F.lit(1)).alias("Occurrences"))
        .orderBy(F.col("Occurrences").desc(), "Delay Type")
    )


def latest_rows(nas: DataFrame, status: DataFrame) -> DataFrame:
    return on_latest_date(nas, status).orderBy("IATA_CODE", "DELAY_TYPE")
