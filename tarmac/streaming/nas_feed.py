"""Delay-program snapshots as a file stream.

The table sink merges files by the batch rule whenever they come; the table is
its state.  The stateful form keeps the latest snapshot per key in the stream's
own state, bounded by a watermark on the date; what comes for a date behind it
is dropped there, and ``repair_late`` takes those rows from the same files into
the table, with their counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tarmac.operators.nas import deduplicate_programs, has_program_key, normalise_airport, parse_times
from tarmac.schemas import NAS_SNAPSHOT, columns
from tarmac.sources.tables import merge_dates, write_batch
from tarmac.sources.versions import VersionedTable

WATERMARK = "1 day"
KEYS = ["FETCH_DATE", "IATA_CODE", "DELAY_TYPE"]


def snapshot_stream(spark: SparkSession, folder: str, files_per_trigger: int | None = None) -> DataFrame:
    """Snapshots under ``<folder>/<date>/`` as they land."""
    reader = spark.readStream.schema(NAS_SNAPSHOT)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(f"{folder}/*")


def clean_lines(lines: DataFrame) -> DataFrame:
    """Parsed lines; a typed row without date or airport is dropped, an untyped
    one stays, as in the batch rule."""
    rows = normalise_airport(parse_times(lines))
    return rows.where(has_program_key() | F.col("DELAY_TYPE").isNull())


def deduplicated(rows: DataFrame, delay: str = WATERMARK) -> DataFrame:
    """The latest snapshot per date, airport and type; NULL keys are equal to each other.

    Ties go to the smallest row, as in the batch rule.  A trigger emits the keys
    it has changed (update mode).  State holds one row per key of the dates that
    the watermark has not passed; rows without a date are one key per airport.
    """
    rest = [name for name in rows.columns if name not in KEYS]
    # negated, so that the smallest struct is the latest snapshot; no clock comes last
    age = F.coalesce(-F.unix_micros(F.col("SNAPSHOT_TS").cast("timestamp")), F.lit((1 << 63) - 1))
    timed = rows.withColumn("DAY", F.col("FETCH_DATE").cast("timestamp")).withWatermark("DAY", delay)
    latest = timed.groupBy("DAY", *KEYS).agg(F.min(F.struct(age.alias("AGE"), *rest)).alias("row"))
    return latest.select(*[F.col(name) if name in KEYS else F.col(f"row.{name}") for name in rows.columns])


def daily_counts(rows: DataFrame) -> DataFrame:
    """Rows with a delay per day of the snapshot clock."""
    by_day = rows.where("HAS_DELAY").groupBy(F.window("SNAPSHOT_TS", "1 day"))
    return by_day.agg(F.count(F.lit(1)).alias("PROGRAMS")).select(
        F.col("window.start").cast("date").alias("DAY"), "PROGRAMS"
    )


def append_to(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return (
        rows.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def replace_dates_in(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Every micro-batch is merged into the stored rows of its dates by the batch rule.

    The latest snapshot of a key wins over all files seen so far, however they
    fall into triggers, so stream and batch agree; rows without a date are kept
    as the batch keeps them.  A retried batch changes nothing.  The table is
    the state: only the dates of a batch are read.
    """
    return (
        rows.writeStream.foreachBatch(lambda batch, _: merge_dates(batch, path, deduplicate_programs))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def latest_into(latest: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """What ``deduplicated`` emits, merged into the stored rows of its dates."""
    return (
        latest.writeStream.outputMode("update")
        .foreachBatch(lambda batch, _: merge_dates(batch, path, deduplicate_programs))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def repair_late(rows: DataFrame, path: str, counts_path: str, checkpoint: str, days: int = 1) -> StreamingQuery:
    """Take rows behind the watermark into the table and count them by batch and date.

    Runs beside ``deduplicated`` on the same files and triggers.  The watermark
    is Spark's: the latest date of all earlier batches less ``days``; rows of
    that date or an older one are late.  It is kept with the pointer of the
    counts, so a restart goes on from it, and a repeated batch merges and counts
    the same rows again in the same place.
    """

    def divert(batch: DataFrame, number: int) -> None:
        counts = VersionedTable(batch.sparkSession, counts_path)
        last = counts.pointer().notes.get("latest", {"batch": -1, "before": None, "after": None})
        before = last["before"] if last["batch"] == number else last["after"]
        own = batch.agg(F.max("FETCH_DATE").cast("string")).first()[0]
        after = max(filter(None, (before, own)), default=None)
        border = F.lit(before).cast("date") - F.expr(f"INTERVAL {days} DAYS")
        late = batch.where(F.col("FETCH_DATE") <= border)
        if not late.isEmpty():
            merge_dates(late, path, deduplicate_programs)
        notes = {"latest": {"batch": number, "before": before, "after": after}}
        counts.replace(_late_counts(late, number), ["BATCH"], notes=notes)

    return (
        rows.writeStream.foreachBatch(divert).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def _late_counts(late: DataFrame, number: int) -> DataFrame:
    counted = late.groupBy("FETCH_DATE").agg(F.count(F.lit(1)).alias("LATE_ROWS"))
    return counted.select("FETCH_DATE", "LATE_ROWS", F.lit(number).cast("long").alias("BATCH"))


def late_counts(spark: SparkSession, counts_path: str) -> DataFrame:
    """Rows diverted by ``repair_late``, by batch and date."""
    return VersionedTable(spark, counts_path).read(columns("FETCH_DATE date, LATE_ROWS bigint, BATCH bigint"))


def write_complete(counts: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Rewrite the whole result per trigger: one row per day."""
    return (
        counts.writeStream.outputMode("complete")
        .foreachBatch(lambda batch, _: write_batch(batch, path))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
