"""Monthly archives → raw layer → staging layer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tarmac.operators.flight_cleaning import (
    clean_flights,
    deduplicate_flights,
    stamp_load,
    staging_flights,
    tag_source,
)
from tarmac.operators.weather import with_weather
from tarmac.schemas import RAW_FLIGHTS, STAGING_FLIGHTS
from tarmac.session import remove_path, work_path
from tarmac.sources.archives import archive_errors, list_archives, unpack, unpacked_rows
from tarmac.sources.tables import add_missing_columns, write_batch, write_partitions
from tarmac.sources.versions import VersionedTable


def load_archives(
    spark: SparkSession, folder: str, raw_path: str, errors_path: str, year: int | None = None, month: int | None = None
) -> DataFrame:
    """Unpack all archives once and clean their rows into the raw layer.

    An archive that cannot be read to its end leaves its stored month as it is;
    a table of them is written to ``errors_path`` and returned.  An archive
    holds one month, so each task writes few partitions and nothing is shuffled.
    The unpacked rows go when the raw layer has them.
    """
    staging = work_path(spark, "unpacked")
    manifest = unpack(list_archives(spark, folder, year, month), staging)
    rows = tag_source(clean_flights(unpacked_rows(manifest).drop("ARCHIVE")))
    whole = add_missing_columns(rows, RAW_FLIGHTS).select(RAW_FLIGHTS.names)
    write_partitions(whole, raw_path, ["YEAR", "MONTH"], rebalance=False)
    errors = archive_errors(manifest)
    write_batch(errors, errors_path)
    remove_path(spark, staging)
    return spark.read.schema(errors.schema).parquet(errors_path)


def build_staging(raw: DataFrame, staging_path: str, weather: DataFrame | None = None, dedup: bool = False) -> None:
    """Raw layer → staging layer, with weather where it is given.

    The raw layer is stored by month, so the plain projection is written as it
    is read; after a join or a deduplication the months are gathered again.
    """
    rows = staging_flights(raw)
    if dedup:
        rows = deduplicate_flights(rows)
    if weather is not None:
        rows = with_weather(rows, weather)
    stamped = stamp_load(rows)
    ordered = [*STAGING_FLIGHTS.names, *[name for name in stamped.columns if name not in STAGING_FLIGHTS.names]]
    moved = dedup or weather is not None
    VersionedTable(raw.sparkSession, staging_path).replace(stamped.select(ordered), ["YEAR", "MONTH"], rebalance=moved)
