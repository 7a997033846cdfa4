"""Weather documents → raw hourly table, and weather → stored staging flights."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tarmac.operators.weather import clean_weather, fill_status, with_weather
from tarmac.schemas import FLIGHT_WEATHER, STAGING_FLIGHTS, WEATHER_HOURLY
from tarmac.sources.landed import read_weather_documents
from tarmac.sources.tables import load_by_name, loaded_rows, write_partitions
from tarmac.sources.versions import VersionedTable, partition_of


def load_weather(
    spark: SparkSession, folder: str, raw_path: str, year: int | None = None, files: str = "*.json"
) -> DataFrame:
    """Reload the hourly table as a whole; returns files seen, rows loaded and rows rejected.

    The rows are counted in the pass that writes them.
    """
    documents = read_weather_documents(spark, folder, files)
    seen = Observation()
    loaded = load_by_name(clean_weather(documents, year), WEATHER_HOURLY).observe(
        seen, F.count_if(~F.col("IS_BAD")).alias("loaded"), F.count_if("IS_BAD").alias("bad")
    )
    stamped = loaded_rows(loaded).withColumn("_LOAD_TS", F.current_timestamp())
    write_partitions(stamped, raw_path, ["YEAR", "MONTH"], whole=True)
    counted = documents.select("_metadata.file_path").distinct().agg(F.count(F.lit(1)).alias("FILES"))
    return counted.select(
        "FILES", F.lit(seen.get["loaded"]).alias("ROWS_LOADED"), F.lit(seen.get["bad"]).alias("ERRORS_SEEN")
    )


BROADCAST_OBSERVATIONS = 1_000_000  # 545,328 hours were 134 MB at each end


def fill_stored_weather(
    spark: SparkSession,
    staging_path: str,
    weather: DataFrame,
    since_year: int = 2025,
    broadcast_rows: int = BROADCAST_OBSERVATIONS,
) -> DataFrame:
    """Fill weather into the stored months that lack any; returns the fill status ``before`` and ``after``.

    Only months with an empty temperature are read and rewritten, as one step
    of the versioned staging table.  The observations are counted and broadcast
    up to ``broadcast_rows``: the flights, which are stored by month, are then
    rewritten by the tasks that read them.  More observations are joined by
    shuffle, which moves whole flights and gathers the months anew.
    """
    fields = {f.name: f for f in [*STAGING_FLIGHTS.fields, *FLIGHT_WEATHER.fields]}
    table, schema = VersionedTable(spark, staging_path), type(STAGING_FLIGHTS)(list(fields.values()))

    def status(when: str) -> DataFrame:
        return fill_status(table.read(schema), since_year).select(F.lit(when).alias("AT"), "*")

    before = status("before")  # reads the version of now, which stays in place
    empty = (F.col("YEAR") >= since_year) & (F.col("ORIGIN_TEMP_C").isNull() | F.col("DEST_TEMP_C").isNull())
    months = table.read(schema).where(empty).select("YEAR", "MONTH").distinct().collect()  # calendar months
    open_months = [partition_of(YEAR=year, MONTH=month) for year, month in months]
    if open_months:
        small = weather.count() <= broadcast_rows
        filled = with_weather(table.read(schema, open_months), weather, broadcast=small)
        table.replace(filled, ["YEAR", "MONTH"], rebalance=not small)
    return before.unionByName(status("after"))
