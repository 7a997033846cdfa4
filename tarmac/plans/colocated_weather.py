"""Flights and observations stored by the same buckets, so that joining weather moves no flight.

Both tables are bucketed by flight date and slice.  An observation is stored
under every flight date that may ask for it, its own and, for overnight
arrivals, the day before, so origin and destination look into one bucket.  A
slice is a share of the flights of a date: with more slices a hot date is many
buckets, and the few observations of a date are repeated for each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.functions.clock import arrival_date, clock_hour
from tarmac.operators.weather import DEST_FIELDS, ORIGIN_FIELDS, filled_from, first_observations
from tarmac.sources.tables import add_missing_columns

BUCKET_KEYS = ["FLIGHT_DATE", "SLICE"]
ROWS_PER_BUCKET = 300_000


def buckets_for(flights: DataFrame, least: int = 1) -> int:
    """Buckets of about ``ROWS_PER_BUCKET`` flights: a task sorts one bucket, so its memory does not grow with the table."""
    return max(least, -(-flights.count() // ROWS_PER_BUCKET))


def store_flights(flights: DataFrame, table: str, path: str, buckets: int, slices: int = 1) -> None:
    """Write the flights once by bucket; the one time that they are shuffled."""
    rows = add_missing_columns(flights)
    sliced = rows.withColumn("SLICE", F.pmod(F.xxhash64(*rows.columns), F.lit(slices)).cast("int"))
    _store(sliced, table, path, buckets)


def store_observations(weather: DataFrame, table: str, path: str, buckets: int, slices: int = 1) -> None:
    """Write the first observation of every hour under the flight dates and slices that may ask for it."""
    fields = [*ORIGIN_FIELDS, *[name for name in DEST_FIELDS if name not in ORIGIN_FIELDS]]
    asked = F.array(
        F.struct(F.col("_date").alias("FLIGHT_DATE"), F.lit(False).alias("NEXT_DAY")),
        F.struct(F.date_sub("_date", 1).alias("FLIGHT_DATE"), F.lit(True).alias("NEXT_DAY")),
    )
    first = first_observations(weather, fields).where("_date IS NOT NULL").select("*", F.inline(asked))
    rows = first.drop("_date").withColumn("SLICE", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    _store(rows, table, path, buckets)


def _store(rows: DataFrame, table: str, path: str, buckets: int) -> None:
    gathered = rows.repartition(buckets, *BUCKET_KEYS)
    gathered.write.mode("overwrite").bucketBy(buckets, *BUCKET_KEYS).option("path", path).saveAsTable(table)


def joined_weather(spark: SparkSession, flights_table: str, observations_table: str) -> DataFrame:
    """The stored flights with weather at both ends, as ``with_weather`` gives it.

    Runs in a session of its own that takes tables gathered by some of the join
    keys as gathered; there the flights are not shuffled.  A bucket is sorted
    where it lies, which spills where it has to.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    flights, observed = session.table(flights_table), session.table(observations_table)
    overnight = arrival_date("FLIGHT_DATE", "SCHEDULED_DEP", "SCHEDULED_ARR") != F.col("FLIGHT_DATE")

    def at(side: str, fields: list[str], airport: str, hour, next_day) -> DataFrame:
        obs = observed.select(
            F.col("FLIGHT_DATE").alias("_date"), F.col("SLICE").alias("_slice"), F.col("NEXT_DAY").alias("_next"),
            "_airport", "_hour", *[f"_{name}" for name in fields],
        )
        same = (F.col("FLIGHT_DATE") == F.col("_date")) & (F.col("SLICE") == F.col("_slice"))
        keys = same & (F.col(airport) == F.col("_airport")) & (hour == F.col("_hour")) & (next_day == F.col("_next"))
        return filled_from(flights, obs, keys, side, fields)

    flights = at("ORIGIN", ORIGIN_FIELDS, "ORIGIN", clock_hour("SCHEDULED_DEP"), F.lit(False))
    arrival = clock_hour(F.coalesce("SCHEDULED_ARR", F.lit(0)))
    flights = at("DEST", DEST_FIELDS, "DEST", arrival, F.coalesce(overnight, F.lit(False)))
    return flights.drop("SLICE")
