"""Layer tables on Parquet: load by name, replace, refresh, guards."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from tarmac.schemas import FLIGHT_WEATHER, LAYER_TABLES
from tarmac.session import settings
from tarmac.sources.versions import VersionedTable, partition_of, read_versioned

STAMP = "_UPDATED_TS"
#: Files a task keeps open at once before it sorts what is left by partition; all of them hold no more than its rows.
OPEN_FILES = 32


# -- loading ---------------------------------------------------------------


def load_by_name(rows: DataFrame, schema: StructType) -> DataFrame:
    """Columns matched by name, ignoring case, and cast to the table's types.

    Names the source lacks are NULL, and so is blank text where the target is no
    text, as in the CSV reader.  ``IS_BAD`` marks rows in which any other value
    does not fit its type; the caller keeps the others.
    """
    given = {name.lower(): name for name in rows.columns}
    casts, misfits = [], F.lit(False)
    for target in schema.fields:
        source = given.get(target.name.lower())
        if source is None:
            casts.append(F.lit(None).cast(target.dataType).alias(target.name))
            continue
        given_value = F.col(f"`{source}`")
        if isinstance(rows.schema[source].dataType, StringType) and not isinstance(target.dataType, StringType):
            given_value = F.nullif(F.trim(given_value), F.lit(""))
        value = given_value.try_cast(target.dataType)
        casts.append(value.alias(target.name))
        misfits = misfits | (given_value.isNotNull() & value.isNull())
    return rows.select(*casts, misfits.alias("IS_BAD"))


def loaded_rows(loaded: DataFrame) -> DataFrame:
    return loaded.where(~F.col("IS_BAD")).drop("IS_BAD")


def load_report(loaded: DataFrame, file_name: str | Column | None = None) -> DataFrame:
    """Files seen, rows loaded and rows rejected."""
    measures = [
        F.count_if(~F.col("IS_BAD")).alias("ROWS_LOADED"),
        F.count_if("IS_BAD").alias("ERRORS_SEEN"),
    ]
    if file_name is not None:
        measures.insert(0, F.count_distinct(file_name).alias("FILES"))
    return loaded.agg(*measures)


# -- replacing rows --------------------------------------------------------


def replace_date(table: DataFrame, incoming: DataFrame, date: dt.date, column: str = "FETCH_DATE") -> DataFrame:
    """``table`` without rows of ``date`` or of no date, plus ``incoming``."""
    return table.where(F.col(column) != F.lit(date)).unionByName(incoming, allowMissingColumns=True)


def replace_month(mart: DataFrame, fresh: DataFrame, date: dt.date) -> DataFrame:
    """``mart`` with the month of ``date`` taken from ``fresh``."""
    in_month = (F.col("YEAR") == date.year) & (F.col("MONTH") == date.month)
    return mart.where(~in_month).unionByName(fresh.where(in_month))


# -- writing ---------------------------------------------------------------


def write_batch(rows: DataFrame, path: str) -> None:
    """One directory per source batch, replaced as a whole."""
    rows.write.mode("overwrite").parquet(path)


def write_counted(rows: DataFrame, path: str, files: int | None = None) -> int:
    """Write and return the row count from the same pass."""
    seen = Observation()
    counted = rows.observe(seen, F.count(F.lit(1)).alias("rows"))
    if files:
        counted = counted.repartition(files)
    counted.write.mode("overwrite").parquet(path)
    return seen.get["rows"]


def write_dated(rows: DataFrame, path: str, column: str = "FETCH_DATE") -> None:
    """Directory per date with the date column kept in the file body.

    The directory key is a copy of the column, so readers that match columns
    inside a file still find it.
    """
    write_partitions(rows.withColumn("DATE_KEY", F.col(column)), path, ["DATE_KEY"], whole=True)


def write_partitions(
    rows: DataFrame, path: str, by: list[str], whole: bool = False, rebalance: bool = True
) -> None:
    """Replace the partitions that occur in ``rows``, or with ``whole`` all of them.

    The rebalance hint lets AQE merge small partitions and split a hot one over
    several files, so one month or day may hold most of the rows.  It costs a
    shuffle; rows whose tasks already hold few partitions can go without, and
    are not sorted either.
    """
    open_files = {} if rebalance else {"spark.sql.maxConcurrentOutputFileWriters": str(OPEN_FILES)}
    with settings(rows.sparkSession, open_files):
        (
            (rows.hint("rebalance", *by) if rebalance else rows)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "static" if whole else "dynamic")
            .partitionBy(*by)
            .parquet(path)
        )


def write_replacing_date(rows: DataFrame, path: str, date: dt.date, column: str = "FETCH_DATE") -> None:
    """On-disk form of ``replace_date``, on a versioned table and in one step.

    The date is replaced even where no row is left for it, and so are the rows
    without a date.  Rows of other dates join the stored ones of their dates,
    each row once, so a repeated load changes nothing.  Until the load is
    finished the table reads as before.
    """
    table = VersionedTable(rows.sparkSession, path)
    replaced = F.col(column).isNull() | (F.col(column) == F.lit(date))
    others = rows.where(~replaced)
    dates = [row[0] for row in others.select(column).distinct().collect()]  # calendar days
    stored = table.read(rows.schema, [partition_of(**{column: day}) for day in dates])
    loaded = rows.where(replaced).unionByName(others.unionByName(stored).distinct())
    table.replace(loaded, [column], removed=[partition_of(**{column: day}) for day in (date, None)])


def merge_dates(
    rows: DataFrame, path: str, winners: Callable[[DataFrame], DataFrame], column: str = "FETCH_DATE"
) -> None:
    """Add ``rows`` to the stored rows of their dates and keep the ``winners``; see ``VersionedTable.merge``."""
    VersionedTable(rows.sparkSession, path).merge(rows, column, winners)


def read_dated(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return read_versioned(spark, path, schema)


def refresh_mart(mart: DataFrame, path: str, by: list[str] | None = None, month: dt.date | None = None) -> None:
    """Replace a mart, or with ``month`` the one month that date lies in, in one step.

    A month is a folder, and is replaced even where the mart has no row for it.
    """
    stamped = mart.withColumn(STAMP, F.current_timestamp())
    table = VersionedTable(mart.sparkSession, path)
    if month is not None:
        in_month = (F.col("YEAR") == month.year) & (F.col("MONTH") == month.month)
        gone = [partition_of(YEAR=month.year, MONTH=month.month)]
        table.replace(stamped.where(in_month), ["YEAR", "MONTH"], removed=gone)
    else:
        table.replace(stamped, by or [], whole=True)


def read_mart(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """The mart as its last finished refresh left it."""
    return read_versioned(spark, path, schema)


def write_report(lines: DataFrame, path: str, order: list[Column], column: str = "FETCH_DATE") -> None:
    """Text lines in a directory per date, ordered within and across its files."""
    ordered = lines.repartitionByRange(F.col(column), *order).sortWithinPartitions(F.col(column), *order)
    ordered.select(column, "LINE").write.mode("overwrite").partitionBy(column).text(path)


# -- tables and guards -----------------------------------------------------


def create_layer_tables(spark: SparkSession, names: list[str] | None = None) -> None:
    """Create the layer databases and tables that do not exist yet."""
    for name in names or list(LAYER_TABLES):
        schema, by = LAYER_TABLES[name]
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.split('.')[0]}")
        fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
        parts = f" PARTITIONED BY ({', '.join(by)})" if by else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({fields}) USING parquet{parts}")


def add_missing_columns(rows: DataFrame, schema: StructType = FLIGHT_WEATHER) -> DataFrame:
    """Typed NULL columns for the names ``rows`` lacks."""
    present = {name.lower() for name in rows.columns}
    absent = {f.name: F.lit(None).cast(f.dataType) for f in schema.fields if f.name.lower() not in present}
    return rows.withColumns(absent) if absent else rows


def has_column(rows: DataFrame, name: str) -> bool:
    return name.lower() in {column.lower() for column in rows.columns}


def has_values(rows: DataFrame, name: str) -> bool:
    """Whether the column exists and any row has a value in it."""
    return has_column(rows, name) and not rows.where(F.col(name).isNotNull()).isEmpty()


def is_ready(table: DataFrame) -> bool:
    return not table.isEmpty()
