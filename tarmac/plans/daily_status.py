"""Daily snapshot → raw layer, replacing the day, then the digest."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.operators.anomalies import digest, digest_order
from tarmac.operators.nas import clean_nas
from tarmac.schemas import NAS_STATUS
from tarmac.sources.landed import read_nas_snapshots
from tarmac.sources.tables import read_dated, write_replacing_date, write_report


def load_day(spark: SparkSession, folder: str, table_path: str, date: dt.date) -> DataFrame:
    """Replace one date of the status table; returns the table."""
    rows = clean_nas(read_nas_snapshots(spark, folder, date.isoformat()))
    write_replacing_date(rows.withColumn("_LOAD_TS", F.current_timestamp()), table_path, date)
    return read_dated(spark, table_path, NAS_STATUS)


def write_digest(status: DataFrame, path: str, date: dt.date | None = None) -> None:
    rows = status if date is None else status.where(F.col("FETCH_DATE") == F.lit(date))
    write_report(digest(rows), path, digest_order())
