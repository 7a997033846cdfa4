"""Month sequences and the months a table lacks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def month_sequence(bounds: DataFrame, start: str = "START", end: str = "END") -> DataFrame:
    """One row per month from START to END, both included; text is ``YYYY-MM``."""

    def first_day(name: str):
        return F.to_date(F.concat(F.col(name), F.lit("-01")))

    months = F.sequence(first_day(start), first_day(end), F.expr("INTERVAL 1 MONTH"))
    return bounds.select(F.explode(months).alias("m")).select(
        F.year("m").alias("YEAR"), F.month("m").alias("MONTH")
    )


def missing_months(requested: DataFrame, rows: DataFrame) -> DataFrame:
    """Requested months for which ``rows`` has nothing."""
    present = rows.select("YEAR", "MONTH").distinct()
    return requested.join(present, ["YEAR", "MONTH"], "left_anti")


def month_coverage(requested: DataFrame, rows: DataFrame) -> DataFrame:
    """Requested, present and missing month counts."""
    present = rows.select("YEAR", "MONTH").distinct().withColumn("PRESENT", F.lit(True))
    return requested.join(present, ["YEAR", "MONTH"], "left").agg(
        F.count(F.lit(1)).alias("MONTHS_REQUESTED"),
        F.count("PRESENT").alias("MONTHS_PRESENT"),
        F.count_if(F.col("PRESENT").isNull()).alias("MONTHS_MISSING"),
    )
