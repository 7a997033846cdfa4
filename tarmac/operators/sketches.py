"""Distinct counts that roll up: a mergeable sketch stored beside the exact count."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Registers as a power of two; the error is about 1.04 / sqrt(2 ** LOG_REGISTERS).
LOG_REGISTERS = 12


def relative_error(deviations: float = 3.0, log_registers: int = LOG_REGISTERS) -> float:
    """Relative error that an estimate stays within, for so many standard deviations."""
    return deviations * 1.04 / math.sqrt(1 << log_registers)


def sketched_counts(rows: DataFrame, by: Sequence[str], value: str, log_registers: int = LOG_REGISTERS) -> DataFrame:
    """Per group the exact number of distinct values (``EXACT``) and a sketch of them (``SKETCH``).

    NULL is no value.  A sketch is some kilobytes, whatever it has seen.
    """
    return rows.groupBy(*by).agg(
        F.count_distinct(value).alias("EXACT"),
        F.hll_sketch_agg(F.col(value).cast("string"), F.lit(log_registers)).alias("SKETCH"),
    )


def rolled_up(sketched: DataFrame, by: Sequence[str]) -> DataFrame:
    """Distinct values (``ESTIMATE``) of coarser groups, from the stored sketches alone.

    Exact counts cannot be added up, as a value may be in several groups.
    """
    merged = sketched.groupBy(*by).agg(F.hll_union_agg("SKETCH").alias("SKETCH"))
    return merged.select(*by, F.hll_sketch_estimate("SKETCH").alias("ESTIMATE"))
