"""Tables of the pipeline and the folder intermediate results are written to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.session import work_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(frame: DataFrame, name: str) -> DataFrame:
    """The rows of ``frame``, written to the shared folder and read again.

    Cuts lineage: a lost executor costs the tasks of one step, not the plan
    behind it.
    """
    spark = frame.sparkSession
    path = work_path(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def trained_on(doc_id: Column) -> Column:
    """Whether labels of a document may be learned: four fifths of the ids, by CRC-32 of the id as text."""
    return F.coalesce(~held_out(doc_id), F.lit(False))


def held_out(doc_id: Column) -> Column:
    """The other fifth.  A document without an id counts as held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def rows_of(frame: DataFrame, ids: DataFrame, key: str, how: str = "left_semi", broadcast_rows: int = 2_000_000) -> DataFrame:
    """``frame`` joined to ``ids`` on ``key``.

    The ids are counted and broadcast up to ``broadcast_rows``, a few bytes
    each; more of them are joined by shuffle.
    """
    small = ids.count() <= broadcast_rows
    return frame.join(F.broadcast(ids) if small else ids, key, how)


def lookup_join(frame: DataFrame, lookup: DataFrame, key: str, most_bytes: int = 32 << 20) -> DataFrame:
    """``frame`` left-joined to a written ``lookup`` on ``key``.

    The lookup is measured as text and broadcast up to ``most_bytes``, so that
    the rows of ``frame`` stay where they are; a larger one is joined by shuffle.
    """
    size = lookup.agg(F.coalesce(F.sum(F.octet_length(F.to_json(F.struct("*")))), F.lit(0))).first()[0]
    return frame.join(F.broadcast(lookup) if size <= most_bytes else lookup, key, "left")
