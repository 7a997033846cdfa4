"""Plain landed files: CSV, newline-delimited JSON, nested JSON documents."""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tarmac.schemas import NAS_SNAPSHOT, SOURCE_CSV, WEATHER_DOCUMENT


#: Bytes of a file that are read at a time until its first line ends.
HEAD_BYTES = 1 << 16


def file_heads(spark: SparkSession, path: str) -> DataFrame:
    """FILE, HEADER (its first line) and BYTES_READ of every file: a few blocks of each, whatever its size."""

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            files = batch.column("FILE").to_pylist()
            heads = [first_line(file) for file in files]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("FILE"),
                    pa.array([line for line, _ in heads], pa.string()),
                    pa.array([size for _, size in heads], pa.int64()),
                ],
                names=["FILE", "HEADER", "BYTES_READ"],
            )

    # the listing alone: the content column is not asked for
    listed = spark.read.format("binaryFile").load(path).select(F.col("path").alias("FILE"))
    return listed.mapInArrow(probe, "FILE string, HEADER string, BYTES_READ long")


def first_line(file: str) -> tuple[str, int]:
    """The first line of a file, without its end or a byte order mark, and the bytes of text read for it.

    A compressed file is known by its name, as Spark knows it.
    """
    uri = re.sub(r"^([a-zA-Z][\w+.\-]*):/(?!/)", r"\1:///", file)
    system, place = fs.FileSystem.from_uri(uri)
    held = b""
    with system.open_input_stream(place) as stream:
        while not any(end in held for end in (b"\n", b"\r")):
            block = stream.read(HEAD_BYTES)
            if not block:
                break
            held += block
    line = re.split(rb"[\r\n]", held, maxsplit=1)[0]
    return line.decode("utf-8-sig", "replace"), len(held)


def read_source_csv(spark: SparkSession, path: str, schema: StructType = SOURCE_CSV) -> DataFrame:
    """On-time CSV by header name; every column is text.

    Files may have more columns than ``schema``, fewer, or another order.  The
    head of each file is read first, and files of one header are read together.
    A column no file of a header has is NULL.  Compressed files (``.csv.gz``)
    are read as they are; each is one task's, so they should be of moderate size.
    """
    spaces = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    of_header: dict[str, list[str]] = {}
    for row in file_heads(spark, path).where("HEADER <> ''").orderBy("FILE").collect():  # a row per file, as Spark lists them
        of_header.setdefault(row["HEADER"], []).append(row["FILE"])
    parts = []
    for header, names in sorted(of_header.items()):
        given = next(csv.reader([header.removeprefix("\ufeff")]))
        unique = [name if name and name not in given[:at] else f"_unnamed_{at}" for at, name in enumerate(given)]
        text = StructType([StructField(name, StringType()) for name in unique])
        rows = spark.read.schema(text).options(header=True, enforceSchema=True, **spaces).csv(names)
        parts.append(
            rows.select(
                *[
                    F.col(f"`{f.name}`") if f.name in unique else F.lit(None).cast("string").alias(f.name)
                    for f in schema.fields
                ]
            )
        )
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schema)


def read_nas_snapshots(spark: SparkSession, folder: str, date: str | None = None) -> DataFrame:
    """Snapshots under ``<folder>/<date>/``; a date reads that one directory only."""
    return spark.read.schema(NAS_SNAPSHOT).json(f"{folder}/{date or '*'}/*.json")


def read_weather_documents(spark: SparkSession, folder: str, files: str = "*.json") -> DataFrame:
    """Hourly weather documents under ``<folder>/<airport>/<year>.json``."""
    return spark.read.schema(WEATHER_DOCUMENT).option("multiLine", True).json(f"{folder}/*/{files}")
