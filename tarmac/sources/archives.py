"""Monthly on-time archives: ZIP files that hold one CSV each."""

from __future__ import annotations

import csv
import io
import uuid
import zipfile
import zlib
from collections.abc import Iterator, Sequence
from itertools import batched, chain

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import csv as pa_csv
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tarmac.schemas import SOURCE_CSV

ROWS_PER_CHUNK = 50_000
BLOCK_CHARACTERS = 16 << 20
ARCHIVE_ROWS = StructType([StructField("ARCHIVE", StringType()), *SOURCE_CSV.fields])
UNPACKED = "ARCHIVE string, PLACE string, ROWS long, ERROR string"
_FILE_SCHEMA = pa.schema([(name, pa.string()) for name in ARCHIVE_ROWS.names])


def list_archives(spark: SparkSession, folder: str, year: int | None = None, month: int | None = None) -> DataFrame:
    """One row per archive with its content, narrowed by the name's year and month.

    The glob keeps other archives out of the listing, so they are not read; the
    filters after it decide exactly.
    """
    name = F.col("_metadata.file_name")
    wanted = f"ontime_*{'' if year is None else f'{year}_*'}{'' if month is None else f'{month:02d}'}.zip"
    archives = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", wanted)
        .load(folder)
        .select(name.alias("ARCHIVE"), "path", "length", "content")
    )
    if year is not None:
        archives = archives.where(F.contains("ARCHIVE", F.lit(f"_{year}_")))
    if month is not None:
        archives = archives.where(F.endswith("ARCHIVE", F.lit(f"_{month:02d}.zip")))
    return archives


def unpack(archives: DataFrame, staging: str) -> DataFrame:
    """Unpack every archive once into a Parquet file under ``staging``: ARCHIVE, PLACE, ROWS, ERROR.

    Members are unpacked on the executors and written in chunks, so a task holds
    one compressed archive and one chunk, not a whole member.  A line with too
    many fields loses the surplus, one with too few is filled with NULL, as
    Spark's permissive reader does.  PLACE is the file of an archive that could
    be read to its end, checksum included; another has ERROR and leaves no file,
    one without a CSV neither.  An attempt writes a file of its own name, and
    only attempts that Spark commits are listed, so a lost executor leaves
    nothing behind that is read.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [unpack_one(name, content, staging) for name, content in zip(batch["ARCHIVE"], batch["content"])]
            yield pd.DataFrame(found, columns=["ARCHIVE", "PLACE", "ROWS", "ERROR"], dtype=object)

    listed = archives.select("ARCHIVE", "content").mapInPandas(run, UNPACKED)
    manifest = f"{staging}/manifest"
    listed.write.parquet(manifest)
    return archives.sparkSession.read.schema(UNPACKED).parquet(manifest)


def unpack_one(name: str, content: bytes, staging: str) -> tuple[str, str | None, int, str | None]:
    """One archive in one pass: its rows go to a file, which goes again when the archive turns out broken."""
    place = f"{staging}/rows/{name}-{uuid.uuid4().hex[:8]}.parquet"
    system, path = fs.FileSystem.from_uri(place)
    writer, rows, problem = None, 0, None
    try:
        for chunk in _member_chunks(content):
            if writer is None:
                system.create_dir(path.rsplit("/", 1)[0], recursive=True)
                writer = pq.ParquetWriter(path, _FILE_SCHEMA, filesystem=system, compression="zstd")
            named = pa.repeat(name, chunk.num_rows)
            writer.write_table(pa.Table.from_arrays([named, *chunk.columns], schema=_FILE_SCHEMA))
            rows += chunk.num_rows
    except (zipfile.BadZipFile, zlib.error, EOFError, OSError, NotImplementedError, RuntimeError) as found:
        problem = f"{type(found).__name__}: {found}"
    finally:
        if writer is not None:
            writer.close()
    if problem and writer is not None:
        system.delete_file(path)
    return name, place if writer is not None and not problem else None, 0 if problem else rows, problem


def unpacked_rows(manifest: DataFrame) -> DataFrame:
    """The rows of all archives that could be read: ARCHIVE and the source columns, as text."""
    spark = manifest.sparkSession
    places = [row[0] for row in manifest.where("PLACE IS NOT NULL").select("PLACE").collect()]  # one per archive
    return spark.read.schema(ARCHIVE_ROWS).parquet(*places) if places else spark.createDataFrame([], ARCHIVE_ROWS)


def archive_errors(manifest: DataFrame) -> DataFrame:
    """One row per archive that cannot be read."""
    return manifest.where("ERROR IS NOT NULL").select("ARCHIVE", "ERROR")


def _csv_member(archive: zipfile.ZipFile) -> str | None:
    return next((entry for entry in archive.namelist() if entry.endswith(".csv")), None)


def _member_chunks(content: bytes) -> Iterator[pa.Table]:
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        member = _csv_member(archive)
        if member is None:
            return
        with archive.open(member) as stream:
            text = io.TextIOWrapper(stream, "utf-8-sig", errors="replace", newline="")
            csv.field_size_limit(1 << 30)
            header = next(csv.reader(_first_lines(text)), [])
            at = {name: place for place, name in reversed(list(enumerate(header)))}
            places = [at.get(name) for name in SOURCE_CSV.names]
            # whole lines a block at a time; those without quotes are cut by Arrow, the others by the csv module
            for plain, quoted in _blocks(text):
                if plain:
                    yield from _plain_lines(plain, len(header), places)
                for rows in batched((line for line in csv.reader(quoted) if line), ROWS_PER_CHUNK):
                    yield _table(rows, places)


def _first_lines(text: io.TextIOWrapper) -> Iterator[str]:
    """Lines from where the text stands, read as they are asked for."""
    while line := text.readline():
        yield line


def _blocks(text: io.TextIOWrapper) -> Iterator[tuple[str, Iterator[str]]]:
    """Blocks of whole lines: a text free of quotes, and after it the lines from the first quote on to the end."""
    rest = ""
    while read := text.read(BLOCK_CHARACTERS):
        rest += read
        if '"' in read:
            start = max(rest.rfind("\n", 0, rest.index('"')), rest.rfind("\r", 0, rest.index('"'))) + 1
            yield rest[:start], chain(io.StringIO(rest[start:] + text.readline(), newline=""), _first_lines(text))
            return
        # a line feed may follow a carriage return at the edge
        end = max(rest.rfind("\n"), rest.rfind("\r", 0, len(rest) - 1)) + 1
        if end:
            yield rest[:end], iter(())
            rest = rest[end:]
    yield rest, iter(())


def _plain_lines(text: str, width: int, places: list[int | None]) -> Iterator[pa.Table]:
    """Lines without quotes as Arrow reads them; those of another width than the header are cut one by one."""
    others: list[list[str]] = []

    def other(row: pa_csv.InvalidRow) -> str:
        others.append(row.text.split(","))
        return "skip"

    if width > 1:
        found = pa_csv.read_csv(
            pa.BufferReader(text.encode("utf-8", "surrogatepass")),
            pa_csv.ReadOptions(column_names=[str(at) for at in range(width)], block_size=4 * len(text) + 1024, use_threads=False),
            pa_csv.ParseOptions(quote_char=False, invalid_row_handler=other),
            pa_csv.ConvertOptions(
                column_types={str(at): pa.string() for at in range(width)},
                include_columns=[str(at) for at in sorted({place for place in places if place is not None})],
                null_values=[""],
                strings_can_be_null=True,
            ),
        )
        columns = [pa.nulls(len(found), pa.string()) if at is None else found.column(str(at)) for at in places]
        yield pa.Table.from_arrays(columns, names=SOURCE_CSV.names)
    else:
        others = [line for line in csv.reader(io.StringIO(text, newline="")) if line]
    yield _table(others, places)


def _table(lines: Sequence[list[str]], places: list[int | None]) -> pa.Table:
    """Fields of single lines by place; an empty or absent one is NULL."""
    return pa.table(
        {
            name: pa.array(
                [(line[place] or None) if place is not None and place < len(line) else None for line in lines], pa.string()
            )
            for name, place in zip(SOURCE_CSV.names, places)
        }
    )
