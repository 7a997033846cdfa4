"""Tables of versioned folders behind a pointer that is switched last.

``<path>/v=<version>/<partition>/…`` holds what one load wrote, and
``<path>/_pointer/<number>.json`` which version holds each partition.  A load
writes its own version and then one small pointer file; until that file is
there, readers see the table as it was, whatever the load had deleted, replaced
or half written.  Deleting and reloading is thereby one step.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def partition_of(**values: object) -> str:
    """The folder of a partition, its columns in order of storage."""
    return "/".join(f"{name}={NULL_PARTITION if value is None else value}" for name, value in values.items())


@dataclass
class Pointer:
    """State of a table: its partition columns, the version that holds each partition, and notes of its writers."""

    number: int = 0
    by: list[str] = field(default_factory=list)
    places: dict[str, str] = field(default_factory=dict)
    notes: dict = field(default_factory=dict)


class VersionedTable:
    """One table; a row per partition is all the driver holds of it."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._jvm = spark._jvm
        self._folder = self._place(f"{path}/_pointer")
        self._files = self._folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _place(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def pointer(self) -> Pointer:
        """The state after the last finished load."""
        if not self._files.exists(self._folder):
            return Pointer()
        names = [status.getPath().getName() for status in self._files.listStatus(self._folder)]
        last = max((name for name in names if name.endswith(".json")), default=None)
        if last is None:
            return Pointer()
        stream = self._files.open(self._place(f"{self.path}/_pointer/{last}"))
        try:
            text = self._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(stream)
        finally:
            stream.close()
        return Pointer(**json.loads(bytes(text).decode()))

    def read(self, schema: StructType | None = None, partitions: Iterable[str] | None = None) -> DataFrame:
        """The rows of the last finished load; with ``partitions`` only those folders are opened.

        Without a ``schema`` that of the files is taken, so there must be some.
        """
        pointer = self.pointer()
        wanted = pointer.places if partitions is None else set(partitions) & pointer.places.keys()
        folders = [f"{self.path}/v={pointer.places[name]}/{name}".rstrip("/") for name in sorted(wanted)]
        if schema is None:
            return self.spark.read.option("basePath", self.path).parquet(*folders).drop("v")
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", self.path).parquet(*folders).select(schema.names)

    def prepare(self, rows: DataFrame, by: Sequence[str] = (), rebalance: bool = True) -> tuple[str, list[str]]:
        """Write ``rows`` as a version that no reader sees yet; returns it and the partitions it holds."""
        version = f"load-{self.pointer().number + 1:08d}-{uuid.uuid4().hex[:8]}"
        place = f"{self.path}/v={version}"
        if not by:
            rows.write.parquet(place)
            return version, [""]
        (rows.hint("rebalance", *by) if rebalance else rows).write.partitionBy(*by).parquet(place)
        found = self._files.globStatus(self._place("/".join([place, *(f"{name}=*" for name in by)])))
        start = len(self._place(place).toUri().getPath()) + 1
        return version, [status.getPath().toUri().getPath()[start:] for status in found]

    def commit(
        self,
        version: str,
        written: Iterable[str],
        removed: Iterable[str] = (),
        whole: bool = False,
        by: Sequence[str] = (),
        notes: dict | None = None,
    ) -> Pointer:
        """Switch the table to ``version`` for the partitions ``written``; those ``removed`` and not written go.

        The pointer file is written aside and moved to its number, which no
        other load may have taken meanwhile.
        """
        before = self.pointer()
        if int(version.split("-")[1]) != before.number + 1:
            raise RuntimeError(f"another load of {self.path} finished first")
        gone = set(removed)
        places = {} if whole else {name: at for name, at in before.places.items() if name not in gone}
        places |= {name: version for name in written}
        after = Pointer(before.number + 1, list(by or before.by), places, {**before.notes, **(notes or {})})
        aside, target = (
            self._place(f"{self.path}/_pointer/{name}") for name in (f".{version}", f"{after.number:08d}.json")
        )
        self._files.mkdirs(self._folder)
        stream = self._files.create(aside, True)
        try:
            stream.write(bytearray(json.dumps(vars(after)).encode()))
        finally:
            stream.close()
        if self._files.exists(target) or not self._files.rename(aside, target):
            raise RuntimeError(f"another load of {self.path} finished first")
        return after

    def replace(
        self,
        rows: DataFrame,
        by: Sequence[str] = (),
        removed: Iterable[str] = (),
        whole: bool = False,
        notes: dict | None = None,
        rebalance: bool = True,
    ) -> Pointer:
        """Replace the partitions that occur in ``rows`` and those ``removed``, or with ``whole`` the table."""
        version, written = self.prepare(rows, by, rebalance)
        return self.commit(version, written, removed, whole or not by, by, notes)

    def merge(
        self,
        rows: DataFrame,
        column: str,
        winners: Callable[[DataFrame], DataFrame],
        notes: dict | None = None,
    ) -> Pointer:
        """Add ``rows`` to the stored rows of their dates and keep the ``winners``.

        The dates of ``rows`` name the folders to read, so the table's size does
        not matter; a date is one value of the driver's memory.  The rows, a
        micro-batch with its state as a rule, are worked out once.  Merging the
        same rows again changes nothing.
        """
        kept = rows.persist()
        try:
            dates = [row[0] for row in kept.select(column).distinct().collect()]
            stored = self.read(kept.schema, [partition_of(**{column: date}) for date in dates])
            return self.replace(winners(stored.unionByName(kept)), [column], notes=notes)
        finally:
            kept.unpersist()

    def forget_unused(self) -> list[str]:
        """Delete the versions no partition of the last load points at; returns them.

        For a time at which nothing else reads or loads the table.
        """
        used = set(self.pointer().places.values())
        names = [status.getPath().getName() for status in self._files.listStatus(self._place(self.path))]
        unused = [name for name in names if name.startswith("v=") and name.removeprefix("v=") not in used]
        for name in unused:
            self._files.delete(self._place(f"{self.path}/{name}"), True)
        return sorted(unused)


def read_versioned(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    return VersionedTable(spark, path).read(schema)

