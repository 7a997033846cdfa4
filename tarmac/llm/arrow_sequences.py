"""Token ids in Arrow files of equal-length sequences.

A shard is two Arrow files: ``.sequences.arrow`` holds the token stream of
consecutive documents, cut every ``length`` ids, as fixed-size lists of ids and
of mask bits; ``.documents.arrow`` says where each document starts.  All record
batches but the last have ``BATCH_SEQUENCES`` rows, so sequence ``k`` is row
``k % BATCH_SEQUENCES`` of batch ``k // BATCH_SEQUENCES`` and is read without
copying from a memory map.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.tables import staged
from tarmac.llm.word_tokens import encoder, slices
from tarmac.session import work_path

BATCH_SEQUENCES = 256


def _folder(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


class ShardWriter:
    """Writes one shard batch by batch; memory holds one record batch of ids."""

    def __init__(self, uri: str, length: int, id_type: np.dtype):
        system, self.path = _folder(uri)
        system.create_dir(self.path.rsplit("/", 1)[0], recursive=True)
        self.length, self.id_type = length, id_type
        self.schema = pa.schema(
            [
                ("ids", pa.list_(pa.from_numpy_dtype(id_type), length)),
                ("mask", pa.list_(pa.bool_(), length)),
            ]
        )
        self.sink = system.open_output_stream(f"{self.path}.sequences.arrow")
        self.writer = pa.ipc.new_file(self.sink, self.schema)
        self.index_sink = system.open_output_stream(f"{self.path}.documents.arrow")
        self.index_schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
        self.index = pa.ipc.new_file(self.index_sink, self.index_schema)
        self.held: list[np.ndarray] = []
        self.n_held = self.n_tokens = self.n_docs = 0

    def add(self, doc_ids: pa.Array, ids: np.ndarray, ends: np.ndarray) -> None:
        starts = np.append(0, ends[:-1])
        self.index.write_batch(
            pa.record_batch(
                [doc_ids, pa.array(self.n_tokens + starts), pa.array(ends - starts)],
                schema=self.index_schema,
            )
        )
        self.n_docs += len(doc_ids)
        self.n_tokens += len(ids)
        self.held.append(ids)
        self.n_held += len(ids)
        whole = BATCH_SEQUENCES * self.length
        if self.n_held >= whole:
            stream = np.concatenate(self.held)
            for at in range(0, len(stream) - whole + 1, whole):
                self._write(stream[at : at + whole])
            rest = stream[len(stream) // whole * whole :]
            self.held, self.n_held = [rest], len(rest)

    def _write(self, stream: np.ndarray) -> None:
        rows = -(-len(stream) // self.length)
        ids = np.zeros(rows * self.length, self.id_type)
        ids[: len(stream)] = stream
        mask = np.arange(rows * self.length) < len(stream)
        self.writer.write_batch(
            pa.record_batch(
                [
                    pa.FixedSizeListArray.from_arrays(pa.array(ids), self.length),
                    pa.FixedSizeListArray.from_arrays(pa.array(mask), self.length),
                ],
                schema=self.schema,
            )
        )

    def close(self) -> None:
        if self.n_held:
            self._write(np.concatenate(self.held))
        for closing in (self.writer, self.sink, self.index, self.index_sink):
            closing.close()


class Shard:
    """Random access to a written shard; ids and masks are views of the file where it is local."""

    def __init__(self, uri: str):
        system, path = _folder(uri)
        local = isinstance(system, fs.LocalFileSystem)
        opened = (lambda p: pa.memory_map(p)) if local else system.open_input_file
        self.sequences = pa.ipc.open_file(opened(f"{path}.sequences.arrow"))
        self.documents = pa.ipc.open_file(opened(f"{path}.documents.arrow"))
        self.length = self.sequences.schema.field("ids").type.list_size
        self._kept: tuple[int, pa.RecordBatch | None] = (-1, None)

    def _batch(self, k: int) -> pa.RecordBatch:
        if self._kept[0] != k:
            self._kept = (k, self.sequences.get_batch(k))
        return self._kept[1]

    def __len__(self) -> int:
        n = self.sequences.num_record_batches
        return 0 if n == 0 else (n - 1) * BATCH_SEQUENCES + self._batch(n - 1).num_rows

    def _values(self, k: int, column: str) -> pa.Array:
        rows = self._batch(k // BATCH_SEQUENCES).column(column)
        return rows.values.slice((rows.offset + k % BATCH_SEQUENCES) * self.length, self.length)

    def ids(self, k: int) -> np.ndarray:
        return self._values(k, "ids").to_numpy(zero_copy_only=True)

    def mask(self, k: int) -> pa.Array:
        """Which ids of sequence ``k`` are tokens; the rest is padding."""
        return self._values(k, "mask")

    def tokens(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` of the shard's token stream."""
        parts = []
        whole = BATCH_SEQUENCES * self.length
        while start < stop:
            k, at = divmod(start, whole)
            flat = self._batch(k).column("ids").values.to_numpy(zero_copy_only=True)
            part = flat[at : min(whole, at + stop - start)]
            parts.append(part)
            start += len(part)
        return np.concatenate(parts) if parts else np.empty(0, np.uint16)


def write_sequences(docs: DataFrame, vocabulary: str, end_id: int, length: int = 2048, folder: str | None = None) -> DataFrame:
    """Encode ``text`` of every document and write the shards in ascending ``doc_id`` order.

    Null and empty texts give the end id alone.  Documents without an id come
    first; rows with one id are ordered by text.  A row per shard is returned:
    ``shard`` (in order), ``uri``, ``n_docs``, ``n_tokens``.  Each attempt of a
    task writes files of its own name and only those of the attempt that Spark
    commits are listed, so a lost executor leaves no half-written shard behind.
    """
    spark = docs.sparkSession
    folder = folder or work_path(spark, "arrow-sequences")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        uri = f"{folder}/{shard:08d}-{uuid.uuid4().hex[:8]}"
        codec, writer = encoder(vocabulary), None
        for batch in batches:
            doc_ids, texts = batch.column("doc_id"), batch.column("text")
            for start, stop in slices(texts):
                ids, ends, _ = codec.encode(texts.slice(start, stop - start))
                with_end = np.insert(ids, ends, end_id).astype(codec.id_type)
                writer = writer or ShardWriter(uri, length, codec.id_type)
                writer.add(doc_ids.slice(start, stop - start), with_end, ends + np.arange(1, len(ends) + 1))
        if writer:
            writer.close()
            yield pa.RecordBatch.from_pydict(
                {"shard": [shard], "uri": [uri], "n_docs": [writer.n_docs], "n_tokens": [writer.n_tokens]}
            )

    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .repartitionByRange(F.col("doc_id"), F.xxhash64("text"))
        .sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    )
    written = ordered.mapInArrow(write, "shard long, uri string, n_docs long, n_tokens long")
    return staged(written, "arrow-manifest")


def read_documents(manifest: DataFrame) -> DataFrame:
    """One row per document, read from the files that ``manifest`` lists.

    ``start`` counts the ids of all documents before it.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(row["uri"])
                for k in range(shard.documents.num_record_batches):
                    index = shard.documents.get_batch(k)
                    starts, lengths = index.column("start").to_numpy(), index.column("n_tokens").to_numpy()
                    sums = [
                        zlib.crc32(shard.tokens(start, start + n).astype("<u4").tobytes())
                        for start, n in zip(starts.tolist(), lengths.tolist())
                    ]
                    yield pa.RecordBatch.from_arrays(
                        [
                            index.column("doc_id"),
                            pa.array(row["base"] + starts),
                            index.column("n_tokens"),
                            pa.array(sums, pa.int64()),
                        ],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    # one row per shard: the running sum is over a list of files, not over documents
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    based = manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    spread = based.repartition(max(1, manifest.count()))
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
