"""Vector codes: parts of vectors named by the nearest entry of a learned codebook.

The nearest entry is found on a trie.  A task's distinct parts are sorted, so
parts that begin alike stand together, and every node of the trie, a prefix of
dimensions, carries the distances of all entries summed over its dimensions.
A child adds its own dimension to its parent's sums, so what parts have in
common is computed once; at the leaves the smallest sum names the entry, and
the leaf's weight, the number of vectors with that part, goes into the sums the
next codebook is made of.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from tarmac.llm.tables import lookup_join, staged

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Leaves of the trie that are followed at once; a level holds as many sums for every entry at most.
_LEAVES = 512
#: Vectors whose parts one trie holds.
_ROWS = 32_768


@dataclass
class Codebooks:
    """One matrix (entries by dimensions) of whole numbers per part."""

    parts: list[np.ndarray]

    @property
    def length(self) -> int:
        return sum(part.shape[1] for part in self.parts)

    def digest(self) -> str:
        """SHA-256 of all components as decimals, by part, entry and place in the part."""
        return hashlib.sha256(",".join(str(x) for part in self.parts for x in part.ravel().tolist()).encode()).hexdigest()


def distinct_parts(parts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct rows in lexicographic order, which of them each row is, and how many rows each is."""
    if not parts.shape[1]:
        return parts[:1], np.zeros(len(parts), np.int64), np.array([len(parts)])
    order = np.lexsort(parts.T[::-1])
    ordered = parts[order]
    new = np.append(True, (ordered[1:] != ordered[:-1]).any(axis=1))
    which = np.empty(len(parts), np.int64)
    which[order] = np.cumsum(new) - 1
    return ordered[new], which, np.diff(np.append(np.flatnonzero(new), len(parts)))


def nearest(leaves: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry and squared distance of each of the sorted distinct ``leaves``; ties to the lower entry.

    The trie is walked depth first, a run of leaves at a time: the sums of a
    level are those of the parent nodes plus one dimension, and leaves that go
    on from the run before take over the sums of the prefix they share with it.
    """
    n, depth = leaves.shape
    code, distance = np.empty(n, np.int64), np.empty(n, np.int64)
    # first dimension in which a leaf leaves the one before it
    parting = np.append(0, np.argmax(leaves[1:] != leaves[:-1], axis=1)) if depth else np.zeros(n, np.int64)
    path = np.zeros((depth + 1, len(entries)), np.int64)  # sums along the last leaf of the run before
    for start in range(0, n, _LEAVES):
        run, opens = leaves[start : start + _LEAVES], parting[start : start + _LEAVES]
        sums, parent = path[:1], np.zeros(len(run), np.int64)
        for level in range(depth):
            node = opens <= level  # leaves that open a node at this level
            shared = not node[0]
            first = np.flatnonzero(node)
            new = sums[parent[first]] + (run[first, level, None] - entries[:, level]) ** 2
            sums = np.concatenate([path[level + 1 : level + 2], new]) if shared else new
            parent = np.cumsum(node) - (0 if shared else 1)
            path[level + 1] = sums[-1]
        best = np.argmin(sums, axis=1)
        code[start : start + len(run)] = best[parent]
        distance[start : start + len(run)] = sums[np.arange(len(sums)), best][parent]
    return code, distance


def whole_numbers(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id``, ``label`` and ``v``, the vector times ``scale``, rounded down, for vectors of finite components."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = finite & (F.size("embedding") > 0)
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale))
    return vectors.where(F.coalesce(usable, F.lit(False))).select(
        F.col("vec_id").cast("long").alias("vec_id"), "label", whole.alias("v")
    )


def first_codebooks(whole: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> Codebooks:
    """The parts of the vectors of the smallest ids, as many as there are entries."""
    by_id = [F.col("vec_id").asc_nulls_last(), F.col("v")]
    first = whole.orderBy(*by_id).select("v").first()
    if first is None:
        return Codebooks([np.empty((0, 0), np.int64)] * parts)
    length = len(first["v"])
    rows = whole.where(F.size("v") == length).orderBy(*by_id).limit(entries).select("v").collect()
    matrix = np.array([row["v"] for row in rows], np.int64)
    return Codebooks([part.copy() for part in np.array_split(matrix, parts, axis=1)])


def _matrices(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[tuple[list[pa.RecordBatch], np.ndarray]]:
    """Batches up to ``_ROWS`` rows and their vectors as one matrix."""
    held: list[pa.RecordBatch] = []

    def matrix() -> np.ndarray:
        flat = [batch.column("v").flatten().to_numpy(zero_copy_only=False) for batch in held]
        return np.concatenate(flat).astype(np.int64, copy=False).reshape(-1, length)

    for batch in batches:
        if held and sum(b.num_rows for b in held) + batch.num_rows > _ROWS:
            yield held, matrix()
            held = []
        held.append(batch)
    if held:
        yield held, matrix()


def improved(whole: DataFrame, books: Codebooks) -> Codebooks:
    """One round: every part goes to its nearest entry, and an entry to the mean of its parts, rounded down.

    A task hands on one row per entry that it used, so what is shuffled and
    collected is bounded by the codebooks, whatever the number of vectors.
    """

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [np.zeros_like(book) for book in books.parts]
        counts = [np.zeros(len(book), np.int64) for book in books.parts]
        for _, matrix in _matrices(batches, books.length):
            for book, total, count, part in zip(books.parts, totals, counts, _parts_of(matrix, books)):
                leaves, _, weight = distinct_parts(part)
                code, _ = nearest(leaves, book)
                np.add.at(total, code, leaves * weight[:, None])
                np.add.at(count, code, weight)
        for k, (total, count) in enumerate(zip(totals, counts)):
            used = np.flatnonzero(count)
            size = total.shape[1]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(used) * size, k), pa.int32()),
                    pa.array(np.repeat(used, size), pa.int32()),
                    pa.array(np.tile(np.arange(size), len(used)), pa.int32()),
                    pa.array(total[used].ravel(), pa.int64()),
                    pa.array(np.repeat(count[used], size), pa.int64()),
                ],
                names=["part", "entry", "place", "total", "n"],
            )

    sums = (
        whole.select("v")
        .mapInArrow(add_up, "part int, entry int, place int, total long, n long")
        .groupBy("part", "entry", "place")
        .agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    )
    parts = [book.copy() for book in books.parts]
    for row in sums.collect():
        parts[row["part"]][row["entry"], row["place"]] = row["total"] // row["n"]
    return Codebooks(parts)


def _parts_of(matrix: np.ndarray, books: Codebooks) -> list[np.ndarray]:
    return np.split(matrix, np.cumsum([book.shape[1] for book in books.parts])[:-1], axis=1)


def assigned(whole: DataFrame, books: Codebooks) -> DataFrame:
    """``vec_id``, ``label``, ``entries`` (one per part) and ``error``, the squared distances summed over the parts."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held, matrix in _matrices(batches, books.length):
            codes, error = [], np.zeros(len(matrix), np.int64)
            for book, part in zip(books.parts, _parts_of(matrix, books)):
                leaves, which, _ = distinct_parts(part)
                code, distance = nearest(leaves, book)
                codes.append(code[which])
                error += distance[which]
            entries = np.stack(codes, axis=1)
            done = 0
            for batch in held:
                rows = slice(done, done + batch.num_rows)
                done += batch.num_rows
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("vec_id"),
                        batch.column("label"),
                        pa.ListArray.from_arrays(
                            pa.array(np.arange(batch.num_rows + 1) * len(codes), pa.int32()),
                            pa.array(entries[rows].ravel(), pa.int32()),
                        ),
                        pa.array(error[rows]),
                    ],
                    names=["vec_id", "label", "entries", "error"],
                )

    schema = whole.select("vec_id", "label").schema.add("entries", ArrayType(IntegerType())).add("error", "long")
    return whole.select("vec_id", "label", "v").mapInArrow(assign, schema)


def learn(whole: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, Codebooks]:
    """The vectors that can be coded, and the codebooks after ``rounds`` rounds over all of them."""
    books = first_codebooks(whole, parts, entries)
    usable = whole.where(F.size("v") == books.length)
    for _ in range(rounds if books.length else 0):
        books = improved(usable, books)
    return usable, books


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """``vec_id``, ``code``, ``error``, ``label_error`` and ``codebooks_sha256`` of every vector that can be coded.

    Components become whole numbers and vectors ``parts`` parts; the code has
    two hex digits per part (more with over 256 entries).  The first codebooks
    are the parts of the smallest ids, ties by the vectors themselves, rows
    without an id last; with fewer vectors than ``entries`` there are fewer
    entries.  Distances are whole and exact: the sum over a vector must stay
    below 2^63, as with components up to a million times the scale it does.

    Vectors that are null, empty or hold null or non-finite components take no
    part, nor do those of another length than the vector of the smallest id.
    A length that ``parts`` does not divide gives the first parts one dimension
    more.  Repeated rows and ids are coded each; labels may be null, and rows
    without one are summed together.  Of an empty table nothing is returned.
    """
    usable, books = learn(whole_numbers(vectors), parts, entries, rounds)
    coded = staged(assigned(usable, books), "codes")
    label = F.to_json(F.struct("label"))  # one text for all rows without a label, so that the join needs no null-safe key
    sums = staged(coded.groupBy(label.alias("of_label")).agg(F.sum("error").alias("label_error")), "label-errors")
    return lookup_join(coded.withColumn("of_label", label), sums, "of_label").select(
        "vec_id", _hex(F.col("entries"), entries).alias("code"), "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256")
    )


def _hex(codes: Column, entries: int) -> Column:
    digits = max(2, len(f"{entries - 1:x}"))
    return F.array_join(F.transform(codes, lambda code: F.lpad(F.lower(F.hex(code)), digits, "0")), "")
