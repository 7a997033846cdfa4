"""Windows filled with lexical neighbours from a sharded BM25 index.

Document frequencies and the mean length are those of all documents; what is
searched is the seed's own shard.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.tables import staged
from tarmac.llm.word_tokens import REMEMBERED_WORDS, encoder, parted, slices

K1, B = 1.2, 0.75


@dataclass
class Corpus:
    """What BM25 has to know of all documents: their number, their mean length, and how many hold each term."""

    n: int
    mean: float
    df: np.ndarray


def corpus_of(encoded: DataFrame, id_type: np.dtype) -> Corpus:
    """Counts over all rows; a task sends a row per term, so what is collected is bounded by the vocabulary."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n, total = np.zeros(1 << 16, np.int64), 0, 0
        # marks of one document, and of up to 255 added up: sorting a document's ids takes several times longer
        found, some = np.zeros(len(df), np.uint8), np.zeros(len(df), np.uint8)
        for batch in batches:
            for value in batch.column("ids"):
                ids = np.frombuffer(value.as_buffer(), id_type)
                if len(ids) and (most := int(ids.max())) >= len(df):
                    df, found, some = (np.append(x, np.zeros(most + 1 - len(x), x.dtype)) for x in (df, found, some))
                found[ids] = 1
                some += found
                found[ids] = 0
                n, total = n + 1, total + len(ids)
                if n % 255 == 0:
                    df += some
                    some[:] = 0
        df += some
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(held, [-1, -2])), pa.array(np.append(df[held], [n, total]))], names=["term", "n"]
        )

    sums = encoded.select("ids").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    counts = {row["term"]: row["n"] for row in sums.collect()}
    n, total = counts.pop(-1, 0), counts.pop(-2, 0)
    df = np.zeros(max(counts, default=-1) + 1, np.int64)
    df[list(counts)] = list(counts.values())
    return Corpus(n, total / max(n, 1), df)


class ShardIndex:
    """BM25 postings over the documents of one shard; terms are token ids.

    Without a ``corpus`` the shard is the corpus; without ``query_terms`` a
    document is searched by all its terms.
    """

    def __init__(self, tokens: list[np.ndarray], query_terms: int | None = None, corpus: Corpus | None = None):
        self.n = len(tokens)
        self.query_terms = query_terms
        lengths = np.array([len(ids) for ids in tokens])
        ids = np.concatenate(tokens)
        width = int(ids.max()).bit_length() if len(ids) else 0
        # a document and a term in one number, sorted for the whole shard at once
        keys = np.repeat(np.arange(self.n, dtype=np.uint32 if self.n << width < 1 << 32 else np.int64), lengths)
        keys <<= width
        keys |= ids.astype(keys.dtype)
        keys.sort()
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
        tf = np.diff(first, append=len(keys)).astype(float)
        documents = (keys[first] >> width).astype(np.int64)
        self.terms = (keys[first] & ((1 << width) - 1)).astype(np.int64)
        self.ends = np.cumsum(np.bincount(documents, minlength=self.n))
        df = np.bincount(self.terms)
        corpus = corpus or Corpus(self.n, lengths.mean(), df)
        held = corpus.df[: len(df)]
        self.idf = np.log1p((corpus.n - held + 0.5) / (held + 0.5))
        norm = K1 * (1 - B + B * lengths / max(corpus.mean, 1.0))
        weights = self.idf[self.terms] * tf * (K1 + 1) / (tf + norm[documents])
        order = np.argsort(self.terms, kind="stable")
        self.posted, self.weights = documents[order], weights[order]
        self.df = df
        self.places = np.append(0, np.cumsum(df))
        self.searched = self.n

    def search_only(self, wanted: np.ndarray) -> None:
        """Leave out the postings of all other documents; the scores of those wanted stay the same."""
        held = wanted[self.posted]
        self.places = np.append(0, np.cumsum(held))[self.places]
        self.posted, self.weights = self.posted[held], self.weights[held]
        self.searched = int(wanted.sum())

    def scores(self, document: int) -> np.ndarray:
        """BM25 of all searched documents of the shard for the terms of one, those that occur elsewhere in it."""
        mine = self.terms[self.ends[document - 1] if document else 0 : self.ends[document]]
        mine = mine[self.df[mine] > 1]
        if self.query_terms is not None and len(mine) > self.query_terms:
            mine = mine[np.argsort(-self.idf[mine], kind="stable")[: self.query_terms]]
        sizes = self.places[mine + 1] - self.places[mine]
        ends = np.cumsum(sizes)
        if not len(mine) or not ends[-1]:
            return np.zeros(self.n)
        at = np.repeat(self.places[mine] - (ends - sizes), sizes) + np.arange(ends[-1])
        return np.bincount(self.posted.take(at), self.weights.take(at), minlength=self.n)


class Packer:
    """Fills windows of ``size`` ids one after the other; only the open window is held."""

    def __init__(self, size: int):
        self.size = size
        self.sequence = 0
        self.filled = 0
        self.open: list[tuple] = []

    def put(self, document: tuple, start: int, out: list[tuple]) -> int:
        """Place ids of ``document`` from ``start`` on; return how far it got."""
        doc_id, ids = document
        n = min(self.size - self.filled, len(ids) - start)
        self.open.append((doc_id, start, ids[start : start + n], len(ids), self.filled))
        self.filled += n
        if self.filled == self.size:
            self._close(self.open, out)
            self.open, self.filled = [], 0
        return start + n

    def _close(self, pieces: list[tuple], out: list[tuple]) -> None:
        for doc_id, start, ids, n, offset in pieces:
            out.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), n, self.sequence, offset))
        self.sequence += 1

    def finish(self, out: list[tuple]) -> None:
        """Cut what is left into sequences of powers of two, which need no padding."""
        rest, left = self.open, self.filled
        while left:
            size, taken, at = 1 << (left.bit_length() - 1), [], 0
            while at < size:
                doc_id, start, ids, n, _ = rest.pop(0)
                fits = min(len(ids), size - at)
                taken.append((doc_id, start, ids[:fits], n, at))
                if fits < len(ids):
                    rest.insert(0, (doc_id, start + fits, ids[fits:], n, 0))
                at += fits
            self._close(taken, out)
            left -= size
        self.open, self.filled = [], 0


def pack_shard(
    documents: list[tuple], packer: Packer, query_terms: int | None, out: list[tuple], corpus: Corpus | None = None
) -> None:
    """Pack ``(doc_id, ids)`` of one shard.

    Whole windows of long documents go first.  Then each unused document in
    turn is a seed: it goes into the open window, followed by its unused
    neighbours from the best score down until the window is full.  The document
    at the edge is cut and its rest is the next seed.
    """
    placed = np.zeros(len(documents), np.int64)
    sizes = np.array([len(ids) for _, ids in documents])
    index = ShardIndex([ids for _, ids in documents], query_terms, corpus)
    free = np.ones(len(documents), bool)
    next_seed, seed = 0, -1
    while True:
        if seed < 0:
            while next_seed < len(documents) and not free[next_seed]:
                next_seed += 1
            if next_seed == len(documents):
                return
            seed = next_seed
        windows = packer.sequence
        free[seed] = False
        while placed[seed] < sizes[seed]:
            placed[seed] = packer.put(documents[seed], int(placed[seed]), out)
        if packer.filled == 0:
            seed = -1
            continue
        if 4 * np.count_nonzero(free) < 3 * index.searched:
            index.search_only(free)
        scores = np.where(free, index.scores(seed), -1.0)
        windows, seed = packer.sequence, -1
        while packer.sequence == windows:
            best = int(np.argmax(scores))
            if scores[best] <= 0:
                break
            scores[best] = -1.0
            free[best] = False
            placed[best] = packer.put(documents[best], 0, out)
            if placed[best] < sizes[best]:
                seed = best


def pack(
    docs: DataFrame,
    vocabulary: str,
    end_id: int,
    size: int = 4096,
    shard_docs: int = 1024,
    shard_tokens: int = 4_000_000,
    query_terms: int | None = None,
    remembered_words: int = REMEMBERED_WORDS,
) -> DataFrame:
    """Pack every document into sequences of ``size`` ids; a row per piece.

    Documents are dealt out by the smallest hash of their words, so texts of
    one vocabulary meet; Spark splits a hash that is too frequent.  A task cuts
    its sorted documents into shards of at most ``shard_docs`` documents or
    ``shard_tokens`` ids, which bounds its memory, and indexes each.  Scores use
    counts over all documents and, without ``query_terms``, all terms of the
    seed; neighbours in other shards are not searched.  Every document is in one shard and every id in one piece.  Sequences are full but
    for the last of a task, which is cut into powers of two.

    Null and empty texts are the end id alone.  Rows that share an id are
    packed as separate documents.  ``remembered_words`` bounds a worker's memory
    of words and changes the speed alone.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = encoder(vocabulary, remembered_words)
        for batch in batches:
            texts = batch.column("text")
            # a larger slice looks up fewer words; its own are to be a small part of those remembered
            for start, stop in slices(texts, max(6 * remembered_words, 1_000_000)):
                ids, ends, least = codec.encode(parted(texts.slice(start, stop - start)))
                ids = np.insert(ids, ends, end_id).astype(codec.id_type)
                ends = np.append(0, ends + np.arange(1, len(ends) + 1)) * codec.id_type.itemsize
                data = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(ids)]
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(start, stop - start),
                        pa.array(least.view(np.int64)),
                        data.cast(pa.binary()),
                    ],
                    names=["doc_id", "signature", "ids"],
                )

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = id_type
        first = TaskContext.get().partitionId() << 33
        packer, shard, tokens = Packer(size), [], 0

        def rows(out: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*out)) or [[] for _ in names]
            arrays = [pa.array(column, pa.int64()) for column in columns]
            arrays[5] = pa.array(np.array(columns[5], np.int64) + first)
            return pa.RecordBatch.from_arrays(arrays, names=names)

        for batch in batches:
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), batch.column("ids")):
                # a copy: a view would hold the whole batch until its last window is full
                ids = np.frombuffer(ids.as_buffer(), kind).copy()
                if shard and (len(shard) >= shard_docs or tokens + len(ids) > shard_tokens):
                    out: list[tuple] = []
                    pack_shard(shard, packer, query_terms, out, shared.value)
                    yield rows(out)
                    shard, tokens = [], 0
                shard.append((doc_id, ids))
                tokens += len(ids)
        out = []
        if shard:
            pack_shard(shard, packer, query_terms, out, shared.value)
        packer.finish(out)
        yield rows(out)

    encoded = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        encode, "doc_id long, signature long, ids binary"
    )
    encoded = staged(encoded, "encoded")
    id_type = encoder(vocabulary, remembered_words).id_type
    shared = docs.sparkSession.sparkContext.broadcast(corpus_of(encoded, id_type))
    dealt = encoded.hint("rebalance", "signature").sortWithinPartitions("signature", "doc_id", "ids")
    return dealt.mapInArrow(fill, ", ".join(f"{name} long" for name in names))
