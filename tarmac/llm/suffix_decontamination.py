"""Benchmark passages found in training text through suffix arrays.

Documents are read in shards.  A shard's words become one array of ids, its
suffixes are sorted, and every suffix of every benchmark item is looked up in
it by binary search.  Words that no item has share one id, which ends any
match, so a suffix array needs no order behind such a word.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.kept import forget
from tarmac.llm.tables import staged

#: Fixed: bytes that part words (ASCII but digits and letters); A-Z become a-z.
_TO_WORDS = bytes(
    code + 32 if 65 <= code <= 90 else code if 48 <= code <= 57 or 97 <= code <= 122 or code >= 128 else 32
    for code in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words of a text: runs of ASCII digits, ASCII letters and all other characters above ASCII."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TO_WORDS).split()


@dataclass
class Probes:
    """Suffixes of benchmark items, ready to be searched."""

    vocabulary: dict[bytes, int]
    names: list[str | None]
    words: np.ndarray  # of all items in a row, each followed by an end that matches nothing
    places: np.ndarray  # where each suffix starts in words
    items: np.ndarray  # the item of each suffix
    sizes: np.ndarray  # words of the suffix that have to match

    @property
    def unknown(self) -> int:
        return len(self.vocabulary)


def probes_of(items: list[tuple], window: int) -> Probes:
    """Every suffix of at least ``window`` words; a shorter item is one suffix by itself."""
    vocabulary: dict[bytes, int] = {}
    names, words, places, of, sizes = [], [], [], [], []
    for item_id, text in items:
        found = [vocabulary.setdefault(word, len(vocabulary)) for word in words_of(text)]
        if not found:
            continue
        size = min(window, len(found))
        for at in range(len(found) - size + 1):
            places.append(len(words) + at)
            of.append(len(names))
            sizes.append(size)
        names.append(None if item_id is None else str(item_id))
        words += [*found, -1]
    return Probes(vocabulary, names, *(np.array(x, np.int64) for x in (words, places, of, sizes)))


def packed(words: np.ndarray, bits: int, per: int) -> np.ndarray:
    """``per`` consecutive words from each place on, in one integer that sorts as they do."""
    key = np.zeros(len(words), np.int64)
    for k in range(per):
        key <<= bits
        key[: max(0, len(words) - k)] |= words[k:]
    return key


class SuffixArray:
    """Suffixes of a shard's words in order of their first ``depth`` words."""

    def __init__(self, words: np.ndarray, unknown: int, depth: int):
        self.words, self.depth = words, depth
        self.bits = max(1, int(unknown).bit_length())
        self.per = max(1, min(depth, 62 // self.bits))
        self.key = packed(words, self.bits, self.per)
        n = len(words)
        self.order = np.argsort(self.key, kind="stable")
        if not n or self.per >= depth:
            return
        # words from each place on before an unknown one: what lies behind that one never decides
        stops = np.where(words == unknown, np.arange(n), n)
        run = np.minimum.accumulate(stops[::-1])[::-1] - np.arange(n)
        rank = np.empty(n, np.int64)
        sorted_key = self.key[self.order]
        rank[self.order] = np.cumsum(np.append(0, sorted_key[1:] != sorted_key[:-1]))
        held = self.per
        while held < depth:
            in_order = rank[self.order]
            tied = np.zeros(n, bool)
            same = in_order[1:] == in_order[:-1]
            tied[1:] |= same
            tied[:-1] |= same
            spots = np.flatnonzero(tied & (run[self.order] >= held))
            if not len(spots):
                return
            # rows of one tie stay in its slots: those that end early keep theirs, the rest sort among theirs
            suffixes = self.order[spots]
            behind = np.where(suffixes + held < n, rank[np.minimum(suffixes + held, n - 1)], -1)
            resorted = np.lexsort((behind, in_order[spots]))
            self.order[spots] = suffixes[resorted]
            moved, ranks = behind[resorted], in_order[spots][resorted]
            new = np.append(False, (moved[1:] != moved[:-1]) & (ranks[1:] == ranks[:-1]))
            step = np.zeros(n, np.int64)
            step[spots] = new
            fresh = np.cumsum(np.append(0, ~same) + step)
            rank[self.order] = fresh
            held *= 2

    def ranges(self, probes: Probes) -> tuple[np.ndarray, np.ndarray]:
        """First and last + 1 rank of the suffixes that begin with each probe's words."""
        pads = np.append(self.words, np.zeros(self.depth, np.int64))
        chunks = -(-self.depth // self.per)
        keys = [self.key] if chunks == 1 else [packed(pads, self.bits, self.per)]
        mine = np.maximum(np.append(probes.words, np.zeros(self.depth, np.int64)), 0)
        mine = packed(mine, self.bits, self.per)
        masks, wanted = [], []
        for c in range(chunks):
            known = np.clip(probes.sizes - c * self.per, 0, self.per)
            mask = ((1 << (known * self.bits)) - 1) << ((self.per - known) * self.bits)
            masks.append(mask)
            wanted.append(mine[probes.places + c * self.per] & mask)

        def search(after: bool) -> np.ndarray:
            low = np.zeros(len(probes.places), np.int64)
            high = np.full(len(probes.places), len(self.order), np.int64)
            while (low < high).any():
                middle = (low + high) // 2
                at = self.order[np.minimum(middle, len(self.order) - 1)]
                less = np.zeros(len(low), bool)
                equal = np.ones(len(low), bool)
                for c in range(chunks):
                    here = keys[0][np.minimum(at + c * self.per, len(keys[0]) - 1)] & masks[c]
                    less |= equal & (here < wanted[c])
                    equal &= here == wanted[c]
                go_up = (less | equal if after else less) & (low < high)
                low = np.where(go_up, middle + 1, low)
                high = np.where(go_up | (low >= high), high, middle)
            return low

        return search(False), search(True)


def occurrences(array: SuffixArray, probes: Probes) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a probe and a place in the shard where its words stand."""
    first, last = array.ranges(probes)
    times = last - first
    probe = np.repeat(np.arange(len(times)), times)
    rank = np.repeat(first - (np.cumsum(times) - times), times) + np.arange(times.sum())
    return probe, array.order[rank]


def longest(array: SuffixArray, probes: Probes, probe: np.ndarray, place: np.ndarray):
    """Verbatim matches that extend no further either way: item, its word, the shard's word, length."""
    mine = probes.places[probe]
    words = np.append(array.words, -2)
    before = (mine > 0) & (place > 0)
    inner = before & (probes.words[np.maximum(mine - 1, 0)] == words[np.maximum(place - 1, 0)])
    probe, place, mine = probe[~inner], place[~inner], mine[~inner]
    length = probes.sizes[probe].copy()
    alive = np.arange(len(length))
    while len(alive):
        more = probes.words[mine[alive] + length[alive]] == words[np.minimum(place[alive] + length[alive], len(words) - 1)]
        alive = alive[more]
        length[alive] += 1
    starts = np.append(0, np.flatnonzero(probes.words == -1) + 1)
    return probes.items[probe], mine - starts[probes.items[probe]], place, length


class Shard:
    """Word ids of consecutive documents, each followed by an unknown word."""

    def __init__(self, texts: list[list[bytes]], probes: Probes, window: int):
        known, unknown = probes.vocabulary.get, probes.unknown
        ids: list[int] = []
        for words in texts:
            ids += [known(word, unknown) for word in words]
            ids.append(unknown)
        self.sizes = np.array([len(words) for words in texts], np.int64)
        self.ends = np.cumsum(self.sizes + 1)
        self.starts = self.ends - self.sizes - 1
        self.array = SuffixArray(np.array(ids, np.int64), unknown, window)
        self.probe, self.place = occurrences(self.array, probes)
        self.probes = probes

    def hits(self) -> np.ndarray:
        """Words of each document that lie inside a match."""
        steps = np.zeros(len(self.array.words) + 1, np.int64)
        np.add.at(steps, self.place, 1)
        np.add.at(steps, self.place + self.probes.sizes[self.probe], -1)
        return np.cumsum(steps)[:-1] > 0

    def found(self) -> list[set[int]]:
        """Items of which a window stands in each document."""
        document = np.searchsorted(self.ends, self.place, side="right")
        sets: list[set[int]] = [set() for _ in self.sizes]
        pairs = np.unique(document * max(1, len(self.probes.names)) + self.probes.items[self.probe])
        for pair in pairs.tolist():
            at, item = divmod(pair, max(1, len(self.probes.names)))
            sets[at].add(item)
        return sets

    def matches(self) -> list[list[dict]]:
        """Longest verbatim matches of each document."""
        rows: list[list[dict]] = [[] for _ in self.sizes]
        found = longest(self.array, self.probes, self.probe, self.place)
        document = np.searchsorted(self.ends, found[2], side="right")
        for at, item, item_start, place, length in zip(document.tolist(), *(x.tolist() for x in found)):
            rows[at].append(
                {
                    "item_id": self.probes.names[item],
                    "item_start": item_start,
                    "doc_start": place - int(self.starts[at]),
                    "length": length,
                }
            )
        for row in rows:
            row.sort(key=lambda match: (match["doc_start"], match["item_id"] or "", match["item_start"]))
        return rows


def _batches_in_shards(
    batches: Iterator[pa.RecordBatch], shard_words: int
) -> Iterator[tuple[pa.RecordBatch, list[list[bytes]]]]:
    """Slices of the batches with the words of their texts, about ``shard_words`` words or one text at a time."""
    for batch in batches:
        column, start, held, n = batch.column("text"), 0, [], 0
        for at in range(batch.num_rows):
            words = words_of(column[at].as_py())
            if held and n + len(words) > shard_words:
                yield batch.slice(start, at - start), held
                start, held, n = at, [], 0
            held.append(words)
            n += len(words) + 1
        if held:
            yield batch.slice(start), held


def benchmark_blocks(benchmark: DataFrame, window: int, block_bytes: int) -> tuple[int, Callable[[int], Probes]]:
    """How many blocks of about ``block_bytes`` of text the items make, and what collects one of them.

    The text is measured first.  Items without words have no suffix.
    """
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = max(1, -(-size // block_bytes))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    return n, lambda k: probes_of([tuple(row) for row in items.where(block == k).distinct().collect()], window)


_MATCH = pa.struct([("item_id", pa.string()), ("item_start", pa.int64()), ("doc_start", pa.int64()), ("length", pa.int64())])
_SPAN = pa.struct([("start", pa.int64()), ("stop", pa.int64())])
_MATCHES = "array<struct<item_id: string, item_start: long, doc_start: long, length: long>>"
_PASS = f"doc_id long, text string, n_words long, spans array<struct<start: long, stop: long>>, items array<string>, matches {_MATCHES}"


def _spans(hit: np.ndarray) -> list[dict]:
    """Stretches of marked words."""
    edges = np.flatnonzero(np.diff(hit.astype(np.int8), prepend=0, append=0))
    return [{"start": start, "stop": stop} for start, stop in edges.reshape(-1, 2).tolist()]


def find_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 10,
    shard_words: int = 1_000_000,
    block_bytes: int = 32 << 20,
) -> DataFrame:
    """What each document shares with the benchmark; a row per row of ``docs``, without a shuffle.

    ``n_words``; ``n_hit``, words inside an occurrence of ``window``
    consecutive item words, or of a whole shorter item; ``n_items``;
    ``items_sha256`` over the item ids in text order, comma-joined (over
    nothing: of the empty text); ``contaminated``; and ``matches``, the longest
    verbatim matches with their places in words, by place in the document, item
    and place in the item.

    Null and empty texts have no words.  Rows of one item id count as one item;
    rows without an id hit words but are neither counted nor named.  An empty
    benchmark hits nothing.  Rows of ``docs`` that share an id, or have none,
    are searched each; their other columns play no part.  A task holds one
    shard of words and one block of the benchmark at a time: a benchmark of
    several blocks is searched block after block, each pass written to the
    shared folder with what it has found.
    """
    n_blocks, collect = benchmark_blocks(benchmark, window, block_bytes)
    spark = docs.sparkSession
    nothing = {"n_words": "long", "spans": "array<struct<start: long, stop: long>>", "items": "array<string>", "matches": _MATCHES}
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        *[F.lit(None).cast(kind).alias(name) for name, kind in nothing.items()],
    )

    def search(shared, last: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch, texts in _batches_in_shards(batches, shard_words):
                shard = Shard(texts, shared.value, window)
                hit = shard.hits()
                before = [batch.column(name).to_pylist() for name in ("spans", "items", "matches")]
                spans, items, matches = [], [], []
                for at, (found, longest_ones, start, size) in enumerate(
                    zip(shard.found(), shard.matches(), shard.starts.tolist(), shard.sizes.tolist())
                ):
                    own = hit[start : start + size]
                    for span in before[0][at] or ():
                        own[span["start"] : span["stop"]] = True
                    spans.append(_spans(own) if own.any() else [])
                    items.append(sorted({shared.value.names[item] for item in found} - {None} | set(before[1][at] or ())))
                    every = [*(before[2][at] or ()), *longest_ones]
                    matches.append(sorted(every, key=lambda m: (m["doc_start"], m["item_id"] or "", m["item_start"])))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"),
                        pa.nulls(len(texts), pa.string()) if last else batch.column("text"),
                        pa.array(shard.sizes, pa.int64()),
                        pa.array(spans, pa.list_(_SPAN)),
                        pa.array(items, pa.list_(pa.string())),
                        pa.array(matches, pa.list_(_MATCH)),
                    ],
                    names=["doc_id", "text", "n_words", "spans", "items", "matches"],
                )

        return run

    for k in range(n_blocks):
        shared = spark.sparkContext.broadcast(collect(k))
        rows = rows.mapInArrow(search(shared, k == n_blocks - 1), _PASS)
        if k < n_blocks - 1:
            rows = staged(rows, "passages")
            shared.unpersist()
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, span: total + span.stop - span.start)
    return rows.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
        "matches",
    )


def report(found: DataFrame) -> DataFrame:
    """The rows of ``find_passages`` with the number of matches and the longest one in place of all.

    Of equal lengths the first in the document counts, then by item and place in it.
    """
    longest_one = F.array_min(
        F.transform("matches", lambda m: F.struct(-m.length, m.doc_start, F.coalesce(m.item_id, F.lit("")), m.item_start))
    )
    best = found.withColumn("best", longest_one)
    return best.select(
        *[name for name in found.columns if name != "matches"],
        F.size("matches").cast("long").alias("n_matches"),
        (-F.col("best.col1")).alias("longest_words"),
        F.col("best.doc_start").alias("longest_doc_start"),
        F.col("best.col3").alias("longest_item"),
        F.col("best.item_start").alias("longest_item_start"),
    )


def remove_affected(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 10,
    shard_words: int = 1_000_000,
    block_bytes: int = 32 << 20,
) -> DataFrame:
    """The rows of ``docs`` without a benchmark passage, with all their columns.

    Null and empty texts, and all rows where the benchmark is empty, stay.  A
    benchmark of several blocks takes a pass for each.
    """
    n_blocks, collect = benchmark_blocks(benchmark, window, block_bytes)

    def keep_clean(shared):
        def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            forget()  # a worker may come from another operator
            for batch, texts in _batches_in_shards(batches, shard_words):
                shard = Shard(texts, shared.value, window)
                yield batch.filter(pa.array(~np.logical_or.reduceat(shard.hits(), shard.starts)))

        return keep

    for k in range(n_blocks):
        shared = docs.sparkSession.sparkContext.broadcast(collect(k))
        docs = docs.mapInArrow(keep_clean(shared), docs.schema)
        if k < n_blocks - 1:
            docs = staged(docs, "clean")
            shared.unpersist()
    return docs
