"""Periodic runs of words, found along sparse diagonals of a text's matches with itself.

A run of period q repeats each word q places later, so it is a stretch of
consecutive matches on the diagonal of lag q.  Words are taken in order; an
earlier occurrence of what stands at a place adds one to the match length of
its lag, and a lag that meets no further match ends there and then, and is a
run if it has become long enough.

Following all earlier occurrences of a word would be quadratic in a text of
one word, so the diagonals are kept sparse by length: at width w the words of
a place are those of the next w places, and only the last earlier occurrence
counts, at lags in (w/2, w].  That loses no run: one of period q and length 4q
or more holds, with w the power of two in [q, 2q), the w words of each of its
places once every q places and, as q is its smallest period, never in between.
For the same reason a diagonal that becomes long enough is a whole run, and q
its smallest period.  Every width is one pass over the places whose words
still recur, so a text of n words takes O(n log n) matches whatever repeats.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.word_tokens import slices

#: A run has this many words and this many periods at least.
LEAST_WORDS, LEAST_PERIODS = 6, 4


def _diagonals(place: np.ndarray, lag: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and period of the runs among matches of ``width`` words at ``place``, ``lag`` back.

    The match length of a lag grows while the next place matches at it and ends elsewhere.
    """
    order = np.argsort(place)
    place, lag = place[order], lag[order]
    opens = np.append(True, (np.diff(place) != 1) | (np.diff(lag) != 0))
    first = np.flatnonzero(opens)
    last = np.append(first[1:], len(place)) - 1
    period = lag[first]
    start = place[first] - period
    length = place[last] + width - start
    long_enough = length >= np.maximum(LEAST_WORDS, LEAST_PERIODS * period)
    return start[long_enough], length[long_enough], period[long_enough]


def find_runs(codes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and period of every run, by start, then period.

    ``codes`` holds the words of consecutive texts, equal words as equal
    numbers, and ``ends`` where each text ends; no run reaches over an end.
    """
    sizes = np.diff(ends, prepend=0)
    stop = np.repeat(ends, sizes)
    recurring = np.arange(len(codes))
    key = np.repeat(np.arange(len(ends)), sizes) * (int(codes.max(initial=0)) + 1) + codes
    group = np.full(len(codes), -1)
    width, found = 1, []
    while len(recurring):
        order = np.argsort(key, kind="stable")
        place, ordered = recurring[order], key[order]
        again = np.append(False, ordered[1:] == ordered[:-1])
        at = np.flatnonzero(again)
        lag = place[at] - place[at - 1]
        near = (lag <= width) & (2 * lag > width)
        if near.any():
            found.append(_diagonals(place[at[near]], lag[near], width))
        # twice the width recurs only where both halves do
        shared = again | np.append(again[1:], False)
        group.fill(-1)
        group[place[shared]] = np.cumsum(~again)[shared]
        recurring = np.sort(place[shared])
        recurring = recurring[recurring + 2 * width <= stop[recurring]]
        recurring = recurring[group[recurring + width] >= 0]
        key = group[recurring] * (len(codes) + 1) + group[recurring + width]
        width *= 2
    if not found:
        return tuple(np.empty(0, np.int64) for _ in range(3))
    start, length, period = (np.concatenate(column) for column in zip(*found))
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def repeated_words(n: int, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Which of ``n`` words some run repeats: all of a run but its first period."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    return np.cumsum(change[:-1]) > 0


def detect(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_words``, ``runs`` and ``collapsed`` for every row of ``docs``.

    A run is a stretch of words with smallest period q, six words and four
    periods long at least, that no neighbouring word extends; ``runs`` are
    structs of ``start`` (word number from 0), ``length`` and ``period`` by
    start, then period.  ``collapsed`` is the text without the words that a run
    repeats, joined by single spaces.  Words are runs of characters other than
    space, tab, line feed, vertical tab, form feed and carriage return, as they
    are written.

    Null texts, empty ones and those without words have no words, no runs and
    an empty ``collapsed``.  Rows that share an id, or have none, are returned
    each; other columns play no part.  Texts go through in slices of about two
    megabytes; a longer text is a slice of its own.
    """
    run = pa.struct([(name, pa.int64()) for name in ("start", "length", "period")])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            for first, last in slices(texts):
                words = [(text.as_py() or "").encode().split() for text in texts.slice(first, last - first)]
                known: dict[bytes, int] = {}
                codes = np.array([known.setdefault(word, len(known)) for text in words for word in text], np.int64)
                ends = np.cumsum([len(text) for text in words])
                start, length, period = find_runs(codes, ends)
                home = np.searchsorted(ends, start, side="right")
                begins = ends - [len(text) for text in words]
                own = np.searchsorted(home, np.arange(len(words) + 1))
                repeats = repeated_words(len(codes), start, length, period)
                collapsed = [
                    b" ".join([word for word, gone in zip(text, repeats[b : b + len(text)]) if not gone] if n else text)
                    for text, b, n in zip(words, begins.tolist(), np.diff(own).tolist())
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(first, last - first),
                        pa.array(np.diff(ends, prepend=0), pa.int64()),
                        pa.ListArray.from_arrays(
                            pa.array(own, pa.int32()),
                            pa.StructArray.from_arrays(
                                [pa.array(column, pa.int64()) for column in (start - begins[home], length, period)],
                                fields=list(run),
                            ),
                        ),
                        pa.array(collapsed, pa.binary()).cast(pa.string()),
                    ],
                    names=["doc_id", "n_words", "runs", "collapsed"],
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        scan,
        "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string",
    )


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``; one document in ten repeats its words with a period from some word on.

    Which ones, from where and with which period follows from the CRC-32 of the
    id as text.  Documents without an id, or without words, stay as they are.
    """
    doc_id = F.col("doc_id").cast("long").alias("doc_id")
    h = F.crc32(doc_id.cast("string").cast("binary"))
    words = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda word: word != "")
    chosen = docs.select(doc_id, "text", h.alias("h")).withColumn("words", F.when(F.col("h") % 10 == 0, words))
    g = F.floor(F.col("h") / 10)
    n = F.greatest(F.size("words"), F.lit(1)).cast("long")
    placed = chosen.withColumn("a", g % n).withColumn("p", 1 + F.floor((n - F.col("a")) / (3 + g % 8)))

    def word_at(word: Column, i: Column) -> Column:
        again = F.get("words", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int"))
        return F.when(i < F.col("a"), word).otherwise(again)

    text = F.when(F.size("words") > 0, F.array_join(F.transform("words", word_at), " ")).otherwise(F.col("text"))
    return placed.select("doc_id", text.alias("text"))


def report(found: DataFrame) -> DataFrame:
    """The row per document of ``detect`` as counts, the longest run and digests."""
    longest = F.array_min(F.transform("runs", lambda r: F.struct(-r.length, r.start, r.period)))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))
    best = found.withColumn("best", longest)
    length, period = -F.col("best.col1"), F.col("best.period")
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
