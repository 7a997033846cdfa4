"""Language identification by cross-parsing with suffix automata.

Each language has the suffix automaton of a labelled sample.  A text is cut
greedily into the longest phrases that occur in the sample; the language whose
phrases cost least wins, a phrase costing the more the larger the sample is
that it points into.
"""

from __future__ import annotations

import math
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.tables import held_out, staged, trained_on

UNDETERMINED = "und"
#: Symbols parsed in a row; a longer text goes on in a parse of its own, in every language alike.
STRETCH = 256
GAP = 0


@lru_cache(maxsize=1)
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """For every code point: whether it is a letter, and whether it belongs to words (letters and marks)."""
    kinds = [unicodedata.category(chr(code))[0] for code in range(0x110000)]
    letter = np.array([kind == "L" for kind in kinds])
    return letter, letter | np.array([kind == "M" for kind in kinds])


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the lower-cased texts in a row, and where each ends."""
    low = [text.lower() for text in texts]
    codes = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), np.uint32)
    return codes, np.cumsum([len(text) for text in low], dtype=np.int64)


#: Bits of a symbol: a code point, or 0 for a gap.
_SYMBOL_BITS = 21
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Transitions:
    """Ways from state to state in an open hash table: as large as the ways there are, whatever the alphabet."""

    keys: np.ndarray  # state and symbol, or -1 where a slot is free
    targets: np.ndarray

    @classmethod
    def of(cls, states: np.ndarray, symbols: np.ndarray, targets: np.ndarray) -> Transitions:
        bits = max(1, int(2 * len(targets)).bit_length())
        table = cls(np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int32))
        keys = (states << _SYMBOL_BITS) | symbols
        slots = table._slots(keys)
        left = np.arange(len(keys))
        while len(left):
            free = left[table.keys[slots[left]] < 0]
            _, first = np.unique(slots[free], return_index=True)
            placed = free[first]
            table.keys[slots[placed]] = keys[placed]
            table.targets[slots[placed]] = targets[placed]
            left = left[table.keys[slots[left]] != keys[left]]
            slots[left] = (slots[left] + 1) & (len(table.keys) - 1)
        return table

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        shift = np.uint64(65 - len(self.keys).bit_length())
        return ((keys.astype(np.uint64) * _SPREAD) >> shift).astype(np.int64)

    def follow(self, states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """The state each way leads to, 0 where there is none."""
        keys = (states << _SYMBOL_BITS) | symbols
        slots = self._slots(keys)
        there = self.keys[slots]
        to = np.where(there == keys, self.targets[slots], 0)
        left = np.flatnonzero((there != keys) & (there >= 0))
        while len(left):
            slots[left] = (slots[left] + 1) & (len(self.keys) - 1)
            there = self.keys[slots[left]]
            met = there == keys[left]
            to[left[met]] = self.targets[slots[left[met]]]
            left = left[~met & (there >= 0)]
        return to


def automaton(symbols: np.ndarray) -> Transitions:
    """Transitions of the suffix automaton of a sequence; state 0 is the root and stands for none."""
    follow: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for symbol in symbols.tolist():
        state = len(follow)
        follow.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and symbol not in follow[p]:
            follow[p][symbol] = state
            p = link[p]
        if p >= 0:
            q = follow[p][symbol]
            if length[p] + 1 == length[q]:
                link[state] = q
            else:
                copy = len(follow)
                follow.append(dict(follow[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and follow[p].get(symbol) == q:
                    follow[p][symbol] = copy
                    p = link[p]
                link[q] = link[state] = copy
        last = state
    ways = [(state, symbol, to) for state, out in enumerate(follow) for symbol, to in out.items()]
    return Transitions.of(*np.array(ways, np.int64).reshape(-1, 3).T)


@dataclass
class LanguageModel:
    """Automata of all languages; symbols are code points of letters and marks, and 0 for the gaps between words."""

    languages: list[str]
    tables: list[Transitions]
    sizes: list[int]  # symbols of each sample
    n_symbols: int = 0  # distinct symbols of all samples
    most_per_letter: float = math.inf  # phrases a letter of a text in a known language takes at most

    def prices(self) -> np.ndarray:
        """Bits a phrase costs in each language: a place in its sample, or one of all symbols."""
        return np.log2(np.array(self.sizes, float) + self.n_symbols + 2)

    def costs(self, counts: np.ndarray) -> np.ndarray:
        """Counts of phrases as bits, over the bits of a phrase in the largest sample; equal samples leave the counts."""
        prices = self.prices()
        return counts * (prices / prices.max())

    def phrases(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Phrases each text (row) takes in each language (column), and how many letters it has."""
        codes, ends = _codes([text or "" for text in texts])
        letter = np.append(np.uint32(0), np.cumsum(_letters()[0][codes], dtype=np.uint32))
        letters = (letter[ends] - letter[np.append(0, ends[:-1])]).astype(np.int64)
        symbols = _symbols(codes)
        # runs of gaps are one gap, and a text has none at its start
        starts = np.zeros(len(codes) + 1, bool)
        starts[np.append(0, ends[:-1])] = True
        starts = starts[:-1]
        gap = symbols == GAP
        keep = ~gap | ~(np.append(True, gap[:-1]) | starts)
        kept = np.append(np.uint32(0), np.cumsum(keep, dtype=np.uint32))[ends].astype(np.int64)
        symbols = symbols[keep]
        sizes = np.diff(kept, prepend=0)
        # stretches of every text, the long ones first so that those still running are a prefix
        parts = -(-sizes // STRETCH)
        of = np.repeat(np.arange(len(texts)), parts)
        first = np.repeat(kept - sizes, parts) + (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)) * STRETCH
        length = np.minimum(STRETCH, np.repeat(kept, parts) - first)
        order = np.argsort(-length, kind="stable")
        of, first, length = of[order], first[order], length[order]
        running = np.searchsorted(-length, -np.arange(1, STRETCH + 1), side="right")
        counts = np.zeros((len(texts), len(self.tables)), np.int64)
        for column, table in enumerate(self.tables):
            state = np.zeros(len(of), np.int64)
            taken = np.ones(len(of), np.int64)
            for at, n in enumerate(running.tolist()):
                if not n:
                    break
                symbol = symbols[first[:n] + at]
                to = table.follow(state[:n], symbol)
                ended = np.flatnonzero(to == 0)
                if at:
                    taken[ended] += 1
                to[ended] = table.follow(np.zeros(len(ended), np.int64), symbol[ended])
                state[:n] = to
            counts[:, column] = np.bincount(of, weights=taken, minlength=len(texts))
        return counts, letters

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """The language of least cost (of equals the first by name) and its share of the odds.

        Every phrase of the largest sample more halves a language's odds.  Texts that are null or have
        no letter are ``und`` with score 0; so is any text if nothing was learned.
        """
        if not self.languages:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts))
        counts, letters = self.phrases(texts)
        has_letter = letters > 0
        costs = self.costs(counts)
        best = costs.argmin(axis=1)
        behind = costs - costs.min(axis=1, keepdims=True)
        score = 1 / np.exp2(-np.minimum(behind, 1000)).sum(axis=1)
        score[~has_letter] = 0.0
        names = [self.languages[k] if known else UNDETERMINED for k, known in zip(best.tolist(), has_letter.tolist())]
        return names, score


def _symbols(codes: np.ndarray) -> np.ndarray:
    return np.where(_letters()[1][codes], codes, GAP).astype(np.int64)


def _one_gap(symbols: np.ndarray) -> np.ndarray:
    gap = symbols == GAP
    return symbols[~gap | ~np.append(True, gap[:-1])]


def learn(
    docs: DataFrame,
    docs_per_language: int = 100,
    chars_per_doc: int = 400,
    docs_to_calibrate: int = 50,
    max_languages: int = 1_000,
) -> LanguageModel:
    """Fit on a bounded sample: ``docs_per_language`` labelled documents of each language, an excerpt of each.

    The documents are those of the smallest hash of their id; ids whose CRC-32
    is divisible by five, and rows without language or text, teach nothing; nor
    do labels beyond the ``max_languages`` that most documents have.
    The excerpt begins at a place the hash picks.  Every language keeps its own
    sample whatever the size of the others; phrases are priced by that size, so
    that no language gains by having been seen more or less.  An automaton is as
    large as its own sample, whatever letters other languages have.  The next
    ``docs_to_calibrate`` documents of each language say how many phrases a
    letter takes where the language is known.  The samples are all that reaches
    the driver.
    """
    order = F.xxhash64("doc_id", "text")
    labelled = docs.where(trained_on(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select(
        "lang",
        order.alias("order"),
        F.substring(
            "text",
            F.pmod(F.xxhash64("text"), F.greatest(F.lit(1), F.length("text") - chars_per_doc)).cast("int") + 1,
            F.lit(chars_per_doc),
        ).alias("text"),
    )
    first = Window.partitionBy("lang").orderBy("order", "text")
    last = docs_per_language + docs_to_calibrate
    sample = staged(labelled.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= last), "samples")
    commonest = sample.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(max_languages)
    rows = sample.join(F.broadcast(commonest), "lang", "left_semi").collect()
    texts: dict[str, list[str]] = {}
    spare: list[str] = []
    for row in sorted(rows, key=lambda row: (row["lang"], row["rank"])):
        if row["rank"] <= docs_per_language:
            texts.setdefault(row["lang"], []).append(row["text"])
        else:
            spare.append(row["text"])
    model = LanguageModel(sorted(texts), [], [])
    seen: list[np.ndarray] = []
    for lang in model.languages:
        symbols = _one_gap(_symbols(_codes([" ".join(texts[lang])])[0]))
        model.tables.append(automaton(symbols))
        model.sizes.append(len(symbols))
        seen.append(symbols)
    if seen:
        pool = np.concatenate(seen)
        model.n_symbols = len(np.unique(pool)) - 1
        model.most_per_letter = _border(model, pool, spare)
    return model


def _border(model: LanguageModel, pool: np.ndarray, spare: list[str], n: int = 200, length: int = 100) -> float:
    """Phrases per letter between text of the learning folds and letters drawn without order from the samples.

    Halfway from the 99th percentile of documents that are in no automaton to
    the fifth of the noise; without such documents four fifths of its median.
    """

    def rates(texts: list[str]) -> np.ndarray:
        counts, letters = model.phrases(texts)
        return counts.min(axis=1) / np.maximum(letters, 1)

    drawn = np.random.default_rng(0).choice(pool, (n, length))
    noise = rates(["".join(chr(code) if code else " " for code in line) for line in drawn.tolist()])
    border = 0.8 * float(np.median(noise))
    if len(spare) >= 20:
        known, low = float(np.percentile(rates(spare), 99)), float(np.percentile(noise, 5))
        border = (known + low) / 2 if known < low else float(np.median(noise))
    return border


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred`` and ``score`` of every row, by its whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in _in_slices(batches):
            names, score = shared.value.predict(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(score)],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text"
    ).mapInArrow(label, "doc_id long, held_out boolean, lang_pred string, score double")


def _in_slices(batches: Iterator[pa.RecordBatch], size: int = 1_000_000) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """Slices of about ``size`` characters, or of one text."""
    for batch in batches:
        start, held, n = 0, [], 0
        for at, value in enumerate(batch.column("text")):
            text = value.as_py()
            if held and n + len(text or "") > size:
                yield batch.slice(start, at - start), held
                start, held, n = at, [], 0
            held.append(text)
            n += len(text or "")
        if held:
            yield batch.slice(start), held


def keep_recognised(docs: DataFrame, model: LanguageModel, spare_phrases: int = 8) -> DataFrame:
    """The rows of ``docs`` in a recognised language, with all their columns.

    Rejected are null texts and those without a letter, and texts that take
    more phrases in every language than their letters would in text of the
    learning folds, and ``spare_phrases`` more: letters without order, or of
    unknown scripts.  What is spared leaves room for a number, a key or an
    address in a short text, and keeps a text too short to tell.  With nothing
    learned every text that has a letter is kept.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in _in_slices(batches):
            counts, letters = shared.value.phrases(texts)
            known = letters > 0
            if counts.shape[1]:
                known &= counts.min(axis=1) <= shared.value.most_per_letter * letters + spare_phrases
            yield batch.filter(pa.array(known))

    return docs.mapInArrow(keep, docs.schema)
