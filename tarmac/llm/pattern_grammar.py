"""Toxicity by a weighted finite-state grammar over clauses.

Words become symbols: insults, threats, targets, negations, words of reported
speech, others.  Small weighted machines each watch one of these; their
composition reads a clause once and adds up what they say.  A document is
scored by the clauses that match, not by isolated words.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Hashable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.hyperminhash import shingle_set
from tarmac.llm.tables import held_out, rows_of, staged, trained_on
from tarmac.llm.word_tokens import slices

OTHER, INSULT, WEAK_INSULT, THREAT, TARGET, NEGATION, REPORT = range(7)
SYMBOLS = 7

#: Fixed: seed words in English, German, French and Spanish.
SEEDS = {
    INSULT: "idiot idiots moron morons scumbag bastard bastards asshole trottel arschloch dummkopf connard salaud abruti gilipollas imbécil cabrón",
    WEAK_INSULT: "stupid dumb pathetic worthless disgusting loser losers scum trash clown dumm erbärmlich wertlos stupide minable nul estúpido patético inútil",
    THREAT: "kill hurt destroy murder beat stab töten umbringen schlagen tuer frapper détruire matar golpear destruir",
    TARGET: "you your yours yourself he she him her they them their du dich dir dein deine ihr euch tu toi te ton ta vous votre tú te ti tu usted ustedes",
    NEGATION: "not no never isn't aren't wasn't don't nicht kein keine nie pas jamais aucun no nunca jamás",
    REPORT: "said says say called calls claimed wrote quoted quote reported sagte sagt nannte schrieb dit disait appelé écrit dijo dice llamó escribió",
}
#: Fixed: marks that end a clause, and letters that digits and signs stand for inside a word.
CLAUSE_ENDS = ".!?;:\n|"
STAND_FOR = str.maketrans("013457@$", "oieastas")


@dataclass(frozen=True)
class Machine:
    """A deterministic weighted transducer: it reads symbols, moves between states and adds weights."""

    start: Hashable
    step: Callable[[Hashable, int], tuple[Hashable, float]]
    end: Callable[[Hashable], float] = lambda state: 0.0


def composed(first: Machine, second: Machine) -> Machine:
    """Both machines on the same clause; their weights add up."""

    def step(state, symbol):
        (a, w), (b, v) = first.step(state[0], symbol), second.step(state[1], symbol)
        return (a, b), w + v

    return Machine((first.start, second.start), step, lambda state: first.end(state[0]) + second.end(state[1]))


_HARSH = {INSULT: 3.0, WEAK_INSULT: 2.0, THREAT: 1.0}


def insult_machine() -> Machine:
    """The harshest insult of the clause counts, each further one a little."""

    def step(state, symbol):
        weight = _HARSH.get(symbol, 0.0) if symbol != THREAT else 0.0
        return max(state, weight), 0.5 if weight and state else 0.0

    return Machine(0.0, step, lambda state: state)


def threat_machine() -> Machine:
    """A threat is one only with somebody it is aimed at, before or after."""

    def step(state, symbol):
        threat, target = state
        return (threat or symbol == THREAT, target or symbol == TARGET), 0.0

    return Machine((False, False), step, lambda state: 3.0 if all(state) else 0.0)


def target_machine() -> Machine:
    """An insult in a clause that names somebody is worse."""

    def step(state, symbol):
        insult, target = state
        return (insult or symbol in (INSULT, WEAK_INSULT), target or symbol == TARGET), 0.0

    return Machine((False, False), step, lambda state: 1.0 if all(state) else 0.0)


def negation_machine(reach: int = 3) -> Machine:
    """An insult or threat within ``reach`` words of a negation weighs less."""

    def step(state, symbol):
        if symbol == NEGATION:
            return reach, 0.0
        return max(0, state - 1), -1.5 if state and symbol in _HARSH else 0.0

    return Machine(0, step)


def report_machine() -> Machine:
    """What follows a word of reporting is somebody else's speech."""

    def step(state, symbol):
        return state or symbol == REPORT, -1.0 if state and symbol in _HARSH else 0.0

    return Machine(False, step)


@dataclass
class Grammar:
    """The composition of all machines as tables over numbered states."""

    follow: list[list[int]]
    weight: list[list[float]]
    end: list[float]

    def clause(self, symbols: list[int]) -> float:
        state, total = 0, 0.0
        for symbol in symbols:
            total += self.weight[state][symbol]
            state = self.follow[state][symbol]
        return total + self.end[state]


def compiled(machine: Machine) -> Grammar:
    numbers, states = {machine.start: 0}, [machine.start]
    grammar = Grammar([], [], [])
    for state in states:
        row, weights = [], []
        for symbol in range(SYMBOLS):
            to, weight = machine.step(state, symbol)
            if to not in numbers:
                numbers[to] = len(states)
                states.append(to)
            row.append(numbers[to])
            weights.append(weight)
        grammar.follow.append(row)
        grammar.weight.append(weights)
        grammar.end.append(machine.end(state))
    return grammar


def toxicity_grammar() -> Grammar:
    machine = insult_machine()
    for other in (threat_machine(), target_machine(), negation_machine(), report_machine()):
        machine = composed(machine, other)
    return compiled(machine)


_CORE = re.compile(r"[^\W_](?:.*[^\W_])?", re.S)


def core_of(word: str) -> str:
    """A word without the marks around it, in lower case; in words of letters mixed with digits or signs those count as letters."""
    found = _CORE.search(word.lower())
    core = found.group() if found else ""
    return core if core.isalpha() else core.translate(STAND_FOR) if any(c.isalpha() for c in core) else core


STEMS = range(4, 8)


@dataclass
class Lexicon:
    """Symbols of whole words, and of stems that words begin with."""

    words: dict[str, int] = field(default_factory=dict)
    stems: dict[str, int] = field(default_factory=dict)

    def symbol(self, word: str) -> int:
        core = core_of(word)
        found = self.words.get(core)
        if found is not None:
            return found
        for n in reversed(STEMS):
            if len(core) > n and core[:n] in self.stems:
                return self.stems[core[:n]]
        return OTHER


FEATURES = 5


def features(texts: pa.Array, lexicon: Lexicon, grammar: Grammar) -> np.ndarray:
    """Per text: number of matching clauses, their summed and largest weight, their share, and clauses played down.

    All words of a text are looked up, each distinct one once; only clauses
    with an insult or a threat run through the grammar.
    """
    spaced = pc.replace_substring(pc.fill_null(texts, ""), "\n", " \n ")
    lists = pc.split_pattern(pc.replace_substring(spaced, "\t", " "), " ")
    coded = lists.flatten().dictionary_encode()
    distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
    symbol_of = np.fromiter((lexicon.symbol(word) if word else OTHER for word in distinct), np.int8, len(distinct))
    ends_of = np.fromiter((word[-1:] in CLAUSE_ENDS if word else False for word in distinct), bool, len(distinct))
    place = coded.indices.to_numpy()
    symbols, ends = symbol_of[place], ends_of[place]
    text_ends = np.cumsum(pc.list_value_length(lists).to_numpy(), dtype=np.int64)
    ends[text_ends - 1] = True
    stops = np.flatnonzero(ends)
    harsh = np.flatnonzero((symbols == INSULT) | (symbols == WEAK_INSULT) | (symbols == THREAT))
    clauses = np.unique(np.searchsorted(stops, harsh))
    found = np.zeros((len(texts), FEATURES))
    of_text = np.searchsorted(text_ends, stops[clauses], side="right")
    for clause, text in zip(clauses.tolist(), of_text.tolist()):
        first = int(stops[clause - 1]) + 1 if clause else 0
        weight = grammar.clause(symbols[first : stops[clause] + 1].tolist())
        if weight > 0:
            found[text, 0] += 1
            found[text, 1] += weight
            found[text, 2] = max(found[text, 2], weight)
        else:
            found[text, 4] += 1
    clauses_of = np.diff(np.searchsorted(stops, text_ends), prepend=0)
    found[:, 3] = found[:, 0] / np.maximum(clauses_of, 1)
    found[:, [0, 1, 4]] = np.log1p(found[:, [0, 1, 4]])
    return found


@dataclass
class Model:
    lexicon: Lexicon
    grammar: Grammar
    weights: np.ndarray

    def score(self, texts: pa.Array) -> np.ndarray:
        found = features(texts, self.lexicon, self.grammar)
        return 1 / (1 + np.exp(-(found @ self.weights[:-1] + self.weights[-1])))


#: Weights of the features and the constant before any label is seen, and the largest constant.
PRIOR = np.array([1.0, 1.0, 1.0, 0.0, 0.0, -4.0])
MOST_CONSTANT = -1.0


def fitted(found: np.ndarray, labels: np.ndarray, rounds: int = 60) -> np.ndarray:
    """Logistic regression drawn towards ``PRIOR`` as by one label, by damped Newton steps; the constant comes last.

    Weights below zero are set to zero for the features that count matches, so
    that a further match never lowers a score, and the constant is held low
    enough that a text without a match is never called toxic.
    """
    x = np.column_stack([found, np.ones(len(found))])
    weights, free = PRIOR.copy(), np.ones(x.shape[1], bool)
    for _ in range(x.shape[1]):
        weights[free] = PRIOR[free]
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
            gradient = x[:, free].T @ (p - labels) + weights[free] - PRIOR[free]
            curve = (x[:, free] * (p * (1 - p))[:, None]).T @ x[:, free] + np.eye(free.sum())
            weights[free] -= np.clip(np.linalg.solve(curve, gradient), -2, 2)
        low = free & (weights < 0)
        low[FEATURES - 1 :] = False
        if not low.any():
            break
        free &= ~low
        weights[low] = 0
    weights[-1] = min(weights[-1], MOST_CONSTANT)
    return weights


def _parts_of(core: str) -> list[str]:
    """A word as a whole, and its stems marked by a star."""
    return [core, *(f"{core[:n]}*" for n in STEMS if len(core) > n)]


def learn_lexicon(sample: DataFrame, n_toxic: int, n_clean: int, least_share: float = 0.01, least_evidence: float = 24.0) -> Lexicon:
    """Words and stems that toxic documents of the sample have and clean ones lack.

    A word has to stand in ``least_share`` of the toxic documents, and the
    log-likelihood ratio of its two counts has to reach ``least_evidence``,
    which one word in a million does by chance.  A stem is taken where it covers
    clearly more documents than the commonest word that begins with it, which is
    the mark of inflection.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic: Counter[str] = Counter()
            clean: Counter[str] = Counter()
            for text, label in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                cores = {core_of(word) for word in (text or "").split()} - {""}
                (toxic if label else clean).update({part for core in cores for part in _parts_of(core)})
            parts = sorted(set(toxic) | set(clean))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(parts, pa.string()),
                    pa.array([toxic[part] for part in parts], pa.int64()),
                    pa.array([clean[part] for part in parts], pa.int64()),
                ],
                names=["part", "n_toxic", "n_clean"],
            )

    both, n = F.col("n_toxic") + F.col("n_clean"), float(max(1, n_toxic + n_clean))

    def term(count: Column, of: Column | int, group: int) -> Column:
        share = count * n / F.greatest(of * F.lit(group), F.lit(1))
        return F.when(count > 0, count * F.log(share)).otherwise(0.0)

    evidence = 2 * (
        term(F.col("n_toxic"), both, n_toxic)
        + term(F.col("n_clean"), both, n_clean)
        + term(n_toxic - F.col("n_toxic"), n - both, n_toxic)
        + term(n_clean - F.col("n_clean"), n - both, n_clean)
    )
    odds = ((F.col("n_toxic") + 0.5) / (n_toxic + 1)) / ((F.col("n_clean") + 0.5) / (n_clean + 1))
    rows = (
        sample.mapInArrow(count, "part string, n_toxic long, n_clean long")
        .groupBy("part")
        .agg(F.sum("n_toxic").alias("n_toxic"), F.sum("n_clean").alias("n_clean"))
        .where((F.col("n_toxic") >= max(1.0, least_share * n_toxic)) & (evidence >= least_evidence))
        .withColumn("odds", odds)
        .where("odds >= 8")
        # every part has its share of the toxic documents of the sample, which bounds their number
        .orderBy(F.desc("n_toxic"), "part")
        .collect()
    )
    lexicon = Lexicon()
    for symbol, words in SEEDS.items():
        lexicon.words.update(dict.fromkeys(words.split(), symbol))
    commonest: Counter[str] = Counter()
    for row in rows:
        if not row["part"].endswith("*"):
            lexicon.words[row["part"]] = INSULT if row["odds"] >= 20 else WEAK_INSULT
            for n in STEMS:
                stem = row["part"][:n] + "*"
                commonest[stem] = max(commonest[stem], row["n_toxic"])
    for row in rows:
        if row["part"].endswith("*") and row["n_toxic"] >= 1.5 * commonest[row["part"]]:
            lexicon.stems[row["part"][:-1]] = INSULT if row["odds"] >= 20 else WEAK_INSULT
    return lexicon


def _without_copies(labelled: DataFrame) -> DataFrame:
    """One ``text`` with its ``toxic`` label for each smallest shingle, so that a much copied document counts about once."""

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(text.as_py()) for text in batch.column("text")]
            least = pa.array([int(found[0] >> np.uint64(1)) if len(found) else -1 for found in sets], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [least, batch.column("text"), batch.column("toxic")], names=["least", "text", "toxic"]
            )

    keyed = labelled.select("text", "toxic").mapInArrow(key, "least long, text string, toxic int")
    return keyed.groupBy("least").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")).select("text", "toxic")


def learn(docs: DataFrame, labels: DataFrame, sample_rows: int = 20_000) -> Model:
    """Fit lexicon and weights on at most ``sample_rows`` labelled documents, those of the smallest hash of their id.

    Ids whose CRC-32 is divisible by five teach nothing.  Copies count
    once.  Without labels of both kinds the seed words and the
    weights of ``PRIOR`` are used.
    """
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where(F.col("toxic").isin(0, 1) & trained_on(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"))
        .limit(sample_rows)
    )
    known = staged(known, "labels")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sample = staged(_without_copies(rows_of(texts, known, "doc_id", "inner")), "toxicity-sample")
    n_toxic = sample.where("toxic = 1").count()
    n_clean = sample.count() - n_toxic
    grammar = toxicity_grammar()
    lexicon = learn_lexicon(sample, n_toxic, n_clean)
    if not n_toxic or not n_clean:
        return Model(lexicon, grammar, PRIOR)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in slices(batch.column("text")):
                part = batch.slice(start, stop - start)
                found = features(part.column("text"), lexicon, grammar)
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(column) for column in found.T), part.column("toxic")],
                    names=[*(f"f{k}" for k in range(FEATURES)), "toxic"],
                )

    columns = ", ".join(f"f{k} double" for k in range(FEATURES))
    table = sample.mapInArrow(count, f"{columns}, toxic int").toArrow()
    found = np.column_stack([table.column(f"f{k}").to_numpy() for k in range(FEATURES)])
    return Model(lexicon, grammar, fitted(found, table.column("toxic").to_numpy().astype(float)))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every row, by its whole text.

    Null and empty texts have no clause and get the score of a text without a match.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in slices(batch.column("text")):
                part = batch.slice(start, stop - start)
                found = shared.value.score(part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("held_out"), pa.array(found), pa.array((found >= 0.5).astype(np.int32))],
                    names=["doc_id", "held_out", "score", "predicted"],
                )

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text"
    ).mapInArrow(rate, "doc_id long, held_out boolean, score double, predicted int")
