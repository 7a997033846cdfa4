"""Runs of words against every lag of every word, and against the contract's plain reading."""

import hashlib
import random
import time
import zlib

import numpy as np

from tarmac.llm import periodic_runs
from tarmac.llm.tables import table


def brute(words):
    """Maximal stretches of every lag; of equal stretches the smallest period."""
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = q
        while i < len(words):
            j = i
            while j < len(words) and words[j] == words[j - q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q):
                found.setdefault((i - q, j - i + q), q)
            i = max(j, i + 1)
    return sorted(((s, l, q) for (s, l), q in found.items()), key=lambda r: (r[0], r[2]))


def random_texts(draw):
    for _ in range(draw.randint(1, 4)):
        letters = draw.randint(1, 4)
        words = [draw.randrange(letters) for _ in range(draw.randint(0, 60))]
        if words and draw.random() < 0.6:
            period = draw.randint(1, 8)
            words = [words[k % period] for k in range(len(words))]
            for _ in range(draw.randint(0, 3)):
                words[draw.randrange(len(words))] = 9
        yield words


def test_random_texts_equal_all_lags():
    draw = random.Random(7)
    for _ in range(1_500):
        texts = list(random_texts(draw))
        ends = np.cumsum([len(words) for words in texts])
        got = list(zip(*(column.tolist() for column in periodic_runs.find_runs(np.array(sum(texts, []), np.int64), ends))))
        begins = [0, *ends.tolist()]
        assert got == [(s + b, l, q) for words, b in zip(texts, begins) for s, l, q in brute(words)]


def test_long_texts_take_little_more_than_linear_time():
    n = 300_000
    for words in (np.zeros(n, np.int64), np.arange(n) % 1_000, np.arange(n) % 2, np.random.default_rng(1).integers(0, 3, n)):
        started = time.process_time()
        start, length, period = periodic_runs.find_runs(words, np.array([n]))
        assert time.process_time() - started < 10
        whole = [(s, p) for s, l, p in zip(start, length, period) if l == n]
        assert whole == ([(0, int(words[:2_000].max()) + 1)] if (words[:-1_000] == words[1_000:]).all() else [])


def expected(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    if doc_id is not None and n and zlib.crc32(str(doc_id).encode()) % 10 == 0:
        g = zlib.crc32(str(doc_id).encode()) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute(words)
    gone = {i for s, l, q in runs for i in range(s + q, s + l)}
    best = min(((-l, s, q) for s, l, q in runs), default=None)
    lines = "".join(f"{s},{l},{q}\n" for s, l, q in runs)
    kept = b" ".join(word for i, word in enumerate(words) if i not in gone)
    longest = (best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *longest, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def reported(docs):
    frame = periodic_runs.report(periodic_runs.detect(periodic_runs.with_planted_periods(docs)))
    assert frame.columns == [
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"
    ]
    return sorted((tuple(row) for row in frame.collect()), key=str)


def test_short_documents_of_every_id(spark):
    """Planted periods in short texts, ties and repeated rows."""
    draw = random.Random(2)
    rows = [(k, " ".join(draw.choice("ab") for _ in range(draw.randint(0, 40)))) for k in range(-20, 400)]
    rows += [(16, "a\tb \x0b a\n b a b a b"), (16, "a\tb \x0b a\n b a b a b"), (None, "x x x x x x y"), (17, None), (18, " \r\n")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = sorted((expected(*row) for row in rows), key=str)
    assert reported(frame) == want
    assert sum(row[1] > 0 for row in want) > 50


def test_given_documents_and_edge_rows(spark, small, edge_docs, no_docs):
    docs = table(spark, small, "documents").where("length(text) < 3000 or text is null")
    assert reported(docs) == sorted((expected(r.doc_id, r.text) for r in docs.collect()), key=str)
    short = edge_docs.where("doc_id <> 8 or doc_id is null")
    assert reported(short) == sorted((expected(r.doc_id, r.text) for r in short.collect()), key=str)
    assert reported(no_docs) == []


def test_own_interface(spark, edge_docs):
    found = {(r.doc_id, r.n_words): r for r in periodic_runs.detect(edge_docs).collect()}
    (long_run,) = found[8, 200_000].runs
    assert tuple(long_run) == (0, 200_000, 5) and found[8, 200_000].collapsed == "lorem ipsum dolor sit amet"
    assert found[1, 0].runs == [] and found[1, 0].collapsed == ""
    text = spark.createDataFrame([(1, "so it goes  it goes it goes it goes\nAnd so and so")], "doc_id int, text string")
    (row,) = periodic_runs.detect(text).collect()
    assert [tuple(run) for run in row.runs] == [(1, 8, 2)] and row.collapsed == "so it goes And so and so"
