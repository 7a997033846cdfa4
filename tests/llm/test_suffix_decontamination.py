"""Benchmark passages against a plain search for every window."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest

from tarmac.llm import suffix_decontamination as sd
from tarmac.llm.queries import ORACLE_SQL
from tarmac.llm.tables import table


def words(text):
    low = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items, window=10):
    windows, sizes = collections.defaultdict(set), set()
    for item_id, text in items:
        found = words(text)
        size = min(window, len(found))
        if size:
            sizes.add(size)
            for k in range(len(found) - size + 1):
                windows[tuple(found[k : k + size])].add(item_id)
    rows = []
    for doc_id, text in docs:
        found, hit, names = words(text), set(), set()
        for size in sizes:
            for k in range(len(found) - size + 1):
                if (gram := tuple(found[k : k + size])) in windows:
                    hit.update(range(k, k + size))
                    names |= {str(i) for i in windows[gram] if i is not None}
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        rows.append((str(doc_id), len(found), len(hit), len(names), digest, bool(hit)))
    return sorted(rows)


def found(docs, benchmark, **options):
    return sorted((str(r[0]), *tuple(r)[1:6]) for r in sd.find_passages(docs, benchmark, **options).collect())


def tuples(frame, *names):
    return [tuple(r) for r in frame.select(*names).collect()]


@pytest.mark.parametrize("options", [{}, {"shard_words": 500}, {"block_bytes": 1000}])
def test_given_documents(spark, small, options):
    docs, benchmark = table(spark, small, "documents"), table(spark, small, "benchmark")
    expected = brute(tuples(docs, "doc_id", "text"), tuples(benchmark, "item_id", "text"))
    assert any(row[-1] for row in expected)
    assert found(docs, benchmark, **options) == expected


def longest(docs, items, window=10):
    """Maximal verbatim matches by plain extension of every window."""
    rows = {}
    items = [(i, words(t)) for i, t in dict.fromkeys(items) if words(t)]
    for doc_id, text in docs:
        own, out = words(text), set()
        for item_id, item in items:
            size = min(window, len(item))
            for b in range(len(item) - size + 1):
                for a in range(len(own) - size + 1):
                    if own[a : a + size] == item[b : b + size]:
                        x, y, n = a, b, size
                        while x and y and own[x - 1] == item[y - 1]:
                            x, y, n = x - 1, y - 1, n + 1
                        while x + n < len(own) and y + n < len(item) and own[x + n] == item[y + n]:
                            n += 1
                        out.add((x, "" if item_id is None else str(item_id), y, n))
        rows[str(doc_id)] = sorted(out)
    return rows


@pytest.mark.parametrize("block_bytes", [32 << 20, 40])
def test_longest_matches_and_their_places(spark, block_bytes):
    """Overlapping, repeated and nested passages, items shorter than a window, blocks one after the other."""
    draw = random.Random(5)
    letters = "a b c d e f".split()
    items = [(k, " ".join(draw.choices(letters, k=draw.choice([2, 3, 5, 9])))) for k in range(6)] + [(None, "f a f a f")]
    docs = [(k, " ".join(draw.choices([*letters, "z"], k=40))) for k in range(25)] + [(90, None), (91, "")]
    docs += [(92, " ".join(t for _, t in items))]
    frame = spark.createDataFrame([(*row, "x", 1) for row in docs], "doc_id long, text string, spans string, items int").repartition(3)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    expected = longest(docs, items, window=4)
    found_rows = sd.find_passages(frame, benchmark, window=4, block_bytes=block_bytes)
    for row in found_rows.collect():
        assert [(m.doc_start, m.item_id or "", m.item_start, m.length) for m in row.matches] == expected[str(row.doc_id)]
    for row in sd.report(found_rows).collect():
        want = expected[str(row.doc_id)]
        best = min(((-n, x, i, y) for x, i, y, n in want), default=(None,) * 4)
        got = (row.longest_words and -row.longest_words, row.longest_doc_start, row.longest_item, row.longest_item_start)
        assert (row.n_matches, got) == (len(want), best)
    assert sd.remove_affected(frame, benchmark, window=4, block_bytes=block_bytes).count() == sum(not m for m in expected.values())


def test_edge_rows(spark, edge_docs, no_docs):
    items = [(1, None), (2, ""), (3, "one"), (None, "two three four"), (4, "ELEVEN"), (4, "lorem ipsum"),
             (5, "one two three four five six seven eight nine ten eleven twelve")]
    benchmark = spark.createDataFrame([(*row, 1) for row in items], "item_id long, text string, doc_id int")
    assert found(edge_docs, benchmark) == brute(tuples(edge_docs, "doc_id", "text"), items)
    assert found(no_docs, benchmark) == []
    assert found(edge_docs, benchmark.where("item_id < 0")) == brute(tuples(edge_docs, "doc_id", "text"), [])


def test_random_words_of_small_alphabets():
    draw = random.Random(1)
    for _ in range(60):
        letters = ["a", "b", "c", "d", "e"][: draw.randint(1, 5)]
        docs = [(k, " ".join(draw.choices(letters, k=draw.choice([0, 1, 5, 20, 200])))) for k in range(12)]
        items = [(k, " ".join(draw.choices([*letters, "z"], k=draw.choice([0, 1, 2, 3, 9, 10, 11, 14])))) for k in range(6)]
        window = draw.choice([2, 3, 10])
        probes = sd.probes_of(items, window)
        shard = sd.Shard([sd.words_of(text) for _, text in docs], probes, window)
        hits = np.add.reduceat(shard.hits().astype(int), shard.starts)
        expected = {int(row[0]): row for row in brute(docs, items, window)}
        for k, names in enumerate(shard.found()):
            assert (expected[k][2], expected[k][3]) == (hits[k], len(names))
        for (_, text), matches in zip(docs, shard.matches()):
            own = sd.words_of(text)
            for match in matches:
                item = sd.words_of(items[int(match["item_id"])][1])
                a, b, n = match["doc_start"], match["item_start"], match["length"]
                assert own[a : a + n] == item[b : b + n]
                assert a == 0 or b == 0 or own[a - 1] != item[b - 1]
                assert a + n == len(own) or b + n == len(item) or own[a + n] != item[b + n]


def test_suffixes_are_in_order():
    draw = np.random.default_rng(2)
    for unknown in (3, 40_000):
        words_of_shard = draw.integers(0, 4, 400) if unknown == 3 else draw.integers(0, unknown + 1, 400)
        array = sd.SuffixArray(words_of_shard, unknown, 10)

        def key(at, shard=words_of_shard, unknown=unknown):
            run = shard[at : at + 10].tolist()
            return run[: run.index(unknown) + 1] if unknown in run else run

        keys = [key(at) for at in array.order.tolist()]
        assert keys == sorted(keys) and sorted(array.order.tolist()) == list(range(400))


def test_affected_documents_go(spark, small, edge_docs):
    docs, benchmark = table(spark, small, "documents"), table(spark, small, "benchmark")
    clean = {row[0] for row in found(docs, benchmark) if not row[-1]}
    kept = sd.remove_affected(docs, benchmark)
    assert kept.schema == docs.schema
    assert {str(r.doc_id) for r in kept.collect()} == clean
    assert sd.remove_affected(edge_docs, benchmark).count() == edge_docs.count()


def test_sql_twin_is_registered():
    assert "op4_suffix_arrays" in ORACLE_SQL


def test_workers_give_up_what_other_operators_remembered():
    from tarmac.llm import kept

    held = kept.kept("of another operator", lambda: ["much"])
    assert kept.kept("of another operator", list) is held
    kept.forget()
    assert kept.kept("of another operator", list) == []
