"""Near-duplicate groups against all pairs."""

import random

import numpy as np
import pytest

from tarmac.llm import hyperminhash
from tarmac.llm.tables import table


def words(text):
    return (text or "").encode().lower().split()


def grouped(rows, percent=75):
    """Shingle set and group of every row by comparing all pairs."""
    sets = []
    for _, text in rows:
        w = words(text)
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(rows)))

    def top(k):
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if rows[a][0] is None or rows[b][0] is None or not sets[a] or not sets[b]:
                continue
            shared = len(sets[a] & sets[b])
            if 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                root[top(a)] = top(b)
    return sets, [top(k) for k in range(len(rows))]


def brute(rows, percent=75):
    """The rows of ``groups``."""
    sets, group = grouped(rows, percent)
    least = {}
    for k, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[group[k]] = min(least.get(group[k], doc_id), doc_id)
    return sorted(
        (str(doc_id), len(sets[k]), str(least.get(group[k])), doc_id is not None and doc_id == least[group[k]])
        for k, (doc_id, _) in enumerate(rows)
    )


def found(frame, **options):
    return sorted(
        (str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in hyperminhash.groups(frame, **options).collect()
    )


def test_given_documents(spark, small):
    docs = table(spark, small, "documents")
    assert found(docs) == brute([tuple(r) for r in docs.select("doc_id", "text").collect()])


def test_edge_rows(edge_docs, no_docs):
    assert found(edge_docs) == brute([tuple(r) for r in edge_docs.select("doc_id", "text").collect()])
    assert found(no_docs) == []


@pytest.mark.parametrize("small_bucket", [1, 64])
def test_a_large_group_with_chains_and_strays(spark, small_bucket):
    """Every level of change around one text, in small and in large buckets; copies and ids on two texts among them."""
    draw = random.Random(3)
    base = [f"w{k}" for k in range(150)]
    rows = []
    for doc_id in range(150):
        text = list(base)
        for _ in range(draw.randint(0, 14)):
            text[draw.randrange(150)] = f"x{draw.randrange(10**6)}"
        rows.append((1000 - doc_id, " ".join(text)))
    rows += [(2000 + k, rows[k][1]) for k in range(10)]
    chain = list(base[::-1])
    for k in range(20):
        chain = chain[1:] + [f"c{k}"] + [f"d{k}"] * (k % 2)
        rows.append((3000 - k, " ".join(chain)))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert found(frame, small_bucket=small_bucket) == brute(rows)
    twice = [*rows, (1000, "another text under an id that is taken " * 3)]
    frame = spark.createDataFrame(twice, "doc_id long, text string")
    assert found(frame, small_bucket=small_bucket) == brute(twice)


def test_one_of_each_group_is_kept(spark, edge_docs):
    kept = hyperminhash.keep_one(edge_docs)
    assert kept.columns == edge_docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, [1, 2, 3, 4, 5, 7, 8, None, 9]))


def test_registers_agree_as_often_as_sets():
    draw = np.random.default_rng(1)
    for size in (4, 40, 4000):
        agreed = []
        for _ in range(60):
            pool = np.unique(draw.integers(0, 2**63, size * 5 // 4, dtype=np.uint64))
            shared = len(pool) * 3 // 5
            side = (len(pool) - shared) // 2
            a, b = np.sort(pool[: shared + side]), np.sort(np.append(pool[:shared], pool[shared + side : shared + 2 * side]))
            jaccard = shared / (shared + 2 * side)
            same = hyperminhash.registers(a) == hyperminhash.registers(b)
            agreed.append(same.mean() - jaccard)
        assert abs(np.mean(agreed)) < 0.06


def test_register_holds_zeros_and_mantissa():
    hashes = np.array([5], np.uint64)
    value = int(hyperminhash.mixed(hashes + hyperminhash.MIX)[0] >> np.uint64(16))
    zeros = 48 - value.bit_length()
    mantissa = (value - (1 << (value.bit_length() - 1))) >> (value.bit_length() - 1 - 10)
    assert set(hyperminhash.registers(hashes).tolist()) == {zeros << 10 | mantissa}


def test_components_of_a_long_chain(spark):
    edges = [(k, k + 1) for k in range(60)] + [(100, 101), (101, 102), (102, 100)]
    labels = hyperminhash.components(spark.createDataFrame(edges, "a long, b long"))
    got = {r.id: r.label for r in labels.collect()}
    assert got == {**{k: 0 for k in range(1, 61)}, 101: 100, 102: 100}


def test_pairs_of_very_short_texts(spark):
    """Three shingles within four: every pair is linked, far below the floor of the estimate or not."""
    rows = []
    for k in range(1_500):
        text = [f"p{k}x{j}" for j in range(8)]
        rows += [(2 * k, " ".join(text[:7])), (2 * k + 1, " ".join(text))]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    lost = [r.doc_id for r in hyperminhash.groups(frame).collect() if r.component_id != r.doc_id // 2 * 2]
    assert lost == []


def test_ids_on_two_texts_lose_neither(spark):
    """An id on a kept text and on a copy, and one on two unrelated texts; copies under one id share a place."""
    a, b, c, d = (" ".join(f"{name}{k}" for k in range(12)) for name in "abcd")
    rows = [(1, a), (2, b), (2, a), (3, c), (3, d), (3, d), (4, b), (5, c + " more")]
    kept = hyperminhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1))
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(1, a), (2, b), (3, c), (3, d)]


def test_ids_on_two_similar_texts(spark):
    """An id whose smallest place names one text also stands on a copy of another: each is compared by its own set."""
    base = [f"w{k}" for k in range(104)]

    def changed(places, mark):
        return " ".join(f"{mark}{k}" if k in places else word for k, word in enumerate(base))

    b, c = " ".join(base), " ".join([*base, "end"])
    a = changed({3, 20, 50, 97}, "x")
    rows = [(3, b), (5, a), (5, b), (9, c)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(frame) == brute(rows)
    assert sorted((r.doc_id, r.text) for r in hyperminhash.keep_one(frame).collect()) == [(3, b), (5, a)]


@pytest.mark.parametrize("seed", range(2))
def test_random_tables_with_repeated_ids(spark, seed):
    draw = random.Random(seed)
    base, texts, rows = [f"w{k}" for k in range(60)], [], []
    for _ in range(60):
        text = list(draw.choice(texts) if texts and draw.random() < 0.7 else base)
        for _ in range(draw.randint(0, 2)):
            text[draw.randrange(60)] = f"x{draw.randrange(99)}"
        texts.append(text)
        rows += [(draw.randrange(40), " ".join(text))] * draw.choice([1, 1, 1, 2])
    rows += [(None, rows[0][1]), (7, None), (7, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert found(frame) == brute(rows)
    # every group keeps its place: one row, or several that share the id and have different sets
    sets, group = grouped(rows)
    kept = sorted(((r.doc_id, r.text) for r in hyperminhash.keep_one(frame).collect()), key=str)
    assert kept.count((None, rows[0][1])) == 1
    groups_kept = {group[k] for k, row in enumerate(rows) if row in kept}
    assert {group[k] for k, row in enumerate(rows) if sets[k] and row[0] is not None} <= groups_kept
    places = {(row[0], group[k]) for k, row in enumerate(rows) if row in kept and row[0] is not None and sets[k]}
    assert len([row for row in kept if row[0] is not None and words(row[1])]) <= len(places)
