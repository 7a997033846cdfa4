"""Vector codes against plain rounds of whole numbers, and the trie against all distances."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarmac.llm import prefix_tries
from tarmac.llm.tables import table


def plain(rows, parts=4, entries=256, rounds=4):
    """The contract in whole Python numbers."""
    rows = [r for r in rows if r[1] and all(x is not None and math.isfinite(x) for x in r[1])]
    whole = sorted(((i, [math.floor(1024 * x) for x in v], label) for i, v, label in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not whole:
        return []
    length = len(whole[0][1])
    whole = [r for r in whole if len(r[1]) == length]
    cuts = np.cumsum([0, *(len(c) for c in np.array_split(np.arange(length), parts))]).tolist()
    split = [[r[1][a:b] for a, b in zip(cuts, cuts[1:])] for r in whole]
    books = [[s[k] for s in split[:entries]] for k in range(parts)]

    def nearest(part, book):
        return min((sum((x - y) ** 2 for x, y in zip(part, entry)), e) for e, entry in enumerate(book))

    for _ in range(rounds):
        for k, book in enumerate(books):
            of = [nearest(s[k], book)[1] for s in split]
            for e in range(len(book)):
                mine = [s[k] for s, x in zip(split, of) if x == e]
                if mine:
                    book[e] = [sum(column) // len(mine) for column in zip(*mine)]
    digest = hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()
    out = []
    for (vec_id, _, label), s in zip(whole, split):
        best = [nearest(s[k], books[k]) for k in range(parts)]
        out.append((vec_id, "".join(f"{e:02x}" for _, e in best), sum(d for d, _ in best), label))
    return [(i, code, error, sum(e for _, _, e, l in out if l == label), digest) for i, code, error, label in out]


def coded(frame, **options):
    found = prefix_tries.compress(frame, **options)
    assert found.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    return sorted((tuple(row) for row in found.collect()), key=str)


@pytest.mark.parametrize("values", [2, 5, 1_000])
def test_trie_equals_all_distances(values):
    draw = np.random.default_rng(values)
    for depth in (1, 3, 8):
        entries = draw.integers(-values, values, (40, depth))
        leaves, which, weight = prefix_tries.distinct_parts(draw.integers(-values, values, (3_000, depth)))
        assert weight.sum() == 3_000 and (np.bincount(which) == weight).all()
        distances = ((leaves[:, None, :] - entries) ** 2).sum(axis=2)
        code, distance = prefix_tries.nearest(leaves, entries)
        assert (code == distances.argmin(axis=1)).all() and (distance == distances.min(axis=1)).all()


def test_given_vectors(spark, small):
    vectors = table(spark, small, "embeddings")
    rows = [(r.vec_id, r.embedding, r.label) for r in vectors.collect()][:150]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)
    assert coded(frame, entries=16) == sorted(plain(rows, entries=16), key=str)


def test_odd_vectors(spark):
    """Null, empty, short, non-finite and repeated vectors, ties, repeated and missing ids and labels, clashing names."""
    draw = np.random.default_rng(5)
    rows = [(k % 40, draw.integers(-3, 3, 6).astype(float).tolist(), k % 3 if k % 5 else None) for k in range(120)]
    rows += [(0, [0.25] * 6, None), (None, [1e-9, -1e-9, 0.0, 1.0, 2.0, 3.0], 1), (3, None, 1), (4, [], 1), (5, [1.0, 2.0], 1)]
    rows += [(6, [math.nan] * 6, 2), (7, [math.inf] + [0.0] * 5, 2), (8, [None] * 6, 2)] + [(90, [0.5] * 6, 0)] * 60
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    frame = frame.withColumns({"v": F.lit(1), "error": F.lit("x"), "entries": F.lit(2), "of_label": F.lit(3)})
    assert coded(frame.repartition(7), entries=8) == sorted(plain(rows, entries=8), key=str)
    assert coded(frame.where("vec_id > 1000")) == []
    assert coded(frame.where("embedding is null")) == []
    few = [r for r in rows if r[0] in (1, 2)]
    assert coded(frame.where("vec_id in (1, 2)")) == sorted(plain(few), key=str)
