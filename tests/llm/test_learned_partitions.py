"""Neighbours by learned partitions against all inner products."""

import collections

import numpy as np
from pyspark.sql import functions as F

from tarmac.llm import learned_partitions as lp
from tarmac.llm.tables import table

def is_query():
    return F.col("vec_id") % 20 == 0


def exact(rows, k=20):
    ids = np.array([i for i, _ in rows])
    points = np.array([v for _, v in rows], np.float32).astype(float)
    found = {}
    for q in ids[ids % 20 == 0]:
        scores = points @ points[np.flatnonzero(ids == q)[0]]
        order = [at for at in np.lexsort((ids, -scores)) if ids[at] != q][:k]
        found[int(q)] = [(int(ids[at]), float(scores[at])) for at in order]
    return found


def searched(frame, **options):
    found = collections.defaultdict(list)
    for row in sorted(lp.search(frame, is_query(), **options).collect(), key=lambda r: (r.query_id, r.rank)):
        found[row.query_id].append((row.vec_id, row.score))
        assert row.rank == len(found[row.query_id])
    return found


def recall(got, expected):
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in best}) for q, best in expected.items())
    return hits / sum(len(best) for best in expected.values())


def test_recall_on_the_given_vectors(spark, small):
    frame = table(spark, small, "embeddings")
    expected = exact([(r.vec_id, r.embedding) for r in frame.collect()])
    got = searched(frame, rows_per_part=32)
    assert set(got) == set(expected) and all(len(found) == 20 for found in got.values())
    assert recall(got, expected) >= 0.9


def test_vectors_of_doubles(spark):
    """Doubles are scored as they are, past what a float holds."""
    draw = np.random.default_rng(8)
    points = draw.standard_normal((300, 6)) + 1e-9
    frame = spark.createDataFrame([(k, p.tolist()) for k, p in enumerate(points)], "vec_id long, embedding array<double>")
    got = searched(frame)
    hits = 0
    for q in range(0, 300, 20):
        scores = points @ points[q]
        ids = [i for i, _ in got[q]]
        assert np.allclose([s for _, s in got[q]], scores[ids], rtol=1e-13, atol=0) and q not in ids
        hits += len(set(ids) & set([i for i in np.argsort(-scores, kind="stable") if i != q][:20]))
    assert hits >= 0.9 * 20 * 15


def test_clusters_are_searched_in_few_parts(spark):
    draw = np.random.default_rng(5)
    centres = draw.standard_normal((16, 24))
    points = (centres[np.arange(4000) % 16] + 0.25 * draw.standard_normal((4000, 24))).astype(np.float32)
    graph = lp.neighbour_graph(points.astype(float), 10)
    part = lp.balanced_parts(graph, 16)
    assert np.bincount(part).tolist() == [250] * 16
    assert np.mean(part[graph] == part[:, None]) > 0.8
    router = lp.fit(points.astype(float), 16)
    assert router.probes <= 6
    frame = spark.createDataFrame([(k, p.tolist()) for k, p in enumerate(points)], "vec_id long, embedding array<float>").repartition(6)
    expected = exact(list(enumerate(points)))
    # small blocks of rows and queries change nothing
    assert recall(searched(frame, block_rows=100, block_queries=7), expected) >= 0.9


def test_edge_rows(spark):
    draw = np.random.default_rng(6)
    rows = [(k, draw.standard_normal(8).astype(np.float32).tolist(), 1.0) for k in range(60)]
    same = [0.5] * 8
    rows += [(k, same, 1.0) for k in range(60, 160)]  # a hot vector
    rows += [(60, same, 1.0), (61, same, 2.0)]  # repeated rows
    bad = [(200, None), (220, [0.0] * 8), (240, [1.0] * 7 + [None]), (260, [1.0] * 7 + [float("nan")]),
           (280, [float("inf")] * 8), (300, [1.0] * 3), (320, []), (None, same)]
    frame = spark.createDataFrame([*rows, *[(*row, 0.0) for row in bad]], "vec_id long, embedding array<float>, score double")
    expected = exact(sorted({row[0]: row[:2] for row in rows}.values()))
    got = searched(frame, rows_per_part=8)
    assert set(got) == set(expected)
    for q, best in expected.items():
        assert len(got[q]) == 20 and q not in [i for i, _ in got[q]]
        scores = dict(exact([row[:2] for row in rows], 500)[q])
        assert all(abs(scores[i] - s) < 1e-9 for i, s in got[q])
    # of the hot vector the smallest ids come first
    assert [i for i, _ in got[80]][:3] == [i for i, _ in expected[80]][:3]
    few = frame.where("vec_id < 5 or vec_id = 200")
    assert {q: len(found) for q, found in searched(few).items()} == {0: 4}
    assert lp.search(frame.where("vec_id >= 200"), is_query()).count() == 0
    assert lp.search(frame.where("vec_id < 0"), is_query()).count() == 0
