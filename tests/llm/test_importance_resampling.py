"""Importance weights and the Gumbel sample against plain Python."""

import collections
import math

from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from tarmac.llm import importance_resampling as ir
from tarmac.llm.tables import table

M = (1 << 64) - 1


def mixed(x):
    x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & M
    x = (x ^ (x >> 27)) * 0x94D049BB133111EB & M
    return x ^ (x >> 31)


def buckets(text):
    mix = 0x9E3779B97F4A7C15
    words = [xxh3_64_intdigest(w) for w in (text or "").encode().lower().split()]
    single = [mixed((w + mix) & M) for w in words]
    pairs = [mixed((mixed(a * mix & M) + b) & M) for a, b in zip(words, words[1:])]
    return [g % ir.BUCKETS for g in single + pairs]


def test_weights_and_sample_of_the_given_documents(spark, small):
    docs, labels = table(spark, small, "documents"), table(spark, small, "labels")
    target = labels.where("quality = 1").select("doc_id")
    wanted = {r.doc_id for r in target.collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    raw, aimed = collections.Counter(), collections.Counter()
    for doc_id, text in texts.items():
        raw.update(buckets(text))
        if doc_id in wanted:
            aimed.update(buckets(text))
    n_raw, n_aimed = sum(raw.values()) + ir.BUCKETS, sum(aimed.values()) + ir.BUCKETS
    got = {r.doc_id: r for r in ir.resample(docs, target, share=0.4).collect()}
    assert set(got) == set(texts)
    for doc_id, text in texts.items():
        grams = buckets(text)
        logs = [math.log((aimed[g] + 1) / n_aimed) - math.log((raw[g] + 1) / n_raw) for g in grams]
        assert got[doc_id].n_grams == len(grams)
        assert math.isclose(got[doc_id].log_weight, math.fsum(logs), rel_tol=1e-9, abs_tol=1e-6)
    order = sorted(got.values(), key=lambda r: -r.sample_key)
    k = math.ceil(0.4 * len(order))
    assert [r.selected for r in order] == [True] * k + [False] * (len(order) - k)


def test_noise_is_gumbel(spark):
    rows = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit(1).cast("long").alias("text_hash"))
    mean, deviation = rows.select(ir.gumbel(0).alias("g")).agg(F.avg("g"), F.stddev("g")).first()
    assert abs(mean - 0.5772) < 0.03 and abs(deviation - math.pi / math.sqrt(6)) < 0.03


def test_place_in_order_is_exact_whatever_is_held(spark):
    rows = spark.range(5000).select(F.rand(4).alias("sample_key"), F.col("id").alias("text_hash")).cache()
    keys = sorted((r.sample_key for r in rows.collect()), reverse=True)
    for k in (1, 77, 2500, 5000):
        assert ir.kth_largest(rows, k, few=100)[0] == keys[k - 1]
    assert ir.kth_largest(rows, 0) is None


def test_ties_are_closed_in_by_the_hash(spark):
    """All keys equal, a few keys, and rows equal in both: no more than ``few`` rows are ever sorted."""
    frames = {
        "one key": spark.range(6_000).select(F.lit(0.5).alias("sample_key"), F.xxhash64("id").alias("text_hash")),
        "three keys": spark.range(6_000).select((F.col("id") % 3 / 2.0).alias("sample_key"), F.xxhash64("id").alias("text_hash")),
        "one hash": spark.range(6_000).select(F.lit(0.5).alias("sample_key"), F.lit(7).cast("long").alias("text_hash")),
        "steps": spark.range(6_000).select(F.exp(F.col("id") % 40).alias("sample_key"), (F.col("id") % 5).alias("text_hash")),
    }
    for name, rows in frames.items():
        order = sorted(((r.sample_key, r.text_hash) for r in rows.collect()), key=lambda r: (-r[0], r[1]))
        for k in (1, 2_000, 4_500, 6_000):
            assert ir.kth_largest(rows, k, few=200) == order[k - 1], (name, k)


def test_edge_rows(spark, edge_docs, no_docs):
    ids = spark.createDataFrame([(5,), (None,), (4,), (4,)], "doc_id long")
    got = ir.resample(edge_docs, ids, share=0.5).collect()
    assert len(got) == edge_docs.count() and all(math.isfinite(r.sample_key) for r in got)
    assert {r.log_weight for r in got if r.doc_id in (1, 2, 3)} == {0.0}
    assert sum(r.selected for r in got) in (6, 7)  # the repeated row shares its fate
    assert len({r.selected for r in got if r.doc_id == 4}) == 1
    assert all(r.selected for r in ir.resample(edge_docs, ids.where("doc_id < 0"), share=1.0).collect())
    assert ir.resample(no_docs, ids).count() == 0
