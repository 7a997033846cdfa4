"""Resampling of raw documents towards a target by hashed n-gram models.

Two bags of hashed words and word pairs, one of the target documents and one of
all documents, give every document an importance weight.  Gumbel noise on the
log weights turns the largest ``k`` into a weighted sample without replacement.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.tables import rows_of, staged
from tarmac.llm.word_hashes import MIX, mixed, word_hashes

BUCKETS = 10_000


def gram_buckets(text: str | None) -> np.ndarray:
    """The bucket of every word and every pair of neighbouring words."""
    words = word_hashes(text)
    pairs = mixed(mixed(words[:-1] * MIX) + words[1:])
    return (np.concatenate([mixed(words + MIX), pairs]) % np.uint64(BUCKETS)).astype(np.int64)


def gram_counts(docs: DataFrame) -> np.ndarray:
    """Counts per bucket over all rows, and over those marked ``in_target``, as two lines.

    A task sends one row per bucket, so what is shuffled and collected is bounded by the buckets.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            for text, marked in zip(batch.column("text"), batch.column("in_target").to_pylist()):
                found = np.bincount(gram_buckets(text.as_py()), minlength=BUCKETS)
                total[0] += found
                if marked:
                    total[1] += found
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(BUCKETS)), pa.array(total[0]), pa.array(total[1])], names=["bucket", "n_raw", "n_target"]
        )

    sums = (
        docs.select("text", "in_target")
        .mapInArrow(count, "bucket long, n_raw long, n_target long")
        .groupBy("bucket")
        .agg(F.sum("n_raw").alias("n_raw"), F.sum("n_target").alias("n_target"))
    )
    counts = np.zeros((2, BUCKETS))
    for row in sums.collect():
        counts[:, row["bucket"]] = row["n_raw"], row["n_target"]
    return counts


def log_ratio(counts: np.ndarray) -> np.ndarray:
    """Log of the target's share of every bucket over the raw share, one added to each count."""
    share = (counts + 1) / (counts.sum(axis=1, keepdims=True) + BUCKETS)
    return np.log(share[1]) - np.log(share[0])


def weighted(docs: DataFrame, ratio: np.ndarray) -> DataFrame:
    """``doc_id``, ``text_hash``, ``n_grams`` and ``log_weight`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(ratio)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, weights = [], []
            for text in batch.column("text"):
                grams = gram_buckets(text.as_py())
                sizes.append(len(grams))
                weights.append(float(shared.value[grams].sum()) if len(grams) else 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(sizes, pa.int64()), pa.array(weights, pa.float64())],
                names=["doc_id", "text_hash", "n_grams", "log_weight"],
            )

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text"
    ).mapInArrow(weigh, "doc_id long, text_hash long, n_grams long, log_weight double")


def gumbel(seed: int) -> Column:
    """Noise of a row from its id and text, the same in every run."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", "text_hash"), 11)
    uniform = (bits + F.lit(0.5)) / F.lit(float(1 << 53))
    return -F.log(-F.log(uniform))


def kth_largest(rows: DataFrame, k: int, few: int = 50_000) -> tuple[float, int] | None:
    """``sample_key`` and ``text_hash`` of the row in place ``k`` by falling key, then by ``text_hash``.

    The place is closed in by quantiles of the key, then, if all keys that are
    left tie, of the hash, until ``few`` rows are left to sort, so no more than
    those ever meet in one task.  Rows equal in both are one place to look at.
    """
    n = rows.count()
    if not 0 < k <= n:
        return None
    counted = rows.select("sample_key", "text_hash")
    key, before = _closed_in(counted, "sample_key", n - k + 1, n, few)
    ties = counted.where(F.col("sample_key") == F.lit(key))
    m = ties.count()
    # places from the top among the ties, whose hashes rise
    place = k - (n - before - m)
    text_hash, _ = _closed_in(ties, "text_hash", place, m, few)
    return key, text_hash


def _closed_in(rows: DataFrame, column: str, place: int, n: int, few: int):
    """The value in ``place`` from the smallest on, and the rows with smaller values."""
    below = 0
    while n > few:
        near = (place - below) / n
        cuts = [max(0.0, near - 0.002), min(1.0, near + 0.002)]
        low, high = rows.agg(F.percentile_approx(column, cuts, 10_000)).first()[0]
        sides = rows.agg(F.count_if(F.col(column) < low).alias("under"), F.count_if(F.col(column) <= high).alias("upto")).first()
        if below + sides["upto"] < place:
            rows, n, below = rows.where(F.col(column) > high), n - sides["upto"], below + sides["upto"]
        elif below + sides["under"] >= place:
            rows, n = rows.where(F.col(column) < low), sides["under"]
        elif low == high:
            return low, below + sides["under"]
        elif sides["upto"] - sides["under"] == n:
            # no cut helps: the distinct values are few enough to be counted, or the range is halved
            middle = (low + high) / 2 if isinstance(low, float) else (low + high) // 2
            upto = rows.where(F.col(column) <= middle).count()
            rows, n, below = (
                (rows.where(F.col(column) <= middle), upto, below)
                if below + upto >= place
                else (rows.where(F.col(column) > middle), n - upto, below + upto)
            )
        else:
            rows, n, below = rows.where(F.col(column).between(low, high)), sides["upto"] - sides["under"], below + sides["under"]
    values = [row[0] for row in rows.select(column).orderBy(column).limit(place - below).collect()]
    value = values[-1]
    return value, below + values.index(value)


def resample(docs: DataFrame, target_ids: DataFrame, share: float = 0.75, seed: int = 0) -> DataFrame:
    """``doc_id``, ``n_grams``, ``log_weight``, ``sample_key`` and ``selected`` for every row of ``docs``.

    ``target_ids`` holds the ``doc_id`` of target documents.  Both models are
    counted over all documents.  The log weight is the importance ratio of the
    two models: the sum of the log ratios of all n-grams of a text.  The ``share`` of rows with the largest sum of log weight and
    Gumbel noise is selected; rows equal in id and text share their fate.

    Null and empty texts have no n-grams and log weight 0: both models give them equally.
    With an empty target all weigh nearly the same.  Rows without an id are
    sampled like others.
    """
    ids = target_ids.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null").distinct()
    marked = rows_of(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), ids.withColumn("in_target", F.lit(True)), "doc_id", "left"
    )
    ratio = log_ratio(gram_counts(marked))
    rows = weighted(docs, ratio).withColumn("sample_key", F.col("log_weight") + gumbel(seed))
    rows = staged(rows, "weights")
    last = kth_largest(rows, math.ceil(share * rows.count()))
    chosen = F.lit(False)
    if last:
        key, text_hash = last
        chosen = (F.col("sample_key") > key) | ((F.col("sample_key") == key) & (F.col("text_hash") <= text_hash))
    return rows.select("doc_id", "n_grams", "log_weight", "sample_key", chosen.alias("selected"))
