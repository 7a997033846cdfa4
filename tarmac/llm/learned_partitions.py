"""Nearest neighbours by learned partitions.

The neighbour graph of a bounded sample is cut into balanced parts with few
edges between them.  A small network learns which parts hold a vector's
neighbours.  It places every row in one part and sends every query to the most
probable parts, whose rows are ranked by exact inner products.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.tables import staged


def neighbour_graph(vectors: np.ndarray, k: int, block: int = 1024) -> np.ndarray:
    """The ``k`` rows of largest inner product to each row, itself left out."""
    found = np.empty((len(vectors), k), np.int64)
    for at in range(0, len(vectors), block):
        scores = vectors[at : at + block] @ vectors.T
        scores[np.arange(len(scores)), at + np.arange(len(scores))] = -np.inf
        found[at : at + block] = np.argpartition(-scores, k - 1, axis=1)[:, :k]
    return found


def _halves(edges: np.ndarray, n: int, rng: np.random.Generator, smoothings: int = 30, swaps: int = 8) -> np.ndarray:
    """A cut of a graph into equal halves: the median of a smooth function, then swaps that save most edges."""
    a, b = edges
    degree = np.maximum(np.bincount(a, minlength=n), 1)
    value = rng.standard_normal(n)
    for _ in range(smoothings):
        value = 0.5 * value + 0.5 * np.bincount(a, weights=value[b], minlength=n) / degree
        value -= value.mean()
        value /= max(np.abs(value).max(), 1e-12)
    side = np.zeros(n, bool)
    side[np.argsort(value, kind="stable")[n // 2 :]] = True
    for _ in range(swaps):
        across = np.bincount(a, weights=side[a] != side[b], minlength=n)
        gain = 2 * across - np.bincount(a, minlength=n)
        left, right = np.flatnonzero(~side), np.flatnonzero(side)
        left, right = left[np.argsort(-gain[left], kind="stable")], right[np.argsort(-gain[right], kind="stable")]
        m = min(len(left), len(right))
        take = int(np.sum(gain[left[:m]] + gain[right[:m]] > 0)) // 2
        if not take:
            break
        side[left[:take]], side[right[:take]] = True, False
    return side


def balanced_parts(graph: np.ndarray, parts: int, seed: int = 7) -> np.ndarray:
    """Recursive halving of the neighbour graph into ``parts``, a power of two."""
    rng = np.random.default_rng(seed)
    n, k = graph.shape
    a = np.concatenate([np.repeat(np.arange(n), k), graph.ravel()])
    b = np.concatenate([graph.ravel(), np.repeat(np.arange(n), k)])
    part = np.zeros(n, np.int64)
    while part.max() + 1 < parts:
        new = part * 2
        for p in range(int(part.max()) + 1):
            nodes = np.flatnonzero(part == p)
            place = np.full(n, -1)
            place[nodes] = np.arange(len(nodes))
            inside = (place[a] >= 0) & (place[b] >= 0)
            new[nodes] += _halves((place[a[inside]], place[b[inside]]), len(nodes), rng)
        part = new
    return part


@dataclass
class Router:
    """A network with one hidden layer from a vector to the odds of the parts."""

    weights: list[np.ndarray]
    probes: int

    @property
    def parts(self) -> int:
        return self.weights[-1].shape[0]

    def odds(self, vectors: np.ndarray) -> np.ndarray:
        """Log odds up to a constant per row; directions alone count."""
        w1, b1, w2, b2 = self.weights
        unit = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-30)
        return np.maximum(unit @ w1 + b1, 0) @ w2 + b2


def train_router(vectors: np.ndarray, graph: np.ndarray, part: np.ndarray, parts: int, hidden: int = 128, epochs: int = 40, seed: int = 7) -> Router:
    """Fit the parts of each vector's neighbours, itself among them, by gradient steps with momentum estimates (Adam)."""
    rng = np.random.default_rng(seed)
    n, dim = vectors.shape
    unit = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-30)
    target = np.zeros((n, parts))
    for column in np.column_stack([np.arange(n), graph]).T:
        np.add.at(target, (np.arange(n), part[column]), 1.0)
    target /= target.sum(axis=1, keepdims=True)
    weights = [
        rng.standard_normal((dim, hidden)) * np.sqrt(2 / dim) * np.sqrt(dim) / 4,
        np.zeros(hidden),
        rng.standard_normal((hidden, parts)) * np.sqrt(1 / hidden),
        np.zeros(parts),
    ]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(n)
        for at in range(0, n, 256):
            rows = order[at : at + 256]
            x, y = unit[rows], target[rows]
            h = np.maximum(x @ weights[0] + weights[1], 0)
            z = h @ weights[2] + weights[3]
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            d = (p - y) / len(rows)
            dh = (d @ weights[2].T) * (h > 0)
            grads = [x.T @ dh, dh.sum(0), h.T @ d, d.sum(0)]
            step += 1
            for w, g, m, v in zip(weights, grads, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= 0.003 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Router(weights, parts)


def calibrated(router: Router, vectors: np.ndarray, graph: np.ndarray, rows: np.ndarray, recall: float) -> Router:
    """The fewest parts per query that hold ``recall`` of the neighbours of the given rows."""
    odds = router.odds(vectors)
    home = odds.argmax(axis=1)
    rank = np.empty(odds[rows].shape, np.int64)
    np.put_along_axis(rank, np.argsort(-odds[rows], axis=1, kind="stable"), np.arange(router.parts)[None, :], axis=1)
    needed = np.take_along_axis(rank, home[graph[rows]], axis=1)
    share = np.cumsum(np.bincount(needed.ravel(), minlength=router.parts)) / needed.size
    return Router(router.weights, min(router.parts, int(np.searchsorted(share, recall) + 1)))


def fit(sample: np.ndarray, parts: int, neighbours: int = 20, recall: float = 0.97) -> Router:
    """Graph, parts and router of a sample; a quarter is left out of the router's training to set its probes."""
    k = min(neighbours, len(sample) - 1)
    graph = neighbour_graph(sample, k)
    part = balanced_parts(graph, parts)
    rows = np.random.default_rng(11).permutation(len(sample))
    seen, unseen = rows[len(rows) // 4 :], rows[: len(rows) // 4]
    router = train_router(sample[seen], _inside(graph, seen), part[seen], parts)
    return calibrated(router, sample, graph, unseen, recall)


def _inside(graph: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Neighbour lists of ``rows`` renumbered to them; a neighbour left out becomes the row itself."""
    place = np.full(len(graph), -1)
    place[rows] = np.arange(len(rows))
    lists = place[graph[rows]]
    return np.where(lists < 0, np.arange(len(rows))[:, None], lists)


def usable(vector: Column) -> Column:
    """Not null, no null or non-finite component, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def search(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    sample_rows: int = 8_192,
    rows_per_part: int = 4_096,
    min_parts: int = 32,
    max_parts: int = 512,
    recall: float = 0.97,
    block_rows: int = 4_096,
    block_queries: int = 2_048,
) -> DataFrame:
    """The ``k`` nearest rows found for each row that ``is_query`` marks, by inner product.

    ``vectors`` has ``vec_id`` and ``embedding``; returned are ``query_id``,
    ``rank`` from 1, ``vec_id`` and ``score``, ties to the smaller id.

    Equal vectors are one row of the index with the smallest ``k + 1`` of their
    ids, so a much repeated vector costs no more than any other.  The router is
    fitted on ``sample_rows`` vectors and cuts about ``rows_per_part`` rows a
    part, at least ``min_parts`` and at most ``max_parts``, sixteen vectors of
    the sample in each.  A part is searched in blocks of ``block_rows``
    rows by ``block_queries`` queries, which bounds a task whatever the size of
    the part.  A query goes to as many parts as the sample needs for
    ``recall``, and to more until ``k + 1`` vectors are in reach; with fewer
    candidates than ``k`` all of them are returned.

    Vectors that are null, zero, or hold null or non-finite components take no
    part, nor do those of another length than most have, nor rows without an
    id.  Rows that repeat an id and a vector count once, and a query never
    finds rows of its own id.
    """
    kept = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding"), is_query.alias("is_query")
    ).where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    lengths = kept.groupBy(F.size("embedding").alias("dim")).count().orderBy(F.desc("count"), "dim").limit(1).collect()
    schema = "query_id long, rank int, vec_id long, score double"
    if not lengths:
        return vectors.sparkSession.createDataFrame([], schema)
    dim = lengths[0]["dim"]
    kept = kept.where(F.size("embedding") == dim).groupBy("vec_id", "embedding").agg(F.max("is_query").alias("is_query"))

    smallest = Window.partitionBy("embedding").orderBy("vec_id")
    ids = (
        kept.withColumn("place", F.row_number().over(smallest))
        .where(F.col("place") <= k + 1)
        .groupBy("embedding")
        .agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    )
    index = staged(ids.withColumn("key", F.monotonically_increasing_id()), "vectors")
    n = index.count()

    sample = index.orderBy(F.xxhash64("embedding"), "key").limit(sample_rows).select("embedding").toArrow()
    points = _matrix(sample.column("embedding"), dim)
    parts = 1
    while parts * 2 <= min(max_parts, max(min_parts, n // rows_per_part), len(points) // 16):
        parts *= 2
    router = fit(points, parts, k, recall) if parts > 1 else None
    shared = vectors.sparkSession.sparkContext.broadcast(router)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            points = _matrix(batch.column("embedding"), dim)
            part = model.odds(points).argmax(axis=1) if model else np.zeros(len(points), np.int64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(part, pa.int32())], names=[*batch.schema.names, "part"]
            )

    element = index.schema["embedding"].dataType.simpleString()  # float or double, as given
    placed = staged(index.mapInArrow(place, f"embedding {element}, ids array<long>, key long, part int"), "parts")
    sizes = [0] * parts
    for row in placed.groupBy("part").count().collect():
        sizes[row["part"]] = row["count"]

    members = kept.where("is_query").select(F.col("vec_id").alias("query_id"), "embedding")
    asked = members.join(index.select("embedding", "key"), "embedding").select("query_id", "key")
    asked = staged(asked, "queries")
    queries = index.join(asked.select("key").distinct(), "key", "left_semi").select("key", "embedding")

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, size = shared.value, np.array(sizes)
        for batch in batches:
            points = _matrix(batch.column("embedding"), dim)
            order = np.argsort(-model.odds(points), axis=1, kind="stable") if model else np.zeros((len(points), 1), np.int64)
            probes = model.probes if model else 1
            reach = np.cumsum(size[order], axis=1)
            enough = np.argmax(reach > k, axis=1) + 1
            enough = np.where(reach[:, -1] > k, enough, order.shape[1])
            take = np.arange(order.shape[1])[None, :] < np.maximum(probes, enough)[:, None]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    batch.column("embedding"),
                    pa.array([row[use].tolist() for row, use in zip(order, take)], pa.list_(pa.int32())),
                ],
                names=["key", "embedding", "parts"],
            )

    routed = staged(
        queries.mapInArrow(route, f"key long, embedding {element}, parts array<int>"), "routes"
    ).withColumn("part", F.explode("parts"))
    asked_of = [0] * parts
    for row in routed.groupBy("part").count().collect():
        asked_of[row["part"]] = row["count"]
    # (all keys of the cogroup are ints: an int and a long hash to different partitions)
    # both sides of a part are cut into blocks, and every block of rows meets every block of queries
    row_blocks = F.array(*(F.lit(max(1, -(-x // block_rows))) for x in sizes))
    query_blocks = F.array(*(F.lit(max(1, -(-x // block_queries))) for x in asked_of))
    spread = F.xxhash64("key")
    rows = placed.select(
        "part",
        F.pmod(spread, row_blocks[F.col("part")]).cast("int").alias("row_block"),
        F.explode(F.sequence(F.lit(0), query_blocks[F.col("part")] - 1)).alias("query_block"),
        "key",
        F.col("ids")[0].alias("least"),
        "embedding",
    )
    sent = routed.select(
        "part",
        F.explode(F.sequence(F.lit(0), row_blocks[F.col("part")] - 1)).alias("row_block"),
        F.pmod(spread, query_blocks[F.col("part")]).cast("int").alias("query_block"),
        "key",
        "embedding",
    )

    def rerank(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["query", "key", "score"]
        if not left.num_rows or not right.num_rows:
            return pa.table({"query": pa.array([], pa.int64()), "key": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        # rows in order of their smallest id, so that a stable sort breaks ties by it
        order = np.argsort(left.column("least").to_numpy(), kind="stable")
        points = _matrix(left.column("embedding"), dim)[order]
        keys = left.column("key").to_numpy()[order]
        asking = _matrix(right.column("embedding"), dim)
        asking_keys = right.column("key").to_numpy()
        out: list[list[np.ndarray]] = [[], [], []]
        take = min(k + 1, len(points))
        for at in range(0, len(asking), 256):
            scores = asking[at : at + 256] @ points.T
            if take < len(points):
                edge = -np.partition(-scores, take - 1, axis=1)[:, take - 1 : take]
            else:
                edge = scores.min(axis=1, keepdims=True)
            query, row = np.nonzero(scores >= edge)
            value = scores[query, row]
            best = np.lexsort((row, -value, query))
            query, row, value = query[best], row[best], value[best]
            place = np.arange(len(query)) - np.searchsorted(query, query)
            first = place < take
            out[0].append(asking_keys[at + query[first]])
            out[1].append(keys[row[first]])
            out[2].append(value[first])
        return pa.table(dict(zip(names, (np.concatenate(x) for x in out))))

    blocks = ["part", "row_block", "query_block"]
    near = (
        rows.groupBy(*blocks)
        .cogroup(sent.groupBy(*blocks))
        .applyInArrow(rerank, "query long, key long, score double")
    )
    best = Window.partitionBy("query").orderBy(F.desc("score"), "least")
    found = (
        near.join(index.select("key", "ids"), "key")
        .withColumn("least", F.col("ids")[0])
        .withColumn("place", F.row_number().over(best))
        .where(F.col("place") <= k + 1)
        .select("query", "score", F.explode("ids").alias("vec_id"))
    )
    in_order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    found = found.withColumn("place", F.row_number().over(in_order)).where(F.col("place") <= k + 1).drop("place")
    of_query = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        asked.join(found, asked["key"] == found["query"])
        .where("query_id <> vec_id")
        .groupBy("query_id", "vec_id")
        .agg(F.max("score").alias("score"))
        .withColumn("rank", F.row_number().over(of_query))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
