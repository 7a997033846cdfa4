"""Near-duplicate groups by HyperMinHash sketches, banding and exact confirmation.

A document's 5-word shingles are hashed once.  The hash picks a bucket, and the
bucket keeps its smallest value compressed to the count of leading zeros and
ten mantissa bits behind the leading one.  Four registers make one 64-bit band
key.  Documents that share a band key are candidates, the collision-corrected
estimate of their similarity drops the hopeless ones, and the rest are
confirmed on full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.tables import rows_of, staged
from tarmac.llm.word_hashes import MIX, mixed, word_hashes

SHINGLE = 5
BANDS, ROWS = 32, 4
BUCKETS = BANDS * ROWS
MANTISSA = 10
#: Bits of a hash that pick a bucket's value, and the largest count of leading zeros a register holds.
VALUE_BITS, MOST_ZEROS = 48, 63
#: Shingles of the smaller set below which a pair is decided without an estimate, as many registers are borrowed.
FEW = 128

def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles.

    Words are runs of bytes other than ASCII white space, A-Z in lower case.  A
    text of fewer than five words is one shingle; one without words has none.
    """
    hashes = word_hashes(text)
    if not len(hashes):
        return np.empty(0, np.uint64)
    n = max(1, len(hashes) - SHINGLE + 1)
    width = min(SHINGLE, len(hashes))
    total = np.full(n, width, np.uint64)
    for k in range(width):
        total = mixed(total * MIX + hashes[k : k + n])
    return np.unique(total)


def probes() -> np.ndarray:
    """For every bucket the order, over all buckets, in which an empty one looks for a value to borrow."""
    at = np.arange(BUCKETS * BUCKETS, dtype=np.uint64).reshape(BUCKETS, BUCKETS)
    return np.argsort(mixed(at + MIX), axis=1)


_PROBES = probes()


def registers(hashes: np.ndarray) -> np.ndarray:
    """One 16-bit register per bucket of a sorted, non-empty set.

    Empty buckets borrow from the first filled bucket of their own random
    order, which keeps the chance of agreement at the Jaccard similarity.
    """
    bucket = ((hashes >> np.uint64(32)) * np.uint64(BUCKETS) >> np.uint64(32)).astype(np.int64)
    first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
    filled = np.zeros(BUCKETS, bool)
    filled[bucket[first]] = True
    # the value is mixed anew, so it does not depend on the bucket; its minimum needs all of a bucket's hashes
    values = mixed(hashes + MIX) >> np.uint64(64 - VALUE_BITS)
    least = np.zeros(BUCKETS, np.uint64)
    least[bucket[first]] = np.minimum.reduceat(values, first)
    length = np.frexp(least.astype(float))[1]  # bits of the value: exact, as 48 bits fit a double
    zeros = np.minimum(VALUE_BITS - length, MOST_ZEROS)
    behind = np.maximum(length - 1, 0)
    tail = least - np.where(length > 0, np.uint64(1) << behind.astype(np.uint64), np.uint64(0))
    up = np.maximum(MANTISSA - behind, 0).astype(np.uint64)
    down = np.maximum(behind - MANTISSA, 0).astype(np.uint64)
    register = (zeros.astype(np.uint64) << np.uint64(MANTISSA)) | ((tail << up) >> down)
    if not filled.all():
        empty = np.flatnonzero(~filled)
        reach = filled[_PROBES[empty]]
        register[empty] = register[_PROBES[empty, np.argmax(reach, axis=1)]]
    return register


def band_keys(register: np.ndarray) -> np.ndarray:
    """Four registers per 64-bit key; no information is lost."""
    lanes = register.reshape(BANDS, ROWS)
    key = np.zeros(BANDS, np.uint64)
    for k in range(ROWS):
        key = (key << np.uint64(16)) | lanes[:, k]
    return key.view(np.int64)


def sketches(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_shingles``, a 128-bit digest of the set, its first half as a number, and the band keys.

    An empty set has no band keys.
    """

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest

        for batch in batches:
            sizes, digests, halves, keys = [], [], [], []
            for text in batch.column("text"):
                found = shingle_set(text.as_py())
                sizes.append(len(found))
                digests.append(xxh3_128_digest(found.tobytes()))
                halves.append(_half(digests[-1]))
                keys.append(band_keys(registers(found)) if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(sizes, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array(halves, pa.int64()),
                    pa.array(keys, pa.list_(pa.int64())),
                ],
                names=["doc_id", "n_shingles", "digest", "half", "bands"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        sketch, "doc_id long, n_shingles long, digest binary, half long, bands array<long>"
    )


def _half(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "little", signed=True)


def full_sets(rows: DataFrame) -> DataFrame:
    """``id`` and sorted shingle hashes of the rows of ``id``, ``half`` and ``text`` whose set has that half digest.

    An id of a document may stand on several texts; only the one that is meant is taken.
    """

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest

        for batch in batches:
            ids, held, size = [], [], 0
            halves = zip(batch.column("id").to_pylist(), batch.column("half").to_pylist())
            for at, ((own, half), text) in enumerate(zip(halves, batch.column("text"))):
                found = shingle_set(text.as_py())
                if _half(xxh3_128_digest(found.tobytes())) == half:
                    ids.append(own)
                    held.append(found)
                    size += len(found)
                if held and (size > 1_000_000 or at == batch.num_rows - 1):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(ids, pa.int64()),
                            pa.ListArray.from_arrays(
                                pa.array(np.append(0, np.cumsum([len(x) for x in held])), pa.int32()),
                                pa.array(np.concatenate(held).view(np.int64)),
                            ),
                        ],
                        names=["id", "shingles"],
                    )
                    ids, held, size = [], [], 0

    return rows.select("id", "half", "text").mapInArrow(shingles, "id long, shingles array<long>")


#: Chance that registers of unrelated sets agree: equal counts of leading zeros (the sum of 4^-k) and mantissas.
CHANCE = (1 / 3) / (1 << MANTISSA)


def estimate(a: Column, b: Column, n_a: Column, n_b: Column) -> Column:
    """Jaccard similarity from two arrays of band keys, corrected for registers that agree by chance.

    With unequal sets the smaller count is rarer, so ``CHANCE`` is an upper
    bound of the collisions.  No similarity exceeds the ratio of the sizes.
    """
    lanes = F.zip_with(
        a,
        b,
        lambda x, y: sum(
            (F.when(F.shiftright(x.bitwiseXOR(y), 16 * k).bitwiseAND(F.lit(0xFFFF)) == 0, 1).otherwise(0) for k in range(ROWS)),
            start=F.lit(0),
        ),
    )
    share = F.aggregate(lanes, F.lit(0), lambda total, x: total + x) / F.lit(float(BUCKETS))
    return F.least((share - CHANCE) / (1 - CHANCE), F.least(n_a, n_b) / F.greatest(n_a, n_b))


def estimates(keys: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The same between all rows of a small matrix of band keys."""
    registers_of = keys.view(np.uint16).reshape(len(keys), BUCKETS)
    share = np.array([(registers_of == row).mean(axis=1) for row in registers_of])
    ratio = np.minimum(sizes[:, None], sizes) / np.maximum(sizes[:, None], sizes)
    return np.minimum((share - CHANCE) / (1 - CHANCE), ratio)


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a``, ``b`` whose sets are linked: 100 * intersection >= percent * union."""
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("a_set"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("b_set"))
    # b first: its set goes along with the pair, while the set of the much shared a is sent once
    both = pairs.join(right, "b").join(left, "a")
    shared = F.size(F.array_intersect("a_set", "b_set"))
    union = F.size("a_set") + F.size("b_set") - F.col("shared")
    return (
        both.select("a", "b", "a_set", "b_set", shared.alias("shared"))
        .where(100 * F.col("shared") >= percent * union)
        .select("a", "b")
    )


def components(edges: DataFrame) -> DataFrame:
    """Smallest reachable id (``label``) of every ``id`` in the edges ``a``, ``b`` but for that smallest one.

    Large-star and small-star steps in turn: every node hands its smallest
    neighbour to the others, until nothing changes.  The number of edges never
    grows, no group is gathered, and the steps grow with the logarithm of the
    longest chain.
    """

    def undirected(e: DataFrame) -> DataFrame:
        return e.select("a", "b").union(e.select(F.col("b"), F.col("a")))

    def star(e: DataFrame, neighbours: DataFrame, least: DataFrame, keep: Column) -> DataFrame:
        joined = neighbours.join(least, "a").where(keep)
        return joined.select(F.col("least").alias("a"), F.col("b")).where("a <> b").distinct()

    edges = staged(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    while True:
        # large star: larger neighbours of a node go to the smallest of its neighbourhood
        both = undirected(edges)
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
        large = star(edges, both, least, F.col("b") > F.col("a"))
        # small star: a node and its smaller neighbours go to the smallest of them
        down = large.select(F.col("b").alias("a"), F.col("a").alias("b"))
        lowest = down.groupBy("a").agg(F.min("b").alias("least"))
        small = star(large, down.union(lowest.select("a", F.col("a").alias("b"))), lowest, F.lit(True))
        after = staged(small, "edges")
        # done when every node hangs on one root and no root hangs on another
        same = after.count() == edges.count() and after.join(edges, ["a", "b"], "left_anti").isEmpty()
        edges = after
        if same:
            break
    return edges.groupBy(F.col("b").alias("id")).agg(F.min("a").alias("label"))


def groups(
    docs: DataFrame,
    percent: int = 75,
    floor: float = 0.55,
    small_bucket: int = 64,
    broadcast_rows: int = 2_000_000,
) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` for every row of ``docs``.

    Rows with equal shingle sets are one class from the start.  First every
    class of a band bucket is compared with the bucket's smallest one, which
    joins nearly all copies at a few comparisons each.  Then all classes of a
    bucket that are still apart are compared: by estimate and full sets up to
    ``small_bucket`` classes, beyond that in blocks, in tasks of bounded size
    that hold the full sets and hand on only links that join something.  So no
    pair of a bucket goes unconfirmed and none is written out in vain.

    At a similarity of 0.75 a pair shares no band with probability
    (1 - 0.75^4)^32 = 5e-6; ``floor`` lies five standard deviations below
    for sets that fill their registers; pairs with a set of fewer than ``FEW``
    shingles are decided on full sets whatever their estimate.

    Null and empty texts, and texts without words, have no shingles and no
    link.  A row without an id has null as its component and is not kept.  Rows
    that share an id are returned each, by their own text.
    """
    return _grouped(docs, percent, floor, small_bucket, broadcast_rows).select("doc_id", "n_shingles", "component_id", "kept")


def _grouped(
    docs: DataFrame, percent: int = 75, floor: float = 0.55, small_bucket: int = 64, broadcast_rows: int = 2_000_000
) -> DataFrame:
    """The rows of ``groups`` with the ``digest`` of the set and the ``label`` of its group.

    Unlike ``component_id`` the label tells groups apart whose smallest id stands on a text of each.
    """
    sketched = staged(sketches(docs), "sketches")
    classes = staged(
        sketched.where("n_shingles > 0 and doc_id is not null")
        .groupBy("n_shingles", "digest", "half")
        .agg(F.min("doc_id").alias("first"), F.first("bands").alias("bands")),
        "classes",
    )
    # an id that is the smallest of several texts cannot name a class; a number of its own can, once it is written
    sizes = classes.agg(F.count("*").alias("n"), F.countDistinct("first").alias("ids")).first()
    numbered = sizes["n"] != sizes["ids"]
    if numbered:
        classes = staged(classes.withColumn("id", F.monotonically_increasing_id()), "numbered")
    else:
        classes = classes.withColumn("id", F.col("first"))
    members = staged(_members(classes), "members")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    wanted = members.select("id").distinct().join(classes, "id").select(F.col("first").alias("doc_id"), "id", "half")
    wanted = staged(wanted, "wanted")
    sets = staged(full_sets(rows_of(texts, wanted, "doc_id", "inner", broadcast_rows)), "sets")
    if sets.count() != wanted.count():  # a row that stands there more than once
        sets = sets.groupBy("id").agg(F.min("shingles").alias("shingles"))
    sketch_of = classes.select("id", "n_shingles", "bands")

    heads = members.groupBy("bucket").agg(F.min("id").alias("a"))
    pairs = members.join(heads, "bucket").where("id <> a").select("a", F.col("id").alias("b")).distinct()
    near = _estimated(pairs, sketch_of).where((F.col("estimate") >= floor) | (F.col("n") < FEW)).select("a", "b")
    links = staged(verified(near, sets, percent), "links")
    apart = staged(_apart(members, components(links), sketch_of), "apart")
    candidates = staged(_near_in_small_buckets(apart.where(F.col("n") <= small_bucket), sketch_of, floor), "candidates")
    more = verified(candidates, sets, percent).union(
        _links_in_large_buckets(apart.where(F.col("n") > small_bucket), sets, percent)
    )
    labels = staged(components(links.union(more)), "labels")

    of_class = classes.select("n_shingles", "digest", "id", "first").join(labels, "id", "left")
    if numbered:
        of_class = of_class.withColumn("label", F.coalesce("label", "id"))
        least = of_class.groupBy("label").agg(F.min("first").alias("component"))
        of_class = of_class.join(least, "label")
    else:
        of_class = of_class.withColumn("component", F.coalesce("label", "first")).withColumn("label", F.col("component"))
    found = sketched.select("doc_id", "n_shingles", "digest").join(
        of_class.select("n_shingles", "digest", "component", "label"), ["n_shingles", "digest"], "left"
    )
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return found.select(
        "doc_id",
        "n_shingles",
        "digest",
        "label",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"),
    )


def _members(classes: DataFrame) -> DataFrame:
    """``bucket`` and ``id`` for every band bucket that two classes share."""
    keyed = classes.select("id", F.posexplode("bands").alias("band", "key")).select(
        F.xxhash64("band", "key").alias("bucket"), "id"
    )
    shared = keyed.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket")
    return keyed.join(shared, "bucket")


def _apart(members: DataFrame, labels: DataFrame, sketch_of: DataFrame) -> DataFrame:
    """Members of the buckets that hold more than one component: ``bucket``, ``id``, ``label``, size and shingles of the bucket."""
    sized = sketch_of.select("id", "n_shingles").join(labels, "id", "left")
    labelled = members.join(sized, "id").withColumn("label", F.coalesce("label", "id"))
    buckets = (
        labelled.groupBy("bucket")
        .agg(
            F.count("*").alias("n"),
            F.sum("n_shingles").alias("values"),
            F.min("label").alias("low"),
            F.max("label").alias("high"),
        )
        .where("low <> high")
        .select("bucket", "n", "values")
    )
    return labelled.join(buckets, "bucket").select("bucket", "id", "label", "n", "values")


def _near_in_small_buckets(apart: DataFrame, sketch_of: DataFrame, floor: float) -> DataFrame:
    """Pairs ``a``, ``b`` of one bucket in different components whose estimate reaches ``floor``, and those with a small set."""

    def compare(bucket: tuple, rows: pa.Table) -> pa.Table:
        ids, labels = rows.column("id").to_numpy(), rows.column("label").to_numpy()
        keys = rows.column("bands").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(ids), BANDS)
        sizes = rows.column("n_shingles").to_numpy()
        close = (estimates(np.ascontiguousarray(keys), sizes) >= floor) | (np.minimum(sizes[:, None], sizes) < FEW)
        one, other = np.nonzero(np.triu(close & (labels[:, None] != labels), 1))
        return pa.table(
            {"a": np.minimum(ids[one], ids[other]), "b": np.maximum(ids[one], ids[other])},
            schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]),
        )

    sketched = apart.select("bucket", "id", "label").join(sketch_of, "id")
    return sketched.groupBy("bucket").applyInArrow(compare, "a long, b long").distinct()


def _links_in_large_buckets(apart: DataFrame, sets: DataFrame, percent: int, block: int = 512, block_values: int = 2_000_000) -> DataFrame:
    """Links ``a``, ``b`` between components of one bucket, enough of them to join whatever is linked.

    A bucket is cut into blocks by count and by shingles, and each pair of
    blocks is one group of rows.
    """
    blocks = F.greatest(F.ceil(F.col("n") / block), F.ceil(F.col("values") / block_values)).cast("int")
    mine = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    rows = (
        apart.withColumn("blocks", blocks)
        .withColumn("mine", mine)
        .select("bucket", "id", "label", "mine", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
        .select("bucket", "id", "label", F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"))
        .join(sets, "id")
    )

    def link(key: tuple, rows: pa.Table) -> pa.Table:
        ids, labels = rows.column("id").to_numpy(), rows.column("label").to_numpy()
        shingles = rows.column("shingles").combine_chunks()
        ends = np.cumsum(pc.list_value_length(shingles).to_numpy())
        one, other = spanning_links(shingles.flatten().to_numpy(zero_copy_only=False), ends, labels, percent)
        return pa.table(
            {"a": np.minimum(ids[one], ids[other]), "b": np.maximum(ids[one], ids[other])},
            schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]),
        )

    return rows.groupBy("bucket", "low", "high").applyInArrow(link, "a long, b long").distinct()


def spanning_links(values: np.ndarray, ends: np.ndarray, labels: np.ndarray, percent: int, columns: int = 4_096):
    """Pairs of sets that are linked and whose labels no earlier pair has joined.

    Sets stand one behind the other in ``values``.  Shingles of one set alone
    add nothing to an intersection; the others are columns of a 0-1 matrix that
    is multiplied ``columns`` at a time.
    """
    n = len(ends)
    sizes = np.diff(ends, prepend=0)
    row = np.repeat(np.arange(n), sizes)
    _, column, times = np.unique(values, return_inverse=True, return_counts=True)
    place = np.cumsum(times > 1) - 1
    common = times[column] > 1
    row, column = row[common], place[column[common]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    shared = np.zeros((n, n), np.float32)
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, columns):
        low, high = np.searchsorted(column, [start, start + columns])
        part = np.zeros((n, columns), np.float32)
        part[row[low:high], column[low:high] - start] = 1
        shared += part @ part.T
    linked = 100 * shared >= percent * (sizes[:, None] + sizes - shared)
    root = {label: label for label in labels.tolist()}

    def top(label: int) -> int:
        while root[label] != label:
            root[label] = label = root[root[label]]
        return label

    kept = []
    for one, other in np.argwhere(np.triu(linked & (labels[:, None] != labels), 1)).tolist():
        a, b = top(int(labels[one])), top(int(labels[other]))
        if a != b:
            root[max(a, b)] = min(a, b)
            kept.append((one, other))
    pairs = np.array(kept, np.int64).reshape(-1, 2)
    return pairs[:, 0], pairs[:, 1]


def _estimated(pairs: DataFrame, sketch_of: DataFrame) -> DataFrame:
    left = sketch_of.select(F.col("id").alias("a"), F.col("n_shingles").alias("n_a"), F.col("bands").alias("a_bands"))
    right = sketch_of.select(F.col("id").alias("b"), F.col("n_shingles").alias("n_b"), F.col("bands").alias("b_bands"))
    joined = pairs.join(right, "b").join(left, "a")
    close = estimate(F.col("a_bands"), F.col("b_bands"), F.col("n_a"), F.col("n_b"))
    return joined.select("a", "b", close.alias("estimate"), F.least("n_a", "n_b").alias("n"))


def keep_one(docs: DataFrame, percent: int = 75) -> DataFrame:
    """One document of each group, the one with the smallest id, with all its columns.

    Documents without an id are kept, as nothing links them.  Rows that share
    an id are told apart by their shingle sets: those of one group share one
    place, those of different groups each have their own.
    """
    found = staged(_grouped(docs, percent), "groups").where("doc_id is not null")
    dropped = staged(found.where("not kept").select("doc_id").distinct(), "dropped")
    repeated = staged(found.groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated")
    if repeated.isEmpty():
        return rows_of(docs, dropped, "doc_id", "left_anti").select(docs.columns)
    gone = staged(dropped.union(repeated).distinct(), "gone")
    rest = rows_of(docs, gone, "doc_id", "left_anti").select(docs.columns)
    # only the rows of repeated ids are dealt out, and each place keeps its first row by text
    places = found.where("kept").join(repeated, "doc_id", "left_semi").select("doc_id", "digest", "label").distinct()
    one = (
        _digested(rows_of(docs, repeated, "doc_id").select(docs.columns))
        .join(places, ["doc_id", "digest"])
        .groupBy("doc_id", "label")
        .agg(F.min_by("row", F.struct(F.xxhash64("row.text"), F.col("row.text"))).alias("row"))
    )
    return rest.unionByName(one.select("row.*"))


def _digested(docs: DataFrame) -> DataFrame:
    """``doc_id``, the whole ``row`` and the ``digest`` of its shingle set."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest

        for batch in batches:
            own = [xxh3_128_digest(shingle_set(text.as_py()).tobytes()) for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row"), pa.array(own, pa.binary())], names=["doc_id", "row", "digest"]
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.struct(*docs.columns).alias("row"), "text")
    return rows.mapInArrow(digest, rows.select("doc_id", "row").schema.add("digest", "binary"))
