"""One row per key, and the largest rows of a frame, with total orders."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.operators.lookup import LOOKUP_BYTES, LOOKUP_ROWS, counted, hashed, text_bytes


def one_per_key(rows: DataFrame, keys: Sequence[str], first: Sequence[Column] = ()) -> DataFrame:
    """Keep the first row of every key, NULL keys being equal.

    ``first`` leads the order and all remaining columns complete it, so the
    winner does not depend on arrival order.  ``rank = 1`` lets Spark cut each
    key to one row per task before the shuffle, however many copies there are.
    """
    rest = [F.col(name).asc_nulls_first() for name in rows.columns if name not in keys]
    window = Window.partitionBy(*keys).orderBy(*first, *rest)
    return rows.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") == 1).drop("_rank")


def row_number_of(names: Sequence[str], digits: int = 15) -> Column:
    """A whole number from the MD5 of the named values as text; NULL values have a mark of their own.

    It depends on the row alone, not on the order of columns, and any engine can work it out.
    """
    text = F.concat_ws("|", *[F.coalesce(F.col(name).cast("string"), F.lit("\u2205")) for name in sorted(names)])
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("long")


def one_per_rare_key(rows: DataFrame, key: str, limit: int = LOOKUP_ROWS) -> DataFrame:
    """One row per ``key``: the one with the smallest ``row_number_of``; rows without a key stay.

    Where most keys have one row, only the keys are counted by shuffle.  The
    repeated ones are measured and sent to the rows, which stay where they are;
    rows of repeated keys alone are aggregated, down to the smallest number and
    then to distinct rows.  Where the repeated keys are too many to send, every
    row moves once, see ``one_per_common_key``.  Nothing is sorted, and a key
    with a third of all rows is one row per task.  Unequal rows of one key with
    the same 60-bit number would both stay.
    """
    n, distinct = rows.agg(F.count(key), F.approx_count_distinct(key, 0.01)).first()
    # a repeated key has two rows at least and may have any number, so only the far end is settled by this
    if distinct > limit and n - distinct > max(n // 4, limit):
        return one_per_common_key(rows, key)
    keyed = rows.where(F.col(key).isNotNull())  # what has no key matches none
    repeated = keyed.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(key)
    stored, n_keys = counted(repeated)
    if n_keys > limit or text_bytes(stored) > LOOKUP_BYTES:
        return one_per_common_key(rows, key)
    keys = F.broadcast(stored)
    single = rows.join(keys, key, "left_anti")
    numbered = rows.join(keys, key, "left_semi").withColumn("_number", row_number_of(rows.columns))
    least = hashed(numbered.groupBy(key).agg(F.min("_number").alias("_number")), limit)
    winners = numbered.join(least, [key, "_number"], "left_semi").select(rows.columns).distinct()
    return single.unionByName(winners)


def one_per_common_key(rows: DataFrame, key: str) -> DataFrame:
    """As ``one_per_rare_key`` where keys are repeated as a rule.

    Keys and numbers are aggregated first; then every row goes once to where the
    winner of its key and number is, by hash, and what is left is made distinct
    there.  The rows are read twice and never sorted.
    """
    numbered = rows.withColumn("_number", row_number_of(rows.columns))
    least = numbered.groupBy(key).agg(F.min("_number").alias("_number"))
    met = numbered.join(least.hint("shuffle_hash"), [key, "_number"], "left_semi")
    # the rows lie by key and number, so this moves nothing
    return met.distinct().drop("_number").unionByName(rows.where(F.col(key).isNull()))


def largest(rows: DataFrame, n: int, by: str, *ties: str) -> DataFrame:
    """The ``n`` rows with the largest ``by``; ``ties`` complete the order."""
    return rows.where(F.col(by).isNotNull()).orderBy(F.col(by).desc(), *[F.col(tie).asc() for tie in ties]).limit(n)


def hash_bucket(names: Sequence[str], seed: int, buckets: int = 100) -> Column:
    """A number below ``buckets`` from the MD5 of the named values as text.

    It depends on the row alone, not on partitions, and any engine can work it
    out.  NULL values are left out of the text.
    """
    text = F.concat_ws("|", *[F.col(name).cast("string") for name in names], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % buckets


def sample_rows(rows: DataFrame, keys: Sequence[str], percent: int, seed: int) -> DataFrame:
    """About ``percent`` of the rows, the same in every run and partitioning."""
    return rows.where(hash_bucket(keys, seed) < percent)


#: Bits of a number that one pass tells apart.
_STEP_BITS = 12


def smallest_per_group(rows: DataFrame, group: str, number: str, wanted: Mapping[object, int], bits: int = 60) -> dict:
    """For every group the number of its ``wanted``-th smallest row, and how many rows with that very number count.

    An exact quantile by refinement: a pass counts the rows of a group by the
    next bits of their number inside the range that holds the wanted row, so it
    hands the driver some thousand counts per group whatever the number of rows.
    A group with fewer rows than wanted has no entry.  Numbers are below ``1 << bits``.
    """
    low = {name: 0 for name, n in wanted.items() if n > 0}
    rest = {name: wanted[name] for name in low}
    found: dict = {}
    width = bits
    while low:
        step = min(_STEP_BITS, width)
        width -= step
        inside = F.lit(False)
        for name, start in low.items():
            of_group = F.col(group).eqNullSafe(F.lit(name))
            inside = inside | (of_group & (F.shiftright(number, width + step) == F.lit(start >> (width + step)).cast("long")))
        counts: dict = {name: {} for name in low}
        part = rows.where(inside).groupBy(group, F.shiftright(number, width).alias("part")).agg(F.count(F.lit(1)).alias("n"))
        for name, value, n in part.collect():
            counts[name][value] = n
        for name in list(low):
            if sum(counts[name].values()) < rest[name]:
                del low[name]
                continue
            for value in sorted(counts[name]):
                if rest[name] <= counts[name][value]:
                    low[name] = value << width
                    break
                rest[name] -= counts[name][value]
            if width == 0:
                found[name] = (low.pop(name), rest[name])
    return found
