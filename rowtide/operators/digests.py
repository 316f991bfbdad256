"""Digests of change keys by bucket, so that feeds are compared without moving what they share.

A key belongs to the bucket that the first bits of its hash name. A bucket's digest is a count and sums of
two independent 64-bit hashes in slices of 22 bits, so it does not depend on the order, digests of parts of
a feed add up to that of the whole, and a sum holds 2^41 keys. Buckets of equal digests hold the same keys as
often; that two different ones agree has a chance of some 2^-128. The tree has a level per entry of
``LEVELS``: a node is the sum of its children, and only children of differing nodes are compared.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of the hash that name a node, per level; the last are the buckets, 65,536 at most.
LEVELS = (0, 8, 16)
_SLICES = ((0, 22), (22, 22), (44, 20))
SUMS = tuple(f"{name}{i}" for name in ("a", "b") for i in range(len(_SLICES)))
#: Columns of a digest beside its bucket. Keys that are null equal nothing and are counted apart.
DIGEST = ("n", "nulls", *SUMS)


def _bucket(bits: int = LEVELS[-1]) -> Column:
    return F.shiftrightunsigned(F.xxhash64("change_key"), 64 - bits)


def key_digests(feed: DataFrame) -> DataFrame:
    """A row per bucket that the feed has keys of. Tasks fold their keys before anything is shuffled."""
    hashes = {"a": F.xxhash64("change_key"), "b": F.xxhash64(F.lit(1), "change_key")}
    slices = {
        f"{name}{i}": F.shiftrightunsigned(h, low).bitwiseAND(F.lit((1 << width) - 1))
        for name, h in hashes.items()
        for i, (low, width) in enumerate(_SLICES)
    }
    hashed = feed.select(_bucket().alias("bucket"), F.col("change_key").isNull().alias("_null"), *[c.alias(n) for n, c in slices.items()])
    sums = [F.sum(name).alias(name) for name in SUMS]
    return hashed.groupBy("bucket").agg(F.count("*").alias("n"), F.count_if("_null").alias("nulls"), *sums)


def added(digests: DataFrame) -> DataFrame:
    """The digests of several parts of a feed, added up."""
    return digests.groupBy("bucket").agg(*[F.sum(name).alias(name) for name in DIGEST])


def _level(leaves: DataFrame, bits: int) -> DataFrame:
    if bits == LEVELS[-1]:
        return leaves
    parent = F.shiftrightunsigned("bucket", LEVELS[-1] - bits).alias("bucket")
    return added(leaves.select(parent, *DIGEST))


def differing_buckets(left: DataFrame, right: DataFrame) -> DataFrame:
    """Buckets whose digests differ or that hold a null key, found from the root of the tree down."""
    differ, above = None, 0
    for bits in LEVELS:
        sides = (_level(left, bits), _level(right, bits))
        if differ is not None:
            parent = F.shiftrightunsigned("bucket", bits - above)
            # One row per node of the level above: 256 at most.
            nodes = F.broadcast(differ.withColumnRenamed("bucket", "_node"))
            sides = tuple(s.join(nodes, parent == F.col("_node"), "left_semi") for s in sides)
        zero = F.lit(0).cast("bigint")
        # Both sides as one sum, the right one negative: a node is equal where all is zero.
        both = sides[0].select("bucket", *DIGEST[:1], *SUMS, "nulls").unionByName(
            sides[1].select("bucket", *[(-F.col(n)).alias(n) for n in ("n", *SUMS)], "nulls")
        )
        total = both.groupBy("bucket").agg(*[F.sum(n).alias(n) for n in DIGEST])
        differ = total.where(reduce(Column.__or__, [F.col(n) != zero for n in DIGEST])).select("bucket")
        above = bits
    return differ


def in_buckets(feed: DataFrame, buckets: DataFrame) -> DataFrame:
    """Change keys of some buckets. The buckets, 65,536 numbers at most, go to the tasks that read the feed."""
    return feed.select("change_key").join(
        F.broadcast(buckets.withColumnRenamed("bucket", "_bucket")), _bucket() == F.col("_bucket"), "left_semi"
    )


def differences(
    left: DataFrame, right: DataFrame, left_digests: DataFrame, right_digests: DataFrame
) -> DataFrame:
    """Distinct change keys that one feed has and the other has not: ``change_key``, ``missing_in``.

    ``missing_in`` is 'right' for what ``missing_changes(left, right)`` gives and 'left' for the other
    direction. Both come from one shuffle of the keys in differing buckets. The digests must cover the
    feeds as they are given, no more and no less.
    """
    buckets = differing_buckets(left_digests, right_digests)
    sides = [
        in_buckets(feed, buckets).withColumns({"_l": F.lit(i == 0), "_r": F.lit(i == 1)})
        for i, feed in enumerate((left, right))
    ]
    found = sides[0].unionByName(sides[1]).groupBy("change_key").agg(F.max("_l").alias("_l"), F.max("_r").alias("_r"))
    alone = F.col("change_key").isNull()
    missing = F.array_compact(
        F.array(
            F.when(F.col("_l") & (~F.col("_r") | alone), F.lit("right")),
            F.when(F.col("_r") & (~F.col("_l") | alone), F.lit("left")),
        )
    )
    return found.select("change_key", F.explode(missing).alias("missing_in"))
