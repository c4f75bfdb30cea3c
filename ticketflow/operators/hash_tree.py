"""A hash tree over a table, and the difference of two tables found through it.

A leaf is the order-insensitive fingerprint of the rows of one key bucket of one
partition, a node above it that of the whole partition, the root that of the table. One
aggregate scan makes the leaves; nodes and root are sums of them. Two trees are
compared downwards: equal roots end the work, and only leaves of differing
partitions are compared. Then only the rows of differing leaves are read with their
contents, so what is shuffled is in proportion to the damage and not to the table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 4096
# Differing partitions up to which they become filters that prune the scan.
MAX_PRUNED = 200
SUMS = ("rows", "h1", "h2")


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def _flagged(columns: Sequence[str]) -> list[Column]:
    """Each column with its NULL flag: the hash functions skip NULLs, so that a value could move between columns unseen."""
    return [x for c in columns for x in (_q(c).isNull(), _q(c))]


def bucket_of(key: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(0), *_flagged(key)), F.lit(buckets))


def row_sums(columns: Sequence[str]) -> list[Column]:
    """Row count and decimal sums of two 64-bit row hashes, as aggregates."""
    cols = _flagged(columns)
    return [F.count(F.lit(1)).alias("rows"), F.sum(F.xxhash64(F.lit(1), *cols).cast("decimal(38,0)")).alias("h1"),
            F.sum(F.xxhash64(F.lit(2), *reversed(cols)).cast("decimal(38,0)")).alias("h2")]


@dataclass
class HashTree:
    """Leaves ``(partition columns, bucket, rows, h1, h2)``; the levels above are sums of them."""

    leaves: DataFrame
    partition_by: tuple[str, ...]
    key: tuple[str, ...]
    buckets: int

    def nodes(self) -> DataFrame:
        return self.leaves.groupBy(*map(_q, self.partition_by)).agg(*[F.sum(c).alias(c) for c in SUMS])

    def root(self) -> tuple:
        return tuple(self.leaves.agg(*[F.sum(c) for c in SUMS]).first())


def hash_tree(df: DataFrame, key: Sequence[str] = (), partition_by: Sequence[str] = (), buckets: int = BUCKETS,
              keep: Callable[[DataFrame], DataFrame] | None = None) -> HashTree:
    """The tree of ``df``; ``key`` (all columns if there is none) decides a row's bucket.

    ``keep`` writes the leaves, a table of at most ``buckets`` rows a partition, which
    may lie beside a copy and then stands for it without a scan.
    """
    key = tuple(key) or tuple(df.columns)
    leaves = (df.select("*", bucket_of(key, buckets).alias("__bucket")).groupBy(*map(_q, partition_by), "__bucket")
              .agg(*row_sums(df.columns)))
    return HashTree(keep(leaves) if keep else leaves, tuple(partition_by), key, buckets)


def _unequal(a: DataFrame, b: DataFrame, on: Sequence[str]) -> DataFrame:
    """Keys ``on`` whose sums differ or that only one side has: no two rows of both sides cancel out."""
    both = a.select(*map(_q, on), *SUMS).exceptAll(b.select(*map(_q, on), *SUMS))
    other = b.select(*map(_q, on), *SUMS).exceptAll(a.select(*map(_q, on), *SUMS))
    return both.union(other).select(*map(_q, on)).distinct()


def _matching(on: Sequence[str], row: Sequence) -> Column:
    out = F.lit(True)
    for c, v in zip(on, row):
        out = out & (_q(c).isNull() if v is None else _q(c) == F.lit(v))
    return out


def _within(df: DataFrame, on: Sequence[str], keys: list) -> DataFrame:
    """Rows of ``df`` under one of a few key tuples, as a filter."""
    out = F.lit(False)
    for k in keys:
        out = out | _matching(on, k)
    return df.where(out)


@dataclass
class Difference:
    """Leaves that differ, and the filter that leaves only their rows of a table."""

    leaves: DataFrame
    tree: HashTree
    partitions: list[tuple] | None

    def rows(self, df: DataFrame) -> DataFrame:
        """The rows of ``df`` in differing leaves."""
        t = self.tree
        if self.partitions is not None:
            df = _within(df, t.partition_by, self.partitions)
        # at most one row a leaf, of a few numbers
        named = F.broadcast(self.leaves.toDF(*[f"__p{i}" for i in range(len(t.partition_by))], "__b"))
        on = bucket_of(t.key, t.buckets) == F.col("__b")
        for i, c in enumerate(t.partition_by):
            on = on & _q(c).eqNullSafe(F.col(f"__p{i}"))
        return df.join(named, on, "left_semi")


def compare_trees(a: HashTree, b: HashTree, keep: Callable[[DataFrame], DataFrame] | None = None) -> Difference | None:
    """What differs between two trees of one shape, from the root down; nothing if the roots are equal."""
    if (a.partition_by, a.key, a.buckets) != (b.partition_by, b.key, b.buckets):
        raise ValueError("trees of different shape")
    if a.root() == b.root():
        return None
    left, right, few = a.leaves, b.leaves, None
    if a.partition_by:
        parts = _unequal(a.nodes(), b.nodes(), a.partition_by).limit(MAX_PRUNED + 1).collect()
        if len(parts) <= MAX_PRUNED:
            few = [tuple(r) for r in parts]
            left, right = _within(left, a.partition_by, few), _within(right, a.partition_by, few)
    leaves = _unequal(left, right, [*a.partition_by, "__bucket"])
    return Difference(keep(leaves) if keep else leaves, a, few)
