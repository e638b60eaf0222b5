"""Differences of two large snapshots of a table, found by digests before any row moves.

Rows fall into buckets by a hash of their key. A bucket's digest is the exclusive or
and the sum of its rows' hashes and their number, which are partial aggregates: one short
row per bucket is shuffled for either snapshot. Only rows of buckets whose digests
differ are then compared one by one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quartermill.operators.joins import match

ADDED, REMOVED, CHANGED = "added", "removed", "changed"


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """The bucket of a row."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def digests(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """One row per bucket: number, exclusive or and sum of the hashes of its rows."""
    whole = F.xxhash64(*sorted(df.columns))
    # The sum tells repeated rows apart, which an exclusive or would cancel; as a decimal it can't overflow.
    sums = [F.count(F.lit(1)).alias("n"), F.bit_xor(whole).alias("x"), F.sum(whole.cast("decimal(20,0)")).alias("s")]
    return df.groupBy(bucket_of(keys, buckets).alias("bucket")).agg(*sums)


def differing_buckets(old: DataFrame, new: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """One row with the list of buckets whose digests differ."""
    both = digests(old, keys, buckets).unionByName(digests(new, keys, buckets))
    # A bucket that is the same on both sides gives the same row twice.
    counted = both.groupBy("bucket", "n", "x", "s").agg(F.count(F.lit(1)).alias("sides")).filter("sides = 1")
    return counted.agg(F.collect_set("bucket").alias("buckets"))


def snapshot_difference(old: DataFrame, new: DataFrame, keys: Sequence[str], buckets: int = 4096) -> DataFrame:
    """Rows that were added, removed or changed, with ``change`` and the columns of ``new``.

    A key stands for one row in each snapshot; a changed one comes with its new values,
    a removed one with its old ones. NULL equals NULL. If a snapshot repeats a key, the
    smallest of its rows speaks for it. ``buckets`` bounds the list of differing ones;
    rows of equal buckets are read twice but never shuffled. Digests of 64 bits tell
    buckets apart; a change that leaves number, exclusive or and sum alike is missed.
    """
    if set(old.columns) != set(new.columns):
        raise ValueError(f"columns differ: {sorted(set(old.columns) ^ set(new.columns))}")
    rest = [c for c in new.columns if c not in keys]
    listed = differing_buckets(old, new, keys, buckets)

    def rows(df: DataFrame, name: str) -> DataFrame:
        picked = df.withColumn("__buckets", listed.scalar()).filter(F.array_contains("__buckets", bucket_of(keys, buckets)))
        return picked.groupBy(*keys).agg(F.min(F.struct(*rest) if rest else F.lit(1)).alias(name))

    before, after = rows(old, "__old"), rows(new, "__new")
    # Both sides in one grouping: no outer join, and a key meets its other side in one shuffle.
    empty_old, empty_new = (F.lit(None).cast(df.schema[c].dataType).alias(c) for df, c in ((before, "__old"), (after, "__new")))
    tagged = before.select(*keys, "__old", empty_new, F.lit(1).alias("__in_old"), F.lit(0).alias("__in_new")).unionByName(
        after.select(*keys, empty_old, "__new", F.lit(0).alias("__in_old"), F.lit(1).alias("__in_new")))
    met = tagged.groupBy(*keys).agg(*[F.max(c).alias(c) for c in ("__old", "__new", "__in_old", "__in_new")])
    change = F.when(F.col("__in_old") == 0, F.lit(ADDED)).when(F.col("__in_new") == 0, F.lit(REMOVED)).when(
        ~F.col("__old").eqNullSafe(F.col("__new")), F.lit(CHANGED))
    found = met.withColumn("change", change).filter("change IS NOT NULL")
    shown = F.when(F.col("__in_new") == 1, F.col("__new")).otherwise(F.col("__old"))
    values = found.withColumn("__row", shown)
    return values.select(*[F.col(c) if c in keys else F.col("__row")[c].alias(c) for c in new.columns], "change")


def apply_difference(old: DataFrame, difference: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The new snapshot, from the old one and its difference."""
    kept = match(old, difference.select(*keys), keys, "left_anti", null_safe=True)
    return kept.unionByName(difference.filter(F.col("change") != REMOVED).select(*old.columns))
