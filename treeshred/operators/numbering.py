"""Ordered numbering and look-back that stay spread when one group holds much of the data."""

from __future__ import annotations

from collections.abc import Sequence

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..session import broadcast_checked, portioned, stage

SMALL_GROUP = 100_000  # rows of a group that one task sorts


def number_within(df: DataFrame, name: str, group: Sequence[str], bucket: Sequence[str],
                  order: Sequence[Column | str]) -> DataFrame:
    """Add the 1-based position ``name`` of each row inside its group.

    ``bucket`` columns cut a group into ordered slices, and ``order`` sorts a
    slice. Only slice sizes are summed per group, so the rows of a hot group
    are spread over tasks by (group, bucket) and never sorted as a whole.
    """
    keys = [*group, *bucket]
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    earlier = W.partitionBy(*group).orderBy(*bucket).rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select(*[F.col(k).alias(f"_k_{k}") for k in keys],
                          F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    local = df.withColumn("_local", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    return (local.join(starts, same, "inner")
            .withColumn(name, F.col("_local") + F.col("_start"))
            .drop("_local", "_start", *[f"_k_{k}" for k in keys]))


def previous_within(df: DataFrame, name: str, group: Sequence[str], bucket: Sequence[str], order: str,
                    value: str) -> DataFrame:
    """Add ``name``: the last non-null ``value`` before each row in its group.

    Works slice by slice like ``number_within``; what a slice hands on to the
    next ones is one row per slice.
    """
    keys = [*group, *bucket]
    before = W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    tails = df.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.max_by(value, order).alias("_tail"))
    # Every slice needs a carried value, also one without a value of its own.
    slices = df.select(*keys).distinct().join(tails, list(keys), "left")
    earlier = W.partitionBy(*group).orderBy(*bucket).rowsBetween(W.unboundedPreceding, -1)
    carried = slices.select(*[F.col(k).alias(f"_k_{k}") for k in keys],
                            F.last("_tail", ignorenulls=True).over(earlier).alias("_carried"))
    local = df.withColumn("_local", F.last(value, ignorenulls=True).over(before))
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    return (local.join(carried, same)
            .withColumn(name, F.coalesce("_local", "_carried"))
            .drop("_local", "_carried", *[f"_k_{k}" for k in keys]))


def previous_small(df: DataFrame, name: str, group: Sequence[str], bucket: str, order: str, value: str) -> DataFrame:
    """``previous_within`` for many groups that nearly all lie in their first slice, ``bucket`` 0; ``df`` is read twice.

    Those are shuffled and sorted once, whole, with no join; groups that reach further slices, if there are any, are cut into them.
    """
    keys = [F.col(k).alias(f"_h_{k}") for k in group]
    large = stage(df.where(F.col(bucket) != 0).select(*keys).distinct(), "large-groups")
    whole = lambda rows: rows.withColumn(name, F.last(value, ignorenulls=True).over(
        W.partitionBy(*group).orderBy(order).rowsBetween(W.unboundedPreceding, -1)))
    if large.isEmpty():
        return whole(df)
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_h_{k}")) for k in group])
    large = broadcast_checked(large)
    sliced = previous_within(df.join(large, same, "left_semi"), name, group, [bucket], order, value)
    return whole(df.join(large, same, "left_anti")).unionByName(sliced)


def number_small(df: DataFrame, name: str, group: Sequence[str], bucket: Sequence[str], order: Sequence[Column | str],
                 portions: int | None = None) -> DataFrame:
    """``number_within`` for many groups that are nearly all small.

    Groups are counted first. Those of at most SMALL_GROUP rows are sorted whole, by one shuffle that leaves them together in
    portions of bounded size; larger ones, if there are any, are cut into slices.
    """
    df, n = portioned(df, *group, portions=portions), F.count(F.lit(1))
    large = stage(df.groupBy(*group).agg(n.alias("_n")).where(F.col("_n") > SMALL_GROUP).select(*[F.col(k).alias(f"_h_{k}") for k in group]),
                  "large-groups")
    whole = lambda rows: rows.withColumn(name, F.row_number().over(
        W.partitionBy(*group).orderBy(*bucket, *order)).cast("bigint"))
    if large.isEmpty():
        return whole(df)
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_h_{k}")) for k in group])
    large = broadcast_checked(large)
    sliced = number_within(df.join(large, same, "left_semi"), name, group, bucket, order)
    return whole(df.join(large, same, "left_anti")).unionByName(sliced)
