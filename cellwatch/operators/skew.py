"""Cutting the rows of large keys into ordered parts.

A window over one key runs in one task. So the (key, order) pairs alone are
dealt into ranges, as for a global sort: a key whose pairs fill several ranges
is cut where the ranges meet, every other key stays whole. Spark picks the
ranges from a sample and AQE merges small ones, so small inputs are not cut at
all and no size is compared here. Neither the number of keys nor that of the
parts of a key has a limit, and nothing passes through the driver: the cuts
are a written table with one row per key that has any.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellwatch.session import materialise

PART = "_part"
CUTS = "_cuts"


@dataclass(frozen=True)
class SplitPolicy:
    """Into how many ranges the pairs are dealt; by default Spark's number of shuffle partitions."""

    ranges: int | None = None


def cut_points(pairs: DataFrame, key: str, order: str, policy: SplitPolicy = SplitPolicy()) -> DataFrame:
    """Keys that fill several ranges, with the first order value of each range after their first.

    ``pairs`` needs just the two columns; ``order`` may be of any type that
    sorts. Equal orders of a key never straddle a cut.
    """
    number = [policy.ranges] if policy.ranges else []
    dealt = pairs.select(key, order).repartitionByRange(*number, key, order)
    starts = dealt.withColumn("_range", F.spark_partition_id()).groupBy(key, "_range").agg(F.min(order).alias("_start"))
    cuts = (
        starts.groupBy(key)
        .agg(F.sort_array(F.collect_list("_start")).alias("_starts"))
        .filter(F.size("_starts") > 1)
        .select(key, F.slice("_starts", F.lit(2), F.size("_starts") - 1).alias(CUTS))
    )
    # Written, because another run could sample other ranges.
    return materialise(cuts, "cuts")


def part_of(cuts: Column, order: Column) -> Column:
    """How many cuts are at or below the value, by binary search; 0 for a null value."""
    # Halving steps from the largest that an array can need.
    steps = F.array(*[F.lit(1 << j) for j in range(30, -1, -1)])
    search = F.aggregate(
        steps,
        F.lit(0),
        lambda found, s: F.when(
            (s <= F.size(cuts) - found) & (F.get(cuts, found + s - 1) <= order), found + s
        ).otherwise(found),
    )
    return F.when(cuts.isNull(), 0).otherwise(search)
