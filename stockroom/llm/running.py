"""Exclusive running totals of groups of any size.

A window over a whole group runs in one task. Here each group is cut into buckets by a prefix of
its sort key; a window runs per (group, bucket), and the totals of the earlier buckets, one small
row per (group, bucket), are added by a join. A group that holds a third of all rows is spread
over as many tasks as it has buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_total(df: DataFrame, group: str, bucket: str, order: list[Column | str], value: str, out: str) -> DataFrame:
    """``df`` plus ``out``: the sum of ``value`` over the rows of the same ``group`` that come
    earlier by (``bucket``, ``order``). ``group`` and ``bucket`` must not be null. ``df`` is read
    twice, so pass a table or a cheap projection."""
    before = Window.partitionBy(group, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    buckets = df.groupBy(group, bucket).agg(F.sum(value).alias("_sum"))
    earlier = Window.partitionBy(group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = buckets.select(
        F.col(group).alias("_group"),
        F.col(bucket).alias("_bucket"),
        F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset"),
    )
    inner = df.withColumn("_inner", F.coalesce(F.sum(value).over(before), F.lit(0)))
    joined = inner.join(offsets, (F.col(group) == F.col("_group")) & (F.col(bucket) == F.col("_bucket")))
    return joined.withColumn(out, F.col("_offset") + F.col("_inner")).drop("_group", "_bucket", "_offset", "_inner")
