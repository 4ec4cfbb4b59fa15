"""Running totals in two levels, so that no task orders a whole group.

Rows of a group are cut into ordered buckets; a window runs inside a bucket
only, and bucket totals (one small row each) give every bucket its offset.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_start(df: DataFrame, group: list[str], bucket: str, order: list[str | Column], value: str, name: str) -> DataFrame:
    """Add ``name``: the sum of ``value`` over all rows of the same group that
    come before in (bucket, order)."""
    inside = Window.partitionBy(*group, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    totals = df.groupBy(*group, bucket).agg(F.sum(value).alias("_total"))
    across = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*group, bucket, F.coalesce(F.sum("_total").over(across), F.lit(0)).alias("_before"))
    return (df.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
              .join(offsets, [*group, bucket])
              .withColumn(name, F.col("_before") + F.col("_inside")).drop("_before", "_inside"))
