"""Gapless numbers inside groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def number_in_group(df: DataFrame, group: str, salt: Column, buckets: int | Column, order: list[str]) -> DataFrame:
    """Add ``rank``: 0, 1, ... in each value of ``group``.

    A group is dealt over ``buckets`` tasks (a number, or a column that is the same in all rows of a group) by ``salt``; a bucket's rows start where the group's earlier buckets end.
    """
    salted = df.withColumn("_bucket", F.pmod(salt, buckets if isinstance(buckets, Column) else F.lit(buckets)))
    heights = salted.groupBy(group, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = heights.select(group, "_bucket", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base"))
    inside = Window.partitionBy(group, "_bucket").orderBy(*order)
    ranked = salted.withColumn("_rank", F.row_number().over(inside) - 1).join(base, [group, "_bucket"])
    return ranked.withColumn("rank", (F.col("_base") + F.col("_rank")).cast("long")).drop("_bucket", "_rank", "_base")
