"""Places of rows in an order, however many rows share a group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..storage import stored


def placed(df: DataFrame, group: str, order: list[Column], name: str = "place") -> DataFrame:
    """df with each row's place, from 1, in its group by a total order.

    The rows are dealt out by ranges of (group, order), so that a group of any size is cut into parts of like
    size; a row's place is its place in its part on top of the sizes of the group's earlier parts. Parts are
    stored, as their bounds are drawn from a sample."""
    dealt = df.repartitionByRange(F.col(group), *order).withColumn("_part", F.spark_partition_id())
    parts = stored(dealt, "ranges")
    sizes = parts.groupBy(F.col(group).alias("_group"), F.col("_part").alias("_of")).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy("_group").orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("_before", F.coalesce(F.sum("_size").over(before), F.lit(0))).drop("_size")
    own = F.row_number().over(Window.partitionBy(group, "_part").orderBy(*order))
    joined = parts.withColumn("_own", own).join(sizes, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_part") == F.col("_of")))
    return joined.withColumn(name, (F.col("_own") + F.col("_before")).cast("long")).drop("_part", "_own", "_before", "_group", "_of")
