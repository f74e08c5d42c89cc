"""Positions and neighbours in a total order, without one task that sees all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbmart.session import materialise

PART, AT = "__part", "__at"


def ordered(df: DataFrame, keys: Sequence[Column], label: str) -> DataFrame:
    """``df`` with the number of its part and its place in it, from 1; parts ascend in the order of ``keys``.

    Rows are range-partitioned and the result is stored, which pins the order of
    rows with equal keys too.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = [f"__key{i}" for i in range(len(keys))]
    keyed = df.withColumns(dict(zip(names, keys, strict=True)))
    ranged = keyed.repartitionByRange(parts, *names).sortWithinPartitions(*names)
    # a monotone id counts the rows of a partition in their order
    placed = ranged.withColumn("__place", F.monotonically_increasing_id()).drop(*names)
    placed = placed.withColumns(
        {PART: F.shiftright("__place", 33), AT: F.col("__place").bitwiseAND((1 << 33) - 1) + 1}
    )
    return materialise(placed.drop("__place"), label)


def running_sum(table: DataFrame, value: str, before: str) -> DataFrame:
    """An ordered table with the sum of ``value`` over all rows before each."""
    sums = table.groupBy(PART).agg(F.sum(value).alias("__sum"))
    # one row a part: this window is as small as the number of partitions
    earlier = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(PART, F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__offset"))
    inside = Window.partitionBy(PART).orderBy(AT).rowsBetween(Window.unboundedPreceding, -1)
    here = F.coalesce(F.sum(value).over(inside), F.lit(0))
    return table.withColumn("__here", here).join(offsets, PART).withColumn(
        before, F.col("__here") + F.col("__offset")
    ).drop("__here", "__offset")


def with_next(table: DataFrame, value: Column, name: str) -> DataFrame:
    """An ordered table with ``value`` of the row after each, NULL at the last."""
    inside = Window.partitionBy(PART).orderBy(AT)
    heads = table.where(F.col(AT) == 1).select(PART, value.alias("__head"))
    # the head of the next part that has rows; one row a part
    following = heads.select(PART, F.lead("__head").over(Window.orderBy(PART)).alias("__head"))
    size = Window.partitionBy(PART)
    near = table.withColumns({name: F.lead(value).over(inside), "__last": F.col(AT) == F.max(AT).over(size)})
    return near.join(following, PART).withColumn(
        name, F.when(F.col("__last"), F.col("__head")).otherwise(F.col(name))
    ).drop("__last", "__head")
