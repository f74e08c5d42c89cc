"""The place of every row in a total order, without one task that sees all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbmart.llm.common import stored


def ordered(df: DataFrame, keys: Sequence[Column], label: str) -> tuple[DataFrame, DataFrame]:
    """``df`` with ``__part`` and ``__at``, and the first and last row of every part.

    Rows are range-partitioned by the keys (ties of the keys may stand in any
    order but the whole order is pinned, as the table is stored). Part numbers
    ascend; ``__at`` counts from 1 within a part. The second table has one row a
    part: its size and the number of rows in the parts before it.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = [f"__key{i}" for i in range(len(keys))]
    keyed = df.withColumns(dict(zip(names, keys, strict=True)))
    ranged = keyed.repartitionByRange(parts, *names).sortWithinPartitions(*names)
    # A monotone id counts the rows of a partition in their order.
    placed = ranged.withColumn("__place", F.monotonically_increasing_id()).drop(*names)
    placed = placed.withColumns({"__part": F.shiftright("__place", 33), "__at": F.col("__place").bitwiseAND((1 << 33) - 1) + 1})
    table = stored(placed.drop("__place"), label)
    sizes = table.groupBy("__part").agg(F.count("*").alias("__size"))
    # One row a part: this window is as small as the number of partitions.
    before = F.sum("__size").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    return table, sizes.withColumn("__before", F.coalesce(before, F.lit(0)))


def ranked(df: DataFrame, keys: Sequence[Column], rank: str, label: str) -> DataFrame:
    """``df`` with the number of every row in the order of the keys, from 1."""
    table, parts = ordered(df, keys, label)
    joined = table.join(parts.select("__part", "__before"), "__part")
    return joined.withColumn(rank, F.col("__before") + F.col("__at")).drop("__part", "__at", "__before")
