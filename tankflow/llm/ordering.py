"""Global order without a single task: rows are range-partitioned, and each partition gets its base from prefix sums.

Only DataFrame functions. ``order`` must be a total order of the rows (no two rows equal in all of it), else equal
rows share a partition however many there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tankflow.llm.common import materialise

#: monotonically_increasing_id() has the partition above this bit and the row of the partition below.
ROW_BITS = 33


def range_sorted(df: DataFrame, order: list[Column]) -> DataFrame:
    """``df`` in global order, written once, with ``part`` (the range) and ``place`` (0, 1, ... in it). ``df`` should be
    a written table: the ranges are found by a sample of it."""
    n = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    return materialise(dealt.withColumn("part", F.shiftright("_id", ROW_BITS).cast("int"))
                       .withColumn("place", F.col("_id").bitwiseAND(F.lit((1 << ROW_BITS) - 1))).drop("_id"))


def with_base(df: DataFrame, **amounts: Column) -> DataFrame:
    """``df`` of ``range_sorted`` with a column for each of ``amounts``: its sum over all ranges before a row's own. The sums
    are one row a range, as many as shuffle partitions, whatever the number of rows."""
    sums = df.groupBy("part").agg(*[F.sum(v).alias(f"_{k}") for k, v in amounts.items()])
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select("part", *[F.coalesce(F.sum(f"_{k}").over(before), F.lit(0)).alias(k) for k in amounts])
    return df.join(F.broadcast(base), "part")


def running(df: DataFrame, amount: str, name: str) -> DataFrame:
    """``df`` of ``range_sorted`` with the sum of ``amount`` over all rows up to each one."""
    inside = Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    return with_base(df, _base=F.col(amount)).withColumn(name, F.col("_base") + F.sum(amount).over(inside)).drop("_base")


def rank(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """``df`` with the rank (1, 2, ...) of each row in the order of all."""
    based = with_base(range_sorted(df, order), _base=F.lit(1))
    return based.withColumn(name, F.col("_base") + F.col("place") + 1).drop("part", "place", "_base")
