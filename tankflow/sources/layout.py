"""Fact tables laid out for the extraction: readings and receipts by month, receipts and items bucketed by receipt id.

Written once when facts arrive, this lets each run of the extraction skip work: the month filter (F2) prunes whole
partitions, and the join of receipts with their items (J2) reads matching buckets side by side without an exchange,
since rows were dealt out by the same hash of the same key when they were written. Buckets are tables of the session's
catalog (a path alone doesn't carry them), stored under the shared checkpoint folder unless ``base`` says otherwise.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import tables_dir

#: Partition column: 100 * year + month.
MONTH = "in_month"


def month_of(ts: str) -> Column:
    return (F.year(ts) * 100 + F.month(ts)).cast("int")


def by_month(df: DataFrame, ts: str, base: str | None = None) -> DataFrame:
    """``df`` partitioned by the month of ``ts`` (column ``MONTH``). Rows are spread by hash before the write, so that a month
    is a few files a task and no task holds a whole month."""
    path = f"{base or tables_dir(df.sparkSession)}/{uuid.uuid4().hex}"
    df.withColumn(MONTH, month_of(ts)).write.partitionBy(MONTH).parquet(path)
    return df.sparkSession.read.parquet(path)


def bucketed(df: DataFrame, key: str, buckets: int, *, month_ts: str | None = None, base: str | None = None) -> DataFrame:
    """``df`` as a table bucketed and sorted by ``key``, also partitioned by the month of ``month_ts`` if given. Rows are
    dealt out by the key first, so that a task writes one file a bucket and month."""
    spark = df.sparkSession
    name = f"tankflow_{uuid.uuid4().hex}"
    path = f"{base or tables_dir(spark)}/{name}"
    if month_ts:
        df = df.withColumn(MONTH, month_of(month_ts))
    w = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("path", path)
    (w.partitionBy(MONTH) if month_ts else w).saveAsTable(name)
    return spark.table(name)
