"""LEAD/LAG over a series ordered by time, without one task per series.

A plain ``lag().over(partitionBy(series).orderBy(ts))`` sends every reading
of a tank to one task; a tank holding a third of all readings would then be
a third of the job in one task. ``segmented_lead_lag`` range-partitions the
readings by (series, time segment), an hour by default. The windows over (series,
segment) need no other exchange, as rows of a segment are together, so readings
are dealt out and sorted once. They are written with their neighbours; only the first and last row
of each segment, which lack one, are read again: the halo of each segment is the last row of
the segment before it and the first of the one after. The result equals the
unsegmented window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


def segmented_lead_lag(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                       values: Sequence[str], segment: str = "HOUR", time_col: str | None = None,
                       prefix_lead: str = "next_", prefix_lag: str = "prev_") -> DataFrame:
    """Add ``next_<v>`` / ``prev_<v>`` (LEAD/LAG by 1) for each value column.

    ``order`` must be a total order within a key (e.g. ts, reading_id);
    ``time_col`` (default ``order[0]``) defines the segments.
    """
    keys, order, values = list(keys), list(order), list(values)
    tcol = time_col or order[0]
    seg = "_seg"
    at = "_at"  # one column: a key column that the planner finds constant would be left out of the windows only
    n = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    d = df.withColumn(seg, F.date_trunc(segment, F.col(tcol)).cast("timestamp_ntz"))
    d = d.withColumn(at, F.struct(*keys, seg)).repartitionByRange(n, at)
    w = Window.partitionBy(at).orderBy(*order)
    cols = {}
    for v in values:
        cols[prefix_lead + v] = F.lead(v, 1).over(w)
        cols[prefix_lag + v] = F.lag(v, 1).over(w)
    cols["_is_first"] = F.lag(order[0], 1).over(w).isNull()
    cols["_is_last"] = F.lead(order[0], 1).over(w).isNull()
    inside = cut_lineage(d.withColumns(cols).drop(at))
    edge = F.col("_is_first") | F.col("_is_last")
    # one or two rows a segment: each takes what it lacks from the edge row next to it
    sw = Window.partitionBy(*keys).orderBy(seg, F.desc("_is_first"), "_is_last", *order)
    fixed = {}
    for v in values:
        fixed[prefix_lead + v] = F.when(F.col("_is_last"), F.lead(v, 1).over(sw)).otherwise(F.col(prefix_lead + v))
        fixed[prefix_lag + v] = F.when(F.col("_is_first"), F.lag(v, 1).over(sw)).otherwise(F.col(prefix_lag + v))
    edges = inside.filter(edge).withColumns(fixed)
    return inside.filter(~edge).unionByName(edges).drop(seg, "_is_first", "_is_last")
