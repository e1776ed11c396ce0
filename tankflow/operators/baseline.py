"""Same-weekday-same-hour baselines.

The history is one row per series and hour, so a window partitioned by
(key, weekday, hour) holds at most one row per week of history: the hot
part of the data (raw readings) never reaches these windows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.schema import SERIES_KEY

K = SERIES_KEY
CELL = K + ["weekday", "hour"]


def observed(history: DataFrame, exclude_filled: bool) -> DataFrame:
    """``history``, or only its hours with an observation (``series.clean_hourly_series(provenance=True)`` has the flag)."""
    return history.filter(~F.col("filled")).drop("filled") if exclude_filled else history


def rolling_baseline(history: DataFrame, window: int, *, exclude_filled: bool = False) -> DataFrame:
    """Rolling mean per (key, weekday, hour) over the last ``window`` rows,
    ``min_periods=1``; one output row per history row. ``exclude_filled`` leaves gap-filled hours out (here and
    below), so that zeros which nobody measured don't enter the mean."""
    history = observed(history, exclude_filled)
    w = Window.partitionBy(*CELL).orderBy("ds").rowsBetween(-(window - 1), 0)
    return history.withColumn("rolling_mean", F.avg("quantity").over(w))


def last_n_per_cell(history: DataFrame, cfg: DataFrame, *, exclude_filled: bool = False, most: int | None = None) -> DataFrame:
    """The last ``window`` rows (by ds) of each (key, weekday, hour) cell.

    ``window`` comes from the per-series configuration. ``most``, the largest window in it where the caller knows it,
    lets the planner keep only that many rows of a cell in each task before the exchange.
    """
    h = observed(history, exclude_filled).join(cfg.select(*K, "window"), K)
    rank = F.row_number().over(Window.partitionBy(*CELL).orderBy(F.col("ds").desc()))
    ranked = h.withColumn("rn", rank).filter(F.col("rn") <= F.col("window"))
    return (ranked if most is None else ranked.filter(F.col("rn") <= int(most))).drop("rn", "window")


def similar_day_baseline(history: DataFrame, cfg: DataFrame, *, exclude_filled: bool = False, most: int | None = None) -> DataFrame:
    """Mean of the last ``window`` observations of each (weekday, hour).

    Equal to the last value of a ``min_periods=1`` rolling mean.
    """
    return (last_n_per_cell(history, cfg, exclude_filled=exclude_filled, most=most)
            .groupBy(*CELL).agg(F.avg("quantity").alias("baseline")))


def lookup_baseline(frame: DataFrame, baseline: DataFrame) -> DataFrame:
    """Attach the (weekday, hour) baseline to each row; 0 when the cell is empty."""
    j = frame.join(baseline, CELL, "left")
    return j.withColumn("baseline", F.coalesce(F.col("baseline"), F.lit(0.0)))
