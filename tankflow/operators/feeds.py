"""The plotted series of the scripts as one long table (the chart itself
is not built; this is its data)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.schema import SERIES_KEY

K = SERIES_KEY


def _long(df: DataFrame, name: str, value: str) -> DataFrame:
    return df.select(*K, "ds", F.lit(name).alias("series_name"), F.col(value).cast("double").alias("value"))


def chart_feed(history: DataFrame, depletion: DataFrame, actual: DataFrame,
               scored: DataFrame, cfg: DataFrame) -> DataFrame:
    """Output: key, ds, series_name, value for history, forecast, accuracy,
    level, dead_stock and actual (UNION ALL)."""
    dead = depletion.join(cfg.select(*K, "dead_stock"), K)
    parts = [
        _long(history, "history", "quantity"),
        _long(depletion, "forecast", "yhat"),
        _long(scored, "accuracy", "accuracy"),
        _long(depletion, "level", "level"),
        _long(dead, "dead_stock", "dead_stock"),
        _long(actual, "actual", "quantity"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
