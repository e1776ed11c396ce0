"""Score the forecast against held-out actuals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import metrics as M
from ..sources.schema import SERIES_KEY

K = SERIES_KEY


def evaluate(forecast: DataFrame, actual: DataFrame) -> DataFrame:
    """J9 + X18: forecast LEFT JOIN actual on (key, ds), then accuracy.

    Output: key, ds, yhat, quantity (actual, null where none), accuracy.
    """
    a = actual.select(*K, "ds", "quantity")
    j = forecast.select(*K, "ds", "yhat").join(a, K + ["ds"], "left")
    return j.withColumn("accuracy", M.accuracy("quantity", "yhat"))


def score_range(scored: DataFrame, cfg: DataFrame) -> DataFrame:
    """F8: rows with score_from <= ds < score_to."""
    c = cfg.select(*K, "score_from", "score_to")
    return (scored.join(c, K)
            .filter((F.col("ds") >= F.col("score_from")) & (F.col("ds") < F.col("score_to")))
            .drop("score_from", "score_to"))


def mean_accuracy(scored: DataFrame, cfg: DataFrame) -> DataFrame:
    """Null-skipping mean accuracy over the score range, per configured
    series; null when nothing in range was scored."""
    agg = (score_range(scored, cfg).groupBy(*K)
           .agg(F.avg("accuracy").alias("mean_accuracy"),
                F.count("accuracy").alias("scored_rows")))
    return (cfg.select(*K).join(agg, K, "left")
            .withColumn("scored_rows", F.coalesce(F.col("scored_rows"), F.lit(0).cast("bigint"))))
