"""C4: hybrid forecast = weighted baseline + weighted model prediction.

The scripts loop over the horizon and scan the history once per hour; here
the horizon is exploded from the config and the lookups are joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import metrics as M
from ..functions import timefmt as tf
from ..sources.schema import SERIES_KEY
from .baseline import lookup_baseline

K = SERIES_KEY


def horizon(cfg: DataFrame) -> DataFrame:
    """X21 over [start, end]: one row per forecast hour and series."""
    h = cfg.select(*K, F.explode(tf.hourly_grid("start", "end")).alias("ds"))
    return h.withColumns({"weekday": tf.weekday("ds"), "hour": tf.hour_of("ds")})


def hybrid_forecast(baseline: DataFrame, cfg: DataFrame, model: DataFrame | None = None) -> DataFrame:
    """C4 (J7 + J8 + X19).

    ``model`` holds (key, ds, yhat) where a model prediction exists. Where it
    does not (beyond the model's horizon, or no model at all) the baseline is
    used for both terms, so those hours get ``(w_base + w_model) * baseline``.
    Output: key, ds, weekday, hour, baseline, model_yhat, yhat.
    """
    hz = lookup_baseline(horizon(cfg), baseline)
    if model is not None:
        hz = hz.join(model.select(*K, "ds", F.col("yhat").alias("model_yhat")), K + ["ds"], "left")
    else:
        hz = hz.withColumn("model_yhat", F.lit(None).cast("double"))
    w = cfg.select(*K, "w_base", "w_model")
    pred = F.coalesce(F.col("model_yhat"), F.col("baseline"))
    return (hz.join(w, K)
            .withColumn("yhat", M.weighted_blend("baseline", pred, "w_base", "w_model"))
            .select(*K, "ds", "weekday", "hour", "baseline", "model_yhat", "yhat"))
