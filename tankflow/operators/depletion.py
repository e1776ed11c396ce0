"""Run the tank level down and find when it reaches dead stock.

W6: level = initial - running sum of yhat.
W7: while the last level is above dead stock, append hours using the
    unweighted baseline, at most ``max_steps`` of them. The scripts do this
    with a loop and repeated concatenation; here it is one exploded step
    range per series, a running sum and a running "first crossing" bound.
A8: first hour at or below dead stock within the rows, null when not reached
    there; ``crossing`` has the step beyond them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import timefmt as tf
from ..sources.schema import SERIES_KEY
from .baseline import lookup_baseline

K = SERIES_KEY
MAX_STEPS = 1000


def tank_level(forecast: DataFrame, cfg: DataFrame) -> DataFrame:
    """Key, ds, yhat, level (initial minus the running sum of yhat)."""
    w = (Window.partitionBy(*K).orderBy("ds")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    f = forecast.select(*K, "ds", "yhat").join(cfg.select(*K, "initial"), K)
    return f.select(*K, "ds", "yhat", (F.col("initial") - F.sum("yhat").over(w)).alias("level"))


def last_level(level: DataFrame) -> DataFrame:
    """O2: last row by ds of each series (``iloc[-1]``)."""
    return (level.groupBy(*K)
            .agg(F.max("ds").alias("last_ds"), F.max_by("level", "ds").alias("last_level")))


WEEK = 168  # hours; the (weekday, hour) baseline repeats with this period
MOST_WEEKS = 1e12  # a crossing beyond so many weeks counts as none: step numbers stay exact


def first_week(level: DataFrame, baseline: DataFrame, cfg: DataFrame) -> DataFrame:
    """For each series that ends its horizon above dead stock the 168 steps of the first week after it
    (r, baseline, running sum s_r, weekly total p), and ``cross_step``, the step at which its level
    first reaches dead stock, however far away; null if it never does."""
    last = last_level(level).join(cfg.select(*K, "dead_stock"), K)
    last = last.filter(F.col("last_level") > F.col("dead_stock"))
    week = last.select(*K, "last_ds", "last_level", "dead_stock",
                       F.explode(F.sequence(F.lit(1), F.lit(WEEK))).alias("r"))
    week = week.withColumn("ds", tf.add_hours("last_ds", F.col("r")))
    week = week.withColumns({"weekday": tf.weekday("ds"), "hour": tf.hour_of("ds")})
    week = lookup_baseline(week, baseline)
    run = Window.partitionBy(*K).orderBy("r").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    week = week.withColumns({"s_r": F.sum("baseline").over(run),
                             "p": F.sum("baseline").over(Window.partitionBy(*K))})

    def crosses(q):
        return (F.col("last_level") - (q * F.col("p") + F.col("s_r"))) <= F.col("dead_stock")

    weeks = F.try_divide(F.col("last_level") - F.col("dead_stock") - F.col("s_r"), F.col("p"))
    # weekly totals near zero (tiny, or sales and returns that cancel) give quotients beyond any long
    est = F.when(crosses(F.lit(0.0)), F.lit(0).cast("bigint")).when(
        (F.col("p") > 0) & (weeks < MOST_WEEKS), F.ceil(F.least(weeks, F.lit(MOST_WEEKS))).cast("bigint"))
    # guard the float estimate: step back or forward by one week when needed
    q = (F.when(est.isNull(), est)
         .when((est > 0) & crosses((est - 1).cast("double")), est - 1)
         .when(~crosses(est.cast("double")), est + 1)
         .otherwise(est))
    return week.withColumn("cross_step", F.min(q * WEEK + F.col("r")).over(Window.partitionBy(*K)))


def crossing(level: DataFrame, baseline: DataFrame, cfg: DataFrame, max_steps: int = MAX_STEPS) -> DataFrame:
    """Per series above dead stock at the end of its horizon: cross_step (null: never) and whether the
    extension of at most ``max_steps`` rows ends before it (``capped``)."""
    week = first_week(level, baseline, cfg).filter(F.col("r") == 1)
    return week.select(*K, "cross_step", (F.coalesce("cross_step", F.lit(max_steps + 1)) > max_steps).alias("capped"))


def extend_to_dead_stock(level: DataFrame, baseline: DataFrame, cfg: DataFrame,
                         max_steps: int = MAX_STEPS) -> DataFrame:
    """Extension rows (key, ds, yhat, level, capped) appended after the horizon.

    Row k exists iff the horizon's last level is above dead stock and every
    extension level before k is still above it; k <= ``max_steps``. ``capped``
    is true on the rows of a series whose extension ends at ``max_steps``
    without reaching dead stock; ``crossing`` tells where it would.

    Step k consumes the baseline of its (weekday, hour), which repeats every
    168 hours. With s_r the running sum over the first week (r = 1..168) and
    P the weekly total, step k = 168 q + r has level L0 - (q P + s_r). So the
    first crossing is found from one week of prefix sums: for each r the
    smallest q with L0 - (q P + s_r) <= dead stock. Only the steps up to that
    crossing (or the cap) are generated.
    """
    cap = int(max_steps)
    week = first_week(level, baseline, cfg)
    prefix = week.select(*K, "r", "s_r", "baseline")
    far = F.coalesce("cross_step", F.lit(cap + 1).cast("bigint"))
    steps = (week.filter(F.col("r") == 1)
             .select(*K, "last_ds", "last_level", "p", (far > cap).alias("capped"),
                     F.explode(F.sequence(F.lit(1), F.least(far, F.lit(cap)).cast("int"))).alias("k")))
    steps = steps.withColumns({"r": ((F.col("k") - 1) % WEEK) + 1,
                               "q": ((F.col("k") - 1) / WEEK).cast("bigint")})
    steps = steps.join(prefix, K + ["r"])
    return steps.select(*K, tf.add_hours("last_ds", F.col("k")).alias("ds"), F.col("baseline").alias("yhat"),
                        (F.col("last_level") - (F.col("q") * F.col("p") + F.col("s_r"))).alias("level"), "capped")


def depletion_forecast(forecast: DataFrame, baseline: DataFrame, cfg: DataFrame,
                       max_steps: int = MAX_STEPS) -> DataFrame:
    """C5 rows: horizon levels followed by the extension (O3, UNION ALL).

    Output: key, ds, yhat, level, extension (boolean).
    """
    lv = tank_level(forecast, cfg)
    ext = extend_to_dead_stock(lv, baseline, cfg, max_steps)
    return (lv.withColumn("extension", F.lit(False))
            .unionByName(ext.drop("capped").withColumn("extension", F.lit(True))))


def below_dead_stock(level: DataFrame, cfg: DataFrame) -> DataFrame:
    """rows whose level is at or below the series' dead stock."""
    return (level.join(cfg.select(*K, "dead_stock"), K)
            .filter(F.col("level") <= F.col("dead_stock")).drop("dead_stock"))


def first_dead_stock(level: DataFrame, cfg: DataFrame) -> DataFrame:
    """Per configured series, the first ds at or below dead stock and its
    level; both null when the level never gets there."""
    hit = (below_dead_stock(level, cfg).groupBy(*K)
           .agg(F.min("ds").alias("ds"), F.min_by("level", "ds").alias("level")))
    return cfg.select(*K).join(hit, K, "left")
