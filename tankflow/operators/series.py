"""Turn an hourly extract into a complete, duplicate-free hourly series.

All series are processed at once, keyed by (station, product, tank).
Shuffles: one aggregation on (key, ds) for the duplicate mean, one partial
aggregation on the key for the series bounds, and the grid join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import timefmt as tf
from ..sources.schema import SERIES_KEY

K = SERIES_KEY


def orders_as_hourly(orders: DataFrame) -> DataFrame:
    """C7 input step: the database variant's bound query
    (``TRUNC(R_DAY)``, ``R_HOUR``, ``NVL(VOLUME, 0)``) in the extract's shape."""
    return orders.select(*K, F.col("r_day").cast("date").alias("date"),
                         F.col("r_hour").cast("int").alias("hour"),
                         F.coalesce(F.col("volume"), F.lit(0.0)).alias("quantity"))


def _parsed(hourly: DataFrame, rollover: str, lenient: bool) -> DataFrame:
    """The extract with ds, q and w, and ``reason``: why a row can't be placed in its series (else null)."""
    if isinstance(hourly.schema["date"].dataType, T.StringType):
        d = tf.parse_date_lenient(hourly["date"]) if lenient else tf.parse_date(hourly["date"])
    else:
        d = hourly["date"].cast("date")
    reason = F.when(d.isNull(), F.lit("bad_date")).when(hourly["hour"].isNull(), F.lit("null_hour"))
    if "corrupt_record" in hourly.columns:
        reason = F.when(hourly["corrupt_record"].isNotNull(), F.lit("corrupt_row")).otherwise(reason)
    rolled, h = tf.hour24_rollover(d, hourly["hour"], rollover)
    w = hourly["pairs"].cast("bigint") if "pairs" in hourly.columns else F.lit(1).cast("bigint")
    return hourly.select(
        *K, "date", "hour", "quantity",
        tf.combine_date_hour(rolled, h).alias("ds"),
        F.coalesce(hourly["quantity"].cast("double"), F.lit(0.0)).alias("q"),
        w.alias("w"), reason.alias("reason"))


def parse_hourly(hourly: DataFrame, *, rollover: str = "all", lenient: bool = True) -> DataFrame:
    """X5/X6 + X14 + X15 + X8: (key, date text, hour, quantity) -> (key, ds, q, w).

    ``w`` is the number of extract rows a row stands for (``pairs`` when the
    extract carries it, else 1). ``lenient=False`` raises on a bad date, as the scripts do.
    With ``lenient=True`` rows that can't be placed are what ``rejected_rows`` returns, and the
    quality report counts them by reason.
    """
    return _parsed(hourly, rollover, lenient).filter(F.col("reason").isNull()).select(*K, "ds", "q", "w")


def rejected_rows(hourly: DataFrame) -> DataFrame:
    """The rows that ``parse_hourly`` leaves out: key, date, hour, quantity and the reason
    (corrupt_row, bad_date or null_hour)."""
    return _parsed(hourly, "all", True).filter(F.col("reason").isNotNull()).select(*K, "date", "hour", "quantity", "reason")


def dedupe_mean(parsed: DataFrame) -> DataFrame:
    """A3: mean of duplicate rows per (key, ds), weighted by multiplicity."""
    return (parsed.groupBy(*K, "ds")
            .agg(F.sum(F.col("q") * F.col("w")).alias("qs"), F.sum("w").alias("n"))
            .select(*K, "ds", (F.col("qs") / F.col("n")).alias("quantity")))


def series_bounds(obs: DataFrame) -> DataFrame:
    """A5: first day of the series and the day after its last observation."""
    b = obs.groupBy(*K).agg(F.min("ds").alias("lo"), F.max("ds").alias("hi"))
    return b.select(*K, tf.truncate_day("lo").alias("grid_start"),
                    tf.add_days(tf.truncate_day("hi"), 1).alias("grid_end"))


def series_grid(bounds: DataFrame) -> DataFrame:
    """The complete hourly grid of each series, both ends inclusive."""
    return bounds.select(*K, F.explode(tf.hourly_grid("grid_start", "grid_end")).alias("ds"))


def gapfill(grid: DataFrame, obs: DataFrame, fill: float = 0.0, *, provenance: bool = False) -> DataFrame:
    """Reindex onto the grid; missing hours get ``fill``. With ``provenance`` a flag ``filled`` says which."""
    j = grid.join(obs.withColumn("_seen", F.lit(True)), K + ["ds"], "left")
    flag = [F.col("_seen").isNull().alias("filled")] if provenance else []
    return j.select(*K, "ds", F.coalesce(F.col("quantity"), F.lit(float(fill))).alias("quantity"), *flag)


def add_calendar_columns(series: DataFrame) -> DataFrame:
    """X11: weekday (Monday = 0) and hour of ``ds``."""
    return series.withColumns({"weekday": tf.weekday("ds"), "hour": tf.hour_of("ds")})


def clean_hourly_series(hourly: DataFrame, cfg: DataFrame | None = None, *,
                        rollover: str = "all", fill: float = 0.0, lenient: bool = True,
                        provenance: bool = False) -> DataFrame:
    """Extract -> (key, ds, quantity, weekday, hour) on a complete hourly grid; with ``provenance``
    also ``filled``, true for hours that no observation stands behind.

    Rows without a place (see ``rejected_rows``) are left out, or raise with ``lenient=False``.
    When ``cfg`` is given only its series are kept (a semi join, the
    multi-series form of the scripts' product/tank filter).
    """
    if cfg is not None:
        hourly = hourly.join(cfg.select(*K), K, "left_semi")
    obs = dedupe_mean(parse_hourly(hourly, rollover=rollover, lenient=lenient))
    grid = series_grid(series_bounds(obs))
    return add_calendar_columns(gapfill(grid, obs, fill, provenance=provenance))


def mean_by_ds_weekday(series: DataFrame) -> DataFrame:
    """A4: mean by (key, ds, weekday); a no-op after the dedupe, kept for parity."""
    return (series.groupBy(*K, "ds", "weekday")
            .agg(F.avg("quantity").alias("quantity"))
            .withColumn("hour", tf.hour_of("ds")))


def split_history(series: DataFrame, cfg: DataFrame) -> DataFrame:
    """rows strictly before the series' cutoff."""
    c = cfg.select(*K, "cutoff")
    return series.join(c, K).filter(F.col("ds") < F.col("cutoff")).drop("cutoff")


def split_actual(series: DataFrame, cfg: DataFrame) -> DataFrame:
    """rows in [actual_from, actual_to], both ends inclusive."""
    c = cfg.select(*K, "actual_from", "actual_to")
    return (series.join(c, K)
            .filter(F.col("ds").between(F.col("actual_from"), F.col("actual_to")))
            .drop("actual_from", "actual_to"))
