"""Hourly outflow per tank from gauge readings and point-of-sale receipts.

What is computed (per station, product, tank and hour):

* ``NP`` (A1): POS volume of the hour, from receipts joined to their shift
  report and their items, filtered by year/month, product type and gross.
* ``MaxMinutes`` (A2): first and last minute with a reading in the hour
  (over the readings inside the ``[start, end]`` date bounds).
* For readings in the last minute, ``max_value`` = the next reading's volume
  when another reading follows in the same minute and the minute is < 30,
  else its own volume. For readings in the first minute, ``min_value`` = its
  own volume when another reading precedes it in the same minute and the
  minute is < 30, else the previous reading's volume (W1-W3, P6).
* ``diff = min_value - max_value``; a negative diff (a delivery) is replaced
  by the POS volume (C2). An hour without POS rows is dropped (J6).

When several readings share a boundary minute the source joins every
last-minute reading with every first-minute reading, so one hour yields
|first| x |last| rows, and the consumer averages them. We never build those
pairs: each hour is emitted once, with ``pairs`` = |first| x |last| and
``quantity`` = the sum of the non-null pair diffs divided by ``pairs`` (null
when every pair diff is null). The pair sums come from one sort of the
boundary values with running counts and sums, so the work is
O(n log n) in the boundary-minute readings, not O(n^2).

Scale: readings are the large input. They are scanned twice: once for the
per-minute hash aggregate (primitive buffers, map-side partial aggregation,
so the shuffle carries one row per series-minute), and once for the rows of
the boundary minutes and of each first minute's previous minute. That second
scan is a join against the small set of needed minutes: AQE broadcasts it when
its runtime size allows, else it is a shuffle join. After that, the
minute-level windows run per series over minute rows, and one exchange on
(series, hour) serves every hour-level window, the pair aggregate and the
join with the POS side. A hot tank is spread over its minutes and hours.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import timefmt as tf
from ..session import cut_lineage, cut_lineages
from ..sources.layout import MONTH
from ..sources.schema import SERIES_KEY

K = SERIES_KEY


def year_month_filter(ts: Column, year: int, months: Iterable[int]) -> Column:
    """F2 as an OR of half-open month ranges, so it is pushed to the parquet scan.

    Equivalent to ``EXTRACT(YEAR) = year AND EXTRACT(MONTH) IN months``.
    """
    cond = None
    for m in sorted(set(int(x) for x in months)):
        lo = dt.datetime(year, m, 1)
        hi = dt.datetime(year + (m == 12), (m % 12) + 1, 1)
        c = (ts >= F.lit(lo).cast("timestamp_ntz")) & (ts < F.lit(hi).cast("timestamp_ntz"))
        cond = c if cond is None else (cond | c)
    return cond if cond is not None else F.lit(False)


def in_months(df: DataFrame, ts: str, year: int, months: Iterable[int]) -> DataFrame:
    """F2 on a frame: the range filter, and on a frame laid out by ``layout.MONTH`` also its partitions."""
    months = sorted(set(int(m) for m in months))
    out = df.filter(year_month_filter(F.col(ts), year, months))
    return out.filter(F.col(MONTH).isin([100 * year + m for m in months])).drop(MONTH) if MONTH in df.columns else out


def between_dates(ts: Column, start: dt.date, end: dt.date) -> Column:
    """``ts BETWEEN TO_DATE(start) AND TO_DATE(end)``; the upper bound is midnight."""
    lo = F.lit(dt.datetime.combine(start, dt.time())).cast("timestamp_ntz")
    hi = F.lit(dt.datetime.combine(end, dt.time())).cast("timestamp_ntz")
    return ts.between(lo, hi)


def _restrict(df: DataFrame, stations: Sequence[str] | None, series: DataFrame | None) -> DataFrame:
    if stations is not None:
        df = df.filter(F.col("station").isin(list(stations)))
    if series is not None:
        df = df.join(series.select(*K), K, "left_semi")
    return df


def sales_filter(station: Column, prodtype: Column, bruto: Column, volume: Column,
                 net_only_stations: Sequence[str]) -> Column:
    """product type 0 and (gross <> 0, or volume <> 0 at a net-only station)."""
    net = (volume != 0) & (prodtype == 0)
    if net_only_stations:
        net = net & station.isin(list(net_only_stations))
    else:
        net = F.lit(False)
    return (prodtype == 0) & ((bruto != 0) | net)


def month_shifts(shifts: DataFrame, *, year: int, months: Iterable[int]) -> DataFrame:
    """The shift reports of the months: a few rows a station and day. ``receipts_with_shift`` takes them written, so that
    its join is planned with their real size."""
    return shifts.filter(year_month_filter(F.col("shift_start"), year, months))


def receipts_with_shift(receipts: DataFrame, shifts: DataFrame, *, year: int,
                        months: Iterable[int], stations: Sequence[str] | None = None, written: DataFrame | None = None) -> DataFrame:
    """Receipts joined to their shift report (the WHERE clause makes it inner). ``written``: ``month_shifts``
    where the caller has written them already."""
    months = list(months)
    z = written if written is not None else cut_lineage(month_shifts(shifts, year=year, months=months))
    # implied by the join equality; stated so it also reaches the receipts scan
    r = in_months(_restrict(receipts, stations, None), "shift_start", year, months)
    return r.join(z, ["station", "znum", "shift_start"], "inner")


def shifts_with_receipts(receipts: DataFrame, shifts: DataFrame, *, year: int, months: Iterable[int],
                         stations: Sequence[str] | None = None) -> DataFrame:
    """J1 in its outer form (receipts RIGHT JOIN shifts): every shift report of the months, with its receipts or, where it
    has none, with null ``id`` and ``start_ts``."""
    cond = year_month_filter(F.col("shift_start"), year, months)
    z = _restrict(shifts, stations, None).filter(cond).select("station", "znum", "shift_start")
    r = _restrict(receipts, stations, None).filter(cond).select("id", "station", "znum", "shift_start", "start_ts")
    return r.join(z, ["station", "znum", "shift_start"], "right")


def receipts_with_items(receipts: DataFrame, items: DataFrame) -> DataFrame:
    """J2 in its outer form (receipts LEFT JOIN items): every row of ``receipts``, with its items or null item columns."""
    it = items.select("receipt_id", "product", "tank", "prodtype", "bruto", "volume")
    return receipts.join(it, F.col("id") == F.col("receipt_id"), "left").drop("receipt_id")


def pos_hourly_sales(receipts: DataFrame, shifts: DataFrame, items: DataFrame, *,
                     year: int, months: Iterable[int], stations: Sequence[str] | None = None,
                     net_only_stations: Sequence[str] = (), written: DataFrame | None = None) -> DataFrame:
    """A1 (NP): POS volume per station, product, tank and hour.

    Output: station, product, tank, hour_ts, pos_volume. Receipts and items bucketed by receipt id
    (``sources.layout``) are joined without an exchange.
    """
    rz = receipts_with_shift(receipts, shifts, year=year, months=months, stations=stations, written=written)
    it = items.select("receipt_id", "product", "tank", "prodtype", "bruto", "volume")
    j = rz.select("id", "station", "start_ts").join(it, F.col("id") == F.col("receipt_id"), "inner")
    j = j.filter(sales_filter(F.col("station"), F.col("prodtype"), F.col("bruto"),
                              F.col("volume"), net_only_stations))
    return (j.groupBy("station", "product", "tank", tf.truncate_hour("start_ts").alias("hour_ts"))
            .agg(F.sum("volume").alias("pos_volume")))


def _readings(gauges: DataFrame, *, year: int, months: Iterable[int], start: dt.date, end: dt.date,
              stations: Sequence[str] | None, series: DataFrame | None) -> DataFrame:
    """Readings inside either filter, flagged by which one they satisfy."""
    ts = F.col("ts")
    in_cte = year_month_filter(ts, year, months)
    in_bounds = between_dates(ts, start, end)
    g = _restrict(gauges, stations, series).filter(in_cte | in_bounds)
    return g.select(*K, "ts", "reading_id", "volume",
                    in_cte.alias("in_cte"), in_bounds.alias("in_bounds"),
                    tf.truncate_minute("ts").alias("minute_ts"))


def minute_summary(readings: DataFrame) -> DataFrame:
    """Per series-minute: bounds presence and the time of the last reading
    inside the month filter. Primitive aggregation buffers only, so this is
    a hash aggregate with map-side partial aggregation.

    Output: key, minute_ts, has_cte, has_bounds, last_ts (null when the
    minute has no reading inside the month filter).
    """
    return (readings.groupBy(*K, "minute_ts")
            .agg(F.max(F.col("in_cte").cast("int")).alias("has_cte"),
                 F.max(F.col("in_bounds").cast("int")).alias("has_bounds"),
                 F.max(F.when(F.col("in_cte"), F.col("ts"))).alias("last_ts")))


def boundary_minutes(minutes: DataFrame) -> DataFrame:
    """A2 + the minute-level half of W1, in one shuffle (partitioned by
    series; both windows below are satisfied by it).

    For each hour: first and last minute with a reading inside the date
    bounds (MaxMinutes). For each boundary minute: the previous minute with a
    reading and that minute's last reading time, where the previous reading's
    volume will be looked up.
    Output: key, hour_ts, minute_ts, mi, is_mx, is_mn, prev_minute_ts, prev_ts.
    """
    hour_ts = tf.truncate_hour("minute_ts")
    mi = F.minute("minute_ts")
    m = minutes.withColumns({"hour_ts": hour_ts, "mi": mi})
    in_b = F.col("has_bounds") == 1
    hw = Window.partitionBy(*K, "hour_ts")
    before = (Window.partitionBy(*K).orderBy("minute_ts")
              .rowsBetween(Window.unboundedPreceding, -1))
    last_minute = F.when(F.col("has_cte") == 1, F.struct(F.col("minute_ts").alias("m"), F.col("last_ts").alias("t")))
    m = m.select(*K, "hour_ts", "minute_ts", "mi", "has_cte",
                 F.max(F.when(in_b, F.col("mi"))).over(hw).alias("max_minute"),
                 F.min(F.when(in_b, F.col("mi"))).over(hw).alias("min_minute"),
                 F.last(last_minute, ignorenulls=True).over(before).alias("prev"))
    m = m.filter((F.col("has_cte") == 1) &
                 ((F.col("mi") == F.col("max_minute")) | (F.col("mi") == F.col("min_minute"))))
    return m.select(*K, "hour_ts", "minute_ts", "mi",
                    (F.col("mi") == F.col("max_minute")).alias("is_mx"),
                    (F.col("mi") == F.col("min_minute")).alias("is_mn"),
                    F.col("prev.m").alias("prev_minute_ts"), F.col("prev.t").alias("prev_ts"))


def hour_minute_bounds(minutes: DataFrame) -> DataFrame:
    """A2 (MaxMinutes) on its own: first and last minute of each hour with a
    reading in bounds. Output: key, hour_ts, max_minute, min_minute."""
    b = minutes.filter(F.col("has_bounds") == 1)
    return (b.groupBy(*K, tf.truncate_hour("minute_ts").alias("hour_ts"))
            .agg(F.max(F.minute("minute_ts")).alias("max_minute"),
                 F.min(F.minute("minute_ts")).alias("min_minute")))


def needed_minutes(rd: DataFrame) -> DataFrame:
    """The minutes whose readings ``boundary_values`` needs: at most three rows a tank-hour."""
    edge = boundary_minutes(minute_summary(rd))
    # minutes whose readings are needed: the boundary minutes themselves, and
    # for each first minute the previous minute with a reading (tagged with
    # the hour it serves). One join of the readings against this small set.
    no_ts = F.lit(None).cast("timestamp_ntz")
    roles = F.filter(F.array(
        F.struct(F.col("minute_ts").alias("m"), F.lit(False).alias("is_p"), F.col("is_mx").alias("is_mx"),
                 F.col("is_mn").alias("is_mn"), no_ts.alias("prev_ts")),
        F.when(F.col("is_mn") & F.col("prev_minute_ts").isNotNull(),
               F.struct(F.col("prev_minute_ts").alias("m"), F.lit(True).alias("is_p"), F.lit(False).alias("is_mx"),
                        F.lit(False).alias("is_mn"), F.col("prev_ts").alias("prev_ts")))),
        lambda x: x.isNotNull())
    return edge.select(*K, "hour_ts", "mi", F.explode(roles).alias("r")).select(
        *K, "hour_ts", "mi", F.col("r.m").alias("minute_ts"), "r.is_p", "r.is_mx", "r.is_mn", "r.prev_ts")


def boundary_values(gauges: DataFrame, *, year: int, months: Iterable[int], start: dt.date,
                    end: dt.date, stations: Sequence[str] | None = None,
                    series: DataFrame | None = None, written: DataFrame | None = None) -> DataFrame:
    """mx/mn rows (J3/J4) with their ``max_value`` / ``min_value``. ``written``: ``needed_minutes`` where the caller has
    written them already.

    Output: key, hour_ts, is_b (True for a last-minute 'mx' value), value.
    """
    rd = _readings(gauges, year=year, months=months, start=start, end=end,
                   stations=stations, series=series)
    # written: adaptive execution would shuffle all readings before it could see that this side is small
    need = written if written is not None else cut_lineage(needed_minutes(rd))
    rows = rd.filter(F.col("in_cte")).select(*K, "minute_ts", "ts", "reading_id", "volume")
    cand = rows.join(need, K + ["minute_ts"], "inner")
    # Everything below is partitioned by (series, hour), so the pair window,
    # its aggregate and the POS join reuse one exchange. The previous volume is
    # the last reading of the tagged previous minute (highest reading_id on a
    # tie in ts). LEAD/LAG within the minute run over the boundary rows of the
    # hour: the neighbour is "in the same minute" when its minute matches.
    pw = Window.partitionBy(*K, "hour_ts")
    at_prev = F.col("is_p") & (F.col("ts") == F.col("prev_ts"))
    w = Window.partitionBy(*K, "hour_ts", "is_p").orderBy("ts", "reading_id")
    nxt_same = F.lead("minute_ts", 1).over(w) == F.col("minute_ts")
    prv_same = F.lag("minute_ts", 1).over(w) == F.col("minute_ts")
    cand = cand.select(
        *K, "hour_ts", "is_p", "is_mx", "is_mn", "mi", "volume",
        F.max_by("volume", F.when(at_prev, F.col("reading_id"))).over(pw).alias("prev_vol"),
        F.lead("volume", 1).over(w).alias("next_in_min"),
        F.lag("volume", 1).over(w).alias("prev_in_min"),
        F.coalesce(nxt_same, F.lit(False)).alias("has_next"),
        F.coalesce(prv_same, F.lit(False)).alias("has_prev"),
    ).filter(~F.col("is_p"))
    early = F.col("mi") < 30  # (60 - minute) > minute
    max_value = F.when(F.col("has_next") & early, F.col("next_in_min")).otherwise(F.col("volume"))
    min_value = F.when(F.col("has_prev") & early, F.col("volume")).otherwise(
        F.when(F.col("has_prev"), F.col("prev_in_min")).otherwise(F.col("prev_vol")))
    # one pass emits both roles: a row of the last minute is an 'mx' value,
    # a row of the first minute an 'mn' value (both when they are the same minute)
    roles = F.filter(F.array(
        F.when(F.col("is_mx"), F.struct(F.lit(True).alias("is_b"), max_value.alias("value"))),
        F.when(F.col("is_mn"), F.struct(F.lit(False).alias("is_b"), min_value.alias("value")))),
        lambda x: x.isNotNull())
    r = cand.select(*K, "hour_ts", F.explode(roles).alias("r"))
    return r.select(*K, "hour_ts", "r.is_b", "r.value")


def pair_outflow(values: DataFrame) -> DataFrame:
    """Sum of ``min_value - max_value`` over all (mx, mn) pairs of an hour,
    without forming the pairs.

    With A the first-minute values and B the last-minute values of an hour:
    for each non-null a, ``cnt_le`` = #{b <= a} and ``sum_le`` = sum{b <= a}
    (running count and sum over the values sorted ascending, b before an equal
    a). Then sum over pairs with a >= b of (a - b) = sum_a (a * cnt_le - sum_le),
    #{a >= b} = sum_a cnt_le, #{a < b} = |A'| |B'| - #{a >= b}.

    Output: key, hour_ts, pairs (= |A| |B|, nulls included), gain_sum,
    gain_pairs (#pairs with diff >= 0), drop_pairs (#pairs with diff < 0).
    """
    key = K + ["hour_ts"]
    is_b = F.col("is_b")
    nn = F.col("value").isNotNull()
    w = (Window.partitionBy(*key).orderBy(F.col("value").asc_nulls_first(), F.when(is_b, 0).otherwise(1))
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    run = values.select(*key, "is_b", "value",
                        F.count(F.when(is_b & nn, 1)).over(w).alias("cnt_le"),
                        F.sum(F.when(is_b & nn, F.col("value")).otherwise(0.0)).over(w).alias("sum_le"))
    a_nn = ~is_b & nn
    agg = (run.groupBy(*key)
           .agg(F.count(F.when(~is_b, 1)).alias("all_a"),
                F.count(F.when(is_b, 1)).alias("all_b"),
                F.count(F.when(a_nn, 1)).alias("n_a"),
                F.count(F.when(is_b & nn, 1)).alias("n_b"),
                F.sum(F.when(a_nn, F.col("value") * F.col("cnt_le") - F.col("sum_le"))).alias("gain_sum"),
                F.sum(F.when(a_nn, F.col("cnt_le"))).alias("gain_pairs")))
    gain_pairs = F.coalesce(F.col("gain_pairs"), F.lit(0)).cast("bigint")
    return agg.filter(F.col("all_a") * F.col("all_b") > 0).select(
        *key,
        (F.col("all_a") * F.col("all_b")).alias("pairs"),
        F.coalesce(F.col("gain_sum"), F.lit(0.0)).alias("gain_sum"),
        gain_pairs.alias("gain_pairs"),
        (F.col("n_a") * F.col("n_b") - gain_pairs).alias("drop_pairs"),
    )


def hourly_tank_outflow(receipts: DataFrame, shifts: DataFrame, items: DataFrame, gauges: DataFrame, *,
                        year: int, months: Iterable[int], start: dt.date, end: dt.date,
                        stations: Sequence[str] | None = None, series: DataFrame | None = None,
                        net_only_stations: Sequence[str] = ()) -> DataFrame:
    """The hourly extract.

    Output: station, product, tank, date ('dd.MM.yyyy'), hour (int), quantity, pairs.
    ``stations`` restricts every input to those stations (the source's
    single-station literal); ``series`` (a frame with the key columns)
    restricts the readings to those tanks.
    """
    months = list(months)
    rd = _readings(gauges, year=year, months=months, start=start, end=end, stations=stations, series=series)
    z, need = cut_lineages(month_shifts(shifts, year=year, months=months), needed_minutes(rd))
    np_ = pos_hourly_sales(receipts, shifts, items, year=year, months=months, stations=stations,
                           net_only_stations=net_only_stations, written=z)
    vals = boundary_values(gauges, year=year, months=months, start=start, end=end,
                           stations=stations, series=series, written=need)
    po = pair_outflow(vals)
    j = po.join(np_, K + ["hour_ts"], "inner")
    # Every negative pair diff is replaced by the POS volume.
    fallback_ok = F.col("pos_volume").isNotNull()
    total = F.col("gain_sum") + F.when(fallback_ok, F.col("pos_volume") * F.col("drop_pairs")).otherwise(0.0)
    nonnull_pairs = F.col("gain_pairs") + F.when(fallback_ok, F.col("drop_pairs")).otherwise(0)
    quantity = F.when(nonnull_pairs > 0, total / F.col("pairs"))
    return j.select(*K, tf.format_date("hour_ts").alias("date"),
                    F.hour("hour_ts").alias("hour"),
                    quantity.alias("quantity"), F.col("pairs").cast("bigint").alias("pairs"))
