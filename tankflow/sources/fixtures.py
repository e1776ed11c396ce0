"""Adapters that shape the driver-generated tables into our input model.

The driver tables (``events``, ``lineitem``) stand in for gauge readings,
receipts and receipt items. Every adapter is a plain projection of a
parquet scan, so filters and column pruning of later stages reach the scan.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import sf_path
from . import schema as S

PRODUCT_BASE = 3300000000

# Event type -> product code offset used by the adapters.
EVENT_PRODUCT_OFFSET = {"click": 0, "view": 2, "signup": 5, "purchase": 8, "error": 10}
# Supplier bucket -> product code offset (index = l_suppkey % 5).
SUPPLIER_PRODUCT_OFFSET = [0, 2, 5, 8, 10]

# The one station whose hour-0 orders are written as hour 24 of the day
# before, to exercise the rollover.
ROLLOVER_STATION = "S0"

# Parameters of the test scenario (one row per series in the config).
TEST_SCENARIO = dict(
    cutoff=dt.datetime(2024, 1, 25),
    actual_from=dt.datetime(2024, 1, 25),
    actual_to=dt.datetime(2024, 1, 26),
    window=7,
    start=dt.datetime(2024, 1, 25, 16),
    end=dt.datetime(2024, 1, 27, 23, 59, 59),
    w_base=0.3,
    w_model=0.7,
    initial=400.0,
    dead_stock=50.0,
    score_from=dt.datetime(2024, 1, 25),
    score_to=dt.datetime(2024, 1, 26),
)
# What differs from TEST_SCENARIO in some series: (SQL condition on the key, parameters); later ones win.
SERIES_SCENARIOS = (
    ("station = 'S1'", dict(window=2, w_base=0.5, w_model=0.4, cutoff=dt.datetime(2024, 1, 24))),
    ("station = 'S2'", dict(window=3, end=dt.datetime(2024, 1, 26, 23, 59, 59), initial=250.0)),
    ("station = 'S3' AND product = 3300000005", dict(score_from=dt.datetime(2024, 1, 25, 6))),
    # never reaches dead stock: its extension ends at the cap
    ("station = 'S0' AND product = 3300000000", dict(dead_stock=-1e9)),
)
# Series that no configuration names: they are left out of every forecast.
UNCONFIGURED = "station = 'S3' AND product = 3300000010"
TEST_YEAR = 2024
TEST_MONTHS = (1,)
TEST_BOUNDS = (dt.date(2024, 1, 2), dt.date(2024, 1, 28))
# Days inside the test month, for the event terms: (event, day, lower, upper).
TEST_EVENTS = [("fair", "2024-01-10", -1, 1), ("holiday", "2024-01-20", 0, 1), ("fair", "2024-01-24", -1, 1)]
# Besides the fixed list one station of the test data counts as net-only.
TEST_NET_ONLY = (*S.NET_ONLY_STATIONS, "S2")


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(sf_path(sf_dir, table))


def _station(user_id: Column) -> Column:
    return F.concat(F.lit("S"), (user_id % 4).cast("string"))


def _event_product(event_type: Column) -> Column:
    expr = None
    for name, off in EVENT_PRODUCT_OFFSET.items():
        cond = event_type == F.lit(name)
        val = F.lit(PRODUCT_BASE + off).cast("bigint")
        expr = F.when(cond, val) if expr is None else expr.when(cond, val)
    return expr


def gauges(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _read(spark, sf_dir, "events")
    return ev.select(
        _station(ev.user_id).alias("station"),
        _event_product(ev.event_type).alias("product"),
        F.lit(1).cast("int").alias("tank"),
        ev.ts.cast("timestamp_ntz").alias("ts"),
        ev.value.cast("double").alias("volume"),
        ev.event_id.alias("reading_id"),
    )


def receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _read(spark, sf_dir, "events")
    ts = ev.ts.cast("timestamp_ntz")
    return ev.select(
        ev.event_id.alias("id"),
        _station(ev.user_id).alias("station"),
        (ev.user_id % 10).cast("bigint").alias("znum"),
        F.date_trunc("DAY", ts).cast("timestamp_ntz").alias("shift_start"),
        ts.alias("start_ts"),
    )


def shifts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shift reports: none for shift 9 (its receipts match nothing), and an empty shift 99 each day."""
    seen = receipts(spark, sf_dir).select("station", "znum", "shift_start").distinct()
    empty = seen.filter("znum = 0").withColumn("znum", F.lit(99).cast("bigint"))
    return seen.filter("znum <> 9").unionByName(empty)


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _read(spark, sf_dir, "lineitem")
    offsets = F.array(*[F.lit(o) for o in SUPPLIER_PRODUCT_OFFSET])
    return li.select(
        li.l_orderkey.alias("receipt_id"),
        (F.lit(PRODUCT_BASE) + F.element_at(offsets, (li.l_suppkey % 5 + 1).cast("int"))).cast("bigint").alias("product"),
        F.lit(1).cast("int").alias("tank"),
        F.when(li.l_returnflag == "R", 1).otherwise(0).cast("int").alias("prodtype"),
        F.when(li.l_linenumber == 5, 0.0).otherwise(li.l_extendedprice).alias("bruto"),
        F.when((li.l_linenumber == 5) & (li.l_quantity > 40), 0.0).otherwise(li.l_quantity).alias("volume"),
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly pre-aggregate of gauge volume (the database variant's input).

    Sums run in DECIMAL (the source has two decimals) so the totals are exact.
    For ``ROLLOVER_STATION`` hour 0 of a day is written as hour 24 of the day
    before.
    """
    g = gauges(spark, sf_dir)
    hourly = (g.groupBy("station", "product", "tank",
                        F.to_date(g.ts).alias("day"), F.hour(g.ts).alias("hr"))
              .agg(F.sum(g.volume.cast("decimal(18,2)")).alias("vol")))
    relabel = (hourly.station == ROLLOVER_STATION) & (hourly.hr == 0)
    return hourly.select(
        "station",
        F.when(relabel, F.date_sub(hourly.day, 1)).otherwise(hourly.day).alias("r_day"),
        F.when(relabel, F.lit(24)).otherwise(hourly.hr).cast("int").alias("r_hour"),
        "product", "tank",
        hourly.vol.cast("double").alias("volume"),
    )


def hourly_from_gauges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Minimum-slice hourly extract: hourly gauge volume per series, as text date + int hour."""
    g = gauges(spark, sf_dir)
    agg = (g.groupBy("station", "product", "tank",
                     F.date_format(g.ts, "dd.MM.yyyy").alias("date"), F.hour(g.ts).alias("hour"))
           .agg(F.sum(g.volume.cast("decimal(18,2)")).alias("q")))
    return agg.select("station", "product", "tank", "date", F.col("hour").cast("int"),
                      F.col("q").cast("double").alias("quantity"))


def fuels(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(S.FUEL_CODES, S.FUELS)


def calendar(spark: SparkSession, events=TEST_EVENTS) -> DataFrame:
    """The event calendar (``schema.SPECIAL_EVENTS`` has the scripts' own days)."""
    rows = [(e, dt.date.fromisoformat(d), lo, up) for e, d, lo, up in events]
    return spark.createDataFrame(rows, S.CALENDAR)


def most_window(**params) -> int:
    """The largest window that ``make_config`` with these parameters gives a series."""
    return params["window"] if "window" in params else max([TEST_SCENARIO["window"], *[own["window"] for _, own in SERIES_SCENARIOS if "window" in own]])


def make_config(series: DataFrame, **params) -> DataFrame:
    """One config row per distinct series of ``series`` but the unconfigured ones: the scenario's values,
    what differs for the series, and ``params`` over both."""
    keys = series.select(*S.SERIES_KEY).distinct().filter(~F.expr(UNCONFIGURED))
    cols = {}
    for f in S.CONFIG.fields:
        if f.name in S.SERIES_KEY:
            continue
        value = F.lit(TEST_SCENARIO[f.name])
        for condition, own in SERIES_SCENARIOS:
            if f.name in own:
                value = F.when(F.expr(condition), F.lit(own[f.name])).otherwise(value)
        cols[f.name] = (F.lit(params[f.name]) if f.name in params else value).cast(f.dataType)
    return keys.withColumns(cols).select(*S.CONFIG.fieldNames())
