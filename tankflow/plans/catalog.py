"""Registered queries: name -> (Spark plan builder, DuckDB oracle SQL or None).

Every query reads the driver tables of ``sf_dir`` (or frames Spark derives
from them) in full. Double outputs are rounded to six decimals on both
sides so that float summation order cannot change the value hash.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import metrics as M
from ..operators import model as md
from ..sources.schema import FUEL_CODES, HOURLY_HEADERS
from . import oracle as O
from .pipeline import Pipeline

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}


def register(name: str, sql: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def rounded(df: DataFrame) -> DataFrame:
    """Round every double column to six decimals."""
    return df.select(*[M.rounded(f.name).alias(f.name) if isinstance(f.dataType, T.DoubleType)
                       else F.col(f.name) for f in df.schema.fields])


K3 = O.KEYS

# ---------------------------------------------------------------- C1 / A1 / A2
register("hourly_tank_outflow", O.sql(
    f"SELECT {K3}, date, hour, {O.r6('quantity', 'quantity')}, pairs FROM hourly", "hourly"))(
    lambda spark, sf: rounded(Pipeline(spark, sf).hourly_plan))


@register("pos_hourly_sales", O.sql(
    f"SELECT {K3}, strftime(hour_ts, '%d.%m.%Y') AS date, CAST(hour(hour_ts) AS INTEGER) AS hour, "
    f"{O.r6('sold', 'pos_volume')} FROM pos_volume", "pos_volume"))
def _pos(spark, sf):
    p = Pipeline(spark, sf).pos_sales
    return rounded(p.select("station", "product", "tank", F.date_format("hour_ts", "dd.MM.yyyy").alias("date"),
                            F.hour("hour_ts").alias("hour"), "pos_volume"))


@register("hour_minute_bounds", O.sql(
    f"SELECT {K3}, strftime(hour_ts, '%d.%m.%Y') AS date, CAST(hour(hour_ts) AS INTEGER) AS hour, "
    "CAST(minute(last_minute) AS INTEGER) AS max_minute, CAST(minute(first_minute) AS INTEGER) AS min_minute "
    "FROM hour_edges", "hour_edges"))
def _bounds(spark, sf):
    from ..operators import outflow as of
    p = Pipeline(spark, sf)
    rd = of._readings(p.gauges, year=p.year, months=p.months, start=p.bounds[0], end=p.bounds[1],
                      stations=None, series=None)
    b = of.hour_minute_bounds(of.minute_summary(rd))
    return b.select("station", "product", "tank", F.date_format("hour_ts", "dd.MM.yyyy").alias("date"),
                    F.hour("hour_ts").alias("hour"), "max_minute", "min_minute")


@register("hour_edge_readings", O.sql(
    f"SELECT {K3}, CAST(hour_ts AS TIMESTAMP) AS hour_ts, edge, {O.r6('value', 'value')} FROM edge_readings", "edge_readings"))
def _edges(spark, sf):
    """The values that stand for an hour's first and last minute."""
    from ..operators import outflow as of
    p = Pipeline(spark, sf)
    v = of.boundary_values(p.gauges, year=p.year, months=p.months, start=p.bounds[0], end=p.bounds[1])
    return rounded(v.select("station", "product", "tank", "hour_ts",
                            F.when(F.col("is_b"), "last").otherwise("first").alias("edge"), "value"))


# ---------------------------------------------------------------- S1, S5, S6: written, then read again
def _new_folder(spark, name: str) -> str:
    """A folder of its own under the checkpoint folder."""
    import uuid

    from ..session import checkpoint_dir
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@register("scan_hourly_csv", O.sql(
    f"SELECT {K3}, date, hour, {O.r6('quantity', 'quantity')} FROM hourly", "hourly"))
def _s1(spark, sf):
    from ..sources import readers as rd
    path = _new_folder(spark, "extract-csv")
    rd.write_extract_csv(Pipeline(spark, sf).hourly_plan, path)
    return rounded(rd.read_hourly_csv(spark, path).where("corrupt_record IS NULL").drop("corrupt_record"))


@register("sink_extract_csv", O.sql(
    f"SELECT {K3}, date, hour, {O.r6('quantity', 'quantity')}, pairs FROM hourly", "hourly"))
def _s5(spark, sf):
    from ..sources import readers as rd
    path = _new_folder(spark, "extract-csv")
    rd.write_extract_csv(Pipeline(spark, sf).hourly_plan, path, pairs=True)
    kinds = "station string, product long, tank int, date string, hour int, quantity double, pairs long"
    return rounded(spark.read.schema(kinds).option("header", True).csv(path))


@register("sink_comparison_csv", O.sql(
    f"SELECT {K3}, ds, {O.r6('yhat', 'yhat')}, {O.r6('quantity', 'quantity')}, "
    f"{O.r6('accuracy', 'accuracy')} FROM scored", "scored"))
def _s6(spark, sf):
    from ..sources import readers as rd
    path = _new_folder(spark, "comparison-csv")
    rd.write_comparison(Pipeline(spark, sf).comparison, path)
    return rounded(rd.read_comparison(spark, path))


# ---------------------------------------------------------------- C3 and splits
register("clean_hourly_series", O.sql(
    f"SELECT {K3}, ds, {O.r6('quantity', 'quantity')}, weekday, hour FROM series", "series"))(
    lambda spark, sf: rounded(Pipeline(spark, sf).series))

register("split_history", O.sql(
    f"SELECT {K3}, ds, {O.r6('quantity', 'quantity')}, weekday, hour FROM history", "history"))(
    lambda spark, sf: rounded(Pipeline(spark, sf).history))

register("split_actual", O.sql(
    f"SELECT {K3}, ds, {O.r6('quantity', 'quantity')}, weekday, hour FROM actual", "actual"))(
    lambda spark, sf: rounded(Pipeline(spark, sf).actual))

# ---------------------------------------------------------------- baseline, forecast, depletion
register("similar_day_mean", O.sql(
    f"SELECT {K3}, weekday, hour, {O.r6('baseline', 'baseline')} FROM baseline", "baseline"))(
    lambda spark, sf: rounded(Pipeline(spark, sf).baseline))

register("hybrid_forecast", O.sql(
    f"SELECT {K3}, ds, weekday, hour, {O.r6('baseline', 'baseline')}, model_yhat, "
    f"{O.r6('yhat', 'yhat')} FROM forecast", "forecast"))(
    lambda spark, sf: rounded(Pipeline(spark, sf).forecast))

register("tank_level", O.sql(
    f"SELECT {K3}, ds, {O.r6('yhat', 'yhat')}, {O.r6('level', 'level')} FROM level", "level"))(
    lambda spark, sf: rounded(Pipeline(spark, sf).level))

register("depletion_forecast", O.sql(
    f"SELECT {K3}, ds, {O.r6('yhat', 'yhat')}, {O.r6('level', 'level')}, extension FROM depletion",
    "depletion"))(
    lambda spark, sf: rounded(Pipeline(spark, sf).depletion))

# Same plan with a larger opening volume, so the extension rows are exercised.
EXT_INITIAL = 2000.0
register("depletion_extension", O.sql(
    f"SELECT {K3}, ds, {O.r6('yhat', 'yhat')}, {O.r6('level', 'level')}, "
    f"min(CASE WHEN level <= stock THEN 0 ELSE 1 END) OVER (PARTITION BY {K3}) = 1 AS capped "
    f"FROM (SELECT e.*, c.dead_stock AS stock FROM ext e JOIN cfg c ON {O.keys_eq('e', 'c')})", "ext", "cfg",
    overrides={"cfg": (("hourly",), O.cfg_sql(initial=repr(EXT_INITIAL)))}))(
    lambda spark, sf: rounded(Pipeline(spark, sf, initial=EXT_INITIAL).extension))

# walked week by week: no quotient says in which week the level gets there
register("dead_stock_crossing", O.sql(f"""
    SELECT {K3}, CAST(min(q * 168 + r) FILTER (WHERE run >= left_then) AS BIGINT) AS cross_step,
           COALESCE(min(q * 168 + r) FILTER (WHERE run >= left_then), 1001) > 1000 AS capped
    FROM first_week JOIN (SELECT {K3}, max(q) AS q, arg_max(need, q) AS left_then FROM walk GROUP BY {K3}) USING ({K3})
    GROUP BY {K3}""", "first_week", "walk", overrides={
        "cfg": (("hourly",), O.cfg_sql(initial=repr(EXT_INITIAL))),
        "first_week": (("steps_y",), f"""
        SELECT {K3}, k AS r, last_level - dead_stock AS need, SUM(y) OVER (PARTITION BY {K3} ORDER BY k) AS run,
               SUM(y) OVER (PARTITION BY {K3}) AS total
        FROM steps_y WHERE k <= 168"""),
        "weeks": (("first_week",), f"""
        SELECT {K3}, any_value(need) AS need, any_value(total) AS total, max(run) AS most FROM first_week GROUP BY {K3}"""),
        "walk": (("weeks",), f"""
        SELECT {K3}, 0 AS q, need, total, most FROM weeks
        UNION ALL
        SELECT {K3}, q + 1, need - total, total, most FROM walk WHERE need > most AND total > 0"""),
    }).replace("WITH ", "WITH RECURSIVE ", 1))(
    lambda spark, sf: Pipeline(spark, sf, initial=EXT_INITIAL).crossing)

register("first_dead_stock_hour", O.sql(
    f"SELECT {K3}, ds, {O.r6('level', 'level')} FROM first_dead", "first_dead"))(
    lambda spark, sf: rounded(Pipeline(spark, sf).first_dead_stock))

register("first_dead_stock_after_extension", O.sql(
    f"SELECT {K3}, ds, {O.r6('level', 'level')} FROM first_dead", "first_dead",
    overrides={"cfg": (("hourly",), O.cfg_sql(initial=repr(EXT_INITIAL)))}))(
    lambda spark, sf: rounded(Pipeline(spark, sf, initial=EXT_INITIAL).first_dead_stock))

# ---------------------------------------------------------------- C6
register("forecast_evaluation", O.sql(
    f"SELECT {K3}, ds, {O.r6('yhat', 'yhat')}, {O.r6('quantity', 'quantity')}, "
    f"{O.r6('accuracy', 'accuracy')} FROM scored", "scored"))(
    lambda spark, sf: rounded(Pipeline(spark, sf).comparison))

register("mean_accuracy", O.sql(
    f"SELECT {K3}, {O.r6('mean_accuracy', 'mean_accuracy')}, CAST(scored_rows AS BIGINT) AS scored_rows "
    "FROM mean_acc", "mean_acc"))(
    lambda spark, sf: rounded(Pipeline(spark, sf).mean_accuracy))


# ---------------------------------------------------------------- C7 / C8 / O4
_ORDERS_OVERRIDES = {
    "parsed0": (("orders",), """
        SELECT station, product, tank, r_day AS d, CASE WHEN r_hour = 24 THEN 0 ELSE r_hour END AS h,
               COALESCE(volume, 0) AS q, CAST(1 AS BIGINT) AS w
        FROM orders"""),
    "cfg": (("orders",), O.cfg_sql(source="orders")),
}

register("orders_to_forecast", O.sql(
    f"SELECT {K3}, ds, {O.r6('yhat', 'yhat')}, {O.r6('quantity', 'quantity')}, "
    f"{O.r6('accuracy', 'accuracy')} FROM scored", "scored", overrides=_ORDERS_OVERRIDES))(
    lambda spark, sf: rounded(Pipeline(spark, sf, source="orders").comparison))

register("gauges_to_forecast", O.sql(
    f"SELECT {K3}, ds, {O.r6('yhat', 'yhat')}, {O.r6('quantity', 'quantity')}, {O.r6('accuracy', 'accuracy')} FROM scored", "scored",
    overrides={"hourly": (("gauges",), f"""
        SELECT {K3}, strftime(ts, '%d.%m.%Y') AS date, CAST(hour(ts) AS INTEGER) AS hour,
               CAST(SUM(CAST(volume AS DECIMAL(18,2))) AS DOUBLE) AS quantity, CAST(1 AS BIGINT) AS pairs
        FROM gauges GROUP BY {K3}, strftime(ts, '%d.%m.%Y'), hour(ts)""")}))(
    lambda spark, sf: rounded(Pipeline(spark, sf, source="gauges").comparison))


@register("series_span_report", O.sql(f"""
    SELECT {K3}, CAST(date_diff('hour', lo, hi) + 1 AS BIGINT) AS grid_hours, date_diff('hour', lo, hi) + 1 > 600 AS too_long
    FROM sbounds""", "sbounds"))
def _span_report(spark, sf):
    """How long each series' grid would be, before it is made."""
    from ..operators import quality as qu
    from ..operators import series as se
    obs = se.dedupe_mean(se.parse_hourly(Pipeline(spark, sf).hourly))
    return qu.series_span(se.series_bounds(obs), most_hours=600)


_SPOILT = {"spoilt": (("hourly",), """
    SELECT station, CAST(CASE WHEN station = 'S3' AND hour = 5 THEN 42 ELSE product END AS BIGINT) AS product, tank,
           CASE WHEN hour = 13 THEN '31.02.2024' ELSE date END AS date, hour = 13 AS bad_date,
           CASE WHEN hour % 8 <> 7 THEN hour END AS hour, quantity
    FROM hourly""")}
_FUELS_SQL = ", ".join(f"('{n}', CAST({c} AS BIGINT))" for n, c in FUEL_CODES)
_FUELS_CTE = {"fuels": ((), f"SELECT * FROM (VALUES {_FUELS_SQL}) AS t(fuel_name, product)")}

register("data_quality_report", O.sql("""
    SELECT finding, row_count FROM (
      SELECT 'empty_input' AS finding, CAST(CASE WHEN n = 0 THEN 1 ELSE 0 END AS BIGINT) AS row_count FROM qa
      UNION ALL SELECT 'unparseable_date', CAST(bad AS BIGINT) FROM qa
      UNION ALL SELECT 'null_hour', CAST(nh AS BIGINT) FROM qa
      UNION ALL SELECT 'corrupt_row', CAST(0 AS BIGINT) FROM qa
      UNION ALL SELECT 'null_quantity', CAST(nq AS BIGINT) FROM qa
      UNION ALL SELECT 'unknown_fuel', CAST(unk AS BIGINT) FROM qa)""", "qa",
    overrides={**_FUELS_CTE, **_SPOILT, "qa": (("spoilt", "fuels"), """
        SELECT count(*) AS n, count_if(bad_date) AS bad, count_if(hour IS NULL AND NOT bad_date) AS nh,
               count_if(quantity IS NULL) AS nq, count_if(f.product IS NULL) AS unk
        FROM spoilt h LEFT JOIN fuels f ON h.product = f.product""")}))(
    lambda spark, sf: _quality(spark, sf))


def _spoilt_rows(spark, sf):
    """The extract with bad dates, null hours and an unknown product in some rows."""
    h = Pipeline(spark, sf).hourly_plan
    return h.select("station", F.when((F.col("station") == "S3") & (F.col("hour") == 5), F.lit(42)).otherwise(F.col("product"))
                    .cast("bigint").alias("product"), "tank",
                    F.when(F.col("hour") == 13, F.lit("31.02.2024")).otherwise(F.col("date")).alias("date"),
                    F.when(F.col("hour") % 8 != 7, F.col("hour")).alias("hour"), "quantity", "pairs")


def _quality(spark, sf):
    from ..operators.quality import quality_report
    from ..sources import fixtures as fx
    return quality_report(_spoilt_rows(spark, sf), fx.fuels(spark))


@register("parse_date_lenient", O.sql(f"""
    SELECT {K3}, date, COALESCE(hour, -1) AS hour, {O.r6('quantity', 'quantity')},
           CASE WHEN bad_date THEN 'bad_date' ELSE 'null_hour' END AS reason
    FROM spoilt WHERE bad_date OR hour IS NULL""", "spoilt", overrides=_SPOILT))
def _x6(spark, sf):
    """The rows that the series can't take, with the reason."""
    from ..operators.series import rejected_rows
    return rounded(rejected_rows(_spoilt_rows(spark, sf)).withColumn("hour", F.coalesce("hour", F.lit(-1))))

register("chart_feed", O.sql(f"""
    SELECT {K3}, ds, series_name, {O.r6('value', 'value')} FROM (
      SELECT {K3}, ds, 'history' AS series_name, quantity AS value FROM history
      UNION ALL SELECT {K3}, ds, 'forecast', yhat FROM depletion
      UNION ALL SELECT {K3}, ds, 'accuracy', accuracy FROM scored
      UNION ALL SELECT {K3}, ds, 'level', level FROM depletion
      UNION ALL SELECT d.station, d.product, d.tank, d.ds, 'dead_stock', c.dead_stock
                FROM depletion d JOIN cfg c ON {O.keys_eq('d', 'c')}
      UNION ALL SELECT {K3}, ds, 'actual', quantity FROM actual)""",
    "history", "depletion", "scored", "actual", "cfg"))(
    lambda spark, sf: rounded(Pipeline(spark, sf).chart_feed))

# ---------------------------------------------------------------- model (M1-M6)
register("model_training_frame", O.sql(
    f"SELECT {K3}, ds, {O.r6('quantity', 'y')} FROM history", "history"))(
    lambda spark, sf: rounded(md.model_training_frame(Pipeline(spark, sf).history)))

register("model_future_frame", O.sql(f"""
    SELECT {K3}, ds FROM history
    UNION ALL
    SELECT {K3}, last_ds + to_hours(CAST(i AS BIGINT)) AS ds
    FROM (SELECT {K3}, max(ds) AS last_ds, unnest(generate_series(1, 48)) AS i FROM history GROUP BY {K3})""",
    "history"))(
    lambda spark, sf: md.model_future_frame(Pipeline(spark, sf).history))


@register("event_window_expand", O.sql(f"""
    SELECT {K3}, ds, event, CAST(CAST(ds AS DATE) - day AS INTEGER) AS day_offset
    FROM series JOIN (VALUES ('fair', DATE '2024-01-10', -1, 1), ('holiday', DATE '2024-01-20', 0, 1),
                             ('fair', DATE '2024-01-24', -1, 1)) AS e(event, day, lo, up)
      ON CAST(ds AS DATE) BETWEEN day + lo AND day + up""", "series"))
def _events(spark, sf):
    """The event terms that are on, hour by hour."""
    from ..sources import fixtures as fx
    from ..sources import schema as S
    on = md.event_window_expand(fx.calendar(spark)).drop("station")  # this calendar holds for all
    s = Pipeline(spark, sf).series.select(*S.SERIES_KEY, "ds", F.to_date("ds").alias("date"))
    return s.join(on, "date").select(*S.SERIES_KEY, "ds", "event", F.col("offset").alias("day_offset"))


# C4 with a model's prediction (``standin``) and its fallback.
_LOOKUP = (("horizon", "baseline", "cfg", "standin"), f"""
        SELECT z.station, z.product, z.tank, z.ds, z.weekday, z.hour,
               COALESCE(b.baseline, 0) AS baseline, s.yhat AS model_yhat,
               c.w_base * COALESCE(b.baseline, 0) + c.w_model * COALESCE(s.yhat, b.baseline, 0) AS yhat
        FROM horizon z
        JOIN cfg c ON {O.keys_eq('z', 'c')}
        LEFT JOIN baseline b ON {O.keys_eq('z', 'b')} AND z.weekday = b.weekday AND z.hour = b.hour
        LEFT JOIN standin s ON {O.keys_eq('z', 's')} AND z.ds = s.ds""")

#: The event terms of fixtures.TEST_EVENTS in the order of the features.
_TERMS = [("fair", -1), ("fair", 0), ("fair", 1), ("holiday", 0), ("holiday", 1)]


def _model_ctes(coefficients: str | None = None, mode: str = "additive") -> dict:
    """The model's features in SQL, the layout of ``model.model_features``: ``mfeat`` over the history, ``pfeat`` over the
    history and 48 hours more; and the prediction from a written table of coefficients, as ``standin`` of J8."""
    spec = md.ModelSpec(events=tuple(_TERMS))
    t = "((epoch(h.ds) - epoch(c.t0)) / 3600.0 / c.span_h)"
    feats = [f"{t}", "1.0"]
    for j in range(1, md.N_CHANGEPOINTS + 1):
        pos = f"(round_even({float(j)!r} * (c.hist_size - 1) / c.ncp, 0) / c.span_h)"
        feats.append(f"CASE WHEN c.ncp >= {j} THEN greatest({t} - {pos}, 0.0) ELSE 0.0 END")
    day = "(epoch(h.ds) / 86400.0)"
    for name, order, period, _, _ in spec.seasonal_blocks:
        for i in range(1, order + 1):
            w = repr(2.0 * i * math.pi / period)
            feats.append(f"CASE WHEN c.use_{name} THEN sin({w} * {day}) ELSE 0.0 END")
            feats.append(f"CASE WHEN c.use_{name} THEN cos({w} * {day}) ELSE 0.0 END")
    feats += [f"CASE WHEN list_contains(e.terms, '{event}:{offset}') THEN 1.0 ELSE 0.0 END" for event, offset in _TERMS]
    flags = ", ".join(f"span_h / 24.0 >= {m!r} AS use_{n}" for n, _, _, _, m in spec.seasonal_blocks)
    features = f"""
        SELECT h.*, c.y_scale, [{", ".join(feats)}] AS x
        FROM {{rows}} h JOIN mscale c ON {O.keys_eq('h', 'c')} LEFT JOIN event_on e ON e.d = CAST(h.ds AS DATE)"""
    ctes = {
        "mscale": (("history",), f"""
        SELECT {K3}, t0, hist_size, greatest(least(25, hist_size - 1), 0) AS ncp, span_h, CASE WHEN ymax > 0 THEN ymax ELSE 1.0 END AS y_scale, {flags}
        FROM (SELECT {K3}, min(ds) AS t0, CAST(floor(count(*) * 0.8) AS INTEGER) AS hist_size, max(abs(quantity)) AS ymax,
                     greatest((epoch(max(ds)) - epoch(min(ds))) / 3600.0, 1.0) AS span_h
              FROM history GROUP BY {K3})"""),
        "event_on": ((), """
        SELECT day + CAST(off AS INTEGER) AS d, list(event || ':' || off) AS terms
        FROM (SELECT event, day, unnest(generate_series(lo, up)) AS off
              FROM (VALUES ('fair', DATE '2024-01-10', -1, 1), ('holiday', DATE '2024-01-20', 0, 1),
                           ('fair', DATE '2024-01-24', -1, 1)) AS e(event, day, lo, up)) GROUP BY ALL"""),
        "mfeat": (("history", "mscale", "event_on"), features.format(rows="history")),
        "pframe": (("history",), f"""
        SELECT {K3}, ds FROM history
        UNION ALL
        SELECT {K3}, last_ds + to_hours(CAST(i AS BIGINT)) AS ds
        FROM (SELECT {K3}, max(ds) AS last_ds, unnest(generate_series(1, 48)) AS i FROM history GROUP BY {K3})"""),
        "pfeat": (("pframe", "mscale", "event_on"), features.format(rows="pframe")),
    }
    ctes["event_on"] = ((), ctes["event_on"][1].replace("GROUP BY ALL", "GROUP BY day + CAST(off AS INTEGER)"))
    if coefficients:
        dot = lambda lo, hi: f"list_sum(list_transform(range({lo + 1}, {hi + 1}), lambda i: p.x[i] * b.beta[i]))"
        k, n = len(spec.feature_names()), md.N_TREND
        yhat = dot(0, k) if mode == "additive" else f"{dot(0, n)} * (1.0 + {dot(n, k)})"
        ctes["coef"] = ((), f"SELECT * FROM read_parquet('{RESULTS}/{coefficients}/*.parquet')")
        ctes["standin"] = (("pfeat", "coef"), f"""
        SELECT p.station, p.product, p.tank, p.ds, ({yhat}) * p.y_scale AS yhat FROM pfeat p JOIN coef b ON {O.keys_eq('p', 'b')}""")
        ctes["forecast"] = _LOOKUP
    return ctes


#: Stands for ``session.results_base()`` until ``oracle_sql()`` is called.
RESULTS = "@results@"


def _model_pipeline(spark, sf, name: str, mode: str = "additive") -> Pipeline:
    """A pipeline whose fitted coefficients are saved under ``name``, for SQL that evaluates them."""
    from ..session import save_result
    p = Pipeline(spark, sf, model=mode)
    save_result(p.fitted[0], name)
    return p


@register("model_features", O.sql(f"""
    SELECT {K3}, ds, CAST(unnest(range(0, len(x))) AS INTEGER) AS feature, round(unnest(x), 6) + 0.0 AS value FROM mfeat""",
    "mfeat", overrides=_model_ctes()))
def _features(spark, sf):
    p = Pipeline(spark, sf)
    train = md.model_training_frame(p.history)
    f = md.model_features(train, md.series_scaling(train, p.spec), p.spec, p.event_days)
    return rounded(f.select("station", "product", "tank", "ds", F.posexplode("x").alias("feature", "value")))


def _grams(p: Pipeline) -> DataFrame:
    train = md.model_training_frame(p.history)
    return md.gram_by_series(md.training_rows(train, md.series_scaling(train, p.spec), p.spec, p.event_days))


# M3 with calendars by station: orders as events of their customer's station, by priority, the days spread over 14 years,
# some lasting two days; every 50th holds for all stations.
_STATION_CALENDAR = """
        SELECT CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE 'S' || CAST(o_custkey % 4 AS {text}) END AS station,
               lower(substr(o_orderpriority, 3)) AS event,
               date_add(DATE '2012-01-01', CAST(o_orderkey * 7919 % 5000 AS INTEGER)) AS date, 0 AS lower, CAST(o_custkey % 2 AS INTEGER) AS upper
        FROM orders"""


def _station_calendar(spark, sf) -> DataFrame:
    from ..session import sf_path
    spark.read.parquet(sf_path(sf, "orders")).createOrReplaceTempView("tankflow_calendar_orders")
    return spark.sql(_STATION_CALENDAR.format(text="STRING").replace("FROM orders", "FROM tankflow_calendar_orders"))


@register("model_station_events", O.sql(f"""
    SELECT s.station, s.product, s.tank, s.ds, e.event, e.day_offset
    FROM series s JOIN station_events e ON CAST(s.ds AS DATE) = e.d AND (e.station IS NULL OR e.station = s.station)
    GROUP BY ALL""", "series", "station_events", overrides={"station_events": ((), f"""
        SELECT DISTINCT station, event, CAST(off AS INTEGER) AS day_offset, CAST(date AS DATE) + CAST(off AS INTEGER) AS d
        FROM (SELECT station, event, date, unnest(generate_series(lower, upper)) AS off FROM ({_STATION_CALENDAR.format(text="VARCHAR")}))""")}))
def _station_events(spark, sf):
    """The event features that are on, hour by hour, from a calendar of one row per order."""
    p, cal = Pipeline(spark, sf), _station_calendar(spark, sf)
    terms = md.event_terms(cal)
    on = md.with_event_terms(p.series.select("station", "product", "tank", "ds"), md.event_days(cal, terms))
    rows = on.select("station", "product", "tank", "ds", F.explode("terms_on").alias("term"))
    term = F.element_at(F.array(*[F.struct(F.lit(e).alias("event"), F.lit(o).alias("day_offset")) for e, o in terms]), F.col("term") + 1)
    return rows.select("station", "product", "tank", "ds", term["event"].alias("event"), term["day_offset"].alias("day_offset"))


@register("model_gram", O.sql(f"""
    SELECT {K3}, a.i, b.i AS j, round(sum(f.x[a.i + 1] * f.x[b.i + 1]), 6) + 0.0 AS value
    FROM mfeat f, idx a, idx b WHERE a.i <= b.i GROUP BY {K3}, a.i, b.i""", "mfeat", "idx", overrides=_model_ctes() | {
        "idx": (("mfeat",), "SELECT CAST(unnest(range(0, (SELECT max(len(x)) FROM mfeat))) AS INTEGER) AS i")}))
def _gram(spark, sf):
    """X'X of each series, upper half in long form."""
    p = Pipeline(spark, sf)
    k = len(p.spec.feature_names())
    g = _grams(p).select("station", "product", "tank", F.posexplode("xtx").alias("at", "value"))
    i, j = F.floor(F.col("at") / k).cast("int"), (F.col("at") % k).cast("int")
    return rounded(g.select("station", "product", "tank", i.alias("i"), j.alias("j"), "value").where("i <= j"))


# What makes coefficients the MAP solution: the residuals' pull on each of them equals the slope of its prior (or stays
# within it, for a changepoint at 0), and the noise variance is the residuals' mean square.
_PRIORS = "[" + ", ".join("NULL" if s else repr(float(v)) for v, s in zip(md.ModelSpec(events=tuple(_TERMS)).prior_scales(),
                                                                         md.ModelSpec(events=tuple(_TERMS)).prior().sparse)) + "]"


@register("model_fit_check", O.sql(f"""
    SELECT {K3}, any_value(n) AS n, round(sqrt(any_value(mse)), 6) + 0.0 AS noise,
           count(*) FILTER (WHERE scale IS NULL AND beta <> 0) AS breaks,
           bool_and(CASE WHEN scale IS NOT NULL THEN abs(pull - v * beta / (scale * scale)) <= tol
                         WHEN beta <> 0 THEN abs(pull - v / {md.CHANGEPOINT_PRIOR} * sign(beta)) <= tol
                         ELSE abs(pull) <= v / {md.CHANGEPOINT_PRIOR} + tol END) AS solved,
           abs(any_value(mse) / any_value(v) - 1) <= 1e-6 AS settled
    FROM pulls JOIN noise USING ({K3}) GROUP BY {K3}, v, mse""", "pulls", "noise",
    overrides=_model_ctes("model_fit_check") | {
        "rest": (("mfeat", "coef"), f"""
        SELECT p.station, p.product, p.tank, p.x, p.quantity / p.y_scale AS ys, b.beta, b.sigma * b.sigma AS v,
               p.quantity / p.y_scale - list_sum(list_transform(range(1, len(p.x) + 1), lambda i: p.x[i] * b.beta[i])) AS e
        FROM mfeat p JOIN coef b ON {O.keys_eq('p', 'b')}"""),
        "noise": (("rest",), f"SELECT {K3}, any_value(v) AS v, count(*) AS n, avg(e * e) AS mse FROM rest GROUP BY {K3}"),
        "pulls": (("rest",), f"""
        SELECT {K3}, i, any_value(beta[i]) AS beta, any_value({_PRIORS}[i]) AS scale, sum(xi * e) AS pull,
               1e-6 * max(greatest(abs(sum(xi * ys)), 1e-6)) OVER (PARTITION BY {K3}) AS tol
        FROM (SELECT {K3}, e, ys, beta, unnest(range(1, len(x) + 1)) AS i, unnest(x) AS xi FROM rest) GROUP BY {K3}, i"""),
    }))
def _fit_check(spark, sf):
    p = _model_pipeline(spark, sf, "model_fit_check")
    return rounded(md.fit_check(_grams(p), p.fitted[0], p.spec.prior()))


@register("model_fit", None)
def _fit(spark, sf):
    return Pipeline(spark, sf, model="additive").fitted[0]


@register("model_predict", O.sql(f"SELECT {K3}, ds, {O.r6('yhat', 'yhat')} FROM standin", "standin",
                                 overrides={k: v for k, v in _model_ctes("model_predict").items() if k != "forecast"}))
def _predict(spark, sf):
    return rounded(_model_pipeline(spark, sf, "model_predict").model_frame_prediction)


def _scored_by_model(name: str, mode: str) -> None:
    register(name, O.sql(f"SELECT {K3}, ds, {O.r6('yhat', 'yhat')}, {O.r6('quantity', 'quantity')}, {O.r6('accuracy', 'accuracy')} FROM scored",
                         "scored", overrides=_model_ctes(name, mode)))(
        lambda spark, sf: rounded(_model_pipeline(spark, sf, name, mode).comparison))


_scored_by_model("model_forecast", "additive")
_scored_by_model("model_seasonality_mode", "multiplicative")

# ---------------------------------------------------------------- scalar functions, filters, joins
@register("format_timestamps", O.sql(f"""
    SELECT {K3}, reading_id, strftime(ts, '%d.%m.%Y') AS date_text, strftime(ts, '%H') AS hour_text,
           strftime(ts, '%M') AS minute_text, strftime(ts, '%d.%m.%Y %H:%M') AS datetime_text
    FROM gauges""", "gauges"))
def _format_ts(spark, sf):
    from ..functions import timefmt as tf
    g = Pipeline(spark, sf).gauges
    return g.select("station", "product", "tank", "reading_id", tf.format_date("ts").alias("date_text"),
                    tf.format_hour("ts").alias("hour_text"), tf.format_minute("ts").alias("minute_text"),
                    tf.format_datetime("ts").alias("datetime_text"))


@register("calendar_fields", O.sql(f"""
    SELECT {K3}, reading_id, CAST(date_trunc('day', ts) AS TIMESTAMP) AS day_start,
           CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
           CAST(isodow(ts) - 1 AS INTEGER) AS weekday, CAST(hour(ts) AS INTEGER) AS hour,
           CAST(CAST(ts AS DATE) AS TIMESTAMP) AS date, ts + INTERVAL 1 DAY AS next_day, ts + INTERVAL 1 HOUR AS next_hour
    FROM gauges""", "gauges"))
def _cal_fields(spark, sf):
    from ..functions import timefmt as tf
    g = Pipeline(spark, sf).gauges
    return g.select("station", "product", "tank", "reading_id", tf.truncate_day("ts").alias("day_start"),
                    F.year("ts").alias("year"), F.month("ts").alias("month"), tf.weekday("ts").alias("weekday"),
                    tf.hour_of("ts").alias("hour"), F.to_date("ts").cast("timestamp_ntz").alias("date"),
                    tf.add_days("ts", 1).alias("next_day"), tf.add_hours("ts", 1).alias("next_hour"))


@register("parse_date", O.sql(
    f"SELECT {K3}, date, hour, CAST(strptime(date, '%d.%m.%Y') AS TIMESTAMP) AS parsed FROM hourly", "hourly"))
def _parse(spark, sf):
    from ..functions import timefmt as tf
    h = Pipeline(spark, sf).hourly_plan
    return h.select("station", "product", "tank", "date", "hour", tf.parse_date("date").cast("timestamp_ntz").alias("parsed"))


@register("hour24_rollover", O.sql(f"""
    SELECT {K3}, CAST(r_day AS TIMESTAMP) AS r_day, r_hour,
           CAST(CASE WHEN h = 0 THEN r_day + 1 ELSE r_day END AS TIMESTAMP) AS day,
           CAST(h AS INTEGER) AS hour,
           CAST(CASE WHEN h = 0 THEN r_day + 1 ELSE r_day END AS TIMESTAMP) + to_hours(CAST(h AS BIGINT)) AS ds
    FROM (SELECT *, CASE WHEN r_hour = 24 THEN 0 ELSE r_hour END AS h FROM orders)""", "orders"))
def _rollover(spark, sf):
    from ..functions import timefmt as tf
    o = Pipeline(spark, sf).orders
    d, h = tf.hour24_rollover(F.col("r_day"), F.col("r_hour"), "all")
    return o.select("station", "product", "tank", F.col("r_day").cast("timestamp_ntz").alias("r_day"), "r_hour",
                    d.cast("timestamp_ntz").alias("day"), h.alias("hour"),
                    tf.combine_date_hour(d, h).alias("ds"))


@register("filter_year_month", O.sql(
    f"SELECT {K3}, reading_id, ts FROM gauges WHERE year(ts) = 2024 AND month(ts) IN (1)", "gauges"))
def _f_ym(spark, sf):
    from ..operators.outflow import year_month_filter
    g = Pipeline(spark, sf).gauges
    return g.filter(year_month_filter(F.col("ts"), 2024, [1])).select("station", "product", "tank",
                                                                      "reading_id", "ts")


@register("filter_between_dates", O.sql(
    f"SELECT {K3}, reading_id, ts FROM gauges "
    "WHERE ts >= TIMESTAMP '2024-01-02' AND ts <= TIMESTAMP '2024-01-28'", "gauges"))
def _f_between(spark, sf):
    from ..operators.outflow import between_dates
    from ..sources.fixtures import TEST_BOUNDS
    g = Pipeline(spark, sf).gauges
    return g.filter(between_dates(F.col("ts"), *TEST_BOUNDS)).select("station", "product", "tank", "reading_id", "ts")


@register("receipts_right_join_shift", O.sql("""
    SELECT r.id, r.station, r.znum, r.shift_start, r.start_ts
    FROM receipts r SEMI JOIN shifts s USING (station, znum, shift_start)
    WHERE r.shift_start >= TIMESTAMP '2024-01-01' AND r.shift_start < TIMESTAMP '2024-02-01'""",
    "receipts", "shifts"))
def _j1(spark, sf):
    from ..operators.outflow import receipts_with_shift
    p = Pipeline(spark, sf)
    return receipts_with_shift(p.receipts, p.shifts, year=2024, months=[1]).select(
        "id", "station", "znum", "shift_start", "start_ts")


@register("receipts_left_join_items", O.sql(
    f"SELECT id, station, product, tank, {O.r6('volume', 'volume')} FROM sold_items", "sold_items"))
def _j2(spark, sf):
    from ..operators.outflow import receipts_with_shift, sales_filter
    from ..sources.fixtures import TEST_NET_ONLY
    p = Pipeline(spark, sf)
    rz = receipts_with_shift(p.receipts, p.shifts, year=2024, months=[1])
    j = rz.select("id", "station").join(p.items, F.col("id") == F.col("receipt_id"))
    j = j.filter(sales_filter(F.col("station"), F.col("prodtype"), F.col("bruto"), F.col("volume"),
                              TEST_NET_ONLY))
    return rounded(j.select("id", "station", "product", "tank", "volume"))


@register("receipts_right_join_shift_outer", O.sql("""
    SELECT r.id, z.station, z.znum, z.shift_start, r.start_ts
    FROM receipts r RIGHT JOIN shifts z ON r.station = z.station AND r.znum = z.znum AND r.shift_start = z.shift_start
    WHERE z.shift_start >= TIMESTAMP '2024-01-01' AND z.shift_start < TIMESTAMP '2024-02-01'""", "receipts", "shifts"))
def _j1_outer(spark, sf):
    """Shift reports with their receipts, and those without any."""
    from ..operators.outflow import shifts_with_receipts
    p = Pipeline(spark, sf)
    return shifts_with_receipts(p.receipts, p.shifts, year=2024, months=[1]).select("id", "station", "znum", "shift_start", "start_ts")


@register("receipts_left_join_items_outer", O.sql(f"""
    SELECT r.id, r.station, i.product, i.tank, i.prodtype, {O.r6('i.volume', 'volume')}
    FROM receipts r LEFT JOIN items i ON i.receipt_id = r.id
    WHERE r.start_ts >= TIMESTAMP '2024-01-01' AND r.start_ts < TIMESTAMP '2024-02-01'""", "receipts", "items"))
def _j2_outer(spark, sf):
    """Receipts with their items, and those without any."""
    from ..operators.outflow import in_months, receipts_with_items
    p = Pipeline(spark, sf)
    r = in_months(p.receipts, "start_ts", 2024, [1])
    return rounded(receipts_with_items(r, p.items).select("id", "station", "product", "tank", "prodtype", "volume"))


def _laid_out(spark, sf, buckets: int = 16):
    from ..sources import layout
    p = Pipeline(spark, sf)
    return p, layout.bucketed(p.receipts, "id", buckets, month_ts="shift_start"), layout.bucketed(p.items, "receipt_id", buckets)


@register("laid_out_pos_sales", O.sql(
    f"SELECT {K3}, hour_ts, {O.r6('sold', 'pos_volume')} FROM pos_volume", "pos_volume"))
def _laid_out_pos(spark, sf):
    """A1 over receipts laid out by month and, like their items, bucketed by receipt id."""
    from ..operators import outflow as of
    p, receipts, items = _laid_out(spark, sf)
    return rounded(of.pos_hourly_sales(receipts, p.shifts, items, year=p.year, months=p.months, net_only_stations=p.net_only_stations))


@register("laid_out_readings", O.sql(f"""
    SELECT {K3}, CAST(count(*) AS BIGINT) AS readings, min(ts) AS first_ts, max(ts) AS last_ts
    FROM gauges WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-02-01' GROUP BY {K3}""", "gauges"))
def _laid_out_readings(spark, sf):
    """F2 over readings laid out by month."""
    from ..operators.outflow import in_months
    from ..sources import layout
    g = in_months(layout.by_month(Pipeline(spark, sf).gauges, "ts"), "ts", 2024, [1])
    return g.groupBy("station", "product", "tank").agg(F.count("*").alias("readings"), F.min("ts").alias("first_ts"),
                                                       F.max("ts").alias("last_ts"))


@register("scan_jdbc_params", O.sql(f"""
    SELECT station, strftime(r_day, '%d.%m.%Y') AS r_day, r_hour, product, tank, {O.r6('COALESCE(volume, 0)', 'volume')} FROM orders
    WHERE station = 'S1' AND product = {3300000002} AND tank = 1""", "orders"))
def _s3(spark, sf):
    """Hourly orders of one station, fuel and tank by SQL text with bound parameters."""
    from ..sources import readers
    found = readers.bound_orders(Pipeline(spark, sf).orders, station="S1", product=3300000002, tank=1)
    return rounded(found.withColumn("r_day", F.date_format("r_day", "dd.MM.yyyy")))


# ---------------------------------------------------------------- baselines of observed hours only (Q10)
_OBSERVED = {"seen": (("history", "obs"), f"""
        SELECT h.* FROM history h SEMI JOIN obs o ON {O.keys_eq('h', 'o')} AND h.ds = o.ds""")}
_OBSERVED["ranked"] = (("seen", "cfg"), O.CTES["ranked"][1].replace("FROM history h", "FROM seen h"))

register("similar_day_mean_observed", O.sql(
    f"SELECT {K3}, weekday, hour, {O.r6('baseline', 'baseline')} FROM baseline", "baseline", overrides=_OBSERVED))(
    lambda spark, sf: rounded(Pipeline(spark, sf, exclude_filled=True).baseline))

register("hybrid_forecast_observed", O.sql(
    f"SELECT {K3}, ds, weekday, hour, {O.r6('baseline', 'baseline')}, model_yhat, {O.r6('yhat', 'yhat')} FROM forecast", "forecast",
    overrides=_OBSERVED))(lambda spark, sf: rounded(Pipeline(spark, sf, exclude_filled=True).forecast))


@register("last_n_per_cell_observed", O.sql(
    f"SELECT {K3}, ds, weekday, hour, {O.r6('quantity', 'quantity')} FROM ranked WHERE rn <= win", "ranked", overrides=_OBSERVED))
def _w5_observed(spark, sf):
    from ..operators.baseline import last_n_per_cell
    p = Pipeline(spark, sf, exclude_filled=True)
    return rounded(last_n_per_cell(p.history, p.cfg, exclude_filled=True))


@register("rolling_mean_observed", O.sql(f"""
    SELECT {K3}, ds, weekday, hour, {O.r6('quantity', 'quantity')},
           {O.r6('avg(quantity) OVER (PARTITION BY station, product, tank, weekday, hour ORDER BY ds '
                 'ROWS BETWEEN 1 PRECEDING AND CURRENT ROW)', 'rolling_mean')}
    FROM seen""", "seen", overrides=_OBSERVED))
def _w4_observed(spark, sf):
    from ..operators.baseline import rolling_baseline
    return rounded(rolling_baseline(Pipeline(spark, sf, exclude_filled=True).history, 2, exclude_filled=True))


@register("empty_extract_chain", O.sql("""
    SELECT 'extract' AS stage, CAST(count(*) AS BIGINT) AS row_count FROM hourly
    UNION ALL SELECT 'series', count(*) FROM series UNION ALL SELECT 'baseline', count(*) FROM baseline
    UNION ALL SELECT 'forecast', count(*) FROM forecast UNION ALL SELECT 'depletion', count(*) FROM depletion
    UNION ALL SELECT 'first_dead_stock', count(*) FROM first_dead UNION ALL SELECT 'scored', count(*) FROM scored
    UNION ALL SELECT 'mean_accuracy', count(*) FROM mean_acc""",
    "hourly", "series", "baseline", "forecast", "depletion", "first_dead", "scored", "mean_acc",
    overrides={"gauges": ((), O.CTES["gauges"][1] + " WHERE user_id % 4 = 9")}))
def _empty_chain(spark, sf):
    """The extract of a station without readings is a file with a header only; read back, it runs through every
    later stage and gives no rows, with the columns of any other extract."""
    import uuid

    from ..session import tables_dir
    from ..sources import readers
    path = f"{tables_dir(spark)}/{uuid.uuid4().hex}"
    readers.write_extract_csv(Pipeline(spark, sf, stations=["S9"]).hourly_plan, path)
    p = Pipeline(spark, sf)
    p.hourly = readers.read_hourly_csv(spark, path)
    stages = [("extract", p.hourly), ("series", p.series), ("baseline", p.baseline), ("forecast", p.forecast), ("depletion", p.depletion),
              ("first_dead_stock", p.first_dead_stock), ("scored", p.comparison), ("mean_accuracy", p.mean_accuracy)]
    counts = [df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("stage"), "row_count") for name, df in stages]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


@register("lead_lag_readings", O.sql(f"""
    SELECT x.station, x.product, x.tank, x.reading_id, a.volume AS next_volume, b.volume AS prev_volume,
           strftime(a.ts, '%d.%m.%Y %H:%M') AS next_text, strftime(b.ts, '%d.%m.%Y %H:%M') AS prev_text,
           CASE WHEN date_trunc('minute', a.ts) = date_trunc('minute', x.ts)
                THEN CAST(minute(x.ts) AS DOUBLE) END AS next_minute_same,
           CASE WHEN date_trunc('minute', b.ts) = date_trunc('minute', x.ts)
                THEN CAST(minute(x.ts) AS DOUBLE) END AS prev_minute_same
    FROM nr x LEFT JOIN nr a ON {O.keys_eq('a', 'x')} AND a.nr = x.nr + 1
              LEFT JOIN nr b ON {O.keys_eq('b', 'x')} AND b.nr = x.nr - 1""", "nr",
    overrides={"nr": (("gauges",), f"SELECT *, row_number() OVER (PARTITION BY {K3} ORDER BY ts, reading_id) AS nr FROM gauges")}))
def _w123(spark, sf):
    from ..functions import timefmt as tf
    from ..operators.windows import segmented_lead_lag
    g = Pipeline(spark, sf).gauges
    r = segmented_lead_lag(g.withColumn("at", F.col("ts")), ["station", "product", "tank"], ["ts", "reading_id"], ["volume", "at"])
    minute = tf.truncate_minute("ts")
    # neighbours of one minute are neighbours of the series, so no second window is needed
    same = lambda c: F.when(tf.truncate_minute(c) == minute, F.minute("ts").cast("double"))
    return r.select("station", "product", "tank", "reading_id", "next_volume", "prev_volume",
                    tf.format_datetime("next_at").alias("next_text"), tf.format_datetime("prev_at").alias("prev_text"),
                    same("next_at").alias("next_minute_same"), same("prev_at").alias("prev_minute_same"))


@register("rolling_mean", O.sql(f"""
    SELECT {K3}, ds, weekday, hour, {O.r6('quantity', 'quantity')},
           {O.r6('avg(quantity) OVER (PARTITION BY station, product, tank, weekday, hour ORDER BY ds '
                 'ROWS BETWEEN 1 PRECEDING AND CURRENT ROW)', 'rolling_mean')}
    FROM history""", "history"))
def _w4(spark, sf):
    from ..operators.baseline import rolling_baseline
    return rounded(rolling_baseline(Pipeline(spark, sf).history, 2))


@register("last_n_per_cell", O.sql(
    f"SELECT {K3}, ds, weekday, hour, {O.r6('quantity', 'quantity')} FROM ranked WHERE rn <= win",
    "ranked"))
def _w5(spark, sf):
    from ..operators.baseline import last_n_per_cell
    p = Pipeline(spark, sf)
    return rounded(last_n_per_cell(p.history, p.cfg))


@register("first_last_row", O.sql(f"""
    SELECT {K3}, min(ds) AS first_ds, {O.r6('arg_min(quantity, ds)', 'first_quantity')},
           max(ds) AS last_ds, {O.r6('arg_max(quantity, ds)', 'last_quantity')}
    FROM history GROUP BY {K3}""", "history"))
def _o12(spark, sf):
    h = Pipeline(spark, sf).history
    return rounded(h.groupBy("station", "product", "tank").agg(
        F.min("ds").alias("first_ds"), F.min_by("quantity", "ds").alias("first_quantity"),
        F.max("ds").alias("last_ds"), F.max_by("quantity", "ds").alias("last_quantity")))


@register("series_bounds", O.sql(
    f"SELECT {K3}, CAST(lo AS TIMESTAMP) AS grid_start, CAST(hi AS TIMESTAMP) AS grid_end FROM sbounds",
    "sbounds"))
def _a5(spark, sf):
    from ..operators import series as se
    p = Pipeline(spark, sf)
    return se.series_bounds(se.dedupe_mean(se.parse_hourly(p.hourly)))


@register("dedupe_mean", O.sql(f"SELECT {K3}, ds, {O.r6('quantity', 'quantity')} FROM obs", "obs"))
def _a3(spark, sf):
    from ..operators import series as se
    return rounded(se.dedupe_mean(se.parse_hourly(Pipeline(spark, sf).hourly)))


@register("mean_by_ds_weekday", O.sql(
    f"SELECT {K3}, ds, weekday, {O.r6('avg(quantity)', 'quantity')}, CAST(hour(ds) AS INTEGER) AS hour "
    f"FROM series GROUP BY {K3}, ds, weekday", "series"))
def _a4(spark, sf):
    from ..operators import series as se
    return rounded(se.mean_by_ds_weekday(Pipeline(spark, sf).series))


@register("hourly_grid", O.sql(f"SELECT {K3}, ds FROM grid", "grid"))
def _x21(spark, sf):
    from ..operators import series as se
    p = Pipeline(spark, sf)
    return se.series_grid(se.series_bounds(se.dedupe_mean(se.parse_hourly(p.hourly))))


@register("null_presence", O.sql(
    f"SELECT {K3}, bool_or(quantity IS NULL) AS has_null, CAST(count_if(quantity IS NULL) AS BIGINT) AS null_rows "
    f"FROM hourly GROUP BY {K3}", "hourly"))
def _a9(spark, sf):
    from ..operators.quality import null_presence
    return null_presence(Pipeline(spark, sf).hourly_plan)


@register("row_count_check", O.sql(
    "SELECT CAST(count(*) AS BIGINT) AS row_count, count(*) = 0 AS is_empty FROM orders", "orders"))
def _a10(spark, sf):
    from ..operators.quality import row_count_check
    return row_count_check(Pipeline(spark, sf).orders).withColumnRenamed("rows", "row_count")


@register("head_preview", O.sql(f"""
    SELECT {K3}, CAST(r_day AS TIMESTAMP) AS r_day, r_hour, {O.r6('volume', 'volume')}, total_rows FROM (
      SELECT *, CAST(count(*) OVER () AS BIGINT) AS total_rows FROM orders)
    ORDER BY station, product, tank, r_day, r_hour LIMIT 5""", "orders"))
def _p8(spark, sf):
    o = Pipeline(spark, sf).orders
    total = o.agg(F.count(F.lit(1))).scalar()          # scalar subquery, no join
    top = o.orderBy("station", "product", "tank", "r_day", "r_hour").limit(5)
    return rounded(top.select("station", "product", "tank", F.col("r_day").cast("timestamp_ntz").alias("r_day"),
                              "r_hour", "volume", total.alias("total_rows")))


_HEADERS = HOURLY_HEADERS


@register("rename_positional", O.sql(
    "SELECT " + ", ".join(f'{c} AS "{h}"' for h, c in _HEADERS.items()) +
    f" FROM (SELECT {K3}, date, hour, round(quantity, 6) + 0.0 AS quantity FROM hourly)", "hourly"))
def _p1(spark, sf):
    h = rounded(Pipeline(spark, sf).hourly_plan.drop("pairs"))
    return h.toDF(*_HEADERS.keys())


# Names as an order would give them: two products by name, one by a name that the list doesn't have.
_NAMED = {**_FUELS_CTE, "named": (("hourly",), f"""
    SELECT {K3}, CASE product WHEN 3300000000 THEN 'Аи-80' WHEN 3300000002 THEN 'Аи-92' WHEN 3300000005 THEN 'Аи-95'
                 WHEN 3300000008 THEN 'no such fuel' END AS fuel_name FROM hourly""")}


def _named(spark, sf):
    h = Pipeline(spark, sf).hourly_plan
    p = F.col("product")
    name = (F.when(p == 3300000000, "Аи-80").when(p == 3300000002, "Аи-92").when(p == 3300000005, "Аи-95")
            .when(p == 3300000008, "no such fuel"))
    return h.select("station", "tank", name.alias("fuel_name"))


@register("fuel_code_join", O.sql("""
    SELECT n.station, n.tank, n.fuel_name, f.product, CAST(count(*) AS BIGINT) AS row_count
    FROM named n JOIN fuels f ON n.fuel_name = f.fuel_name GROUP BY ALL""", "named", "fuels", overrides=_NAMED))
def _j11(spark, sf):
    from ..operators.quality import fuel_code_join
    from ..sources import fixtures as fx
    known, _ = fuel_code_join(_named(spark, sf), fx.fuels(spark))
    return known.groupBy("station", "tank", "fuel_name", "product").agg(F.count("*").alias("row_count"))


@register("fuel_code_rejects", O.sql("""
    SELECT n.station, n.tank, n.fuel_name, CAST(count(*) AS BIGINT) AS row_count
    FROM named n ANTI JOIN fuels f ON n.fuel_name = f.fuel_name GROUP BY ALL""", "named", "fuels", overrides=_NAMED))
def _j11_rejects(spark, sf):
    from ..operators.quality import fuel_code_join
    from ..sources import fixtures as fx
    _, unknown = fuel_code_join(_named(spark, sf), fx.fuels(spark))
    return unknown.groupBy("station", "tank", "fuel_name").agg(F.count("*").alias("row_count"))


# ---------------------------------------------------------------- J8 / J10 / O3 on their own
register("union_extension", O.sql(
    f"SELECT {K3}, ds, {O.r6('yhat', 'yhat')}, {O.r6('level', 'level')}, extension FROM depletion",
    "depletion", overrides={"cfg": (("hourly",), O.cfg_sql(initial=repr(EXT_INITIAL)))}))(
    lambda spark, sf: rounded(Pipeline(spark, sf, initial=EXT_INITIAL).depletion))


@register("grid_gapfill", O.sql(f"""
    SELECT g.station, g.product, g.tank, g.ds FROM grid g
    WHERE NOT EXISTS (SELECT 1 FROM obs o WHERE {O.keys_eq('o', 'g')} AND o.ds = g.ds)""", "grid", "obs"))
def _j10(spark, sf):
    from ..operators import series as se
    p = Pipeline(spark, sf)
    obs = se.dedupe_mean(se.parse_hourly(p.hourly))
    grid = se.series_grid(se.series_bounds(obs))
    return grid.join(obs, ["station", "product", "tank", "ds"], "left_anti")


# Stand-in model table for J8: hour-of-day mean of the history over the
# model's frame (history + 48 h), so the lookup and its fallback are both
# exercised with values both engines compute.
_STANDIN = {
    "standin": (("history",), f"""
        SELECT f.station, f.product, f.tank, f.ds, m.yhat FROM (
            SELECT {K3}, ds FROM history
            UNION ALL
            SELECT {K3}, last_ds + to_hours(CAST(i AS BIGINT)) AS ds
            FROM (SELECT {K3}, max(ds) AS last_ds, unnest(generate_series(1, 48)) AS i FROM history GROUP BY {K3})) f
        JOIN (SELECT {K3}, hour, avg(quantity) AS yhat FROM history GROUP BY {K3}, hour) m
          ON {O.keys_eq('f', 'm')} AND m.hour = hour(f.ds)"""),
    "forecast": _LOOKUP,
}


@register("model_lookup", O.sql(
    f"SELECT {K3}, ds, weekday, hour, {O.r6('baseline', 'baseline')}, {O.r6('model_yhat', 'model_yhat')}, "
    f"{O.r6('yhat', 'yhat')} FROM forecast", "forecast", overrides=_STANDIN))
def _j8(spark, sf):
    from ..operators import forecast as fc
    from ..operators import model as md
    p = Pipeline(spark, sf)
    h = p.history
    means = h.groupBy("station", "product", "tank", "hour").agg(F.avg("quantity").alias("yhat"))
    frame = md.model_future_frame(h).withColumn("hour", F.hour("ds"))
    standin = frame.join(means, ["station", "product", "tank", "hour"]).select(
        "station", "product", "tank", "ds", "yhat")
    return rounded(fc.hybrid_forecast(p.baseline, p.cfg, standin))


def queries() -> dict[str, QueryFn]:
    return {k: v[0] for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    from ..session import results_base
    found = {k: v[1] for k, v in REGISTRY.items() if v[1] is not None}
    return {k: v.replace(RESULTS, results_base()) if RESULTS in v else v for k, v in found.items()}
