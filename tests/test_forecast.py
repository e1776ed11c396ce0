"""C3-C6 quirks on hand tables, the extension against a plain loop, and the
golden values of the stored forecast output."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from tankflow.functions import metrics as M
from tankflow.operators import baseline as bl
from tankflow.operators import depletion as dp
from tankflow.operators import evaluate as ev
from tankflow.operators import forecast as fc
from tankflow.operators import series as se
from tankflow.sources import fixtures as fx
from tankflow.sources import schema as S

KEY = ("Z", 3300000002, 3)


def cfg_df(spark, **over):
    p = dict(fx.TEST_SCENARIO)
    p.update(over)
    row = KEY + tuple(p[f.name] for f in S.CONFIG.fields[3:])
    return spark.createDataFrame([row], S.CONFIG)


def hourly_df(spark, rows):
    return spark.createDataFrame([KEY + r for r in rows], S.HOURLY)


def test_rollover_moves_every_midnight(spark):
    """Hour 24 -> 0 of the next day, and genuine hour-0 rows move too."""
    h = hourly_df(spark, [("05.01.2024", 24, 1.0), ("05.01.2024", 0, 2.0), ("05.01.2024", 5, 3.0)])
    got = sorted((r.ds, r.q) for r in se.parse_hourly(h).collect())
    assert got == [(dt.datetime(2024, 1, 5, 5), 3.0), (dt.datetime(2024, 1, 6), 1.0), (dt.datetime(2024, 1, 6), 2.0)]
    obs = {r.ds: r.quantity for r in se.dedupe_mean(se.parse_hourly(h)).collect()}
    assert obs[dt.datetime(2024, 1, 6)] == 1.5       # 24 and 0 collide and are averaged
    only = {r.ds for r in se.parse_hourly(h, rollover="only_24").collect()}
    assert dt.datetime(2024, 1, 5) in only


def test_grid_end_points_one_hour(spark):
    """Q9: one observed hour gives a grid from its midnight to the next midnight, inclusive."""
    s = se.clean_hourly_series(hourly_df(spark, [("05.01.2024", 7, 4.0)])).orderBy("ds").collect()
    assert len(s) == 25
    assert s[0].ds == dt.datetime(2024, 1, 5) and s[-1].ds == dt.datetime(2024, 1, 6)
    assert [r.quantity for r in s if r.quantity] == [4.0]


def test_grid_complete_and_unique(spark):
    rnd = random.Random(5)
    rows = [(f"{d:02d}.01.2024", rnd.randrange(0, 25), rnd.uniform(0, 9)) for d in range(1, 20) for _ in range(6)]
    s = se.clean_hourly_series(hourly_df(spark, rows))
    n, nd, lo, hi = s.agg(F.count("*"), F.countDistinct("ds"), F.min("ds"), F.max("ds")).first()
    assert n == nd == int((hi - lo).total_seconds() // 3600) + 1


def test_bad_date_and_null_quantity(spark):
    h = hourly_df(spark, [("xx.01.2024", 3, 1.0), ("02.01.2024", 3, None)])
    s = se.clean_hourly_series(h).filter("quantity != 0").count()
    assert s == 0
    from tankflow.operators.quality import quality_report
    rep = {r.finding: r.row_count for r in quality_report(h, fx.fuels(spark)).collect()}
    assert rep == {"empty_input": 0, "unparseable_date": 1, "null_hour": 0, "corrupt_row": 0, "null_quantity": 1,
                   "unknown_fuel": 0}


def test_no_row_is_lost_silently(spark):
    """Each input row is either in the parsed rows or among the rejected ones, with a reason."""
    from tankflow.operators.quality import quality_report
    h = hourly_df(spark, [("xx.01.2024", 3, 1.0), ("02.01.2024", None, 2.0), ("02.01.2024", 3, 4.0), (None, None, 5.0)])
    assert se.parse_hourly(h).count() == 1
    assert sorted((r.reason, r.quantity) for r in se.rejected_rows(h).collect()) == [
        ("bad_date", 1.0), ("bad_date", 5.0), ("null_hour", 2.0)]
    rep = {r.finding: r.row_count for r in quality_report(h).collect()}
    assert rep["unparseable_date"] == 2 and rep["null_hour"] == 1
    with pytest.raises(Exception):
        se.clean_hourly_series(h, lenient=False).count()


def test_empty_input_flows_through(spark):
    from tankflow.sources.readers import empty_hourly
    h = empty_hourly(spark)
    cfg = cfg_df(spark)
    s = se.clean_hourly_series(h, cfg)
    hist = se.split_history(s, cfg)
    base = bl.similar_day_baseline(hist, cfg)
    f = fc.hybrid_forecast(base, cfg)
    assert s.count() == 0 and base.count() == 0
    assert f.count() > 0 and f.filter("yhat != 0").count() == 0   # horizon still exists, zero baseline


def _history(spark, values, start=dt.datetime(2024, 1, 1)):
    rows = [KEY + (start + dt.timedelta(hours=i), float(v)) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "station string, product long, tank int, ds timestamp_ntz, quantity double")
    return se.add_calendar_columns(df)


def test_similar_day_mean_is_last_rolling_value(spark):
    vals = list(range(24 * 21))
    hist = _history(spark, vals)
    b = {(r.weekday, r.hour): r.baseline for r in bl.similar_day_baseline(hist, cfg_df(spark, window=2)).collect()}
    # Monday 2024-01-01 hour 0 occurs at rows 0, 168, 336 -> last two
    assert b[(0, 0)] == (168 + 336) / 2
    roll = bl.rolling_baseline(hist, 2).filter("weekday = 0 AND hour = 0").orderBy("ds").collect()
    assert roll[-1].rolling_mean == b[(0, 0)] and roll[0].rolling_mean == 0.0


def test_fallback_beyond_model_uses_both_weights(spark):
    """Q12: without a model value the baseline is used for both terms."""
    hist = _history(spark, [10.0] * (24 * 14))
    cfg = cfg_df(spark, start=dt.datetime(2024, 1, 15), end=dt.datetime(2024, 1, 15, 3), w_base=0.4, w_model=0.7)
    base = bl.similar_day_baseline(hist, cfg)
    model = spark.createDataFrame([KEY + (dt.datetime(2024, 1, 15, 1), 100.0)],
                                  "station string, product long, tank int, ds timestamp_ntz, yhat double")
    f = {r.ds.hour: r.yhat for r in fc.hybrid_forecast(base, cfg, model).collect()}
    assert f[0] == pytest.approx(11.0) and f[1] == pytest.approx(0.4 * 10 + 0.7 * 100)


def loop_extension(last_ds, last_level, dead, profile, cap=1000):
    out, lv, ds = [], last_level, last_ds
    while lv > dead and len(out) < cap:
        ds = ds + dt.timedelta(hours=1)
        y = profile.get((ds.weekday(), ds.hour), 0.0)
        lv = lv - y
        out.append((ds, y, lv))
    return out


@pytest.mark.parametrize("seed,initial,dead", [(1, 500.0, 50.0), (2, 40.0, 50.0), (3, 900.0, 100.0), (4, 300.0, 0.0),
                                               (5, 500.0, 50.0), (6, 500.0, 50.0)])
def test_extension_equals_loop(spark, seed, initial, dead):
    rnd = random.Random(seed)
    profile = {(w, h): rnd.uniform(-3, 9) for w in range(7) for h in range(24)}
    if seed == 4:
        profile = {k: 0.0 for k in profile}      # zero profile: hits the 1000-step cap
    if seed == 5:                                # sales and returns that cancel but for rounding
        profile = {(0, 0): 0.1, (0, 1): 0.2, (0, 2): -0.3}
    if seed == 6:
        profile = {(0, 0): 1e-17}
    base = spark.createDataFrame([KEY + (w, h, v) for (w, h), v in profile.items()],
                                 "station string, product long, tank int, weekday int, hour int, baseline double")
    last = dt.datetime(2024, 1, 27, 23)
    level = spark.createDataFrame([KEY + (last - dt.timedelta(hours=1), 1.0, initial + 1.0),
                                   KEY + (last, 1.0, initial)],
                                  "station string, product long, tank int, ds timestamp_ntz, yhat double, level double")
    cfg = cfg_df(spark, dead_stock=dead)
    got = [(r.ds, r.yhat, r.level) for r in dp.extend_to_dead_stock(level, base, cfg).orderBy("ds").collect()]
    want = loop_extension(last, initial, dead, profile)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[0] == w[0] and g[1] == pytest.approx(w[1]) and g[2] == pytest.approx(w[2])
    if seed >= 4:
        assert len(got) == 1000
    assert {r.capped for r in dp.extend_to_dead_stock(level, base, cfg).collect()} <= {len(want) == 1000 and want[-1][2] > dead}


def test_crossing_beyond_the_cap(spark):
    base = spark.createDataFrame([KEY + (w, h, 0.25) for w in range(7) for h in range(24)],
                                 "station string, product long, tank int, weekday int, hour int, baseline double")
    last = dt.datetime(2024, 1, 27, 23)
    level = spark.createDataFrame([KEY + (last, 1.0, 1000.0)],
                                  "station string, product long, tank int, ds timestamp_ntz, yhat double, level double")
    r = dp.crossing(level, base, cfg_df(spark, dead_stock=50.0)).first()
    assert r.cross_step == 3800 and r.capped
    assert not dp.crossing(level, base, cfg_df(spark, dead_stock=900.0)).first().capped


@pytest.mark.parametrize("actual,forecast,expect", [
    (0.0, 344.7, 0.0), (0.0, 0.0, None), (10.0, -5.0, -50.0), (-4.0, -2.0, 200.0), (None, 3.0, None)])
def test_accuracy_cases(spark, actual, forecast, expect):
    """Q14/Q15: signed values kept, 0/0 and missing sides give null."""
    df = spark.createDataFrame([(actual, forecast)], "a double, f double")
    got = df.select(M.accuracy("a", "f").alias("x")).first().x
    assert got == (pytest.approx(expect) if expect is not None else None)


def test_score_range_disjoint_gives_null(spark):
    """Q16."""
    scored = spark.createDataFrame([KEY + (dt.datetime(2024, 9, 3, 5), 1.0, 1.0, 100.0)],
                                   "station string, product long, tank int, ds timestamp_ntz, yhat double, "
                                   "quantity double, accuracy double")
    cfg = cfg_df(spark, score_from=dt.datetime(2024, 9, 6), score_to=dt.datetime(2024, 9, 7))
    r = ev.mean_accuracy(scored, cfg).first()
    assert r.mean_accuracy is None and r.scored_rows == 0


# Path of a stored 55-row comparison output (ds, yhat, actual, accuracy),
# given by the environment; the test is skipped without it.
GOLDEN = os.environ.get("TANKFLOW_GOLDEN_OUTPUT", "")


@pytest.mark.skipif(not (GOLDEN and os.path.exists(GOLDEN)), reason="stored forecast output not given")
def test_golden_forecast_file(spark):
    """W6, A8, J9/X18, A7 on the stored 55-row output (initial 24987, dead stock 2997);
    expected values are those derived in FIXTURES.md."""
    raw = spark.read.option("header", True).csv(GOLDEN)
    cols = raw.columns
    f = raw.select(F.lit(KEY[0]).alias("station"), F.lit(KEY[1]).cast("bigint").alias("product"),
                   F.lit(KEY[2]).alias("tank"), F.to_timestamp(cols[0]).cast("timestamp_ntz").alias("ds"),
                   F.col(cols[1]).cast("double").alias("yhat"), F.col(cols[2]).cast("double").alias("quantity"))
    cfg = cfg_df(spark, initial=24987.0, dead_stock=2997.0, score_from=dt.datetime(2024, 9, 18),
                 score_to=dt.datetime(2024, 9, 19))
    level = dp.tank_level(f, cfg)
    assert level.count() == 55
    assert f.agg(F.sum("yhat")).first()[0] == pytest.approx(30592.453, abs=1e-3)
    first = dp.first_dead_stock(level, cfg).first()
    assert first.ds == dt.datetime(2024, 9, 18, 11) and first.level == pytest.approx(2572.627, abs=1e-3)
    prev = level.filter(F.col("ds") == dt.datetime(2024, 9, 18, 10)).first().level
    assert prev == pytest.approx(3262.774, abs=1e-3)
    last = dp.last_level(level).first()
    assert last.last_level == pytest.approx(-5605.453, abs=1e-3)
    empty_base = spark.createDataFrame([], "station string, product long, tank int, weekday int, hour int, baseline double")
    assert dp.extend_to_dead_stock(level, empty_base, cfg).count() == 0
    actual = f.filter("quantity IS NOT NULL").select("station", "product", "tank", "ds", "quantity")
    scored = ev.evaluate(level, actual)
    acc = ev.mean_accuracy(scored, cfg).first()
    assert acc.scored_rows == 1 and acc.mean_accuracy == 0.0
