"""M1-M7: a trend + seasonality + event model, fitted per series, with additive or multiplicative seasonality.

Model (after Taylor & Letham, "Forecasting at Scale", 2018, and the public
defaults of the library the scripts call):

    y / y_scale = k*t + m + sum_j d_j * max(t - s_j, 0)          (trend)
                + sum Fourier terms (weekly order 3, daily order 4, yearly order 10)
                + sum_e b_e * [ds lies on a day of the event term]   (events)

with t = hours since the first history hour / history span, y_scale = max|y|,
and up to 25 changepoints s_j evenly spaced over the first 80 % of history.
Seasonalities switch on per series like the library's "auto": weekly with at
least two weeks of history, daily with at least two days, yearly with two
years. The fit is a MAP estimate: Gaussian priors (scales 5 for k and m, 10
for seasonal and event terms), a Laplace prior (scale 0.05) on the
changepoints, so that most of them are exactly 0, and the noise scale
re-estimated by fixed-point iteration.

Events are data: a calendar frame, for all stations or for one, is expanded to
one row per station and date with the numbers of the event terms that are on,
and the history joins it. Only the names of the terms, which are features of
the model, are known to the driver (at most ``MAX_EVENT_TERMS``).

Distribution: narrow rows (key, ds, y) are dealt out and sorted by series;
the features are native columns computed after that exchange. Each task
sums up its series (X'X, X'y, y'y, n) in ``mapInArrow`` and solves the small
K x K system where the sums are: neither feature rows nor sums cross an exchange.
The multiplicative model alternates between its two halves inside the task that
holds the series. Prediction is a join with the coefficients and a dot product
in ``aggregate(zip_with(...))``, JVM-side.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import timefmt as tf
from ..sources.schema import SERIES_KEY

K = SERIES_KEY

# Library defaults the model reproduces.
N_CHANGEPOINTS = 25
CHANGEPOINT_RANGE = 0.8
CHANGEPOINT_PRIOR = 0.05
SEASONALITY_PRIOR = 10.0
HOLIDAY_PRIOR = 10.0
TREND_PRIOR = 5.0
WEEKLY_ORDER, WEEKLY_DAYS = 3, 7.0
DAILY_ORDER, DAILY_DAYS = 4, 1.0
YEARLY_ORDER, YEARLY_DAYS = 10, 365.25
FUTURE_PERIODS = 48
#: Event terms are columns of the model: their number must not grow with the data.
MAX_EVENT_TERMS = 200


@dataclass(frozen=True)
class ModelSpec:
    """Switches of the model: True, False or "auto" for each seasonality."""
    weekly: object = "auto"
    daily: object = "auto"
    yearly: object = "auto"
    events: tuple = field(default_factory=tuple)  # ((event, offset), ...), see event_terms
    mode: str = "additive"

    @property
    def seasonal_blocks(self):
        return [("weekly", WEEKLY_ORDER, WEEKLY_DAYS, self.weekly, 14.0),
                ("daily", DAILY_ORDER, DAILY_DAYS, self.daily, 2.0),
                ("yearly", YEARLY_ORDER, YEARLY_DAYS, self.yearly, 730.0)]

    def feature_names(self) -> list[str]:
        names = ["k", "m"] + [f"cp_{j}" for j in range(1, N_CHANGEPOINTS + 1)]
        for name, order, _, _, _ in self.seasonal_blocks:
            for i in range(1, order + 1):
                names += [f"{name}_sin{i}", f"{name}_cos{i}"]
        names += [f"{e}_{'+' if o >= 0 else '-'}{abs(o)}" for e, o in self.events]
        return names

    def prior_scales(self) -> np.ndarray:
        s = [TREND_PRIOR, TREND_PRIOR] + [CHANGEPOINT_PRIOR] * N_CHANGEPOINTS
        for _, order, _, _, _ in self.seasonal_blocks:
            s += [SEASONALITY_PRIOR] * (2 * order)
        s += [HOLIDAY_PRIOR] * len(self.events)
        return np.asarray(s, dtype=float)

    def prior(self) -> "Prior":
        """Normal priors, and Laplace ones on the changepoints."""
        at = np.arange(len(self.feature_names()))
        return Prior(self.prior_scales(), (at >= 2) & (at < 2 + N_CHANGEPOINTS))


def event_window_expand(calendar: DataFrame) -> DataFrame:
    """M3: (event, date, lower, upper and maybe station) -> (station, event, offset, date), one row for each day on which
    a term is on. A null station, or a calendar without that column, holds for all stations."""
    station = F.col("station").cast("string") if "station" in calendar.columns else F.lit(None).cast("string")
    c = calendar.select(station.alias("station"), "event", "date", F.explode(F.sequence("lower", "upper")).alias("offset"))
    return c.select("station", "event", "offset", F.date_add("date", F.col("offset")).alias("date"))


def event_terms(calendar: DataFrame, most: int = MAX_EVENT_TERMS) -> tuple:
    """The (event, offset) terms of a calendar in order; each is a feature of the model, so ``most`` bounds them."""
    c = calendar.where("event is not null").select("event", F.explode(F.sequence("lower", "upper")).alias("offset")).distinct()
    rows = c.orderBy("event", "offset").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"the calendar has more than {most} event terms")
    return tuple((r.event, r.offset) for r in rows)


def event_days(calendar: DataFrame, terms: tuple) -> DataFrame:
    """(station, date, terms_on) of a calendar: the sorted numbers of the terms that are on, one row per station and date."""
    number = F.lit(None).cast("int")
    for i, (event, offset) in enumerate(terms):
        number = F.when((F.col("event") == event) & (F.col("offset") == offset), i).otherwise(number)
    days = event_window_expand(calendar).withColumn("number", number).where("number is not null and date is not null")
    return days.groupBy("station", "date").agg(F.sort_array(F.collect_set("number")).alias("terms_on"))


def with_event_terms(frame: DataFrame, days: DataFrame) -> DataFrame:
    """``frame`` with ``terms_on``: the terms of all stations and of a row's own that are on at its ``ds``. Both joins find
    at most one row; the planner broadcasts the calendar if it is small."""
    every = days.where("station is null").select(F.col("date").alias("_day"), F.col("terms_on").alias("_every"))
    own = days.where("station is not null").select(F.col("station").alias("_at"), F.col("date").alias("_own_day"), F.col("terms_on").alias("_own"))
    f = frame.withColumn("_date", F.to_date("ds"))
    f = f.join(every, F.col("_date") == F.col("_day"), "left")
    f = f.join(own, (F.col("station") == F.col("_at")) & (F.col("_date") == F.col("_own_day")), "left")
    none = F.array().cast("array<int>")
    on = F.array_union(F.coalesce("_every", none), F.coalesce("_own", none))
    return f.withColumn("terms_on", on).drop("_date", "_day", "_every", "_at", "_own_day", "_own")


# ---------------------------------------------------------------- M1 / scaling
def model_training_frame(history: DataFrame) -> DataFrame:
    """M1: (key, ds, y)."""
    return history.select(*K, "ds", F.col("quantity").alias("y"))


def series_scaling(train: DataFrame, spec: ModelSpec) -> DataFrame:
    """Per-series constants of the features: first hour, span, y scale,
    changepoint count and the seasonality switches."""
    s = train.groupBy(*K).agg(F.min("ds").alias("t0"), F.max("ds").alias("t1"),
                              F.count("*").alias("n"), F.max(F.abs("y")).alias("ymax"))
    span_h = (F.unix_seconds(F.col("t1").cast("timestamp")) -
              F.unix_seconds(F.col("t0").cast("timestamp"))) / 3600.0
    hist_size = F.floor(F.col("n") * CHANGEPOINT_RANGE).cast("int")
    ncp = F.greatest(F.least(F.lit(N_CHANGEPOINTS), hist_size - 1), F.lit(0))
    cols = {
        "span_h": F.greatest(span_h, F.lit(1.0)),
        "y_scale": F.when(F.col("ymax") > 0, F.col("ymax")).otherwise(F.lit(1.0)),
        "hist_size": hist_size,
        "ncp": ncp,
    }
    days = span_h / 24.0
    for name, _, _, switch, min_days in spec.seasonal_blocks:
        on = F.lit(bool(switch)) if switch != "auto" else (days >= min_days)
        cols[f"use_{name}"] = on
    return s.withColumns(cols).drop("ymax")


def _hours_since(ds: Column, t0: Column) -> Column:
    return (F.unix_seconds(ds.cast("timestamp")) - F.unix_seconds(t0.cast("timestamp"))) / 3600.0


def feature_columns(spec: ModelSpec) -> list[Column]:
    """The feature expressions (layout = spec.feature_names()) over a frame
    that carries ``ds``, the per-series scaling columns and, with events, ``terms_on``."""
    t = _hours_since(F.col("ds"), F.col("t0")) / F.col("span_h")
    feats = [F.lit(1.0) * t, F.lit(1.0)]
    # changepoint j sits at history row round(j * (hist_size - 1) / ncp); hours = row index
    for j in range(1, N_CHANGEPOINTS + 1):
        pos = F.bround(F.lit(float(j)) * (F.col("hist_size") - 1) / F.col("ncp"), 0) / F.col("span_h")
        feats.append(F.when(F.col("ncp") >= j, F.greatest(t - pos, F.lit(0.0))).otherwise(F.lit(0.0)))
    day_t = F.unix_seconds(F.col("ds").cast("timestamp")) / 86400.0
    for name, order, period, _, _ in spec.seasonal_blocks:
        on = F.col(f"use_{name}")
        for i in range(1, order + 1):
            arg = F.lit(2.0 * i * math.pi / period) * day_t
            feats.append(F.when(on, F.sin(arg)).otherwise(F.lit(0.0)))
            feats.append(F.when(on, F.cos(arg)).otherwise(F.lit(0.0)))
    for i in range(len(spec.events)):
        feats.append(F.when(F.array_contains("terms_on", i), F.lit(1.0)).otherwise(F.lit(0.0)))
    return [c.cast("double") for c in feats]


def model_features(frame: DataFrame, scaling: DataFrame, spec: ModelSpec, days: DataFrame | None = None) -> DataFrame:
    """M2: attach the feature vector ``x`` (array<double>, layout = spec.feature_names())."""
    if spec.events:
        frame = with_event_terms(frame, days)
    return frame.join(scaling, K).withColumn("x", F.array(*feature_columns(spec)))


def training_rows(train: DataFrame, scaling: DataFrame, spec: ModelSpec, days: DataFrame | None = None) -> DataFrame:
    """(key, x, ys), the rows of a series together in one task (a series has at most one row an hour, so none is hot).
    What is exchanged and sorted is (key, ds, y) and the terms that are on; the feature vector is made after that."""
    if spec.events:
        train = with_event_terms(train, days)
    together = train.repartition(*K).join(scaling, K).sortWithinPartitions(*K, "ds")
    return together.select(*K, F.array(*feature_columns(spec)).alias("x"), (F.col("y") / F.col("y_scale")).alias("ys"))


# ---------------------------------------------------------------- M4 fit
_KEY_FIELDS = [pa.field("station", pa.string()), pa.field("product", pa.int64()), pa.field("tank", pa.int32())]
_GRAM = pa.schema([*_KEY_FIELDS, pa.field("n", pa.int64()), pa.field("yty", pa.float64()), pa.field("xty", pa.list_(pa.float64())),
                   pa.field("xtx", pa.list_(pa.float64()))])
_COEF = pa.schema([*_KEY_FIELDS, pa.field("beta", pa.list_(pa.float64())), pa.field("sigma", pa.float64()), pa.field("n", pa.int64()),
                   pa.field("change", pa.float64()), pa.field("settled", pa.bool_())])
_KEY_SQL = "station string, product long, tank int"
_GRAM_SQL = f"{_KEY_SQL}, n long, yty double, xty array<double>, xtx array<double>"
_COEF_SQL = f"{_KEY_SQL}, beta array<double>, sigma double, n long, change double, settled boolean"


def _by_series(batches, start, add, end, schema: pa.Schema):
    """Fold the rows of each series, which follow each other: ``start()`` makes a state, ``add(state, X, y)`` takes the
    rows of a batch, ``end(state)`` gives the cells after the key. A series that goes on in the next batch is carried over."""
    key, state = None, None
    for rb in batches:
        if rb.num_rows == 0:
            continue
        X = rb.column("x").flatten().to_numpy(zero_copy_only=False).reshape(rb.num_rows, -1)
        y = rb.column("ys").to_numpy(zero_copy_only=False)
        codes = pd.MultiIndex.from_arrays([rb.column(c).to_pandas() for c in K]).factorize()[0]
        starts = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1]))).tolist()
        done = []
        for i, j in zip(starts, [*starts[1:], rb.num_rows]):
            own = tuple(rb.column(c)[i].as_py() for c in K)
            if own != key:
                if key is not None:
                    done.append((*key, *end(state)))
                key, state = own, start()
            state = add(state, X[i:j], y[i:j])
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)
    if key is not None:
        last = (*key, *end(state))
        yield pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip(last, schema)], schema=schema)


def _add_gram(state, X, y):
    part = (len(y), float(y @ y), X.T @ y, X.T @ X)
    return part if state is None else tuple(a + b for a, b in zip(state, part))


def gram_by_series(rows: DataFrame) -> DataFrame:
    """One row per series: X'X (flat), X'y, y'y and n of ``training_rows``, summed up in the tasks that hold the series."""
    def run(batches):
        return _by_series(batches, lambda: None, _add_gram, lambda s: (s[0], s[1], s[2].tolist(), s[3].ravel().tolist()), _GRAM)
    return rows.mapInArrow(run, _GRAM_SQL)


NOISE_ITERATIONS = 200
NOISE_TOLERANCE = 1e-10
LEAST_NOISE = 1e-8


def lasso(A: np.ndarray, b: np.ndarray, weight: float, start: np.ndarray | None = None) -> np.ndarray:
    """argmin of d'Ad/2 - b'd + weight * |d|_1, exactly, by feature-sign search (Lee et al., 2007): a signed guess of the
    non-zero terms is solved as a linear system, terms that cross zero on the way leave, and the worst violated one enters."""
    d = np.zeros(len(b)) if start is None else start.copy()
    slack = 1e-9 * max(np.abs(b).max(initial=0.0), weight, 1e-300)
    value = lambda v: v @ A @ v / 2 - b @ v + weight * np.abs(v).sum()
    for _ in range(100 * (len(b) + 1)):
        pull = b - A @ d
        out = np.where(d == 0, np.abs(pull) - weight, -np.inf)
        on, sign = d != 0, np.sign(d)
        if np.abs(np.where(on, pull - weight * sign, 0)).max(initial=0.0) <= slack:  # what is in is solved: let one enter
            j = int(out.argmax()) if len(out) else -1
            if j < 0 or out[j] <= slack:
                break
            on[j], sign[j] = True, np.sign(pull[j])
        at = np.flatnonzero(on)
        goal = np.zeros(len(b))
        goal[at] = np.linalg.lstsq(A[np.ix_(at, at)], b[at] - weight * sign[at], rcond=None)[0]
        step = [1.0]
        crossing = (d != 0) & (goal * d < 0) | (d != 0) & on & (goal == 0)
        step += (d[crossing] / (d[crossing] - goal[crossing])).tolist()
        tries = []
        for t in step:
            v = d + t * (goal - d)
            v[crossing & (np.abs(v) <= 1e-14 * np.maximum(np.abs(d), np.abs(goal)))] = 0.0
            if t == 1.0:
                v[on & (np.sign(v) != sign) & (d == 0)] = 0.0
            tries.append((value(v), v))
        best = min(tries, key=lambda x: x[0])
        if not best[0] < value(d) and (best[1] == d).all():
            break
        d = best[1]
    return d


class Prior:
    """Scales of the priors: normal ones, and Laplace ones where ``sparse``."""

    def __init__(self, scales: np.ndarray, sparse: np.ndarray):
        self.scales, self.sparse = np.asarray(scales, float), np.asarray(sparse, bool)

    def part(self, some: slice) -> "Prior":
        return Prior(self.scales[some], self.sparse[some])

    def solve(self, xtx: np.ndarray, xty: np.ndarray, sigma2: float, start: np.ndarray | None = None) -> np.ndarray:
        """The MAP coefficients for a given noise variance: normal terms are eliminated, the sparse rest is a lasso."""
        L, R = np.flatnonzero(self.sparse), np.flatnonzero(~self.sparse)
        own = xtx[np.ix_(R, R)] + sigma2 * np.diag(1 / self.scales[R] ** 2)
        beta = np.zeros(len(xty))
        if not len(L):
            beta[R] = np.linalg.solve(own, xty[R])
            return beta
        cross = xtx[np.ix_(R, L)]
        both = np.linalg.solve(own, np.column_stack([cross, xty[R]]))
        A, b = xtx[np.ix_(L, L)] - cross.T @ both[:, :-1], xty[L] - cross.T @ both[:, -1]
        # one scale of its own for each term: solve in units of the scales
        s = self.scales[L]
        beta[L] = s * lasso(A * np.outer(s, s), b * s, sigma2, None if start is None else start[L] / s)
        beta[R] = both[:, -1] - both[:, :-1] @ beta[L]
        return beta


def _solve_series(prior: Prior, n: int, yty: float, xty: np.ndarray, xtx: np.ndarray, iterations: int = NOISE_ITERATIONS,
                  tolerance: float = NOISE_TOLERANCE) -> tuple[np.ndarray, float, float]:
    """(beta, noise variance, its last relative change): the noise variance is iterated until it changes by less than
    ``tolerance``; each step lowers the joint loss."""
    sigma2, beta, change = 0.25, None, math.inf  # prior mode region of the noise scale (half-normal 0.5)
    for _ in range(iterations):
        beta = prior.solve(xtx, xty, sigma2, beta)
        rss = max(yty - 2 * beta @ xty + beta @ xtx @ beta, 0.0)
        before, sigma2 = sigma2, max(rss / max(n, 1), LEAST_NOISE)
        change = abs(sigma2 - before) / before
        if change < tolerance:
            break
    return beta, sigma2, change


def solve_grams(grams: DataFrame, prior: Prior) -> DataFrame:
    """The coefficients of each row of ``gram_by_series``, where it is."""
    def run(batches):
        for rb in batches:
            rows = []
            for r in rb.to_pylist():
                xty = np.asarray(r["xty"])
                beta, sigma2, change = _solve_series(prior, r["n"], r["yty"], xty, np.asarray(r["xtx"]).reshape(len(xty), -1))
                rows.append((*[r[c] for c in K], beta.tolist(), math.sqrt(sigma2), r["n"], change, change < NOISE_TOLERANCE))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _COEF)], schema=_COEF)
    return grams.mapInArrow(run, _COEF_SQL)


def fit_check(grams: DataFrame, coefs: DataFrame, prior: Prior, tolerance: float = 1e-6) -> DataFrame:
    """Per series: rows, noise scale and changepoints in use; ``solved``: each coefficient's pull equals its prior's slope (for
    a changepoint at 0, stays within it), relative to the largest of X'y; ``settled``: the noise variance is the mean square
    of the residuals."""
    def run(batches):
        schema = pa.schema([*_KEY_FIELDS, pa.field("n", pa.int64()), pa.field("noise", pa.float64()), pa.field("breaks", pa.int64()),
                            pa.field("solved", pa.bool_()), pa.field("settled", pa.bool_())])
        for rb in batches:
            rows = []
            for r in rb.to_pylist():
                xty, beta, v = np.asarray(r["xty"]), np.asarray(r["beta"]), r["sigma"] ** 2
                xtx = np.asarray(r["xtx"]).reshape(len(xty), -1)
                pull = xty - xtx @ beta
                mse = (r["yty"] - 2 * beta @ xty + beta @ xtx @ beta) / r["n"]
                tol = tolerance * max(np.abs(xty).max(), 1e-6)
                sparse, slope = prior.sparse, v / prior.scales
                fine = np.where(~sparse, np.abs(pull - slope * beta / prior.scales) <= tol,
                                np.where(beta != 0, np.abs(pull - slope * np.sign(beta)) <= tol, np.abs(pull) <= slope + tol))
                rows.append((*[r[c] for c in K], r["n"], math.sqrt(max(mse, 0.0)), int((beta[sparse] != 0).sum()), bool(fine.all()),
                             bool(abs(mse / v - 1) <= tolerance)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
    both = grams.join(coefs.select(*K, "beta", "sigma"), K)
    return both.mapInArrow(run, f"{_KEY_SQL}, n long, noise double, breaks long, solved boolean, settled boolean")


N_TREND = 2 + N_CHANGEPOINTS
PASSES = 500
PASS_TOLERANCE = 1e-8


def fit_model(history: DataFrame, spec: ModelSpec = ModelSpec(), days: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """M4 (and M7): per-series coefficients. Returns (coefficients, scaling).

    ``spec.mode == "multiplicative"`` fits y = trend * (1 + seasonal + events)
    by alternating MAP solves inside the task that holds the series: with the
    trend fixed, the seasonal part is a fit of (y - g) on g * x_s; with the
    seasonal part fixed, the trend is a fit of y on (1 + s) * x_t. The passes
    end when no fitted value changes by ``PASS_TOLERANCE`` of the largest y;
    ``change`` is the last change and ``settled`` says whether it got there.
    """
    if spec.mode not in ("additive", "multiplicative"):
        raise ValueError(f"mode {spec.mode!r}")
    train = model_training_frame(history)
    scaling = series_scaling(train, spec)
    rows = training_rows(train, scaling, spec, days)
    prior = spec.prior()
    if spec.mode == "additive":
        return solve_grams(gram_by_series(rows), prior), scaling

    def run(batches):
        add = lambda s, X, y: [*s, (X.copy(), y.copy())]
        return _by_series(batches, list, add, lambda s: _fit_multiplicative(prior, *map(np.concatenate, zip(*s))), _COEF)
    return rows.mapInArrow(run, _COEF_SQL), scaling


def _fit_multiplicative(prior: Prior, X: np.ndarray, y: np.ndarray) -> tuple:
    """(beta, sigma, n, change, settled) of one series' rows."""
    T, S = X[:, :N_TREND], X[:, N_TREND:]
    of_trend, of_season = prior.part(slice(0, N_TREND)), prior.part(slice(N_TREND, None))
    bt, sigma2, _ = _solve_series(of_trend, len(y), float(y @ y), T.T @ y, T.T @ T)
    bs, fitted, change = np.zeros(S.shape[1]), T @ bt, math.inf
    size = max(np.abs(y).max(), 1e-12)
    for _ in range(PASSES):
        g = T @ bt
        Z = S * g[:, None]
        bs = of_season.solve(Z.T @ Z, Z.T @ (y - g), sigma2)
        s1 = 1 + S @ bs
        Z = T * s1[:, None]
        bt = of_trend.solve(Z.T @ Z, Z.T @ y, sigma2, bt)
        before, fitted = fitted, (T @ bt) * s1
        sigma2 = max(float(((y - fitted) ** 2).mean()), LEAST_NOISE)
        change = float(np.abs(fitted - before).max() / size)
        if change < PASS_TOLERANCE:
            break
    return np.concatenate([bt, bs]).tolist(), math.sqrt(sigma2), len(y), change, change < PASS_TOLERANCE


# ---------------------------------------------------------------- M5 / M6
def model_future_frame(history: DataFrame, periods: int = FUTURE_PERIODS) -> DataFrame:
    """M5: every history hour plus ``periods`` hourly steps after the last one."""
    h = history.select(*K, "ds")
    last = h.groupBy(*K).agg(F.max("ds").alias("last_ds"))
    fut = last.select(*K, F.explode(F.sequence(F.lit(1), F.lit(int(periods)))).alias("i"), "last_ds")
    fut = fut.select(*K, tf.add_hours("last_ds", F.col("i")).alias("ds"))
    return h.unionByName(fut)


def dot(x: Column, beta: Column) -> Column:
    return F.aggregate(F.zip_with(x, beta, lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v)


def predict_model(coefs: DataFrame, scaling: DataFrame, frame: DataFrame,
                  spec: ModelSpec = ModelSpec(), days: DataFrame | None = None) -> DataFrame:
    """M6: yhat for every (key, ds) of ``frame``. Output: key, ds, yhat."""
    f = model_features(frame.select(*K, "ds"), scaling, spec, days)
    j = f.join(coefs.select(*K, "beta"), K)
    if spec.mode == "multiplicative":
        k = len(spec.feature_names())
        g = dot(F.slice("x", 1, N_TREND), F.slice("beta", 1, N_TREND))
        s = dot(F.slice("x", N_TREND + 1, k - N_TREND), F.slice("beta", N_TREND + 1, k - N_TREND))
        yhat = g * (F.lit(1.0) + s)
    else:
        yhat = dot(F.col("x"), F.col("beta"))
    return j.select(*K, "ds", (yhat * F.col("y_scale")).alias("yhat"))


def fit_predict(history: DataFrame, calendar: DataFrame | None = None, spec: ModelSpec | None = None,
                periods: int = FUTURE_PERIODS, mode: str = "additive") -> DataFrame:
    """M1-M6 end to end: fit on the history with the events of ``calendar``, predict history + ``periods`` hours."""
    if spec is None:
        spec = ModelSpec(events=event_terms(calendar) if calendar is not None else (), mode=mode)
    days = event_days(calendar, spec.events) if calendar is not None else None
    coefs, scaling = fit_model(history, spec, days)
    return predict_model(coefs, scaling, model_future_frame(history, periods), spec, days)
