"""End-to-end plans: extraction -> clean series -> baseline -> forecast ->
depletion -> evaluation, for every series at once.

``Pipeline`` only wires lazy DataFrames together; nothing is collected.
Each stage is a property, so a query touches only the stages it needs and
Catalyst sees one plan.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..operators import baseline as bl
from ..operators import depletion as dp
from ..operators import evaluate as ev
from ..operators import forecast as fc
from ..operators import outflow as of
from ..operators import series as se
from ..sources import fixtures as fx
from ..session import cut_lineage


class Pipeline:
    """All stages over the driver tables of one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str, *, year: int = fx.TEST_YEAR,
                 months=fx.TEST_MONTHS, bounds: tuple[dt.date, dt.date] = fx.TEST_BOUNDS,
                 stations=None, net_only_stations=fx.TEST_NET_ONLY, rollover: str = "all", exclude_filled: bool = False,
                 model: str | None = None, source: str = "extract", **scenario):
        self.spark = spark
        self.sf_dir = sf_dir
        self.year = year
        self.months = tuple(months)
        self.bounds = bounds
        self.stations = stations
        self.net_only_stations = tuple(net_only_stations)
        self.rollover = rollover
        self.exclude_filled = exclude_filled
        self.model_kind = model
        if source not in ("extract", "orders", "gauges"):
            raise ValueError(f"source {source!r}")
        self.source = source
        self.scenario = scenario

    # -- inputs ---------------------------------------------------------
    @cached_property
    def gauges(self) -> DataFrame:
        return fx.gauges(self.spark, self.sf_dir)

    @cached_property
    def receipts(self) -> DataFrame:
        return fx.receipts(self.spark, self.sf_dir)

    @cached_property
    def shifts(self) -> DataFrame:
        return fx.shifts(self.spark, self.sf_dir)

    @cached_property
    def items(self) -> DataFrame:
        return fx.items(self.spark, self.sf_dir)

    # -- C1 -------------------------------------------------------------
    @cached_property
    def pos_sales(self) -> DataFrame:
        return of.pos_hourly_sales(self.receipts, self.shifts, self.items, year=self.year,
                                   months=self.months, stations=self.stations,
                                   net_only_stations=self.net_only_stations)

    @cached_property
    def hourly(self) -> DataFrame:
        """C1 output, checkpointed: the extract is the hand-off point between
        extraction and forecasting (the scripts write it to a file), it is
        small (one row per tank-hour) and every later stage reads it."""
        return cut_lineage(self.source_plan)

    @cached_property
    def source_plan(self) -> DataFrame:
        """The hourly input of the forecast: the extraction (C1), the
        database's hourly orders (C7), or plain hourly gauge sums."""
        if self.source == "orders":
            return se.orders_as_hourly(self.orders)
        if self.source == "gauges":
            return fx.hourly_from_gauges(self.spark, self.sf_dir)
        return self.hourly_plan

    @cached_property
    def orders(self) -> DataFrame:
        return fx.orders(self.spark, self.sf_dir)

    @cached_property
    def hourly_plan(self) -> DataFrame:
        return of.hourly_tank_outflow(self.receipts, self.shifts, self.items, self.gauges,
                                      year=self.year, months=self.months, start=self.bounds[0],
                                      end=self.bounds[1], stations=self.stations,
                                      net_only_stations=self.net_only_stations)

    # -- config and C3 ----------------------------------------------------
    @cached_property
    def cfg(self) -> DataFrame:
        """One row per series, written once: every stage joins it."""
        return cut_lineage(fx.make_config(self.hourly, **self.scenario))

    @cached_property
    def series(self) -> DataFrame:
        """C3 output, checkpointed: read by the history, actual and model stages."""
        return cut_lineage(se.clean_hourly_series(self.hourly, self.cfg, rollover=self.rollover,
                                                   provenance=self.exclude_filled))

    @cached_property
    def history(self) -> DataFrame:
        return se.split_history(self.series, self.cfg)

    @cached_property
    def actual(self) -> DataFrame:
        return se.split_actual(self.series, self.cfg)

    # -- baseline, model, C4 ----------------------------------------------
    @cached_property
    def baseline(self) -> DataFrame:
        return bl.similar_day_baseline(self.history, self.cfg, exclude_filled=self.exclude_filled,
                                       most=fx.most_window(**self.scenario))

    @cached_property
    def calendar(self) -> DataFrame:
        return fx.calendar(self.spark)

    @cached_property
    def spec(self):
        from ..operators import model as md
        return md.ModelSpec(events=md.event_terms(self.calendar), mode=self.model_kind or "additive")

    @cached_property
    def event_days(self) -> DataFrame:
        from ..operators import model as md
        return md.event_days(self.calendar, self.spec.events)

    @cached_property
    def fitted(self) -> tuple[DataFrame, DataFrame]:
        """(coefficients, scaling): the coefficients, one row per series, are written once."""
        from ..operators import model as md
        coefs, scaling = md.fit_model(self.history, self.spec, self.event_days)
        return cut_lineage(coefs), scaling

    @cached_property
    def model_frame_prediction(self) -> DataFrame:
        """The model's prediction of the history and the hours after it."""
        from ..operators import model as md
        return md.predict_model(*self.fitted, md.model_future_frame(self.history), self.spec, self.event_days)

    @cached_property
    def model_prediction(self) -> DataFrame | None:
        return None if self.model_kind is None else self.model_frame_prediction

    @cached_property
    def forecast(self) -> DataFrame:
        return fc.hybrid_forecast(self.baseline, self.cfg, self.model_prediction)

    # -- C5 ---------------------------------------------------------------
    @cached_property
    def level(self) -> DataFrame:
        return dp.tank_level(self.forecast, self.cfg)

    @cached_property
    def extension(self) -> DataFrame:
        return dp.extend_to_dead_stock(self.level, self.baseline, self.cfg)

    @cached_property
    def crossing(self) -> DataFrame:
        return dp.crossing(self.level, self.baseline, self.cfg)

    @cached_property
    def depletion(self) -> DataFrame:
        return dp.depletion_forecast(self.forecast, self.baseline, self.cfg)

    @cached_property
    def first_dead_stock(self) -> DataFrame:
        return dp.first_dead_stock(self.depletion, self.cfg)

    # -- C6 ---------------------------------------------------------------
    @cached_property
    def comparison(self) -> DataFrame:
        return ev.evaluate(self.depletion, self.actual)

    @cached_property
    def mean_accuracy(self) -> DataFrame:
        return ev.mean_accuracy(self.comparison, self.cfg)

    # -- O4 -----------------------------------------------------------------
    @cached_property
    def chart_feed(self) -> DataFrame:
        from ..operators import feeds
        return feeds.chart_feed(self.history, self.depletion, self.actual, self.comparison, self.cfg)
