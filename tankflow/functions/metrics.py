"""Numeric column expressions used by the forecast and the evaluation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def accuracy(actual, forecast) -> Column:
    """``min/max * 100``; null if either side is null or max is 0.

    ``least``/``greatest`` skip nulls, so both operands are guarded first.
    The scripts divide by zero on (0, 0); we return null (the database
    variant's guarded form). Negative values and values above 100 are kept.
    """
    a, f = _c(actual), _c(forecast)
    ratio = F.try_divide(F.least(a, f), F.nullif(F.greatest(a, f), F.lit(0.0))) * F.lit(100.0)
    return F.when(a.isNotNull() & f.isNotNull(), ratio)


def weighted_blend(base, model, w_base, w_model) -> Column:
    """``w_base * base + w_model * model``; weights are not normalised."""
    return _c(w_base) * _c(base) + _c(w_model) * _c(model)


def rounded(x, digits: int = 6) -> Column:
    """Output rounding used where results are compared across engines."""
    return F.round(_c(x), digits)
