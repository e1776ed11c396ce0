"""Date/time column expressions (all built-in, all inside whole-stage codegen).

Oracle format models of the source map to Spark datetime patterns:
``dd.mm.yyyy`` -> ``dd.MM.yyyy``, ``hh24`` -> ``HH``, ``mi`` -> ``mm``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text formats of the extract.
DATE_FORMAT = "dd.MM.yyyy"
HOUR_FORMAT = "HH"
MINUTE_FORMAT = "mm"
DATETIME_FORMAT = "dd.MM.yyyy HH:mm"

def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x

def format_date(ts) -> Column:
    """``TO_CHAR(ts, 'dd.mm.yyyy')``."""
    return F.date_format(_c(ts), DATE_FORMAT)

def format_hour(ts) -> Column:
    """``TO_CHAR(ts, 'hh24')`` ('00'..'23')."""
    return F.date_format(_c(ts), HOUR_FORMAT)

def format_minute(ts) -> Column:
    """``TO_CHAR(ts, 'mi')`` ('00'..'59')."""
    return F.date_format(_c(ts), MINUTE_FORMAT)

def format_datetime(ts) -> Column:
    """``TO_CHAR(ts, 'dd.mm.yyyy hh24:mi')``."""
    return F.date_format(_c(ts), DATETIME_FORMAT)

def parse_date(text) -> Column:
    """Strict ``dd.MM.yyyy`` parse (ANSI mode raises on bad text)."""
    return F.to_date(_c(text), DATE_FORMAT)

def parse_date_lenient(text, fmt: str = DATE_FORMAT) -> Column:
    """Bad text becomes null, to be reported by the quality check."""
    return F.try_to_date(_c(text), fmt)

def truncate_hour(ts) -> Column:
    return F.date_trunc("HOUR", _c(ts)).cast("timestamp_ntz")

def truncate_minute(ts) -> Column:
    return F.date_trunc("MINUTE", _c(ts)).cast("timestamp_ntz")

def truncate_day(ts) -> Column:
    """``TRUNC(ts)`` / ``normalize()``; stays timezone-free."""
    return F.date_trunc("DAY", _c(ts)).cast("timestamp_ntz")

def combine_date_hour(date, hour) -> Column:
    """Date + hour -> hourly timestamp. Works for hour 24 (next midnight)."""
    return F.timestamp_add("HOUR", _c(hour), _c(date).cast("timestamp_ntz"))

def add_hours(ts, n) -> Column:
    """``+ n hours`` (n may be a column)."""
    return F.timestamp_add("HOUR", n if isinstance(n, Column) else F.lit(n), _c(ts))

def add_days(ts, n) -> Column:
    """``+ n days`` on a timestamp."""
    return F.timestamp_add("DAY", n if isinstance(n, Column) else F.lit(n), _c(ts))

def weekday(ts) -> Column:
    """X11: day of week with Monday = 0 (``weekday``, not ``dayofweek``)."""
    return F.weekday(_c(ts))

def hour_of(ts) -> Column:
    return F.hour(_c(ts))

def hour24_rollover(date, hour, mode: str = "all") -> tuple[Column, Column]:
    """Hour 24 becomes hour 0; hour-0 rows move to the next day.

    ``mode="all"`` reproduces the scripts: *every* hour-0 row moves, also the
    genuine midnights. ``mode="only_24"`` moves only the rows that were 24.
    """
    date, hour = _c(date), _c(hour)
    new_hour = F.when(hour == 24, F.lit(0)).otherwise(hour)
    moved = (new_hour == 0) if mode == "all" else (hour == 24)
    if mode not in ("all", "only_24"):
        raise ValueError(f"rollover mode {mode!r}")
    new_date = F.when(moved, F.date_add(date, 1)).otherwise(date)
    return new_date, new_hour

def hourly_grid(start, end) -> Column:
    """Every hour from ``start`` to ``end``, both ends inclusive (explode it)."""
    return F.sequence(_c(start), _c(end), F.expr("INTERVAL 1 HOUR"))
