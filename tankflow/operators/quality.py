"""Data-quality findings as a table (replaces the scripts' log lines and exits).

One aggregation pass over the extract gives every count; the fuel check is a
left join against the fuel dimension, a nine-row list whose size the planner knows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import timefmt as tf
from ..sources.schema import SERIES_KEY

K = SERIES_KEY
CHECKS = ("empty_input", "unparseable_date", "null_hour", "corrupt_row", "null_quantity", "unknown_fuel")


def _date_is_bad(df: DataFrame):
    c = df["date"]
    if isinstance(df.schema["date"].dataType, T.StringType):
        return tf.parse_date_lenient(c).isNull()
    return c.isNull()


def null_presence(df: DataFrame, col: str = "quantity") -> DataFrame:
    """Per series, whether any ``col`` is null and how many."""
    return df.groupBy(*K).agg(F.bool_or(F.col(col).isNull()).alias("has_null"),
                              F.count_if(F.col(col).isNull()).alias("null_rows"))


def row_count_check(df: DataFrame) -> DataFrame:
    """A10: row count and emptiness of an input."""
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("is_empty", F.col("rows") == 0)


def fuel_code_join(df: DataFrame, fuels: DataFrame, name_col: str = "fuel_name") -> tuple[DataFrame, DataFrame]:
    """The product code of each row's fuel name; returns (known, rejected). A name that the
    list doesn't have, or no name, is rejected."""
    dim = fuels.select(F.col("fuel_name").alias("_name"), F.col("product"))
    same = F.col(name_col) == F.col("_name")
    return df.join(dim, same, "inner").drop("_name"), df.join(dim, same, "left_anti")


def quality_report(hourly: DataFrame, fuels: DataFrame | None = None) -> DataFrame:
    """(finding, row_count): empty input, rows by reason why the series can't take them (bad date,
    null hour, corrupt row), null quantities, and product codes missing from the fuel list. Always one
    row per finding."""
    corrupt = F.col("corrupt_record").isNotNull() if "corrupt_record" in hourly.columns else F.lit(False)
    df, unknown = hourly, F.lit(0)
    if fuels is not None:
        df = df.join(fuels.select("product", F.lit(True).alias("_known")), "product", "left")
        unknown = F.count_if(F.col("_known").isNull())
    agg = df.agg(F.count(F.lit(1)).alias("n"),
                 F.count_if(_date_is_bad(df) & ~corrupt).alias("bad_date"),
                 F.count_if(F.col("hour").isNull() & ~_date_is_bad(df) & ~corrupt).alias("null_hour"),
                 F.count_if(corrupt).alias("corrupt"),
                 F.count_if(F.col("quantity").isNull()).alias("null_q"),
                 unknown.cast("bigint").alias("unknown"))
    return agg.select(F.expr(
        "stack(6, 'empty_input', CAST(IF(n = 0, 1, 0) AS BIGINT), 'unparseable_date', bad_date, "
        "'null_hour', null_hour, 'corrupt_row', corrupt, "
        "'null_quantity', null_q, 'unknown_fuel', unknown) AS (finding, row_count)"))


def series_span(bounds: DataFrame, most_hours: int = 24 * 366 * 20) -> DataFrame:
    """C8 before the grid is made: (key, grid_hours, too_long) from ``series.series_bounds``. One far-off date makes a grid
    of millions of hours; ``too_long`` tells which series have one."""
    seconds = F.unix_seconds(F.col("grid_end").cast("timestamp")) - F.unix_seconds(F.col("grid_start").cast("timestamp"))
    hours = F.floor(seconds / 3600).cast("bigint") + 1
    return bounds.select(*K, hours.alias("grid_hours"), (hours > most_hours).alias("too_long"))
