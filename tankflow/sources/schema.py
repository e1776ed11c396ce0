"""Declared schemas of every input and output frame.

Types are declared, never inferred, so that an empty input still carries
its schema through every stage.
"""

from __future__ import annotations

from pyspark.sql import types as T

SERIES_KEY = ["station", "product", "tank"]

RECEIPTS = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("station", T.StringType()),
    T.StructField("znum", T.LongType()),
    T.StructField("shift_start", T.TimestampNTZType()),
    T.StructField("start_ts", T.TimestampNTZType()),
])

SHIFTS = T.StructType([
    T.StructField("station", T.StringType()),
    T.StructField("znum", T.LongType()),
    T.StructField("shift_start", T.TimestampNTZType()),
])

ITEMS = T.StructType([
    T.StructField("receipt_id", T.LongType()),
    T.StructField("product", T.LongType()),
    T.StructField("tank", T.IntegerType()),
    T.StructField("prodtype", T.IntegerType()),
    T.StructField("bruto", T.DoubleType()),
    T.StructField("volume", T.DoubleType()),
])

GAUGES = T.StructType([
    T.StructField("station", T.StringType()),
    T.StructField("product", T.LongType()),
    T.StructField("tank", T.IntegerType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("volume", T.DoubleType()),
    T.StructField("reading_id", T.LongType()),
])

# Hourly extract: what the extraction writes and the forecast reads.
# `pairs` is ours: how many (last reading, first reading) pairs the hour
# stands for when readings share a boundary minute (see operators.outflow).
HOURLY = T.StructType([
    T.StructField("station", T.StringType()),
    T.StructField("product", T.LongType()),
    T.StructField("tank", T.IntegerType()),
    T.StructField("date", T.StringType()),
    T.StructField("hour", T.IntegerType()),
    T.StructField("quantity", T.DoubleType()),
])

# Pre-aggregated hourly orders table of the database variant.
ORDERS = T.StructType([
    T.StructField("station", T.StringType()),
    T.StructField("r_day", T.DateType()),
    T.StructField("r_hour", T.IntegerType()),
    T.StructField("product", T.LongType()),
    T.StructField("tank", T.IntegerType()),
    T.StructField("volume", T.DoubleType()),
])

FUELS = T.StructType([
    T.StructField("fuel_name", T.StringType()),
    T.StructField("product", T.LongType()),
])

CALENDAR = T.StructType([
    T.StructField("event", T.StringType()),
    T.StructField("date", T.DateType()),
    T.StructField("lower", T.IntegerType()),
    T.StructField("upper", T.IntegerType()),
])

# One row per series. Timestamps are hour-resolution bounds; `end` is
# inclusive (the scripts use 23:59:59 so the last forecast hour is 23:00).
CONFIG = T.StructType([
    T.StructField("station", T.StringType()),
    T.StructField("product", T.LongType()),
    T.StructField("tank", T.IntegerType()),
    T.StructField("cutoff", T.TimestampNTZType()),
    T.StructField("actual_from", T.TimestampNTZType()),
    T.StructField("actual_to", T.TimestampNTZType()),
    T.StructField("window", T.IntegerType()),
    T.StructField("start", T.TimestampNTZType()),
    T.StructField("end", T.TimestampNTZType()),
    T.StructField("w_base", T.DoubleType()),
    T.StructField("w_model", T.DoubleType()),
    T.StructField("initial", T.DoubleType()),
    T.StructField("dead_stock", T.DoubleType()),
    T.StructField("score_from", T.TimestampNTZType()),
    T.StructField("score_to", T.TimestampNTZType()),
])

COMPARISON = T.StructType([
    T.StructField("ds", T.TimestampNTZType()),
    T.StructField("yhat", T.DoubleType()),
    T.StructField("quantity", T.DoubleType()),
    T.StructField("accuracy", T.DoubleType()),
])

# The original column headers of the hourly extract, in file
# order, mapped to our canonical names. Used only on read and write.
HOURLY_HEADERS = {
    "АЗС_CODE": "station",
    "PRODNAME": "product",
    "TANKNUM": "tank",
    "ДАТА": "date",
    "HOUR": "hour",
    "КОЛИЧЕСТВО": "quantity",
}

# The header of the stored comparison output.
COMPARISON_HEADERS = {"ds": "ds", "yhat": "yhat", "КОЛИЧЕСТВО": "quantity", "accuracy": "accuracy"}

# Fuel name -> product code, as listed by the database script.
FUEL_CODES = [
    ("Аи-80", 3300000000),
    ("Аи-92", 3300000002),
    ("Аи-95", 3300000005),
    ("Аи-98", 3300000008),
    ("ДТ-Л", 3300000010),
    ("ДТ-3-25", 3300000029),
    ("ДТ-3-32", 3300000038),
    ("СУГ", 3400000000),
    ("Аи-95-import", 3300000095),
]

# The special-event calendar of the forecast scripts
# (event name, day, lower window, upper window).
SPECIAL_EVENTS = [
    ("special_event", "2024-08-30", 0, 1),
    ("special_event", "2024-08-31", 0, 1),
]

# Stations for which a non-zero volume alone (zero gross)
# still counts as a sale in the POS aggregate.
NET_ONLY_STATIONS = ("X347", "X345", "X343", "X364", "X344", "X348",
                     "X342", "X351", "X349", "X341", "X346", "X350")
