"""Readers (S1-S4) and writers.

Connection details always come from the caller (configuration or a secret
store); nothing here holds credentials.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import schema as S

# Column names of the database's hourly orders table.
ORDERS_SOURCE_COLUMNS = {
    "OBJECTCODE": "station",
    "R_DAY": "r_day",
    "R_HOUR": "r_hour",
    "GASNUM": "product",
    "TANK": "tank",
    "VOLUME": "volume",
}


def read_hourly_csv(spark: SparkSession, path: str) -> DataFrame:
    """The hourly extract CSV (original headers) -> canonical columns.

    The schema is declared, applied by position, so an empty file still has
    the right columns and types (S4). A row that does not fit it keeps what could be
    read and its whole text in ``corrupt_record`` (null elsewhere), so that the series
    reject it and the quality report counts it.
    """
    # read as text and cast here: the reader only notices bad cells of columns that the query selects
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in S.HOURLY.fields] + [T.StructField("_line", T.StringType())])
    # all columns are parsed whatever the query selects, else a line with more cells than columns would pass unseen
    raw = (spark.read.schema(text).option("header", True).option("encoding", "UTF-8").option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", "_line").option("columnPruning", False).csv(path))
    cast = {f.name: F.col(f.name).try_cast(f.dataType) for f in S.HOURLY.fields}
    bad = F.col("_line").isNotNull()  # more or fewer cells than columns
    for name, value in cast.items():
        bad = bad | (F.col(name).isNotNull() & value.isNull())
    line = F.concat_ws(",", *[F.coalesce(F.col(f.name), F.lit("")) for f in S.HOURLY.fields])
    return raw.select(*[c.alias(n) for n, c in cast.items()], F.when(bad, F.coalesce("_line", line)).alias("corrupt_record"))


def empty_hourly(spark: SparkSession) -> DataFrame:
    """A zero-row extract with the declared schema."""
    return spark.createDataFrame([], S.HOURLY)


def read_jdbc(spark: SparkSession, url: str, query: str | None = None, *, table: str | None = None,
              properties: dict | None = None, fetchsize: int = 10_000,
              partition_column: str | None = None, lower_bound=None, upper_bound=None,
              num_partitions: int | None = None) -> DataFrame:
    """Run a query (or read a table) over JDBC.

    ``fetchsize`` streams rows the way a server-side cursor does. Large
    tables should be read by ``table`` with a numeric or date
    ``partition_column`` so that executors read ranges in parallel; filters
    applied afterwards are pushed into the database's WHERE clause. A query with a
    ``partition_column`` is read the same way, as a derived table.
    """
    r = spark.read.format("jdbc").option("url", url).option("fetchsize", str(fetchsize))
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if query is not None:
        if table is not None:
            raise ValueError("give either query or table")
        if partition_column is None:
            return r.option("query", query).load()
        table = f"({query}) q"
    if table is None:
        raise ValueError("query or table is required")
    r = r.option("dbtable", table)
    if partition_column is not None:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", str(lower_bound))
             .option("upperBound", str(upper_bound)).option("numPartitions", str(num_partitions or 8)))
    return r.load()


def _product(product: int | None, fuel: str | None) -> int | None:
    if fuel is None:
        return product
    codes = dict(S.FUEL_CODES)
    if fuel not in codes:
        raise ValueError(f"unknown fuel {fuel!r}")
    return codes[fuel]


def read_orders(spark: SparkSession, url: str, table: str, *, station=None, product=None, tank=None, fuel: str | None = None,
                properties: dict | None = None, **jdbc) -> DataFrame:
    """S3: the parameterised read of hourly orders (station, fuel code, tank).

    Parameters become DataFrame filters, which Spark pushes into the JDBC
    query; the projection is the database script's (day truncated, volume
    null -> 0 happens in ``series.orders_as_hourly``). ``fuel`` names the product; a name
    that the fuel list does not have raises.
    """
    product = _product(product, fuel)
    df = read_jdbc(spark, url, table=table, properties=properties, **jdbc)
    df = df.select(*[F.col(src).alias(dst) for src, dst in ORDERS_SOURCE_COLUMNS.items()])
    if station is not None:
        df = df.filter(F.col("station") == F.lit(station))
    if product is not None:
        df = df.filter(F.col("product") == F.lit(int(product)))
    if tank is not None:
        df = df.filter(F.col("tank") == F.lit(int(tank)))
    return df.select(
        F.col("station").cast("string"),
        F.to_date(F.col("r_day")).alias("r_day"),
        F.col("r_hour").cast("int"),
        F.col("product").cast("bigint"),
        F.col("tank").cast("int"),
        F.col("volume").cast("double"),
    )


#: S3 as SQL text: the names after the colons are bound, never pasted in.
ORDERS_SQL = """
SELECT station, CAST(date_trunc('DAY', r_day) AS DATE) AS r_day, r_hour, product, tank, COALESCE(volume, 0D) AS volume
FROM {orders}
WHERE station = :station AND product = :product AND tank = :tank
"""


def bound_orders(orders: DataFrame, *, station: str, product: int | None = None, tank: int, fuel: str | None = None) -> DataFrame:
    """S3 as parameterised SQL over a frame of hourly orders: parameters are bound as typed values (``args``), so a value
    can't change the statement. ``fuel`` names the product, as in ``read_orders``."""
    return orders.sparkSession.sql(ORDERS_SQL, args={"station": station, "product": _product(product, fuel), "tank": tank}, orders=orders)


def with_original_headers(df: DataFrame, headers: dict[str, str]) -> DataFrame:
    """Rename canonical columns back to the source's headers."""
    back = {v: k for k, v in headers.items()}
    return df.select(*[F.col(c).alias(back[c]) for c in back if c in df.columns])


def write_extract_csv(df: DataFrame, path: str, mode: str = "overwrite", pairs: bool = False) -> None:
    """The hourly extract as UTF-8 CSV with the original headers; ``pairs`` adds the number of
    source rows that each row stands for."""
    out = with_original_headers(df, S.HOURLY_HEADERS)
    if pairs:
        out = with_original_headers(df, {**S.HOURLY_HEADERS, "pairs": "pairs"})
    out.write.mode(mode).option("header", True).option("encoding", "UTF-8").csv(path)


def write_comparison(df: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite") -> None:
    """(ds, yhat, quantity, accuracy) per series with the original headers, partitioned by
    station (and product, tank) so each tank's file is separate; rows are dealt out by tank first,
    so that a tank gets one file."""
    keys = ["station", "product", "tank"]
    out = with_original_headers(df, {**S.COMPARISON_HEADERS, **{k: k for k in keys}}).repartition(*keys)
    w = out.write.mode(mode).partitionBy(*keys)
    if fmt == "csv":
        w.option("header", True).option("encoding", "UTF-8").csv(path)
    else:
        w.format(fmt).save(path)


def read_comparison(spark: SparkSession, path: str) -> DataFrame:
    schema = T.StructType(S.COMPARISON.fields + [
        T.StructField("station", T.StringType()), T.StructField("product", T.LongType()),
        T.StructField("tank", T.IntegerType())])
    return spark.read.schema(schema).option("header", True).csv(path)
