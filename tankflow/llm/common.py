"""Helpers that the operators share: session set-up, reading, Arrow batches."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tankflow.session import configure, cut_lineage, sf_path

#: Rows of an Arrow batch. Texts may be long, and a Python worker holds a few batches at once.
BATCH_ROWS = 350


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of the operators: those of the library, and Arrow batches small enough
    for tables with long texts."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(sf_path(sf_dir, name))


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text (null: empty). Whatever other columns ``docs`` has, none can
    clash with what an operator adds."""
    return docs.select(F.col(id_col).alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def materialise(df: DataFrame) -> DataFrame:
    """Write once under the session's checkpoint folder and read back (see ``cut_lineage``)."""
    return cut_lineage(df)


def map_batches(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], list]],
                schema: str) -> DataFrame:
    """``mapInArrow`` with one set-up for each task.

    ``make()`` runs in the task and returns a function from a record batch to a list of
    columns (Arrow arrays or Python lists) in the order of ``schema``.
    """
    out = df.sparkSession.createDataFrame([], schema).schema
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        gc.disable()  # the functions make many small objects and no cycles; collections took half the time
        try:
            for b in batches:
                if b.num_rows:
                    cols = [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, t.type)
                            for c, t in zip(f(b), arrow)]
                    yield pa.RecordBatch.from_arrays(cols, schema=arrow)
        finally:
            gc.enable()

    return df.mapInArrow(run, out)

