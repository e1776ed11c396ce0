"""Session construction and cluster-safe helpers.

Nothing here keeps global state: every operator takes DataFrames and
returns DataFrames, so the same code runs on ``local[8]`` and on a
multi-executor cluster.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings every session of ours needs for correct results: timestamps in
# the test data are timezone-free, and `date_trunc` returns a zoned
# timestamp that we cast back, so the session zone must be pinned.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tankflow", extra: dict | None = None) -> SparkSession:
    """Create (or fetch) a session with the settings our operators rely on."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(REQUIRED_CONF)
    conf.setdefault("spark.ui.enabled", "false")
    conf.setdefault("spark.sql.execution.arrow.pyspark.enabled", "true")
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the required SQL settings to an existing session (idempotent)
    and ship this package to the executors for the Arrow/pandas steps."""
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Zip the ``tankflow`` package once per SparkContext and ``addPyFile`` it,
    so executor-side Python (mapInArrow/applyInPandas) can import it."""
    sc = spark.sparkContext
    if getattr(sc, "_tankflow_shipped", False):
        return
    import zipfile
    pkg = os.path.dirname(os.path.abspath(__file__))
    fd, path = tempfile.mkstemp(prefix="tankflow-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(path)
    sc._tankflow_shipped = True


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    Read from the session. Only a session whose executors are threads of this
    process (tests, local runs) gets a scratch folder of its own when it is
    unset; any other raises, since executors would not see each other's files.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if not current:
        current = spark.conf.get("spark.checkpoint.dir", None)
        if not current:
            if not sc.master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            current = tempfile.mkdtemp(prefix="tankflow-ckpt-")
        sc.setCheckpointDir(current)
    return current


def tables_dir(spark: SparkSession) -> str:
    """The folder of this application's written tables, under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/tankflow-tables/{spark.sparkContext.applicationId}"


def drop_tables(spark: SparkSession) -> bool:
    """Delete all tables that this application has written with ``cut_lineage``. For the end of a session, or between jobs of
    a long-lived one: frames that were made before can't be read any more. True if there were any."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(tables_dir(spark))
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise a frame reliably and cut its lineage.

    The frame is written once as a parquet table under the session's shared
    checkpoint folder and read back: later stages read files that survive
    executor loss, the optimizer sees their real size, and the plan runs
    once (``Dataset.checkpoint`` on an unpersisted plan runs it twice: once
    for the eager count, once for the write).
    """
    import uuid
    path = f"{tables_dir(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.mode("error").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_lineages(*frames: DataFrame) -> list[DataFrame]:
    """``cut_lineage`` of several frames that don't need each other, at the same time: small ones leave most cores idle."""
    from concurrent.futures import ThreadPoolExecutor

    from pyspark import inheritable_thread_target
    with ThreadPoolExecutor(len(frames)) as pool:
        return list(pool.map(inheritable_thread_target(frames[0].sparkSession)(cut_lineage), frames))


def results_base(spark: SparkSession | None = None) -> str:
    """Where ``save_result`` puts tables for readers outside Spark: on a cluster under its ``spark.checkpoint.dir``, in a local
    run (one machine, one file system) in a folder of this user's that doesn't depend on the session."""
    spark = spark or SparkSession.getActiveSession()
    if spark is None or spark.sparkContext.master.startswith("local["):
        return os.path.join(tempfile.gettempdir(), f"tankflow-{os.getuid()}", "results")
    return f"{checkpoint_dir(spark).removeprefix('file://').rstrip('/')}/tankflow-results"


def save_result(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under a name that others can read it by (a later call replaces it), and read it back."""
    path = f"{results_base(df.sparkSession)}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sf_path(sf_dir: str, table: str) -> str:
    return os.path.join(sf_dir, f"{table}.parquet")
