"""Sessions, table access and the few settings the operators rely on."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def get_session(app: str = "rillframe", cpus: int | str = "*", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster use the one the cluster gives."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for k, v in conf.items():
        builder = builder.config(k.replace("__", "."), v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def task_slots(spark: SparkSession, asked: int | None = None) -> int:
    """How many tasks run at once: what is asked for, at most what the session has."""
    return max(1, min(asked or 1 << 30, spark.sparkContext.defaultParallelism))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by the session; a temporary one only where none is set and the master is local."""
    known = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if known:
        return known
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    path = getattr(checkpoint_dir, "_path", None)
    if path is None or not os.path.isdir(path):
        path = checkpoint_dir._path = tempfile.mkdtemp(prefix="rillframe-")
        atexit.register(shutil.rmtree, path, ignore_errors=True)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows are written once to the shared folder and read from there."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(checkpoint_dir(spark))
    return df.checkpoint(eager=True)


def broadcast_if_small(df: DataFrame, rows: int, max_rows: int) -> DataFrame:
    """Hint a broadcast only where a counted number of rows is within the bound; else the planner decides."""
    return F.broadcast(df) if rows <= max_rows else df


def epoch_us(col):
    """Microseconds since 1970-01-01 UTC of a TIMESTAMP or TIMESTAMP_NTZ column."""
    return F.expr(f"timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', cast({col} as timestamp_ntz))")


def floor_div(a, b):
    """Integer division that rounds towards minus infinity (SQL ``div`` truncates)."""
    return F.call_function("div", a - F.pmod(a, b), b)
