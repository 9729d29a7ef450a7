"""Session helpers: sessions, table reads, lineage cuts in the shared folder."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import sys
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(name: str = "caseloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the engine expects: UTC, AQE with skew handling, Arrow."""
    b = SparkSession.builder.appName(name)
    if master:
        b = b.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    return b.config(map={**defaults, **conf}).getOrCreate()


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Table ``name`` of the data folder ``root`` (a Parquet file or folder)."""
    return spark.read.parquet(f"{root}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share.

    It is ``spark.checkpoint.dir`` of the session. Only a single-JVM session (as in tests) that has
    none gets a temporary folder; on a cluster a missing setting is an error.
    """
    sc = spark.sparkContext
    known = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not known:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        known = "file://" + tempfile.mkdtemp(prefix="caseloom-")
        sc.setCheckpointDir(known)
    return known.rstrip("/")


_cleaned: set[str] = set()


def materialize(df: DataFrame, what: str = "step") -> DataFrame:
    """Write ``df`` into the shared folder and read it back: cuts the lineage, survives lost executors.

    The files are Parquet, so the planner then knows the size of the result. They go when the driver ends,
    by the file system that holds them; :func:`discard` deletes them earlier.
    """
    spark = df.sparkSession
    own = f"{shared_dir(spark)}/caseloom-{os.getpid()}"
    path = f"{own}/{what}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    if own not in _cleaned:
        _cleaned.add(own)
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(own)  # only what exists can be marked
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(p)
        if own.startswith(("file:", "/")):
            atexit.register(shutil.rmtree, re.sub("^file:/*", "/", own), ignore_errors=True)
    out = spark.read.schema(df.schema).parquet(path)
    out._caseloom_path = path
    return out


def discard(df: DataFrame) -> None:
    """Delete the files of a :func:`materialize` result that nothing reads any more."""
    path = getattr(df, "_caseloom_path", None)
    if path:
        spark = df.sparkSession
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def is_small(df: DataFrame, rows: int) -> bool:
    """Whether ``df`` has at most ``rows`` rows; reads no more than that of each partition."""
    return df.limit(rows + 1).count() <= rows


def ship(module: str) -> None:
    """Send the functions of ``module`` to Python workers by value, so that executors need no copy of the package."""
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[module])
