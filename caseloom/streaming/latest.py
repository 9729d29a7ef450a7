"""Streams of records: late repeats dropped, the latest state per key kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.operators.records import latest_by


def deduplicated(stream: DataFrame, keys: list[str], time: str, delay: str) -> DataFrame:
    """``stream`` without repeats of ``keys`` that come within ``delay``; the state is bounded by the watermark."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def windowed_counts(stream: DataFrame, time: str, width: str, delay: str, by: list[str]) -> DataFrame:
    """(start, by..., n): rows per time window and key, final once the watermark has passed."""
    counts = stream.withWatermark(time, delay).groupBy(F.window(time, width), *by).agg(F.count("*").alias("n"))
    return counts.select(F.col("window.start").alias("start"), *by, "n")


def maintain_latest(stream: DataFrame, path: str, checkpoint: str, keys: list[str], order: list[str]) -> None:
    """Run ``stream`` to its end, keeping at ``path`` the row of each key that is last by ``order``.

    Each micro-batch is merged into a new version of the table, so a repeated batch changes nothing. The
    version that it was made of stays for those who read it; older ones are deleted.
    """
    spark = stream.sparkSession

    def merge(batch: DataFrame, number: int) -> None:
        old = _newest(spark, path, number)
        every = batch if old is None else old.unionByName(batch)
        latest_by(every, keys, [F.col(c) for c in order]).write.mode("overwrite").parquet(f"{path}/v={number:012d}")
        for version in _versions(spark, path)[:-2]:
            _fs(spark, path).delete(_path(spark, f"{path}/{version}"), True)

    stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _versions(spark: SparkSession, path: str) -> list[str]:
    """The whole versions at ``path``, oldest first."""
    fs = _fs(spark, path)
    if not fs.exists(_path(spark, path)):
        return []
    names = sorted(s.getPath().getName() for s in fs.listStatus(_path(spark, path)) if s.getPath().getName().startswith("v="))
    return [v for v in names if fs.exists(_path(spark, f"{path}/{v}/_SUCCESS"))]


def _newest(spark: SparkSession, path: str, before: int) -> DataFrame | None:
    versions = [v for v in _versions(spark, path) if int(v[2:]) < before]
    return spark.read.parquet(f"{path}/{versions[-1]}") if versions else None


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    """The table that :func:`maintain_latest` keeps."""
    out = _newest(spark, path, 10**12)
    if out is None:
        raise FileNotFoundError(path)
    return out
