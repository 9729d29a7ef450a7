"""Latest and best records, pending work, upserts and ordered reasons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.functions.text import hash_fraction


def instant(x: Column) -> Column:
    """An ISO time with any offset as a timestamp; null if unreadable."""
    return F.try_to_timestamp(x)


def first_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The row of each key that comes first by ``order``, a list of ascending columns, nulls first.

    An aggregate, not a window: rows are reduced before the shuffle, so a hot key is no hot task. The
    order should be total; equal rows are the same row.
    """
    named = [c.alias(f"o{i}") for i, c in enumerate(order)]
    best = df.groupBy(*keys).agg(F.min(F.struct(*named, F.struct(*df.columns).alias("row"))).alias("b"))
    return best.select("b.row.*")


def latest_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The row of each key that comes last by ``order``."""
    named = [c.alias(f"o{i}") for i, c in enumerate(order)]
    return df.groupBy(*keys).agg(F.max(F.struct(*named, F.struct(*df.columns).alias("row"))).alias("b")).select("b.row.*")


def position(x: Column, values: list[str]) -> Column:
    """Index of ``x`` in ``values``; behind all for others and nulls."""
    at = F.array_position(F.array(*map(F.lit, values)), x)
    return F.when(at > 0, at - 1).otherwise(len(values)).cast("int")


def best_images(images: DataFrame, relevance: list[str], modalities: list[str]) -> DataFrame:
    """One image per case: by relevance, modality, caption, size in pixels, then id."""
    blank = F.coalesce(F.trim("caption") == "", F.lit(True)).cast("int")
    pixels = -(F.col("width").cast("long") * F.col("height"))
    return first_by(images, ["case_id"], [position(F.col("image_relevance"), relevance), position(F.col("image_modality"), modalities), blank, F.coalesce(pixels, F.lit(0)), F.col("image_id")])


def pending(work: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``work`` without a counterpart in ``done``."""
    return work.join(done.select(*keys).distinct(), keys, "left_anti")


def first_pending(work: DataFrame, done: DataFrame, keys: list[str], n: int) -> DataFrame:
    """The ``n`` first pending rows by key; a top-k, not a sort of all."""
    return pending(work, done, keys).orderBy(*keys).limit(n)


def ladder(*rungs: tuple[Column, str], otherwise: str | None = None) -> Column:
    """The name of the first condition that holds; a null condition does not."""
    out = F.lit(otherwise)
    for test, name in reversed(rungs):
        out = F.when(F.coalesce(test, F.lit(False)), name).otherwise(out)
    return out


def reasons(*flags: tuple[Column, str]) -> Column:
    """All names whose condition holds, in order."""
    return F.array_compact(F.array(*(F.when(F.coalesce(test, F.lit(False)), name) for test, name in flags)))


def sampled(key: Column, salt: str, rate: float) -> Column:
    """Whether ``key`` falls into the reproducible sample of ``rate``."""
    return hash_fraction(F.concat(key, F.lit(salt))) < rate


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``new`` and the rows of ``old`` whose keys ``new`` has not."""
    return pending(old, new, keys).unionByName(new, allowMissingColumns=True)


def append_new(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``old`` and the rows of ``new`` whose keys it has not; a key that is new twice comes once."""
    return old.unionByName(pending(new.dropDuplicates(keys), old, keys), allowMissingColumns=True)


def append_audit(log: str, new: DataFrame, keys: list[str]) -> None:
    """Append to the log at path ``log`` the rows of ``new`` whose keys it has not; what was written is never changed.

    A run that is repeated adds nothing. ``log`` is created with the first rows, even if there are none.
    """
    spark = new.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(log)
    fresh = new.dropDuplicates(keys)
    if path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        fresh = pending(fresh, spark.read.parquet(log), keys)
    fresh.write.mode("append").parquet(log)


def reuse_results(jobs: DataFrame, cache: DataFrame, key: str) -> DataFrame:
    """``jobs`` with the cached columns of the same request key and ``cached``; a changed request finds nothing."""
    return jobs.join(cache.withColumn("cached", F.lit(True)), key, "left").withColumn("cached", F.coalesce("cached", F.lit(False)))


def conflicting(cache: DataFrame, key: str, result: str) -> DataFrame:
    """Request keys with several results."""
    return cache.groupBy(key).agg(F.min(result).alias("__a"), F.max(result).alias("__b")).where("__a <> __b").select(key)


def last_valid_attempt(attempts: Column, valid) -> Column:
    """The last element of an array of attempts for which ``valid`` holds, or null."""
    return F.get(F.filter(F.reverse(attempts), valid), F.lit(0))


def same_set(a: DataFrame, b: DataFrame) -> bool:
    """Whether two tables hold the same distinct rows."""
    return a.distinct().exceptAll(b.distinct()).limit(1).count() == 0 and b.distinct().exceptAll(a.distinct()).limit(1).count() == 0
