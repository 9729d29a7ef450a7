"""Exact ranks within groups of any size, without a group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def unit(*columns: Column | str, seed: int = 0) -> Column:
    """A number in (0, 1) that the values of ``columns`` determine."""
    return (F.shiftrightunsigned(F.xxhash64(*columns, F.lit(seed)), 11) + F.lit(0.5)) / F.lit(float(2**53))


def group_rank(df: DataFrame, groups: list[str], order: str, ties: list[str], rank: str = "rank", bins: int = 1024) -> DataFrame:
    """``df`` with the 0-based ``rank`` of each row in its group by ``order``, a number in [0, 1], then ``ties``.

    Rows are counted by bin of ``order`` (pre-aggregated), the counts summed up over the bins of each
    group, and only the rows of one bin of one group meet in a task. Rows equal in all of these keep
    an arbitrary order among themselves.
    """
    binned = df.withColumn("__bin", F.floor(F.col(order) * bins).cast("int"))
    keys = [*groups, "__bin"]
    ahead = Window.partitionBy(*groups).orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1)
    before = binned.groupBy(*keys).agg(F.count("*").alias("__n")).withColumn("__before", F.coalesce(F.sum("__n").over(ahead), F.lit(0))).drop("__n")
    own = Window.partitionBy(*keys).orderBy(F.col(order), *[F.col(t) for t in ties])
    ranked = binned.withColumn("__own", F.row_number().over(own) - 1)
    out = ranked.join(before, keys)
    return out.withColumn(rank, (F.col("__before") + F.col("__own")).cast("long")).select(*df.columns, rank)
