"""Statistics over aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed value: the 97.5 % point of the normal distribution.
Z95 = 1.959963984540054


def wilson(successes: Column, trials: Column, z: float = Z95) -> list[Column]:
    """rate, low and high of the Wilson interval, rounded to 6 places; null without trials."""
    n, k = trials.cast("double"), successes.cast("double")
    p = F.try_divide(k, n)
    scale = 1 + F.try_divide(F.lit(z * z), n)
    centre = (p + F.try_divide(F.lit(z * z), 2 * n)) / scale
    half = z / scale * F.sqrt(F.try_divide(p * (1 - p), n) + F.try_divide(F.lit(z * z), 4 * n * n))
    return [F.round(p, 6).alias("rate"), F.round(centre - half, 6).alias("low"), F.round(centre + half, 6).alias("high")]


def cohen_kappa(pairs: DataFrame, left: str, right: str) -> DataFrame:
    """One row (n, agreement, kappa) of the two label columns; kappa is null if chance agreement is 1.

    Only label pairs are counted in the shuffle. Rows with a null label do not take part.
    """
    cells = pairs.where(F.col(left).isNotNull() & F.col(right).isNotNull()).groupBy(F.col(left).alias("l"), F.col(right).alias("r")).agg(F.count("*").alias("n"))
    sides = cells.select(F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("l").alias("v")), F.struct(F.lit(1).alias("side"), F.col("r").alias("v")))).alias("x"), "n")
    marginal = sides.groupBy("x.v").agg(F.sum(F.when(F.col("x.side") == 0, F.col("n")).otherwise(0)).alias("a"), F.sum(F.when(F.col("x.side") == 1, F.col("n")).otherwise(0)).alias("b"))
    chance = marginal.agg(F.sum(F.col("a") * F.col("b")).cast("double").alias("c"))
    seen = cells.agg(F.sum("n").alias("n"), F.sum(F.when(F.col("l") == F.col("r"), F.col("n")).otherwise(0)).cast("double").alias("same"))
    both = seen.crossJoin(chance)  # one row each
    po, pe = F.try_divide("same", "n"), F.try_divide("c", F.col("n").cast("double") * F.col("n"))
    return both.select(F.coalesce("n", F.lit(0)).cast("long").alias("n"), F.round(po, 6).alias("agreement"), F.round(F.try_divide(po - pe, 1 - pe), 6).alias("kappa"))
