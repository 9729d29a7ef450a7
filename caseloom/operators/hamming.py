"""Pairs of 64-bit values that differ in few bits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.session import materialize


def _extract(value: Column, blocks: list[tuple[int, int]]) -> Column:
    """The bits of ``value`` in ``blocks`` (start, width), packed side by side."""
    out = F.lit(0).cast("long")
    for start, width in blocks:
        out = F.shiftleft(out, width).bitwiseOR(F.shiftrightunsigned(value, start).bitwiseAND(F.lit((1 << width) - 1)))
    return out


def _blocks(bits: list[int], n: int) -> list[list[int]]:
    cut = [round(i * len(bits) / n) for i in range(n + 1)]
    return [bits[cut[i] : cut[i + 1]] for i in range(n)]


def _runs(bits: list[int]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for b in bits:
        if out and b == sum(out[-1]):
            out[-1] = (out[-1][0], out[-1][1] + 1)
        else:
            out.append((b, 1))
    return out


def hamming_pairs(values: DataFrame, column: str, most: int = 4, hot: int = 256) -> DataFrame:
    """(a, b), a < b: distinct 64-bit values of ``column`` that differ in 1 to ``most`` bits.

    The bits are cut in n blocks; two values that differ in at most ``most`` bits agree in n - most
    of them, so each value is indexed by every choice of n - most blocks. n grows with the number of
    values, keeping the expected bucket near one value. A bucket of more than ``hot`` values is
    indexed again by the choices of blocks of its other bits, so no bucket's pairs are all tried.
    """
    from itertools import combinations

    vals = materialize(values.select(F.col(column).cast("long").alias("v")).where("v is not null").distinct(), "hashes")
    count = vals.count()
    n = next((n for n in range(most + 2, 2 * most + 1) if 2 ** (64 * (n - most) / n) >= count), 2 * most)
    parts = _blocks(list(range(64)), n)
    choices, finer = [], []
    for c in combinations(range(n), n - most):
        own = sorted(b for i in c for b in parts[i])
        rest = _blocks([b for b in range(64) if b not in own], most + 2)
        choices.append(_extract(F.col("v"), _runs(own)))
        finer.append(F.array(*(_extract(F.col("v"), _runs(sorted(rest[i] + rest[j]))) for i, j in combinations(range(most + 2), 2))))
    keyed = vals.select("v", F.posexplode(F.array(*choices)).alias("choice", "bucket"))
    crowded = keyed.groupBy("choice", "bucket").agg(F.count("*").alias("n")).where(F.col("n") > 1).withColumn("big", F.col("n") > hot)
    keyed = materialize(keyed.join(crowded.select("choice", "bucket", "big"), ["choice", "bucket"]), "buckets")

    def pairs(rows: DataFrame, keys: list[str]) -> DataFrame:
        left = rows.select(*keys, F.col("v").alias("a"))
        right = rows.select(*keys, F.col("v").alias("b"))
        return left.join(right, keys).where((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= most)).select("a", "b")

    near = pairs(keyed.where("not big"), ["choice", "bucket"])
    if keyed.where("big").limit(1).count():
        pick = F.element_at(F.array(*finer), F.col("choice") + 1)
        split = keyed.where("big").select("choice", "bucket", "v", F.posexplode(pick).alias("sub", "sub_bucket"))
        near = near.unionByName(pairs(split, ["choice", "bucket", "sub", "sub_bucket"]))
    return near.distinct()
