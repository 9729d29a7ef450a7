"""Duplicate groups: exact keys, near hashes, connected components by alternating stars."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.operators.hamming import hamming_pairs
from caseloom.session import discard, materialize


def key_edges(rows: DataFrame, node: str, keys: list[str]) -> DataFrame:
    """(u, v): each node linked with the smallest node of every non-blank key it has; no pairs are formed."""
    out = None
    for k in keys:
        own = rows.select(F.col(node).alias("v"), F.col(k).cast("string").alias("key")).where("trim(key) <> '' and v is not null")
        first = own.groupBy("key").agg(F.min("v").alias("u"), F.max("v").alias("last")).where("u <> last").drop("last")
        edges = own.join(first, "key").where("u <> v").select("u", "v")
        out = edges if out is None else out.unionByName(edges)
    return out.distinct()


def _star(edges: DataFrame, large: bool) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    if not large:
        both = both.where("v < u")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    linked = both.join(least, "u")
    if large:
        return linked.where("v > u").select(F.col("m").alias("u"), "v").where("u <> v").distinct()
    return linked.select(F.col("m").alias("u"), "v").unionByName(least.select(F.col("m").alias("u"), F.col("u").alias("v"))).where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for the nodes of ``edges`` (u, v); root is the smallest node of the component.

    Large-star and small-star steps alternate until the edges form stars; each round is written to the
    shared folder, so no lineage grows and a lost executor costs one round.
    """
    live = materialize(edges.where("u is not null and v is not null and u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "stars")
    while True:
        new = materialize(_star(_star(live, large=True), large=False).select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "stars")
        same = new.exceptAll(live).limit(1).count() == 0 and live.exceptAll(new).limit(1).count() == 0
        discard(live)
        live = new
        if same:
            break
    return live.select(F.col("v").alias("node"), F.col("u").alias("root")).unionByName(live.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct())


def near_hashes(hashes: DataFrame, key: str, bits: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """(pairs, members): pairs (a, b, distance), a < b, of 64-bit values that differ in 1 to ``most`` bits, each value
    known by its smallest key; members (key, representative) of every row with a value.

    Values are compared, not rows, so a value that a third of the rows share costs as much as any other, and
    rows of equal values are never paired: the membership tells them.
    """
    rows = hashes.select(F.col(key), bits.cast("long").alias("v")).where(F.col("v").isNotNull() & F.col(key).isNotNull()).distinct()
    first = materialize(rows.groupBy("v").agg(F.min(key).alias("r")), "values")
    near = hamming_pairs(first, "v", most)
    near = near.join(first.select(F.col("v").alias("a"), F.col("r").alias("ra")), "a").join(first.select(F.col("v").alias("b"), F.col("r").alias("rb")), "b")
    distance = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))).alias("distance")
    pairs = near.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"), distance)
    return pairs, rows.join(first, "v").select(key, F.col("r").alias("representative"))


def group_report(members: DataFrame, labels: DataFrame, node: str, root: str, label: str) -> DataFrame:
    """(root, size, labels, conflict) per group; conflict if it holds several labels."""
    sizes = members.groupBy(root).agg(F.count_distinct(node).alias("size"))
    named = members.join(labels.select(node, label).where(F.col(label).isNotNull()).distinct(), node).groupBy(root).agg(F.array_sort(F.collect_set(label)).alias("labels"))
    out = sizes.join(named, root, "left").withColumn("labels", F.coalesce("labels", F.array().cast("array<string>")))
    return out.withColumn("conflict", F.size("labels") > 1)


def group_id(members: DataFrame, root: str, node: str) -> DataFrame:
    """(root, group_id): SHA-256 of the sorted members joined by line breaks."""
    return members.groupBy(root).agg(F.sha2(F.array_join(F.array_sort(F.collect_set(node)), "\n"), 256).alias("group_id"))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)
