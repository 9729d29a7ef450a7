"""Problem 1: one group identifier for all cases that pairwise matches link."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.llm.components import connected_components, star_edges
from caseloom.operators.hamming import hamming_pairs
from caseloom.session import materialize


def clean_key(value: Column) -> Column:
    """A match key in lower case without outer blanks; null if blank or all zero."""
    v = F.lower(F.regexp_replace(value, r"(?U)^\s+|\s+$", ""))
    return F.when(v.rlike("[^0]"), v)


def hash_bits(value: Column) -> Column:
    """A hexadecimal hash, as spelled by different tools, as a signed 64-bit number; null if it is none or zero."""
    h = F.regexp_replace(clean_key(value), "^0x", "")
    h = F.when(h.rlike("^[0-9a-f]{1,16}$") & h.rlike("[^0]"), F.lpad(h, 16, "0"))
    half = lambda at: F.conv(F.substring(h, at, 8), 16, 10).cast("long")
    return F.shiftleft(half(1), 32).bitwiseOR(half(9))


def match_edges(images: DataFrame, groups: DataFrame, most_bits: int = 4) -> DataFrame:
    """Edges between case ids: equal image hashes, perceptual hashes within ``most_bits``, equal split groups.

    Nulls, blanks and all-zero keys match nothing; repeated rows add nothing; other columns are not read.
    """
    rows = images.select("case_id", clean_key(F.col("image_sha256")).alias("sha"), hash_bits(F.col("perceptual_hash")).alias("bits"))
    group = groups.select("case_id", F.when(F.trim("split_group").rlike("[^0]"), F.col("split_group")).alias("grp"))
    links = (
        rows.select("case_id", F.struct(F.lit("i").alias("kind"), F.col("sha").alias("key")).alias("k")).where("k.key is not null")
        .unionByName(group.select("case_id", F.struct(F.lit("g").alias("kind"), F.col("grp").alias("key")).alias("k")).where("k.key is not null"))
        .unionByName(rows.select("case_id", F.struct(F.lit("p").alias("kind"), F.col("bits").cast("string").alias("key")).alias("k")).where("k.key is not null"))
    )
    exact = star_edges(links, "k", "case_id")
    first = materialize(rows.where("bits is not null and case_id is not null").groupBy("bits").agg(F.min("case_id").alias("c")), "firsts")
    near = (
        hamming_pairs(first, "bits", most_bits)
        .join(first.select(F.col("bits").alias("a"), F.col("c").alias("ca")), "a")
        .join(first.select(F.col("bits").alias("b"), F.col("c").alias("cb")), "b")
        .select(F.col("ca").alias("a"), F.col("cb").alias("b"))
    )
    return exact.unionByName(near)


def consolidate_matches(images: DataFrame, groups: DataFrame, most_bits: int = 4) -> DataFrame:
    """(case_id, group_case_id) for every case of both tables; a case that matches none is its own group."""
    found = connected_components(match_edges(images, groups, most_bits))
    found = found.select(F.col("node").alias("case_id"), F.col("component").alias("group_case_id"))
    every = images.select("case_id").unionByName(groups.select("case_id")).where("case_id is not null").distinct()
    return every.join(found, "case_id", "left").select("case_id", F.coalesce("group_case_id", "case_id").alias("group_case_id"))
