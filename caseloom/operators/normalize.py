"""Nested and untidy source records as flat tables, with keys checked and rejects kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def field(df: DataFrame, *paths: str) -> Column:
    """The first non-null of several nested ``paths``; those the schema lacks are skipped."""
    from pyspark.errors import AnalysisException

    found = []
    for p in paths:
        try:
            df.select(p)
        except AnalysisException:
            continue
        found.append(F.col(p))
    return F.coalesce(*found) if found else F.lit(None)


def flatten_records(df: DataFrame, array: str, keep: list[str] | None = None) -> DataFrame:
    """One row per element of ``array``, its fields beside the parent's ``keep`` columns.

    The column may be an array of structs, a struct, or absent, in which case the row itself is the record.
    A record's own field wins over the parent's of the same name; parents without elements vanish.
    """
    kind = dict(df.dtypes).get(array)
    if kind is None:
        return df
    if kind.startswith("array"):
        df = df.withColumn("__r", F.explode(array))
    else:
        df = df.withColumnRenamed(array, "__r").where("__r is not null")
    own = df.select("__r.*").columns
    parents = [c for c in (keep or [c for c in df.columns if c not in (array, "__r")]) if c not in own]
    mixed = [F.coalesce(F.col(f"__r.{c}"), F.col(c)).alias(c) if c in (keep or []) and c in df.columns else F.col(f"__r.{c}").alias(c) for c in own]
    return df.select(*parents, *mixed)


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """(keys, n) of keys that are null or stand in several rows; empty if the key holds."""
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where((F.col("n") > 1) | missing)


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Rows of ``child`` whose ``key`` is null or not in ``parent``."""
    return child.join(parent.select(key).distinct(), key, "left_anti")


def require_empty(df: DataFrame, what: str) -> None:
    """Raise if ``df`` has a row."""
    rows = df.limit(3).collect()
    if rows:
        raise ValueError(f"{what}: {rows}")


def relation_pairs(df: DataFrame, key: str, member: str) -> DataFrame:
    """(key, member, n): the distinct members of each key, a row each, and how many the key has.

    A key's members are never gathered in one row; the counts are aggregates joined back.
    """
    pairs = df.select(key, member).where(F.col(key).isNotNull() & F.col(member).isNotNull()).distinct()
    return pairs.join(pairs.groupBy(key).agg(F.count("*").alias("n")), key)


def split_accepted(rows: DataFrame, known: DataFrame, pairs: DataFrame, key: str, pair: list[str]) -> DataFrame:
    """``rows`` with reject_reason: ORPHAN if ``key`` is unknown, UNVERIFIED if the pair is, else null.

    One pass: both lookups are joins with distinct keys, so accepted and rejected rows come of one scan.
    """
    k = known.select(key, F.lit(True).alias("__k")).distinct()
    p = pairs.select(*pair, F.lit(True).alias("__p")).distinct()
    out = rows.join(k, key, "left").join(p, pair, "left")
    return out.withColumn("reject_reason", F.when(F.col("__k").isNull(), "ORPHAN").when(F.col("__p").isNull(), "UNVERIFIED")).drop("__k", "__p")


def image_path(file: Column, root: str = "images") -> Column:
    """Folders by the first characters of the file name, as large collections are stored."""
    return F.concat(F.lit(root + "/"), F.substring(file, 1, 4), F.lit("/"), F.substring(file, 1, 5), F.lit("/"), file)
