"""Ontology text, closure of its hierarchy, scope and most specific concepts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.session import materialize

MOST_LEVELS = 64


def read_obo(spark: SparkSession, path: str, least_alias: int = 1, extra: DataFrame | None = None) -> DataFrame:
    """(concept_id, disease, aliases, parents) of the terms of an OBO file that are not obsolete.

    The file is split at its term blocks by the reader, so it needs not fit in one task. Aliases are the
    name, the exact synonyms and those of ``extra`` (concept_id, alias) of ``least_alias`` characters or
    more, sorted and distinct.
    """
    blocks = spark.read.option("lineSep", "[Term]\n").text(path).select(F.split("value", r"\[Typedef\]").getItem(0).alias("b"))
    one = lambda tag: F.regexp_extract("b", rf"(?m)^{tag}: (.+)$", 1)
    terms = blocks.select(
        F.regexp_extract("b", r"(?m)^id: (\w+:\d+)", 1).alias("concept_id"),
        F.trim(one("name")).alias("disease"),
        F.regexp_extract_all("b", F.lit(r'(?m)^synonym: "([^"\n]+)" EXACT'), F.lit(1)).alias("synonyms"),
        F.regexp_extract_all("b", F.lit(r"(?m)^is_a: (\w+:\d+)"), F.lit(1)).alias("parents"),
        F.col("b").rlike(r"(?m)^is_obsolete: true").alias("gone"),
    ).where("concept_id <> '' and disease <> '' and not gone")
    more = F.array().cast("array<string>")
    if extra is not None:
        terms = terms.join(extra.groupBy("concept_id").agg(F.collect_set("alias").alias("more")), "concept_id", "left")
        more = F.coalesce("more", more)
    every = F.filter(F.concat(F.array("disease"), F.col("synonyms"), more), lambda a: F.length(a) >= least_alias)
    return terms.select("concept_id", "disease", F.array_sort(F.array_distinct(every)).alias("aliases"), "parents")


def ancestors(edges: DataFrame, child: str, parent: str) -> DataFrame:
    """(node, ancestor) for all pairs linked by one or more steps from ``child`` to ``parent``.

    Paths double in length each round, so a hierarchy of depth d takes log2(d) rounds. A cycle, or more
    than MOST_LEVELS doublings, is an error.
    """
    pairs = materialize(edges.where(F.col(child).isNotNull() & F.col(parent).isNotNull()).select(F.col(child).alias("node"), F.col(parent).alias("ancestor")).distinct(), "closure")
    size = pairs.count()
    for _ in range(MOST_LEVELS):
        step = pairs.select(F.col("node").alias("ancestor"), F.col("ancestor").alias("up"))
        pairs = materialize(pairs.unionByName(pairs.join(step, "ancestor").select("node", F.col("up").alias("ancestor"))).distinct(), "closure")
        if pairs.where("node = ancestor").limit(1).count():
            raise ValueError("cycle in the hierarchy")
        new = pairs.count()
        if new == size:
            return pairs
        size = new
    raise ValueError("hierarchy too deep")


def in_scope(concept: Column, ancestor_ids: Column, roots: list[str], excluded: list[str]) -> Column:
    """Whether the concept or an ancestor is a root and the concept itself is not excluded."""
    every = F.concat(F.coalesce(ancestor_ids, F.array().cast("array<string>")), F.array(concept))
    return F.arrays_overlap(every, F.array(*map(F.lit, roots))) & ~concept.isin(excluded)


def most_specific(members: DataFrame, closure: DataFrame, group: str, concept: str) -> DataFrame:
    """(group, concept) of ``members`` without the concepts that are ancestors of another one of the group."""
    own = members.select(group, concept).distinct()
    above = own.join(closure.select(F.col("node").alias(concept), "ancestor"), concept).select(group, F.col("ancestor").alias(concept)).distinct()
    return own.join(above, [group, concept], "left_anti")
