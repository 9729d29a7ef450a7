"""Groups of records that pairwise matches link directly or through others.

Minimum labels travel along the edges, pointer jumping flattens the resulting trees, and every round
writes its state into the shared folder. After a round the edges are renamed to the labels of their
ends and those inside one label vanish, so later rounds work on a shrinking graph; when none is left
no label can change any more.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.session import discard, materialize


def star_edges(links: DataFrame, key: str, node: str) -> DataFrame:
    """Edges (a, b), a < b, that join all ``node`` of one ``key`` to its smallest node.

    One edge a row instead of one a pair; the minimum is pre-aggregated before the shuffle, and a hot
    key's rows may be split in the join, as they meet a single row. Rows with a null key or node
    relate nothing. ``key`` may be any type, several columns can be packed in a struct.
    """
    rows = links.select(F.col(key).alias("k"), F.col(node).alias("b")).where("k is not null and b is not null")
    first = rows.groupBy("k").agg(F.min("b").alias("a"), F.max("b").alias("z")).where("a < z").select("k", "a")
    return rows.join(first, "k").where("a < b").select("a", "b")


def _jump(parents: DataFrame) -> DataFrame:
    """Pointer jumping until every vertex points to a vertex that has no parent."""
    while True:
        up = parents.select(F.col("v").alias("p"), F.col("p").alias("pp"))
        new = materialize(parents.join(up, "p", "left").select("v", F.coalesce("pp", "p").alias("p"), F.col("pp").isNotNull().alias("moved")), "jump")
        discard(parents)
        if new.where("moved").limit(1).count() == 0:
            out = new.select("v", "p")
            out._caseloom_path = new._caseloom_path
            return out
        path, new = new._caseloom_path, new.select("v", "p")
        new._caseloom_path = path
        parents = new


def _label(rows: DataFrame, column: str, parents: DataFrame) -> DataFrame:
    """``rows`` with ``column`` replaced by its label; a vertex without parent keeps itself."""
    p = parents.select(F.col("v").alias(column), F.col("p").alias("__p"))
    return rows.join(p, column, "left").withColumn(column, F.coalesce("__p", column)).drop("__p")


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of ``edges``; component is the smallest node linked to it.

    Edges may repeat, run in both directions or be loops; edges with a null end are ignored. An
    empty table gives an empty result. Nodes need an ordered type; strings compare by code point.
    """
    x, y = F.col(a), F.col(b)
    nodes_type = edges.schema[a].dataType
    live = edges.where(x.isNotNull() & y.isNotNull()).select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))
    live = materialize(live.distinct(), "edges")
    loops = live.where("a = b").select(F.col("a").alias("node"))
    first, live = live, live.where("a < b")
    levels: list[DataFrame] = []
    previous = None
    while live.limit(1).count():
        parents = _jump(materialize(live.groupBy(F.col("b").alias("v")).agg(F.min("a").alias("p")), "parents"))
        levels.append(parents)
        renamed = _label(_label(live, "a", parents), "b", parents).where("a <> b")
        new = materialize(renamed.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
        if previous is not None:
            discard(previous)
        previous = live = new
    if not levels:
        return loops.distinct().select("node", F.col("node").cast(nodes_type).alias("component"))
    labels = levels.pop()
    while levels:
        finer = levels.pop()
        # Vertices that vanished in the finer round, renamed by the later one, and the later one's own.
        labels = materialize(_label(finer, "p", labels).unionByName(labels), "labels")
    members = labels.select(F.col("v").alias("node"), F.col("p").alias("component"))
    roots = members.select(F.col("component").alias("node"), "component").distinct()
    lone = loops.join(members.unionByName(roots).select("node"), "node", "left_anti").distinct()
    return members.unionByName(roots).unionByName(lone.select("node", F.col("node").alias("component")))
