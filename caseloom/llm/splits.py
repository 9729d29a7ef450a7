"""Problem 6: splits that keep related records together."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.llm.components import connected_components, star_edges
from caseloom.llm.flow import Network
from caseloom.llm.sampling import clean_label
from caseloom.operators.ranks import group_rank, unit
from caseloom.session import is_small, materialize

#: Spellings that name no patient, in lower case. Values without a letter or digit name none either.
PLACEHOLDERS = ["unknown", "none", "n/a", "na", "n.a.", "nil", "null", "nan", "unk", "missing", "not available", "not applicable", "not known", "not recorded", "undefined", "tbd"]
#: Bundles that one network holds; the next ones are solved against what these left of the quotas.
BLOCK = 20_000
#: Rows of a plan that are broadcast; beyond, they are joined by a shuffle.
MOST_BROADCAST = 100_000


def clean_link(value: Column) -> Column:
    """A patient link in lower case without outer blanks; null if it is blank or a placeholder."""
    v = F.lower(F.regexp_replace(value, r"(?U)^\s+|\s+$", ""))
    return F.when(v.rlike(r"[\p{L}\p{N}]") & ~v.isin(PLACEHOLDERS), v)


def clean_partition(value: Column) -> Column:
    """A partition name in lower case without outer blanks, hyphens as underscores; null if blank."""
    v = F.translate(F.lower(F.regexp_replace(value, r"(?U)^\s+|\s+$", "")), "-", "_")
    return F.when(v != "", v)


def related_cases(cases: DataFrame, groups: DataFrame) -> DataFrame:
    """(case_id, component) for every case of ``cases``; cases related to none are their own component.

    Cases are related by article, by cleaned patient link or by a non-null split group, and chains
    count. Null keys relate nothing; repeated rows add nothing; other columns are not read.
    """
    key = lambda kind, value: F.struct(F.lit(kind).alias("kind"), value.alias("key"))
    own = cases.select("case_id", "article_id", clean_link(F.col("patient_link_id")).alias("link")).where("case_id is not null")
    grp = groups.select("case_id", F.col("split_group").alias("g")).where("g is not null").join(own.select("case_id").distinct(), "case_id", "left_semi")
    links = (
        own.where("article_id is not null").select("case_id", key("a", F.col("article_id")).alias("k"))
        .unionByName(own.where("link is not null").select("case_id", key("p", F.col("link")).alias("k")))
        .unionByName(grp.select("case_id", key("g", F.col("g")).alias("k")))
    )
    found = connected_components(star_edges(links, "k", "case_id"))
    every = own.select("case_id").distinct()
    return every.join(found.withColumnRenamed("node", "case_id"), "case_id", "left").select("case_id", F.coalesce("component", "case_id").alias("component"))


def torn_cases(related: DataFrame, assignments: DataFrame) -> DataFrame:
    """(case_id, component) of assigned cases whose component stands in more than one partition."""
    rows = assignments.select("case_id", clean_partition(F.col("partition")).alias("part")).where("case_id is not null").distinct()
    rows = rows.join(related, "case_id")
    torn = rows.groupBy("component").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).where("lo < hi").select("component")
    return rows.join(torn, "component", "left_semi").select("case_id", "component").distinct()


class SplitPlan:
    """Integer numbers of components for each bundle and split, planned block by block.

    ``whole`` is the number of records, ``labels`` that of each label. A bundle is all components of one
    size and one label profile (records of each label, 0 for records without). Flow units are records:
    a bundle sends its records to the splits, past the quota of its commonest label in the split, which
    costs nothing up to the quota and a unit beyond, and past the split's quota, where deviations cost
    more the larger they are. Bundles come by falling size. Each block of about equal sizes gets, of what is
    left of every quota, the share of its records among those left, so that no block takes the room of the
    others; after it the quotas are reduced by what was given, with all labels of the profile. What rounding
    to whole components takes from a split is given back with the block's next bundle.
    """

    def __init__(self, shares: dict[str, float], whole: int, labels: dict) -> None:
        self.names, self.left, self.left_of = sorted(shares), whole, dict(labels)
        total = sum(shares.values()) or 1
        self.share = {s: shares[s] / total for s in self.names}
        self.quota = {s: self.share[s] * whole for s in self.names}
        self.label_quota = {(p, s): n * self.share[s] for p, n in labels.items() for s in self.names}

    def block(self, bundles: list[dict]) -> list[list[int]]:
        """For each of ``bundles`` (size, profile, components) how many components each of ``names`` gets."""
        net, arcs, names = Network(), {}, self.names
        records = [b["size"] * b["components"] for b in bundles]
        lead = [max(b["profile"], key=lambda p, b=b: (b["profile"][p], p), default=None) for b in bundles]
        mass, mass_of = sum(records), {}
        for r, p in zip(records, lead, strict=True):
            mass_of[p] = mass_of.get(p, 0) + r
        for i, r in enumerate(records):
            net.arc("source", ("bundle", i), r)
            for s in names:
                arcs[i, s] = net.arc(("bundle", i), ("label", lead[i], s), r)
        for p in sorted(mass_of, key=str):
            part = min(1.0, mass_of[p] / max(1, self.left_of.get(p, 0)))
            for s in names:
                net.arc(("label", p, s), ("split", s), max(0, round(self.label_quota.get((p, s), 0) * part)), 0)
                net.arc(("label", p, s), ("split", s), mass, 1)
        part = mass / max(1, self.left)
        for s in names:
            room = max(0, round(self.quota[s] * part))
            net.arc(("split", s), "sink", room, 0)
            net.arc(("split", s), "sink", room // 50 + 1, 20)
            net.arc(("split", s), "sink", mass, 200)
        net.solve("source", "sink")
        owed, out = dict.fromkeys(names, 0.0), []
        for i, b in enumerate(bundles):
            size = b["size"]
            flow = {s: net.flow(arcs[i, s]) / size for s in names}
            given = {s: math.floor(flow[s] + 1e-9) for s in names}
            for s in names:
                owed[s] += (flow[s] - given[s]) * size
            for _ in range(b["components"] - sum(given.values())):
                s = max(names, key=lambda s: (owed[s], s))
                given[s] += 1
                owed[s] -= size
            for s in names:
                self.quota[s] -= given[s] * size
                for p, n in b["profile"].items():
                    if (p, s) in self.label_quota:
                        self.label_quota[p, s] -= given[s] * n
            for p, n in b["profile"].items():
                self.left_of[p] = self.left_of.get(p, 0) - n * b["components"]
            self.left -= records[i]
            out.append([given[s] for s in names])
        return out


def plan_blocks(bundles: Iterable[dict], most: int = BLOCK) -> Iterator[list[dict]]:
    """``bundles`` by falling size in blocks of sizes within a factor of two and of at most ``most`` bundles."""
    block: list[dict] = []
    for b in bundles:
        if block and (len(block) >= most or 2 * b["size"] <= block[0]["size"]):
            yield block
            block = []
        block.append(b)
    if block:
        yield block


def assign_splits(related: DataFrame, labels: DataFrame, targets: DataFrame, seed: int = 11) -> DataFrame:
    """(case_id, component, split) for every row of ``related``; all cases of a component get one split.

    ``labels`` has (case_id, label), ``targets`` (split_name, target_share), one row a split. Components of
    identical size and label profile form a bundle; the planned numbers of each bundle are dealt to its
    components in hash order. The driver holds the targets, the totals of the labels and one block of
    bundles at a time. Without targets no row comes out.
    """
    spark = related.sparkSession
    shares = {r[0]: float(r[1]) for r in targets.where("split_name is not null and target_share > 0").groupBy("split_name").agg(F.max("target_share")).collect()}
    labelled = labels.where("label is not null").groupBy("case_id").agg(F.min("label").alias("label"))
    counted = related.join(labelled, "case_id", "left").groupBy("component", "label").agg(F.count("*").alias("n"))
    profile = F.array_sort(F.collect_list(F.when(F.col("label").isNotNull(), F.struct("label", "n"))))
    parts = counted.groupBy("component").agg(F.sum("n").alias("size"), profile.alias("profile"))
    parts = materialize(parts.withColumn("bundle", F.xxhash64("size", "profile")), "bundles")
    sums = materialize(parts.groupBy("bundle").agg(F.first("size").alias("size"), F.first("profile").alias("profile"), F.count("*").alias("components")), "sums")
    whole = sums.agg(F.sum(F.col("size") * F.col("components"))).first()[0]
    if not whole or not shares:
        return related.select("case_id", "component", F.lit(None).cast("string").alias("split")).limit(0)
    each = sums.select("components", F.inline("profile")).groupBy("label").agg(F.sum(F.col("n") * F.col("components")).alias("n"))
    plan = SplitPlan(shares, whole, {r["label"]: r["n"] for r in each.collect()})
    kind = "bundle long, " + ", ".join(f"n{i} long" for i in range(len(plan.names)))
    ordered = sums.orderBy(F.desc("size"), "profile", "bundle").toLocalIterator(prefetchPartitions=True)
    rows = ({"bundle": r["bundle"], "size": r["size"], "components": r["components"], "profile": {x["label"]: x["n"] for x in r["profile"]}} for r in ordered)
    done, waiting = [], []
    for block in plan_blocks(rows):
        waiting += [(b["bundle"], *n) for b, n in zip(block, plan.block(block), strict=True)]
        if len(waiting) >= BLOCK:
            done.append(materialize(spark.createDataFrame(waiting, kind), "plan"))
            waiting = []
    plan_df = spark.createDataFrame(waiting, kind)
    for other in done:
        plan_df = plan_df.unionByName(other)
    ranked = group_rank(parts.select("component", "bundle", unit("component", seed=seed).alias("u")), ["bundle"], "u", ["component"])
    ranked = ranked.join(F.broadcast(plan_df) if not done or is_small(plan_df, MOST_BROADCAST) else plan_df, "bundle")
    split, upto, cases = F.lit(None).cast("string"), F.lit(0), []
    for i, s in enumerate(plan.names):
        upto = upto + F.col(f"n{i}")
        cases.append((F.col("rank") < upto, F.lit(s)))
    for test, s in reversed(cases):
        split = F.when(test, s).otherwise(split)
    return related.join(ranked.select("component", split.alias("split")), "component").select("case_id", "component", "split")


def case_labels(assignments: DataFrame) -> DataFrame:
    """(case_id, label): the smallest cleaned label of each case."""
    rows = assignments.select("case_id", clean_label(F.col("diagnosis_label")).alias("label")).where("label is not null")
    return rows.groupBy("case_id").agg(F.min("label").alias("label"))
