"""Grouped stratified splits and folds, and the checks on them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.functions.text import hash_fraction
from caseloom.operators.ranks import group_rank
from caseloom.session import is_small, materialize

#: Rows of a plan that are broadcast; beyond, they are joined by a shuffle.
MOST_BROADCAST = 100_000


class _Balance:
    """Counts per label held against targets; the cost of a step is the change of the squared misses over the targets."""

    def __init__(self, goal: dict) -> None:
        self.goal, self.held = goal, dict.fromkeys(goal, 0)

    def cost(self, profile: dict, times: int = 1) -> float:
        return sum(((self.held[c] + times * n - self.goal[c]) ** 2 - (self.held[c] - self.goal[c]) ** 2) / max(self.goal[c], 1) for c, n in profile.items())

    def add(self, profile: dict, times: int = 1) -> None:
        for c, n in profile.items():
            self.held[c] += times * n


def plan_groups(kinds: list[tuple[dict, int]], test_share: float, folds: int) -> list[tuple[int, list[int]]]:
    """For each kind (label profile, number of groups) how many groups go to the test part and to each fold.

    Groups of one profile are alike, so the plan is made over kinds: those with the label that fewest groups
    have come first. A kind gives the test part as many groups as lower its cost, which is convex in their
    number, while each of its labels keeps ``folds`` groups. The others are dealt evenly to the folds, the
    remainder to those where it costs least.
    """
    whole: dict = {}
    holders: dict = {}
    for profile, m in kinds:
        for c, n in profile.items():
            whole[c] = whole.get(c, 0) + n * m
            holders[c] = holders.get(c, 0) + m
    order = sorted(range(len(kinds)), key=lambda i: (min(holders[c] for c in kinds[i][0]), sorted(kinds[i][0].items())))
    test, out = _Balance({c: n * test_share for c, n in whole.items()}), [(0, [0] * folds) for _ in kinds]
    for i in order:
        profile, m = kinds[i]
        most = max(0, min(m, min(holders[c] - folds for c in profile)))
        square = sum(n * n / max(test.goal[c], 1) for c, n in profile.items())
        line = sum(2 * n * (test.held[c] - test.goal[c]) / max(test.goal[c], 1) for c, n in profile.items())
        best = max(0, min(most, int(-line / (2 * square) + 0.5)))
        test.add(profile, best)
        for c in profile:
            holders[c] -= best
        out[i] = (best, out[i][1])
    parts = [_Balance({c: (whole[c] - test.held[c]) / folds for c in whole}) for _ in range(folds)]
    sizes = [0] * folds
    for i in order:
        profile, m = kinds[i]
        given = [(m - out[i][0]) // folds] * folds
        for f in range(folds):
            parts[f].add(profile, given[f])
            sizes[f] += given[f] * sum(profile.values())
        for _ in range((m - out[i][0]) % folds):
            f = min(range(folds), key=lambda f: (parts[f].cost(profile), sizes[f], f))
            parts[f].add(profile)
            given[f] += 1
            sizes[f] += sum(profile.values())
        out[i] = (out[i][0], given)
    return out


def greedy_split(rows: DataFrame, group: str, label: str, test_share: float = 0.2, folds: int = 5, seed: int = 42) -> DataFrame:
    """(group, partition, fold): groups kept whole, labels spread evenly; see :func:`plan_groups`.

    Groups are reduced to kinds, groups of one label profile, before anything reaches the driver; how many
    there are depends on the labels, not on the groups. The groups of a kind take the planned places by the
    rank of their hash, so the result does not depend on how rows are stored. A label with fewer than
    ``folds`` + 1 groups, and a test part without a group, are errors. Null groups and labels are left out.
    """
    spark = rows.sparkSession
    counted = rows.where(F.col(group).isNotNull() & F.col(label).isNotNull()).groupBy(group, F.col(label).alias("label")).agg(F.count("*").alias("n"))
    own = counted.groupBy(group).agg(F.array_sort(F.collect_list(F.struct("label", "n"))).alias("profile"))  # labels of one group
    own = materialize(own.withColumn("kind", F.xxhash64("profile")), "profiles")
    kinds = own.groupBy("kind").agg(F.first("profile").alias("profile"), F.count("*").alias("m")).collect()
    if not kinds:
        return own.select(group, F.lit("development").alias("partition"), F.lit(0).alias("fold"))
    holders: dict = {}
    for k in kinds:
        for x in k["profile"]:
            holders[x["label"]] = holders.get(x["label"], 0) + k["m"]
    if few := sorted(c for c, n in holders.items() if n < folds + 1):
        raise ValueError(f"labels with fewer than {folds + 1} groups: {few[:5]}")
    plan = plan_groups([({x["label"]: x["n"] for x in k["profile"]}, k["m"]) for k in kinds], test_share, folds)
    if not any(test for test, _ in plan):
        raise ValueError("no group fits the test part")
    places = []
    for k, (test, given) in zip(kinds, plan, strict=True):
        at = 0
        for part, fold, n in (("test", None, test), *(("development", f, n) for f, n in enumerate(given))):
            if n:
                places.append((k["kind"], at, at + n, part, fold))
            at += n
    plan_df = spark.createDataFrame(places, "kind long, first long, upto long, partition string, fold int")
    sha = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(group).cast("string")), 256)
    ranked = group_rank(own.select(group, "kind", sha.alias("__sha"), hash_fraction(F.concat(F.lit(f"{seed}:"), F.col(group).cast("string"))).alias("__u")), ["kind"], "__u", ["__sha", group])
    placed = ranked.join(F.broadcast(plan_df) if is_small(plan_df, MOST_BROADCAST) else plan_df, "kind").where("rank >= first and rank < upto")
    return placed.select(group, "partition", "fold")


def split_problems(split: DataFrame, rows: DataFrame, group: str, label: str, folds: int) -> DataFrame:
    """(label, problem) of a split (group, partition, fold): labels missing in a part or in a fold; empty if all hold."""
    j = rows.select(group, label).where(F.col(label).isNotNull()).distinct().join(split, group)
    per = j.groupBy(label).agg(F.bool_or(F.col("partition") == "test").alias("t"), F.bool_or(F.col("partition") != "test").alias("d"), F.count_distinct("fold").alias("f"))
    problem = F.when(~F.col("t"), "NOT_IN_TEST").when(~F.col("d"), "NOT_IN_DEVELOPMENT").when(F.col("f") < folds, "NOT_IN_EVERY_FOLD")
    return per.select(label, problem.alias("problem")).where("problem is not null")


def hash_split(groups: DataFrame, group: str, shares: dict[str, float], seed: int = 42) -> DataFrame:
    """(group, partition) by where the hash of the group falls among the cumulated ``shares``; no shuffle but the distinct."""
    u = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col(group).cast("string")), 256), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
    total, at = sum(shares.values()), 0.0
    part = F.lit(list(shares)[-1])
    steps = []
    for name, share in shares.items():
        at += share / total
        steps.append((at, name))
    for upto, name in reversed(steps[:-1]):
        part = F.when(u < upto, name).otherwise(part)
    return groups.select(group).where(F.col(group).isNotNull()).distinct().select(group, part.alias("partition"))


def hash_folds(groups: DataFrame, group: str, label: str, folds: int, seed: int = 42) -> DataFrame:
    """(group, label, fold): within each label groups are dealt to the folds in hash order.

    Ranks come from counts per bin of the hash, so a label that most groups have is no single task.
    """
    salted = F.concat(F.lit(f"{seed}:"), F.col(group).cast("string"))
    rows = groups.select(group, label).distinct().withColumn("__u", hash_fraction(salted)).withColumn("__sha", F.sha2(salted, 256))
    ranked = group_rank(rows, [label], "__u", ["__sha", group])
    return ranked.select(group, label, (F.col("rank") % folds).cast("int").alias("fold"))


def overlaps(rows: DataFrame, fields: list[str], by: str) -> DataFrame:
    """(field, n): for each of ``fields`` how many of its values stand in several values of ``by``.

    All fields are checked in one pass over their distinct values.
    """
    pairs = F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields)))
    long = rows.where(F.col(by).isNotNull()).select(F.col(by).cast("string").alias("by"), pairs.alias("x")).where("x.value is not null")
    torn = long.groupBy("x.field", "x.value").agg(F.min("by").alias("lo"), F.max("by").alias("hi")).where("lo < hi")
    every = rows.sparkSession.createDataFrame([(f,) for f in fields], "field string")
    return every.join(torn.groupBy("field").agg(F.count("*").alias("n")), "field", "left").select("field", F.coalesce("n", F.lit(0)).alias("n"))


def uncovered(rows: DataFrame, label: str, by: str) -> DataFrame:
    """(label, by) combinations that have no row though both values occur."""
    labels, parts = rows.select(label).where(F.col(label).isNotNull()).distinct(), rows.select(by).where(F.col(by).isNotNull()).distinct()
    there = rows.select(label, by).distinct()
    sizes = parts.agg(F.array_sort(F.collect_set(by)).alias("all"))  # partitions or folds: a handful
    return labels.join(F.broadcast(sizes), F.lit(True)).select(label, F.explode("all").alias(by)).join(there, [label, by], "left_anti")
