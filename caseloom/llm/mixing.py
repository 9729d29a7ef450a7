"""Problem 8: a mixture of sources by target shares of the total size."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.operators.ranks import group_rank, unit
from caseloom.session import is_small, materialize

#: Rows of a plan that are broadcast; beyond, they are joined by a shuffle.
MOST_BROADCAST = 100_000

PLAN = (
    "source string, target_share double, max_repeats int, available_tokens long, target_tokens double, planned_tokens double, "
    "scale double, filled boolean, documents long"
)


def clean_source(value: Column) -> Column:
    """A source name in lower case without outer blanks; null if blank."""
    v = F.lower(F.regexp_replace(value, r"(?U)^\s+|\s+$", ""))
    return F.when(v != "", v)


def _scale(parts: list[tuple[int, int]], goal: float, most: int) -> float:
    """c such that the sum over (copies, tokens) of min(most, c / copies) * tokens is ``goal``, or the c that repeats all."""
    parts = sorted(parts)
    most_of_all = float(most * max((m for m, _ in parts), default=1))
    if sum(most * t for _, t in parts) <= goal:
        return most_of_all
    rest = list(accumulate(t / m for m, t in reversed(parts)))[::-1]  # tokens a unit of c from here on
    full = 0
    for (m, t), slope in zip(parts, rest, strict=True):  # those before are repeated most times
        if slope > 0 and (c := (goal - most * full) / slope) <= most * m:
            return max(0.0, c)
        full += t
    return most_of_all


def plan_mixture(docs: DataFrame, targets: DataFrame) -> DataFrame:
    """One row for each source of ``targets``: its size, its target and whether its documents can fill it.

    ``docs`` has (doc_id, source_key, tokens, copies). The target is the share of the summed size of
    all rows of ``docs``, of whatever source. A document is wanted scale / copies times, at most
    max_repeats times, so that texts that stand there several times don't count several times.
    Sources without documents cannot fill a share above 0. Null shares and repeats count as 0.
    """
    spark = docs.sparkSession
    want = targets.where("source is not null").groupBy("source").agg(F.max("target_share").alias("share"), F.max("max_repeats").alias("most"))
    rows = want.withColumn("key", clean_source(F.col("source"))).collect()  # target sources
    sums = docs.groupBy("source_key", "copies").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("n"))
    named = targets.select(clean_source(F.col("source")).alias("source_key"), F.lit(True).alias("named")).distinct()
    named = F.broadcast(named) if len(rows) <= MOST_BROADCAST else named
    sums = sums.join(named, "source_key", "left").withColumn("source_key", F.when(F.col("named"), F.col("source_key"))).withColumn("copies", F.when(F.col("named"), F.col("copies")))
    sums = sums.groupBy("source_key", "copies").agg(F.sum("tokens").alias("tokens"), F.sum("n").alias("n"))
    by: dict = {}
    for r in sums.collect():  # n rows of a source have at most sqrt(2 n) different numbers of copies
        by.setdefault(r["source_key"], []).append((r["copies"], r["tokens"] or 0, r["n"]))
    total = sum(t for parts in by.values() for _, t, _ in parts)
    plan = []
    for r in sorted(rows, key=lambda r: r["source"]):
        parts = by.get(r["key"], []) if r["key"] is not None else []
        have, share, most = sum(t for _, t, _ in parts), r["share"] or 0.0, r["most"] or 0
        goal = share * total
        filled = not most * have < goal
        scale = _scale([(m, t) for m, t, _ in parts], goal, most)
        planned = sum(min(most, scale / m) * t for m, t, _ in parts)
        plan.append((r["source"], float(share), most, have, float(goal), float(planned), float(scale), filled, sum(n for *_, n in parts)))
    return spark.createDataFrame(plan, PLAN)


def mix_documents(docs: DataFrame, plan: DataFrame, seed: int = 5) -> DataFrame:
    """(doc_id, source, tokens, repeats): how often each document of a planned source is used, if at all.

    A document wanted w times gets floor(w) whole copies for certain. For the fraction p that is left
    the documents of a source are ordered by u / (1 - u) divided by p / (1 - p), u uniform by hash of
    the id, and as many of them as their p sum up to, rounded, get one copy more.
    """
    few = is_small(plan, MOST_BROADCAST)
    keyed = plan.withColumn("source_key", clean_source(F.col("source"))).select("source_key", "source", "scale", "max_repeats")
    keyed = F.broadcast(keyed) if few else keyed
    rows = docs.select("doc_id", "source_key", "tokens", "copies").join(keyed, "source_key")
    wish = F.least(F.col("max_repeats").cast("double"), F.col("scale") / F.col("copies"))
    rows = rows.withColumn("wish", wish).withColumn("whole", F.floor(F.col("wish") + 1e-9).cast("long"))
    rows = rows.withColumn("part", F.greatest(F.col("wish") - F.col("whole"), F.lit(0.0)))
    rows = rows.withColumn("part", F.when(F.col("part") > 1e-9, F.col("part")).otherwise(0.0))
    u = unit("doc_id", seed=seed)
    odds = F.try_divide(u / (1 - u), F.try_divide(F.col("part"), 1 - F.col("part")))
    loose = rows.where("part > 0").withColumn("odds", odds).withColumn("order", F.col("odds") / (1 + F.col("odds")))
    draws = rows.groupBy("source_key").agg(F.round(F.sum("part")).cast("long").alias("draws"))
    ranked = group_rank(loose.select("doc_id", "source_key", "order"), ["source_key"], "order", ["doc_id"])
    picked = ranked.join(F.broadcast(draws) if few else draws, "source_key").where("rank < draws").select("doc_id", F.lit(1).alias("extra"))  # draws: a row a source
    out = rows.join(picked, "doc_id", "left").withColumn("repeats", F.col("whole") + F.coalesce("extra", F.lit(0)))
    return out.where("repeats > 0").select("doc_id", "source", "tokens", "repeats")


def mixture_report(plan: DataFrame, mixture: DataFrame) -> DataFrame:
    """The plan with the tokens reached and their share of the whole mixture, for every planned source."""
    got = mixture.groupBy("source").agg(F.sum(F.col("tokens") * F.col("repeats")).alias("actual_tokens"), F.max("repeats").alias("most_used"))
    out = plan.join(got, "source", "left").fillna(0, ["actual_tokens", "most_used"])
    whole = out.agg(F.sum("actual_tokens").alias("whole"))
    out = out.join(F.broadcast(whole), F.lit(True))  # one row
    share = F.when(F.col("whole") > 0, F.col("actual_tokens") / F.col("whole")).otherwise(0.0)
    return out.select("source", "target_share", "max_repeats", "available_tokens", F.round("target_tokens").cast("long").alias("target_tokens"), "actual_tokens", F.round(share, 6).alias("actual_share"), "most_used", "filled")


def sized_documents(documents: DataFrame, size: Column) -> DataFrame:
    """(doc_id, source_key, tokens, copies) of ``documents``; copies counts equal texts of a source.

    A repeated row counts once. Null ids are ignored; null texts have 0 tokens. The sizes are computed
    once and written.
    """
    rows = documents.where("doc_id is not null").select("doc_id", clean_source(F.col("source")).alias("source_key"), size.alias("tokens"), F.xxhash64("text").alias("h"))
    rows = materialize(rows.dropDuplicates(["doc_id"]), "sized")
    copies = rows.groupBy("source_key", "h").agg(F.count("*").alias("copies")).where("copies > 1")
    copies = copies.select(F.col("source_key").alias("s"), F.col("h").alias("t"), "copies")
    back = rows.join(copies, F.col("source_key").eqNullSafe(F.col("s")) & (F.col("h") == F.col("t")), "left")
    return back.select("doc_id", "source_key", "tokens", F.coalesce("copies", F.lit(1)).alias("copies"))
