"""The pN_ queries over the project's tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable
from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.llm import consensus, keywords, lookalike, matching, mixing, neardup, packing, sampling, splits
from caseloom.llm.sizes import word_count
from caseloom.session import table


def _groups(spark: SparkSession, d: str) -> DataFrame:
    return matching.consolidate_matches(table(spark, d, "selected_images"), table(spark, d, "groups"))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return _groups(spark, d).where("case_id <> group_case_id").select("group_case_id", "case_id")


def p1_groups(spark: SparkSession, d: str) -> DataFrame:
    return _groups(spark, d)


def _consensus(spark: SparkSession, d: str) -> consensus.Consensus:
    reviews = consensus.all_reviews(*(table(spark, d, t) for t in ("reviewer_a", "reviewer_b", "medgemma_labels", "human_label_adjudications")))
    return consensus.Consensus(consensus.latest_votes(reviews, table(spark, d, "cases")))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return consensus.contested(_consensus(spark, d).decisions())


def p2_agreement(spark: SparkSession, d: str) -> DataFrame:
    """Votes and agreement of every case; contested tells the cases of p2_found."""
    out = _consensus(spark, d).decisions()
    return out.select("case_id", "votes", "agreement", (F.coalesce(F.col("agreement") < 1, F.lit(False)) & (F.col("votes") >= 3)).alias("contested"))


def p2_consensus(spark: SparkSession, d: str) -> DataFrame:
    return _consensus(spark, d).decisions()


def p2_reliability(spark: SparkSession, d: str) -> DataFrame:
    return _consensus(spark, d).annotator_reliability()


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return lookalike.lookalike_quotes(table(spark, d, "medgemma_labels"), table(spark, d, "cases"))


def p3_canonical(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "cases").select("case_id", F.col("raw_case_text").alias("text")).withColumn("key", F.xxhash64("case_id", "text"))
    return lookalike.canonical_text(rows.dropDuplicates(["key"]), ["text"], "key").select("case_id", "text")


def _near(spark: SparkSession, d: str) -> neardup.NearDuplicates:
    rows = neardup.case_texts(table(spark, d, "cases"), table(spark, d, "text_qc"))
    return neardup.NearDuplicates(rows, width=3, similarity=Fraction(3, 5))  # as TESTDATA.md states the problem


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return _near(spark, d).document_pairs().select(F.col("a").alias("case_id_a"), F.col("b").alias("case_id_b"))


def p4_classes(spark: SparkSession, d: str) -> DataFrame:
    return _near(spark, d).classes().withColumnRenamed("doc_id", "case_id")


def p4_groups(spark: SparkSession, d: str) -> DataFrame:
    """The group of near-duplicates of each text."""
    return _near(spark, d).groups().withColumnRenamed("doc_id", "case_id")


def _samples(spark: SparkSession, d: str) -> DataFrame:
    return sampling.labelled_samples(table(spark, d, "manifest"), table(spark, d, "assignments"))


def _spelled(quotas: DataFrame, targets: DataFrame) -> DataFrame:
    names = targets.select("diagnosis_label", "fold", sampling.clean_label(F.col("diagnosis_label")).alias("label")).distinct()
    return quotas.join(names, ["label", "fold"])


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    targets = table(spark, d, "sample_targets")
    return _spelled(sampling.sample_quotas(_samples(spark, d), targets).where("shortfall > 0"), targets).select("diagnosis_label", "fold")


def p5_quotas(spark: SparkSession, d: str) -> DataFrame:
    targets = table(spark, d, "sample_targets")
    return _spelled(sampling.sample_quotas(_samples(spark, d), targets), targets).select("diagnosis_label", "fold", "available", "wanted", "quota", "shortfall")


def p5_shortfalls(spark: SparkSession, d: str) -> DataFrame:
    """Of each target cell the rows there, the rows wanted at least and those missing; quotas between them hold their floors."""
    q = p5_quotas(spark, d)
    kept = (F.col("quota") >= F.least("wanted", "available")) & (F.col("quota") <= F.col("available"))
    return q.select("diagnosis_label", "fold", "available", "wanted", "shortfall", kept.alias("floor_kept"))


def p5_sample(spark: SparkSession, d: str) -> DataFrame:
    samples = _samples(spark, d)
    return sampling.draw_sample(samples, sampling.sample_quotas(samples, table(spark, d, "sample_targets")))


def _related(spark: SparkSession, d: str) -> DataFrame:
    return splits.related_cases(table(spark, d, "cases"), table(spark, d, "groups"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return splits.torn_cases(_related(spark, d), table(spark, d, "assignments")).select("case_id")


def p6_splits(spark: SparkSession, d: str) -> DataFrame:
    return splits.assign_splits(_related(spark, d), splits.case_labels(table(spark, d, "assignments")), table(spark, d, "split_targets"))


def p6_check(spark: SparkSession, d: str) -> DataFrame:
    """Of each split its target, whether its share of the cases is within a hundredth of it, and components that are torn."""
    out = p6_splits(spark, d)
    torn = out.groupBy("component").agg(F.count_distinct("split").alias("n")).where("n > 1").agg(F.count("*").alias("torn"))
    whole = out.agg(F.count("*").alias("cases"), F.count_distinct("case_id").alias("distinct_cases"))
    got = out.groupBy(F.col("split").alias("split_name")).agg(F.count("*").alias("n"))
    rows = table(spark, d, "split_targets").select("split_name", "target_share").join(got, "split_name", "left").crossJoin(whole).crossJoin(torn)  # one row each
    near = F.abs(F.coalesce("n", F.lit(0)) / F.col("cases") - F.col("target_share")) <= 0.01
    return rows.select("split_name", "cases", "distinct_cases", near.alias("near_target"), "torn")


def _packed(spark: SparkSession, d: str) -> DataFrame:
    capacity = table(spark, d, "pack_limits").agg(F.max("capacity_tokens")).first()[0]
    return packing.pack_documents(table(spark, d, "documents").select("doc_id", word_count(F.col("text")).alias("tokens")), int(capacity))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return _packed(spark, d).where("pieces > 1").select("doc_id").distinct()


def p7_packed(spark: SparkSession, d: str) -> DataFrame:
    return _packed(spark, d)


def p7_check(spark: SparkSession, d: str) -> DataFrame:
    """One row: documents, their tokens, documents in pieces, containers over the capacity, and short documents that are cut."""
    capacity = int(table(spark, d, "pack_limits").agg(F.max("capacity_tokens")).first()[0])
    out = _packed(spark, d)
    full = out.where("container is not null").groupBy("container").agg(F.sum("tokens").alias("t")).agg(F.count_if(F.col("t") > capacity).alias("overfull"))
    docs = out.groupBy("doc_id").agg(F.sum("tokens").alias("t"), F.max("pieces").alias("p"), F.count("*").alias("n"))
    sums = docs.agg(F.count("*").alias("documents"), F.sum("t").alias("tokens"), F.count_if(F.col("p") > 1).alias("in_pieces"), F.count_if(((F.col("p") > 1) & (F.col("t") <= capacity)) | (F.col("n") != F.greatest("p", F.lit(1)))).alias("wrongly_cut"))
    return sums.crossJoin(full)  # one row each


def _mix_plan(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    docs = mixing.sized_documents(table(spark, d, "documents"), word_count(F.col("text")))
    return docs, mixing.plan_mixture(docs, table(spark, d, "mix_targets"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return _mix_plan(spark, d)[1].where("not filled").select("source")


def p8_mixture(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix_documents(*_mix_plan(spark, d))


def p8_report(spark: SparkSession, d: str) -> DataFrame:
    docs, plan = _mix_plan(spark, d)
    return mixing.mixture_report(plan, mixing.mix_documents(docs, plan))


def p8_check(spark: SparkSession, d: str) -> DataFrame:
    """Of each source what is there and wanted, and whether its documents were used no more often than allowed and as much as planned."""
    r = p8_report(spark, d)
    goal = F.least("target_tokens", F.col("available_tokens") * F.col("max_repeats"))
    near = F.abs(F.col("actual_tokens") - goal) <= F.greatest(F.lit(20_000), goal * 0.1)  # sizes of single documents
    return r.select("source", "available_tokens", "target_tokens", "filled", (F.col("most_used") <= F.col("max_repeats")).alias("allowed"), near.alias("near_target"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return keywords.keyword_features(table(spark, d, "documents")).where("flagged").select("doc_id")


def p9_features(spark: SparkSession, d: str) -> DataFrame:
    return keywords.keyword_features(table(spark, d, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k[0] == "p" and k[1].isdigit() and callable(f)}


def oracle_sql() -> dict[str, str]:
    from caseloom.llm.oracle import SQL

    return dict(SQL)
