"""Registered queries that combine a case's reviews, requirements, checks and images, each with its SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.functions.text import canonical_json, exact_evidence, hash_fraction
from caseloom.operators import components, decisions, ontology, records, splits
from caseloom.plans.queries import _OFFSETS, _PRESENCE, MODALITIES, RELEVANCE, UNKNOWN_LICENCES, _aliases, _decision, _distinct, _mentions, _sql_decision, query
from caseloom.session import table

_UNKNOWN = ", ".join(f"'{x}'" for x in UNKNOWN_LICENCES)
_LABEL = "upper(trim({}))"


def _label(name: str) -> Column:
    return F.upper(F.trim(name))


# Shared relations, in SQL and as plans. A sample is a case with the smallest candidate that reviewer A names for it.

_SQL_ORDER = "try_cast(reviewed_at AS TIMESTAMPTZ) DESC, coalesce(decision, '') DESC, model DESC, coalesce(evidence_quote, '') DESC, raw_text_sha256 DESC, candidate_disease DESC"
_BASE = f"""c AS (SELECT DISTINCT case_id, article_id, raw_text_sha256, raw_case_text AS t FROM cases
), s AS (SELECT c.*, k.candidate_disease FROM c JOIN (SELECT case_id, min({_LABEL.format('candidate_disease')}) AS candidate_disease FROM reviewer_a GROUP BY 1) k USING (case_id)
), """ + ", ".join(
    f"""{n} AS (SELECT * EXCLUDE (k), {_sql_decision('decision')} AS d, coalesce({_sql_decision('decision')} = 'accept' AND diagnosis_status = 'confirmed' AND disease_is_current AND NOT multiple_target_diseases
  AND coalesce(len(other_target_diseases), 0) = 0 AND evidence_valid, false) AS ok FROM (SELECT r.*, row_number() OVER (PARTITION BY r.case_id ORDER BY {_SQL_ORDER}) AS k
  FROM (SELECT * REPLACE ({_LABEL.format('candidate_disease')} AS candidate_disease) FROM {t}) r SEMI JOIN s ON s.case_id = r.case_id AND s.raw_text_sha256 = r.raw_text_sha256 AND s.candidate_disease = r.candidate_disease) WHERE k = 1)"""
    for n, t in (("a", "reviewer_a"), ("b", "reviewer_b"), ("m", "medgemma_labels"))
)
_HUMAN = f""", h AS (SELECT x.*, {_sql_decision('human_decision')} AS d, x.raw_text_sha256 = s.raw_text_sha256 AND x.candidate_disease = s.candidate_disease AS bound,
  coalesce(human_evidence_valid AND human_status = 'confirmed' AND NOT multiple_target_diseases AND evidence_quote <> '' AND (length(s.t) - length(replace(s.t, evidence_quote, ''))) // nullif(length(evidence_quote), 0) = 1, false) AS good
  FROM (SELECT * EXCLUDE (k) FROM (SELECT *, row_number() OVER (PARTITION BY case_id ORDER BY imported_at::TIMESTAMPTZ DESC, record_sha256 DESC) AS k
  FROM (SELECT * REPLACE ({_LABEL.format('candidate_disease')} AS candidate_disease) FROM human_label_adjudications)) WHERE k = 1) x JOIN s USING (case_id))"""
_NEED = "(NOT coalesce(a.ok, false) OR ('0x' || substr(sha256(s.case_id || ':B'), 1, 8))::UBIGINT / 4294967296.0::DOUBLE < 0.1)"
_ADJUDICATED = f"""{_BASE}{_HUMAN}, j AS (SELECT s.case_id, s.article_id, s.candidate_disease, s.raw_text_sha256, s.t, a.d AS da, b.d AS db, m.d AS dm, m.processing_status AS pm, m.case_id IS NOT NULL AS hm, {_NEED} AS needs_b,
  CASE WHEN h.bound AND h.d = 'reject' THEN 'HUMAN_LABEL_ADJUDICATED_REJECTED' WHEN h.bound AND h.d = 'accept' AND h.good THEN 'HUMAN_LABEL_ADJUDICATED' WHEN h.bound THEN 'HUMAN_ADJUDICATION_REQUIRED'
    WHEN a.case_id IS NULL THEN 'REVIEW_A_REQUIRED' WHEN {_NEED} AND b.case_id IS NULL THEN 'REVIEW_B_REQUIRED' WHEN a.d = 'reject' AND b.d = 'reject' THEN 'REVIEWER_CONSENSUS_REJECTED'
    WHEN a.ok AND ((NOT {_NEED} AND b.case_id IS NULL) OR coalesce(b.ok, false)) AND (m.case_id IS NULL OR m.ok) THEN 'AUTOMATED_CONSENSUS' ELSE 'HUMAN_ADJUDICATION_REQUIRED' END AS reason
  FROM s LEFT JOIN a ON a.case_id = s.case_id LEFT JOIN b ON b.case_id = s.case_id LEFT JOIN m ON m.case_id = s.case_id LEFT JOIN h ON h.case_id = s.case_id
), r AS (SELECT *, CASE WHEN reason IN ('HUMAN_LABEL_ADJUDICATED_REJECTED', 'REVIEWER_CONSENSUS_REJECTED') THEN 'rejected' WHEN reason = 'HUMAN_LABEL_ADJUDICATED' THEN 'human_reviewed' WHEN reason = 'AUTOMATED_CONSENSUS' THEN 'verified_silver' ELSE 'pending' END AS status,
  reason IN ('HUMAN_LABEL_ADJUDICATED', 'AUTOMATED_CONSENSUS') AS verified FROM j)"""


def _samples(spark: SparkSession, d: str) -> DataFrame:
    k = table(spark, d, "reviewer_a").groupBy("case_id").agg(F.min(_label("candidate_disease")).alias("candidate_disease"))
    return _distinct(spark, d, "cases", "case_id", "article_id", "raw_text_sha256", F.col("raw_case_text").alias("t")).join(k, "case_id")


def _accepted(decision: Column) -> Column:
    return decisions.all_true(decision == "accept", F.col("diagnosis_status") == "confirmed", F.col("disease_is_current"), ~F.col("multiple_target_diseases"), decisions.none_listed(F.col("other_target_diseases")), F.col("evidence_valid"))


def _current(spark: SparkSession, d: str, name: str, samples: DataFrame, *more: str) -> DataFrame:
    """(case_id, d, ok, more): the last review of each sample's text and candidate."""
    r = table(spark, d, name).withColumn("candidate_disease", _label("candidate_disease"))
    blank = lambda c: F.coalesce(c, F.lit(""))
    order = [records.instant(F.col("reviewed_at")), blank("decision"), F.col("model"), blank("evidence_quote"), F.col("raw_text_sha256"), F.col("candidate_disease")]
    last = decisions.current(r, samples, ["case_id", "raw_text_sha256", "candidate_disease"], order)
    x = _decision(F.col("decision"))
    return last.select("case_id", x.alias("d"), _accepted(x).alias("ok"), *more)


def _humans(spark: SparkSession, d: str, samples: DataFrame) -> DataFrame:
    """(case_id, d, bound, good, ...): each sample's last human record, whether it is of the sample and could accept it."""
    h = table(spark, d, "human_label_adjudications").select("case_id", "imported_at", "record_sha256", "human_decision", "human_status", "human_evidence_valid", "multiple_target_diseases", "evidence_quote", "reason_code", F.col("raw_text_sha256").alias("of_text"), _label("candidate_disease").alias("of_candidate"))
    last = records.latest_by(h, ["case_id"], [records.instant(F.col("imported_at")), F.col("record_sha256")])
    j = last.join(samples, "case_id")
    good = decisions.all_true(F.col("human_evidence_valid"), F.col("human_status") == "confirmed", ~F.col("multiple_target_diseases"), decisions.quoted_once(F.col("t"), F.col("evidence_quote")))
    bound = decisions.all_true(F.col("of_text") == F.col("raw_text_sha256"), F.col("of_candidate") == F.col("candidate_disease"))
    return j.select("case_id", _decision(F.col("human_decision")).alias("d"), bound.alias("bound"), good.alias("good"), "record_sha256", "human_decision", "human_status", "reason_code")


def _adjudicated(spark: SparkSession, d: str) -> DataFrame:
    """Samples with their reviews a, b, m and h as structs, needs_b, reason, status and verified."""
    s = _samples(spark, d)
    j = decisions.look_up(s, "case_id", a=_current(spark, d, "reviewer_a", s), b=_current(spark, d, "reviewer_b", s), m=_current(spark, d, "medgemma_labels", s, "processing_status", "confidence"), h=_humans(spark, d, s).drop("human_decision", "human_status", "reason_code", "record_sha256"))
    j = j.withColumn("needs_b", decisions.needs_second(F.col("a.ok"), F.col("case_id"), ":B", 0.1))
    bound, alone = F.col("h.bound"), ~F.col("needs_b") & F.col("b").isNull()
    reason = records.ladder(
        (bound & (F.col("h.d") == "reject"), "HUMAN_LABEL_ADJUDICATED_REJECTED"),
        (bound & (F.col("h.d") == "accept") & F.col("h.good"), "HUMAN_LABEL_ADJUDICATED"),
        (bound, "HUMAN_ADJUDICATION_REQUIRED"),
        (F.col("a").isNull(), "REVIEW_A_REQUIRED"),
        (F.col("needs_b") & F.col("b").isNull(), "REVIEW_B_REQUIRED"),
        ((F.col("a.d") == "reject") & (F.col("b.d") == "reject"), "REVIEWER_CONSENSUS_REJECTED"),
        (F.col("a.ok") & (alone | F.coalesce("b.ok", F.lit(False))) & (F.col("m").isNull() | F.col("m.ok")), "AUTOMATED_CONSENSUS"),
        otherwise="HUMAN_ADJUDICATION_REQUIRED",
    )
    j = j.withColumn("reason", reason)
    status = records.ladder((F.col("reason").isin("HUMAN_LABEL_ADJUDICATED_REJECTED", "REVIEWER_CONSENSUS_REJECTED"), "rejected"), (F.col("reason") == "HUMAN_LABEL_ADJUDICATED", "human_reviewed"), (F.col("reason") == "AUTOMATED_CONSENSUS", "verified_silver"), otherwise="pending")
    return j.withColumn("status", status).withColumn("verified", F.col("status").isin("human_reviewed", "verified_silver"))


# Reviews


@query(f"WITH {_BASE} SELECT 'a' AS role, case_id, d AS decision, ok AS accepted FROM a UNION ALL SELECT 'b', case_id, d, ok FROM b UNION ALL SELECT 'm', case_id, d, ok FROM m")
def current_reviews(spark: SparkSession, d: str) -> DataFrame:
    """The last review of the present text and candidate in each role, and whether it accepts the case."""
    s = _samples(spark, d)
    one = lambda role, name: _current(spark, d, name, s).select(F.lit(role).alias("role"), "case_id", F.col("d").alias("decision"), F.col("ok").alias("accepted"))
    return components.union_all([one("a", "reviewer_a"), one("b", "reviewer_b"), one("m", "medgemma_labels")])


@query(f"WITH {_BASE} SELECT s.case_id, coalesce(a.ok, false) AS accepted, {_NEED} AS needs_b FROM s LEFT JOIN a ON a.case_id = s.case_id WHERE a.case_id IS NOT NULL AND {_NEED} AND s.case_id NOT IN (SELECT case_id FROM b)")
def second_review_due(spark: SparkSession, d: str) -> DataFrame:
    """Cases with a first review that need a second one and have none."""
    s = _samples(spark, d)
    j = s.select("case_id").join(_current(spark, d, "reviewer_a", s), "case_id")
    due = j.select("case_id", F.col("ok").alias("accepted"), decisions.needs_second(F.col("ok"), F.col("case_id"), ":B", 0.1).alias("needs_b")).where("needs_b")
    return records.pending(due, _current(spark, d, "reviewer_b", s), ["case_id"])


@query(f"""WITH {_BASE}{_HUMAN} SELECT case_id, bound, coalesce(bound AND good AND d = 'accept', false) AS label_accepted,
  '{{"human_decision":' || coalesce(to_json(human_decision), 'null') || ',"human_status":' || coalesce(to_json(human_status), 'null') || ',"reason_code":' || coalesce(to_json(reason_code), 'null') || '}}' AS editable FROM h""")
def human_records(spark: SparkSession, d: str) -> DataFrame:
    """The last human record of each sample, whether it is bound to the sample and accepts its label, and its editable fields."""
    h = _humans(spark, d, _samples(spark, d))
    accepted = decisions.all_true(F.col("bound"), F.col("good"), F.col("d") == "accept")
    return h.select("case_id", "bound", accepted.alias("label_accepted"), canonical_json(human_decision=F.col("human_decision"), human_status=F.col("human_status"), reason_code=F.col("reason_code")).alias("editable"))


_PARTITION = "replace(lower(trim(partition)), '-', '_')"


def _parts(spark: SparkSession, d: str) -> DataFrame:
    part = F.translate(F.lower(F.trim("partition")), "-", "_")
    return table(spark, d, "assignments").groupBy("case_id").agg(F.min(_label("diagnosis_label")).alias("label"), F.max(part).alias("part"), F.max("fold").alias("fold"))


@query(f"""WITH p AS (SELECT case_id, min({_LABEL.format('diagnosis_label')}) AS label, max({_PARTITION}) AS part FROM assignments GROUP BY 1), n AS (SELECT label, count(*) AS n FROM p GROUP BY 1)
  SELECT case_id, coalesce(n.n < 30, false) OR coalesce(part = 'frozen_test', false) OR ('0x' || substr(sha256(case_id || ':human-v001'), 1, 8))::UBIGINT / 4294967296.0::DOUBLE < 0.1 AS audited FROM p LEFT JOIN n USING (label)""")
def human_sample(spark: SparkSession, d: str) -> DataFrame:
    """Cases to audit: all of a small class, the whole test part, and a reproducible tenth."""
    p = _parts(spark, d)
    n = p.groupBy("label").agg(F.count("*").alias("n"))
    tests = (F.col("n") < 30, F.col("part") == "frozen_test", hash_fraction(F.concat("case_id", F.lit(":human-v001"))) < 0.1)
    audited = F.lit(False)
    for x in tests:
        audited = audited | F.coalesce(x, F.lit(False))
    return p.join(n, "label", "left").select("case_id", audited.alias("audited"))


@query(f"WITH {_ADJUDICATED} SELECT case_id, candidate_disease, needs_b, coalesce(da, 'pending') AS by_a, coalesce(db, CASE WHEN needs_b THEN 'pending' ELSE 'not_required' END) AS by_b, reason, status, verified FROM r")
def adjudication(spark: SparkSession, d: str) -> DataFrame:
    """Six left joins of a sample with its reviews, and a ladder of reasons over them; the last source that decides holds."""
    none = F.when(F.col("needs_b"), "pending").otherwise("not_required")
    return _adjudicated(spark, d).select("case_id", "candidate_disease", "needs_b", F.coalesce("a.d", F.lit("pending")).alias("by_a"), F.coalesce("b.d", none).alias("by_b"), "reason", "status", "verified")


@query(f"WITH {_ADJUDICATED} SELECT case_id, da AS by_a, db AS by_b, dm AS by_m, sha256('{{\"case_id\":' || to_json(case_id) || ',\"raw_text_sha256\":' || to_json(raw_text_sha256) || '}}') AS payload_sha256 FROM r WHERE reason = 'HUMAN_ADJUDICATION_REQUIRED' AND da IS NOT NULL AND db IS NOT NULL")
def adjudication_export(spark: SparkSession, d: str) -> DataFrame:
    """Unresolved samples that both reviewers decided, with the third review if there is one and the digest that binds the answer."""
    r = _adjudicated(spark, d).where("reason = 'HUMAN_ADJUDICATION_REQUIRED' and a.d is not null and b.d is not null")
    payload = canonical_json(case_id=F.col("case_id"), raw_text_sha256=F.col("raw_text_sha256"))
    return r.select("case_id", F.col("a.d").alias("by_a"), F.col("b.d").alias("by_b"), F.col("m.d").alias("by_m"), F.sha2(payload, 256).alias("payload_sha256"))


@query(f"""WITH {_BASE} SELECT DISTINCT x.record_sha256, x.case_id, array_to_string(list_filter([CASE WHEN s.case_id IS NULL OR x.raw_text_sha256 IS DISTINCT FROM s.raw_text_sha256 THEN 'raw_text_sha256' END,
  CASE WHEN s.case_id IS NULL OR {_LABEL.format('x.candidate_disease')} IS DISTINCT FROM s.candidate_disease THEN 'candidate_disease' END], lambda v: v IS NOT NULL), ',') AS changed FROM human_label_adjudications x LEFT JOIN s ON s.case_id = x.case_id""")
def context_changes(spark: SparkSession, d: str) -> DataFrame:
    """Which part of what a person was shown is no longer what the tables hold."""
    h = table(spark, d, "human_label_adjudications").select("record_sha256", "case_id", "raw_text_sha256", _label("candidate_disease").alias("candidate_disease")).distinct()
    out = decisions.context_changes(h, _samples(spark, d), "case_id", ["raw_text_sha256", "candidate_disease"])
    return out.select("record_sha256", "case_id", F.array_join("changed", ",").alias("changed"))


@query(f"""WITH {_ADJUDICATED}, p AS (SELECT case_id, CASE WHEN min({_sql_decision('human_decision')}) <> max({_sql_decision('human_decision')}) THEN 'PEOPLE_DISAGREE' ELSE 'PEOPLE_AGREE' END AS why FROM human_label_adjudications GROUP BY 1
), n AS (SELECT case_id, array_to_string(list_filter([CASE WHEN reason = 'HUMAN_ADJUDICATION_REQUIRED' THEN 'HUMAN_ADJUDICATION_REQUIRED' END, CASE WHEN ('0x' || substr(sha256(case_id || ':human-v001'), 1, 8))::UBIGINT / 4294967296.0::DOUBLE < 0.1 THEN 'RELEASE_AUDIT' END], lambda v: v IS NOT NULL), ';') AS why FROM r)
  SELECT coalesce(n.case_id, p.case_id) AS case_id, coalesce(n.why, p.why) AS why, CASE WHEN p.case_id IS NULL THEN 'NEW' WHEN n.case_id IS NULL THEN 'PRIOR' ELSE 'RENEWED' END AS origin FROM (SELECT * FROM n WHERE why <> '') n FULL JOIN p ON p.case_id = n.case_id""")
def human_requirements(spark: SparkSession, d: str) -> DataFrame:
    """What people have to decide, merged into the earlier register; reasons are listed in order."""
    why = records.reasons((F.col("reason") == "HUMAN_ADJUDICATION_REQUIRED", "HUMAN_ADJUDICATION_REQUIRED"), (records.sampled(F.col("case_id"), ":human-v001", 0.1), "RELEASE_AUDIT"))
    new = _adjudicated(spark, d).select("case_id", F.array_join(why, ";").alias("why")).where("why <> ''")
    x = _decision(F.col("human_decision"))
    prior = table(spark, d, "human_label_adjudications").groupBy("case_id").agg(F.when(F.min(x) != F.max(x), "PEOPLE_DISAGREE").otherwise("PEOPLE_AGREE").alias("why"))
    return decisions.merge_requirements(new, prior, "case_id", ["why"])


# Jobs


@query(f"WITH {_ADJUDICATED} SELECT case_id FROM s WHERE case_id IN (SELECT case_id FROM r WHERE reason = 'HUMAN_ADJUDICATION_REQUIRED') AND case_id NOT IN (SELECT case_id FROM m WHERE processing_status = 'valid')")
def job_scope(spark: SparkSession, d: str) -> DataFrame:
    """Unresolved samples that the third reviewer has not answered."""
    s, r = _samples(spark, d), _adjudicated(spark, d).where("reason = 'HUMAN_ADJUDICATION_REQUIRED'")
    return decisions.job_scope(s.select("case_id"), r, _current(spark, d, "medgemma_labels", s, "processing_status").where("processing_status = 'valid'"), "case_id")


@query("""WITH j AS (SELECT DISTINCT case_id, raw_text_sha256 FROM cases), v AS (SELECT DISTINCT case_id, raw_text_sha256 FROM medgemma_labels WHERE processing_status = 'valid'), f AS (SELECT DISTINCT case_id, raw_text_sha256 FROM medgemma_labels WHERE processing_status <> 'valid')
  SELECT state, count(*) AS n FROM (SELECT CASE WHEN EXISTS (SELECT 1 FROM v WHERE v.case_id = j.case_id AND v.raw_text_sha256 = j.raw_text_sha256) THEN 'DONE' WHEN EXISTS (SELECT 1 FROM f WHERE f.case_id = j.case_id AND f.raw_text_sha256 = j.raw_text_sha256) THEN 'FAILED'
  WHEN EXISTS (SELECT 1 FROM v WHERE v.case_id = j.case_id) THEN 'STALE' ELSE 'PENDING' END AS state FROM j) GROUP BY 1""")
def job_states(spark: SparkSession, d: str) -> DataFrame:
    """Jobs by state: a result of the present text, a failure, a result of an older text, or none."""
    m = table(spark, d, "medgemma_labels").select("case_id", "raw_text_sha256", "processing_status")
    out = decisions.job_states(_distinct(spark, d, "cases", "case_id", "raw_text_sha256"), m.where("processing_status = 'valid'"), m.where("processing_status <> 'valid'"), "case_id", "raw_text_sha256")
    return out.groupBy("state").agg(F.count("*").alias("n"))


@query(f"""WITH q AS (SELECT DISTINCT case_id, raw_text_sha256, text_usable, reason FROM text_qc), v AS (SELECT case_id, raw_text_sha256, max({_sql_decision('decision')}) AS d FROM medgemma_labels WHERE processing_status = 'valid' GROUP BY 1, 2)
  SELECT q.case_id, coalesce(v.d IS NOT NULL AND v.d = 'accept', false) AS text_usable, CASE WHEN v.case_id IS NULL THEN 'TEXT_AI_REVIEW_REQUIRED' ELSE v.d END AS reason FROM q LEFT JOIN v USING (case_id, raw_text_sha256)""")
def applied_results(spark: SparkSession, d: str) -> DataFrame:
    """Text checks with the answers of the same text applied; a check whose text has changed is reset."""
    q = _distinct(spark, d, "text_qc", "case_id", "raw_text_sha256", "text_usable", "reason")
    v = table(spark, d, "medgemma_labels").where("processing_status = 'valid'").groupBy("case_id", "raw_text_sha256").agg(F.max(_decision(F.col("decision"))).alias("reason"))
    v = v.withColumn("text_usable", F.coalesce(F.col("reason") == "accept", F.lit(False)))
    return decisions.apply_results(q, v, "case_id", "raw_text_sha256", {"text_usable": F.lit(False), "reason": F.lit("TEXT_AI_REVIEW_REQUIRED")}).drop("raw_text_sha256")


# Feasibility, manifest, gate, hand-off

_SIDES = f""", tq AS (SELECT case_id, bool_and(text_usable) AS usable, max(clinical_text_sha256) AS clinical_sha, max(reason) AS why FROM text_qc GROUP BY 1
), im AS (SELECT * EXCLUDE (k) FROM (SELECT *, row_number() OVER (PARTITION BY case_id ORDER BY coalesce(list_position({RELEVANCE}, image_relevance), 99), coalesce(list_position({MODALITIES}, image_modality), 99), coalesce(trim(caption) = '', true), -(width::BIGINT * height), image_id) AS k
  FROM (SELECT DISTINCT case_id, image_id, image_relevance, image_modality, caption, width, height, license, path, lower(trim(image_sha256)) AS sha FROM selected_images)) WHERE k = 1
), gr AS (SELECT case_id, bool_or(duplicate_conflict) AS conflict, min(split_group) AS grp FROM groups GROUP BY 1
), f AS (SELECT r.*, tq.clinical_sha, im.image_id, im.path, im.sha, coalesce(gr.grp, r.case_id) AS grp, CASE WHEN im.case_id IS NOT NULL AND coalesce(im.license, '') IN ({_UNKNOWN}) THEN 'IMAGE_LICENSE_UNKNOWN' WHEN NOT coalesce(tq.usable, false) THEN 'TEXT_QC_PENDING_OR_FAILED'
  WHEN im.case_id IS NULL THEN 'IMAGE_QC_PENDING_OR_FAILED' WHEN NOT verified THEN 'LABEL_REVIEW_PENDING_OR_REJECTED' WHEN coalesce(gr.conflict, false) THEN 'DUPLICATE_CONFLICT' ELSE 'ELIGIBLE' END AS outcome
  FROM r LEFT JOIN tq ON tq.case_id = r.case_id LEFT JOIN im ON im.case_id = r.case_id LEFT JOIN gr ON gr.case_id = r.case_id
), k AS (SELECT candidate_disease AS concept_id, count(*) AS usable_cases, count(DISTINCT grp) AS independent_groups, count(*) >= 30 AND count(DISTINCT grp) >= 30 AS enough FROM f WHERE outcome = 'ELIGIBLE' GROUP BY 1)"""


def _feasible(spark: SparkSession, d: str) -> DataFrame:
    """The adjudicated samples with text, image and group as structs, grp and outcome."""
    t = table(spark, d, "text_qc").groupBy("case_id").agg(F.bool_and("text_usable").alias("usable"), F.max("clinical_text_sha256").alias("clinical_sha"), F.max("reason").alias("why"))
    i = _distinct(spark, d, "selected_images", "case_id", "image_id", "image_relevance", "image_modality", "caption", "width", "height", "license", "path", F.lower(F.trim("image_sha256")).alias("sha"))
    g = table(spark, d, "groups").groupBy("case_id").agg(F.bool_or("duplicate_conflict").alias("conflict"), F.min("split_group").alias("grp"))
    j = decisions.look_up(_adjudicated(spark, d), "case_id", tq=t, im=records.best_images(i, RELEVANCE, MODALITIES), gr=g)
    outcome = records.ladder(
        (F.col("im").isNotNull() & F.coalesce("im.license", F.lit("")).isin(UNKNOWN_LICENCES), "IMAGE_LICENSE_UNKNOWN"),
        (~F.coalesce("tq.usable", F.lit(False)), "TEXT_QC_PENDING_OR_FAILED"),
        (F.col("im").isNull(), "IMAGE_QC_PENDING_OR_FAILED"),
        (~F.col("verified"), "LABEL_REVIEW_PENDING_OR_REJECTED"),
        (F.col("gr.conflict"), "DUPLICATE_CONFLICT"),
        otherwise="ELIGIBLE",
    )
    return j.withColumn("grp", F.coalesce("gr.grp", "case_id")).withColumn("outcome", outcome)


def _classes(feasible: DataFrame) -> DataFrame:
    k = feasible.where("outcome = 'ELIGIBLE'").groupBy(F.col("candidate_disease").alias("concept_id")).agg(F.count("*").alias("usable_cases"), F.count_distinct("grp").alias("independent_groups"))
    return k.withColumn("enough", (F.col("usable_cases") >= 30) & (F.col("independent_groups") >= 30))


@query(f"WITH {_ADJUDICATED}{_SIDES} SELECT case_id, outcome FROM f")
def feasibility(spark: SparkSession, d: str) -> DataFrame:
    """The first thing that keeps a sample out, of six left joins."""
    return _feasible(spark, d).select("case_id", "outcome")


@query(f"WITH {_ADJUDICATED}{_SIDES} SELECT * FROM k")
def feasible_classes(spark: SparkSession, d: str) -> DataFrame:
    return _classes(_feasible(spark, d))


@query(f"""WITH {_ADJUDICATED}{_SIDES}, p AS (SELECT case_id, max({_PARTITION}) AS part, max(fold) AS fold FROM assignments GROUP BY 1)
  SELECT sha256('v001:' || f.case_id) AS sample_id, f.case_id, f.candidate_disease AS diagnosis_label, f.image_id, sha256('v001:' || f.case_id) || regexp_extract(f.path, '\\.[A-Za-z0-9]+$') AS image_file, p.part, p.fold
  FROM f JOIN k ON k.concept_id = f.candidate_disease AND k.enough JOIN p ON p.case_id = f.case_id WHERE f.outcome = 'ELIGIBLE'""")
def manifest_rows(spark: SparkSession, d: str) -> DataFrame:
    """Eligible samples of classes with enough of them, with sample ids, image files and their part; each join must find its row."""
    f = _feasible(spark, d)
    kept = f.where("outcome = 'ELIGIBLE'").join(_classes(f).where("enough").select(F.col("concept_id").alias("candidate_disease")), "candidate_disease", "left_semi")
    assigned = _parts(spark, d).select("case_id", "part", "fold")
    out = decisions.strict_join(kept.join(assigned.select("case_id"), "case_id", "left_semi"), "case_id", p=assigned)
    sample = F.sha2(F.concat(F.lit("v001:"), "case_id"), 256)
    return out.select(sample.alias("sample_id"), "case_id", F.col("candidate_disease").alias("diagnosis_label"), F.col("im.image_id").alias("image_id"), F.concat(sample, F.regexp_extract("im.path", r"\.[A-Za-z0-9]+$", 0)).alias("image_file"), F.col("p.part").alias("part"), F.col("p.fold").alias("fold"))


@query(f"""WITH {_ADJUDICATED}{_SIDES} SELECT k.concept_id, string_agg(DISTINCT m.disease, ';' ORDER BY m.disease) AS aliases FROM k JOIN manifest m ON {_LABEL.format('m.diagnosis_label')} = k.concept_id WHERE k.enough AND trim(m.disease) <> '' GROUP BY 1""")
def taxonomy(spark: SparkSession, d: str) -> DataFrame:
    """The classes that have enough samples, with their aliases."""
    j = _classes(_feasible(spark, d)).where("enough").select("concept_id").join(_aliases(spark, d), "concept_id")
    return j.groupBy("concept_id").agg(F.array_join(F.array_sort(F.collect_set("alias")), ";").alias("aliases"))


_FIELDS = ["case_id", "article_id", "split_group", "raw_text_sha256", "clinical_text_sha256"]
_GATE = f"""{_ADJUDICATED}{_SIDES}, w AS (SELECT DISTINCT x.sample_id, x.case_id, {_LABEL.format('x.diagnosis_label')} AS label, lower(trim(x.image_sha256)) AS sha FROM manifest x
), as1 AS (SELECT case_id, min({_LABEL.format('diagnosis_label')}) AS label, max({_PARTITION}) AS part FROM assignments GROUP BY 1
), aq AS (SELECT case_id, evidence_start AS es, evidence_end AS ee, evidence_quote AS eq FROM a
), g0 AS (SELECT w.*, f.case_id IS NOT NULL AS known, f.candidate_disease, f.t, f.verified, f.image_id, f.sha AS sha_now, f.outcome, tq.usable, gr.conflict, im.license, as1.part, as1.label AS label_there, h.case_id IS NOT NULL AS human, h.good AND h.d = 'accept' AS human_ok, aq.es, aq.ee, aq.eq
  FROM w LEFT JOIN f ON f.case_id = w.case_id LEFT JOIN tq ON tq.case_id = w.case_id LEFT JOIN gr ON gr.case_id = w.case_id LEFT JOIN im ON im.case_id = w.case_id LEFT JOIN as1 ON as1.case_id = w.case_id LEFT JOIN h ON h.case_id = w.case_id LEFT JOIN aq ON aq.case_id = w.case_id
), ap AS (SELECT DISTINCT case_id, article_id, split_group, raw_text_sha256, clinical_text_sha256, {_PARTITION} AS part, fold, {_LABEL.format('diagnosis_label')} AS label FROM assignments
), codes AS (SELECT unnest([
  {{'code': 'MISSING_SOURCE_CASE', 'n': count(*) FILTER (NOT known)}}, {{'code': 'LABEL_FAILURE', 'n': count(*) FILTER (known AND coalesce(label <> candidate_disease, true))}},
  {{'code': 'EVIDENCE_SPAN_INVALID', 'n': count(*) FILTER (known AND NOT coalesce(es >= 0 AND es < ee AND ee <= length(t) AND trim(eq) <> '' AND substr(t, es + 1, ee - es) = eq, false))}},
  {{'code': 'TEXT_NOT_USABLE', 'n': count(*) FILTER (NOT coalesce(usable, false))}}, {{'code': 'IMAGE_QC_FAILED', 'n': count(*) FILTER (known AND image_id IS NULL)}},
  {{'code': 'IMAGE_HASH_MISMATCH', 'n': count(*) FILTER (known AND image_id IS NOT NULL AND coalesce(sha, '') <> coalesce(sha_now, ''))}}, {{'code': 'DUPLICATE_CONFLICT', 'n': count(*) FILTER (conflict)}},
  {{'code': 'IMAGE_LICENSE_UNKNOWN', 'n': count(*) FILTER (image_id IS NOT NULL AND coalesce(license, '') IN ({_UNKNOWN}))}}, {{'code': 'REVIEW_PENDING', 'n': count(*) FILTER (known AND NOT verified)}},
  {{'code': 'HUMAN_REVIEW_MISSING', 'n': count(*) FILTER (part = 'frozen_test' AND NOT human)}}, {{'code': 'HUMAN_AUDIT_FAILED', 'n': count(*) FILTER (part = 'frozen_test' AND human AND NOT coalesce(human_ok, false))}},
  {{'code': 'SPLIT_MISSING', 'n': count(*) FILTER (part IS NULL)}}]) AS x FROM g0
), gate AS (SELECT x.code AS code, x.n AS n FROM codes """ + "".join(
    f" UNION ALL SELECT 'SPLIT_{c.upper()}_OVERLAP', count(*) FROM (SELECT {c} FROM ap WHERE {c} IS NOT NULL GROUP BY 1 HAVING count(DISTINCT part) > 1)" for c in _FIELDS
) + "".join(
    f" UNION ALL SELECT 'FOLD_{c.upper()}_OVERLAP', count(*) FROM (SELECT DISTINCT l.fold, r2.fold FROM ap l JOIN ap r2 ON l.{c} = r2.{c} AND l.fold < r2.fold)" for c in _FIELDS
) + """ UNION ALL SELECT 'SPLIT_CLASS_COVERAGE', count(*) FROM (SELECT label FROM ap WHERE label IS NOT NULL AND part IN ('development', 'frozen_test') GROUP BY 1 HAVING count(DISTINCT part) < 2)
  UNION ALL SELECT 'SPLIT_FOLD_CLASS_COVERAGE', count(*) FROM (SELECT DISTINCT l.label, o.fold FROM (SELECT DISTINCT label FROM ap WHERE fold IS NOT NULL AND label IS NOT NULL) l, (SELECT DISTINCT fold FROM ap WHERE fold IS NOT NULL) o WHERE NOT EXISTS (SELECT 1 FROM ap WHERE ap.label = l.label AND ap.fold = o.fold)))"""


def _gate(spark: SparkSession, d: str) -> DataFrame:
    f = _feasible(spark, d)
    s = _samples(spark, d)
    own = f.select("case_id", "candidate_disease", "t", "verified", F.col("im.image_id").alias("image_id"), F.col("im.sha").alias("sha_now"), F.col("im.license").alias("license"))
    w = table(spark, d, "manifest").select("sample_id", "case_id", _label("diagnosis_label").alias("label"), F.lower(F.trim("image_sha256")).alias("sha")).distinct()
    t = table(spark, d, "text_qc").groupBy("case_id").agg(F.bool_and("text_usable").alias("usable"))
    g = table(spark, d, "groups").groupBy("case_id").agg(F.bool_or("duplicate_conflict").alias("conflict"))
    a = _current(spark, d, "reviewer_a", s, "evidence_start", "evidence_end", "evidence_quote")
    j = decisions.look_up(w, "case_id", f=own, tq=t, gr=g, sp=_parts(spark, d), h=_humans(spark, d, s), a=a)
    known, image, frozen = F.col("f").isNotNull(), F.col("f.image_id").isNotNull(), F.col("sp.part") == "frozen_test"
    none = F.lit("")
    counts = decisions.count_codes(
        j,
        (~known, "MISSING_SOURCE_CASE"),
        (known & F.coalesce(F.col("label") != F.col("f.candidate_disease"), F.lit(True)), "LABEL_FAILURE"),
        (known & ~exact_evidence(F.col("f.t"), F.col("a.evidence_quote"), F.col("a.evidence_start"), F.col("a.evidence_end")), "EVIDENCE_SPAN_INVALID"),
        (~F.coalesce("tq.usable", F.lit(False)), "TEXT_NOT_USABLE"),
        (known & ~image, "IMAGE_QC_FAILED"),
        (known & image & (F.coalesce("sha", none) != F.coalesce("f.sha_now", none)), "IMAGE_HASH_MISMATCH"),
        (F.col("gr.conflict"), "DUPLICATE_CONFLICT"),
        (image & F.coalesce("f.license", none).isin(UNKNOWN_LICENCES), "IMAGE_LICENSE_UNKNOWN"),
        (known & ~F.col("f.verified"), "REVIEW_PENDING"),
        (frozen & F.col("h").isNull(), "HUMAN_REVIEW_MISSING"),
        (frozen & F.col("h").isNotNull() & ~decisions.all_true(F.col("h.good"), F.col("h.d") == "accept"), "HUMAN_AUDIT_FAILED"),
        (F.col("sp.part").isNull(), "SPLIT_MISSING"),
    )
    ap = table(spark, d, "assignments").select(*_FIELDS, F.translate(F.lower(F.trim("partition")), "-", "_").alias("part"), "fold", _label("diagnosis_label").alias("label")).distinct()
    named = lambda df, tag: df.select(F.concat(F.lit(tag + "_"), F.upper("field"), F.lit("_OVERLAP")).alias("code"), "n")
    lone = ap.where("label is not null and part in ('development', 'frozen_test')").groupBy("label").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).where("lo = hi")
    gaps = splits.uncovered(ap.where("fold is not null and label is not null").select("label", "fold").distinct(), "label", "fold")
    count = lambda df, code: df.agg(F.count("*").alias("n")).select(F.lit(code).alias("code"), "n")
    return components.union_all([counts, named(splits.overlaps(ap, _FIELDS, "part"), "SPLIT"), named(decisions.pairwise_overlaps(ap, _FIELDS, "fold"), "FOLD"), count(lone, "SPLIT_CLASS_COVERAGE"), count(gaps, "SPLIT_FOLD_CLASS_COVERAGE")])


@query(f"WITH {_GATE} SELECT code, n FROM gate")
def gate_counts(spark: SparkSession, d: str) -> DataFrame:
    """All checks of a release: eight left joins of the manifest, overlaps between parts and folds, classes missing in one."""
    return _gate(spark, d)


@query(f"WITH {_GATE} SELECT CASE WHEN (SELECT count(*) FROM w) > 0 AND count(*) FILTER (n > 0) = 0 THEN 'PASS' ELSE 'FAIL' END AS status, (SELECT count(*) FROM w) AS rows, count(*) FILTER (n > 0) AS failed FROM gate")
def gate_status(spark: SparkSession, d: str) -> DataFrame:
    w = table(spark, d, "manifest").select("sample_id", "case_id", _label("diagnosis_label"), F.lower(F.trim("image_sha256"))).distinct()
    return decisions.gate_status(_gate(spark, d), w)


_BLOCKS = """list_filter([CASE WHEN reason = 'HUMAN_ADJUDICATION_REQUIRED' AND NOT hm THEN 'THIRD_REVIEW_PENDING' WHEN hm AND (dm IS DISTINCT FROM da OR dm IS DISTINCT FROM db) THEN 'THIRD_REVIEW_DISAGREES' END,
  CASE WHEN pm = 'validation_failed' THEN 'THIRD_REVIEW_FAILED' END, CASE WHEN NOT coalesce(usable, false) THEN coalesce(why, 'TEXT_QC_MISSING') END, CASE WHEN image_id IS NULL THEN 'NO_USABLE_IMAGE' END, CASE WHEN NOT verified THEN reason END, CASE WHEN conflict THEN 'DUPLICATE_CONFLICT' END], lambda v: v IS NOT NULL)"""


@query(f"""WITH {_ADJUDICATED}{_SIDES} SELECT case_id, CASE WHEN verified THEN 'ACCEPTED' WHEN status = 'rejected' THEN 'REJECTED' WHEN pm = 'validation_failed' THEN 'THIRD_FAILED' WHEN hm THEN 'THIRD_REVIEWED' ELSE 'THIRD_PENDING' END AS label_status,
  array_to_string({_BLOCKS}, ';') AS blocks, coalesce(images, '') AS images FROM (SELECT f.*, tq.usable, tq.why, gr.conflict, n.images FROM f LEFT JOIN tq ON tq.case_id = f.case_id LEFT JOIN gr ON gr.case_id = f.case_id
  LEFT JOIN (SELECT case_id, string_agg(DISTINCT image_id, ',' ORDER BY image_id) AS images FROM selected_images GROUP BY 1) n ON n.case_id = f.case_id)""")
def final_bundle(spark: SparkSession, d: str) -> DataFrame:
    """What goes to the last reviewers: eight left joins, the label's state, what blocks the case, and its images."""
    n = table(spark, d, "selected_images").groupBy("case_id").agg(F.array_join(F.array_sort(F.collect_set("image_id")), ",").alias("images"))
    f = decisions.look_up(_feasible(spark, d), "case_id", all=n)
    third, m = F.col("m").isNotNull(), F.col("m.d")
    failed = F.col("m.processing_status") == "validation_failed"
    state = records.ladder((F.col("verified"), "ACCEPTED"), (F.col("status") == "rejected", "REJECTED"), (failed, "THIRD_FAILED"), (third, "THIRD_REVIEWED"), otherwise="THIRD_PENDING")
    blocks = F.array_compact(F.array(
        records.ladder(((F.col("reason") == "HUMAN_ADJUDICATION_REQUIRED") & ~third, "THIRD_REVIEW_PENDING"), (third & ~(m.eqNullSafe(F.col("a.d")) & m.eqNullSafe(F.col("b.d"))), "THIRD_REVIEW_DISAGREES")),
        F.when(failed, "THIRD_REVIEW_FAILED"), F.when(~F.coalesce("tq.usable", F.lit(False)), F.coalesce("tq.why", F.lit("TEXT_QC_MISSING"))), F.when(F.col("im").isNull(), "NO_USABLE_IMAGE"), F.when(~F.col("verified"), F.col("reason")), F.when(F.col("gr.conflict"), "DUPLICATE_CONFLICT"),
    ))
    return f.select("case_id", state.alias("label_status"), F.array_join(blocks, ";").alias("blocks"), F.coalesce("all.images", F.lit("")).alias("images"))


@query(f"WITH {_ADJUDICATED} SELECT part, fold, count(*) AS cases, count(*) FILTER (verified) AS verified FROM (SELECT case_id, max({_PARTITION}) AS part, max(fold) AS fold FROM assignments GROUP BY 1) LEFT JOIN r USING (case_id) GROUP BY 1, 2")
def fold_counts(spark: SparkSession, d: str) -> DataFrame:
    j = _parts(spark, d).join(_adjudicated(spark, d).select("case_id", "verified"), "case_id", "left")
    return j.groupBy("part", "fold").agg(F.count("*").alias("cases"), F.count_if(F.coalesce("verified", F.lit(False))).alias("verified"))


# Candidates


@query(f"""WITH {_PRESENCE}, meta AS (SELECT DISTINCT article_id, lower(caption) AS t FROM selected_images WHERE caption <> ''
), mh AS (SELECT DISTINCT article_id, concept_id FROM (SELECT article_id, concept_id, replace(t, alias, chr(57345)) AS m FROM meta JOIN aliases ON contains(t, alias)) WHERE regexp_matches(m, '(^|[^\\p{{L}}\\p{{N}}])\\x{{E001}}($|[^\\p{{L}}\\p{{N}}])'))
  SELECT case_id, concept_id, bool_or(f = 'text') AS in_text, bool_or(f = 'metadata') AS in_metadata FROM (SELECT case_id, concept_id, 'text' AS f FROM hits UNION ALL SELECT DISTINCT c.case_id, mh.concept_id, 'metadata' FROM cases c JOIN mh USING (article_id)) GROUP BY 1, 2""")
def metadata_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Concepts named in a case's text or in what its article says; matches of an article are found once and joined to its cases."""
    from caseloom.operators.matcher import find_aliases

    meta = _distinct(spark, d, "selected_images", "article_id", "caption").where("caption <> ''")
    found = find_aliases(meta, _aliases(spark, d), "article_id", "caption").select("article_id", "concept_id").distinct()
    every = _mentions(spark, d).select("case_id", "concept_id", F.lit(True).alias("text"))
    every = every.unionByName(_distinct(spark, d, "cases", "case_id", "article_id").join(found, "article_id").select("case_id", "concept_id", F.lit(False).alias("text")))
    return every.groupBy("case_id", "concept_id").agg(F.bool_or("text").alias("in_text"), F.bool_or(~F.col("text")).alias("in_metadata"))


@query(f"WITH {_OFFSETS} SELECT concept_id, count(*) AS mentions, count(DISTINCT case_id) AS candidate_cases FROM hits GROUP BY 1")
def mention_counts(spark: SparkSession, d: str) -> DataFrame:
    return _mentions(spark, d).groupBy("concept_id").agg(F.count("*").alias("mentions"), F.count_distinct("case_id").alias("candidate_cases"))


@query(f"WITH {_OFFSETS} SELECT case_id, concept_id, string_agg(a || '-' || (a + length(alias)), ',' ORDER BY a, a + length(alias)) AS locations, string_agg(DISTINCT substr(t, a + 1, length(alias)), ';' ORDER BY substr(t, a + 1, length(alias))) AS aliases FROM hits GROUP BY 1, 2")
def candidate_locations(spark: SparkSession, d: str) -> DataFrame:
    """Where a case names a concept, and in which spellings."""
    g = _mentions(spark, d).groupBy("case_id", "concept_id").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("l"), F.array_sort(F.collect_set("alias")).alias("s"))
    return g.select("case_id", "concept_id", F.array_join(F.transform("l", lambda x: F.concat_ws("-", x["start"], x["end"])), ",").alias("locations"), F.array_join("s", ";").alias("aliases"))


_CONCEPTS = f"""con AS (SELECT DISTINCT {_LABEL.format('diagnosis_label')} AS c FROM manifest WHERE diagnosis_label IS NOT NULL), up AS (SELECT x.c, y.c AS p FROM con x JOIN con y ON y.c = left(x.c, length(x.c) - 2) || '00' AND x.c <> y.c)"""
_ROUTE = f"""{_CONCEPTS}, {_PRESENCE}, conf AS (SELECT DISTINCT case_id, {_LABEL.format('candidate_disease')} AS c FROM reviewer_a WHERE diagnosis_status = 'confirmed' UNION SELECT DISTINCT case_id, {_LABEL.format('candidate_disease')} FROM reviewer_b WHERE diagnosis_status = 'confirmed'
  UNION SELECT case_id, concept_id FROM hits), tgt AS (SELECT case_id, c FROM conf WHERE NOT EXISTS (SELECT 1 FROM conf o JOIN up ON up.c = o.c WHERE o.case_id = conf.case_id AND up.p = conf.c)
), per AS (SELECT case_id, string_agg(c, ',' ORDER BY c) AS targets, count(*) AS n FROM tgt GROUP BY 1), hit AS (SELECT case_id, count(*) AS k, bool_or(concept_id NOT IN ('IDX:0004137', 'IDX:0004174')) AS inside FROM hits GROUP BY 1)"""


@query(f"""WITH {_ROUTE} SELECT x.case_id, per.targets, CASE WHEN per.n = 1 THEN 'SINGLE_TARGET' WHEN per.n > 1 THEN 'MULTI_TARGET_DIAGNOSIS' WHEN hit.k > 0 AND NOT hit.inside THEN 'OUT_OF_SCOPE' WHEN coalesce(hit.k, 0) = 0 THEN 'NO_CANDIDATE_DISEASE_MENTION' ELSE 'NO_CONFIRMED_TARGET' END AS route
  FROM (SELECT DISTINCT case_id FROM cases) x LEFT JOIN per USING (case_id) LEFT JOIN hit USING (case_id)""")
def routing(spark: SparkSession, d: str) -> DataFrame:
    """The confirmed or named concepts of each case without the ancestors of others, and the five-way route they give."""
    con = table(spark, d, "manifest").where("diagnosis_label is not null").select(_label("diagnosis_label").alias("c")).distinct()
    up = con.select("c", F.concat(F.expr("left(c, length(c) - 2)"), F.lit("00")).alias("p")).where("c <> p").join(con.select(F.col("c").alias("p")), "p", "left_semi")
    hits = _mentions(spark, d).select("case_id", F.col("concept_id").alias("c")).distinct()
    said = lambda t: table(spark, d, t).where("diagnosis_status = 'confirmed'").select("case_id", _label("candidate_disease").alias("c"))
    conf = components.union_all([said("reviewer_a"), said("reviewer_b"), hits]).where("c is not null").distinct()
    per = decisions.collapse_targets(conf, ontology.ancestors(up, "c", "p"), "case_id", "c")
    hit = hits.groupBy("case_id").agg(F.count("*").alias("k"), F.bool_or(~F.col("c").isin("IDX:0004137", "IDX:0004174")).alias("inside"))
    j = _distinct(spark, d, "cases", "case_id").join(per, "case_id", "left").join(hit, "case_id", "left")
    k = F.coalesce("k", F.lit(0))
    route = records.ladder((F.col("n") == 1, "SINGLE_TARGET"), (F.col("n") > 1, "MULTI_TARGET_DIAGNOSIS"), ((k > 0) & ~F.col("inside"), "OUT_OF_SCOPE"), (k == 0, "NO_CANDIDATE_DISEASE_MENTION"), otherwise="NO_CONFIRMED_TARGET")
    return j.select("case_id", F.array_join("targets", ",").alias("targets"), route.alias("route"))
