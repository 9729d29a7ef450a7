"""What a sentence asserts about a mention, as a chain of regular expressions in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.functions.text import enclosing_span, sentence_spans, slice_text

# Statuses from best to worst, and the cue patterns in the order in which they are tried.
STATUSES = ["confirmed", "probable", "suspected", "differential", "ruled_out", "historical", "unclear"]
CLAUSE = r"[;:]|\b(?:but|whereas|however)\b"
FAMILY = r"\b(?:family history|mother|father|sister|brother)\b"
HISTORY = r"\b(?:history of|previous|prior|past|resolved)\b"
NEGATED_BEFORE = r"\b(?:no evidence of|negative for|ruled out|excluded|without)\s*(?:\w+\s+){0,3}$"
NEGATED_AFTER = r"^\s*(?:was |is |had been )?(?:ruled out|excluded|negative|not confirmed)"
NOT_DIAGNOSED = r"\b(?:not|never)\s+(?:\w+\s+){0,2}(?:confirmed|diagnosed)"
DIFFERENTIAL = r"\b(?:differential|versus|vs\.?|considered)\b"
PROBABLE = r"\b(?:probable|likely|presumed)\b"
SUSPECTED = r"\b(?:suspect\w*|possible|potential|may|might|could|cannot exclude)\b"
CONFIRMED_BEFORE = r"\b(?:confirmed|diagnosed with|diagnosis (?:of|was)|positive for|consistent with a diagnosis of)\s+(?:\w+\s+){0,3}$"
CONFIRMED_AFTER = r"^\s*(?:was |is |has been )?(?:confirmed|diagnosed|established)\b"
CONTEXT = 100


def mention_status(before: Column, after: Column) -> Column:
    """Status of a mention from the parts of its sentence before and after it.

    Only the mention's own clause counts, and of it CONTEXT characters on each side. The first rule
    that holds decides; no cue at all is unclear. Nulls count as empty.
    """
    u = "(?U)"
    left = F.lower(F.coalesce(before, F.lit("")))
    right = F.lower(F.coalesce(after, F.lit("")))
    left = F.regexp_extract(left, rf"(?Us)^(?:.*(?:{CLAUSE}))?(.*)\z", 1)
    left = F.substring(left, F.greatest(F.lit(1), F.length(left) - CONTEXT + 1), F.lit(CONTEXT))
    right = F.substring(F.get(F.split(right, u + CLAUSE, 2), F.lit(0)), 1, CONTEXT)
    both = F.concat(left, F.lit(" <disease> "), right)
    return (
        F.when(left.rlike(u + FAMILY), "historical")
        .when(left.rlike(u + HISTORY), "historical")
        .when(left.rlike(u + NEGATED_BEFORE) | right.rlike(u + NEGATED_AFTER) | left.rlike(u + NOT_DIAGNOSED), "ruled_out")
        .when(both.rlike(u + DIFFERENTIAL), "differential")
        .when(both.rlike(u + PROBABLE), "probable")
        .when(both.rlike(u + SUSPECTED), "suspected")
        .when(left.rlike(u + CONFIRMED_BEFORE) | right.rlike(u + CONFIRMED_AFTER), "confirmed")
        .otherwise("unclear")
    )


def status_rank(status: Column) -> Column:
    """Position of a status from best to worst; unknown ones come last."""
    at = F.array_position(F.array(*map(F.lit, STATUSES)), status)
    return F.when(at > 0, at - 1).otherwise(len(STATUSES)).cast("int")


def diagnose(texts: DataFrame, mentions: DataFrame, key: str, text: str) -> DataFrame:
    """The best assertion per text and concept of ``mentions`` (key, concept_id, start, end).

    (key, concept_id, status, reason, evidence, evidence_start, evidence_end). A text meets its mentions once;
    what goes on are their sentences, not the text. A mention in no sentence is no evidence. Confirmed and ruled out for one concept makes it
    unclear, with the first confirmed sentence as evidence. Ties go to the earliest mention.
    """
    held = mentions.groupBy(key).agg(F.collect_set(F.struct("concept_id", "start", "end")).alias("__m"))  # mentions of one text
    spans = texts.select(key, F.col(text).alias("__text"), sentence_spans(F.col(text)).alias("__spans")).join(held, key)
    cut = lambda a, b: slice_text(F.col("__text"), a, b)

    def around(m: Column) -> Column:
        s = enclosing_span(F.col("__spans"), m["start"], m["end"])
        sides = (cut(s["start"], m["start"]).alias("left"), cut(m["end"], s["end"]).alias("right"), cut(s["start"], s["end"]).alias("evidence"))
        return F.struct(m["concept_id"].alias("concept_id"), m["start"].alias("start"), m["end"].alias("end"), s["start"].alias("a"), s["end"].alias("b"), *sides)

    found = spans.select(key, F.inline(F.transform("__m", around))).where("a is not null").withColumn("status", mention_status(F.col("left"), F.col("right")))
    rank = status_rank(F.col("status"))
    best = F.min(F.struct(rank.alias("rank"), "start", "end", "status", "a", "b", "evidence")).alias("best")
    out = found.groupBy(key, "concept_id").agg(best, F.bool_or(F.col("status") == "ruled_out").alias("no"))
    torn = (F.col("best.status") == "confirmed") & F.col("no")
    reason = F.when(torn, "CONTRADICTORY_ASSERTIONS").when(F.col("best.status") == "confirmed", "EXPLICIT_ASSERTION").otherwise("NOT_CONFIRMED")
    return out.select(key, "concept_id", F.when(torn, "unclear").otherwise(F.col("best.status")).alias("status"), reason.alias("reason"), F.col("best.evidence").alias("evidence"), F.col("best.a").alias("evidence_start"), F.col("best.b").alias("evidence_end"))
