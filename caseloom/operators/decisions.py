"""Reviews, requirements and checks joined per record: latest sources, predicates, strict joins, context equality.

The operators take their conditions as columns; which state follows from which condition is the caller's rule.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.functions.text import hash_fraction, occurrences
from caseloom.operators.records import latest_by


def all_true(*tests: Column) -> Column:
    """Whether all ``tests`` hold; null counts as no."""
    return reduce(lambda a, b: a & b, (F.coalesce(t, F.lit(False)) for t in tests))


def none_listed(values: Column) -> Column:
    """Whether an array is null or empty."""
    return F.coalesce(F.size(values) == 0, F.lit(True))


def needs_second(accepted: Column, key: Column, salt: str, rate: float) -> Column:
    """Whether a record needs a second review: it was not accepted, or it falls into the reproducible sample."""
    return ~F.coalesce(accepted, F.lit(False)) | (hash_fraction(F.concat(key, F.lit(salt))) < rate)


def quoted_once(text: Column, quote: Column) -> Column:
    """Whether ``quote`` stands in ``text`` just once."""
    return F.coalesce(occurrences(text, quote) == 1, F.lit(False))


def current(records: DataFrame, samples: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The last record by ``order`` of each first key, among those whose ``keys`` are those of ``samples``.

    Keys compare by equality, so a record of another text or candidate is not current. The samples' other
    columns stay out; a sample that stands twice adds nothing.
    """
    bound = records.join(samples.select(*keys).distinct(), keys, "left_semi")
    return latest_by(bound, keys[:1], order)


def look_up(base: DataFrame, key: str, **sides: DataFrame) -> DataFrame:
    """``base`` left joined with each side's columns as a struct named as the side, null where it has no row.

    Each side has one row a key. Structs keep clashing column names of the sides apart.
    """
    for name, side in sides.items():
        packed = side.select(F.col(key), F.struct(*[c for c in side.columns if c != key]).alias(name))
        base = base.join(packed, key, "left")
    return base


def strict_join(base: DataFrame, key: str, **sides: DataFrame) -> DataFrame:
    """As :func:`look_up`, but a row of ``base`` without a counterpart in a side is an error when the result is read."""
    out = look_up(base, key, **sides)
    for name in sides:
        missing = F.raise_error(F.concat(F.lit(f"no {name} for "), F.coalesce(F.col(key).cast("string"), F.lit("null"))))
        out = out.withColumn(name, F.when(F.col(name).isNotNull(), F.col(name)).otherwise(missing))
    return out


def merge_requirements(new: DataFrame, prior: DataFrame, key: str, values: list[str]) -> DataFrame:
    """Full outer join of new and earlier requirements; of each of ``values`` the new one holds where there is one.

    Earlier requirements that are not renewed stay, so the register only grows. origin is NEW, RENEWED or PRIOR.
    """
    n = new.select(key, *values, F.lit(True).alias("__n"))
    p = prior.select(key, *(F.col(v).alias("__" + v) for v in values), F.lit(True).alias("__p"))
    origin = F.when(F.col("__p").isNull(), "NEW").when(F.col("__n").isNull(), "PRIOR").otherwise("RENEWED")
    return n.join(p, key, "full_outer").select(key, *(F.coalesce(v, "__" + v).alias(v) for v in values), origin.alias("origin"))


def context_changes(exported: DataFrame, now: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """``exported`` with changed: the names of ``fields`` that ``now`` holds otherwise, all of them if the key is gone.

    Nulls are equal to nulls. ``now`` has one row a key.
    """
    seen = now.select(key, *(F.col(f).alias("__" + f) for f in fields), F.lit(True).alias("__there"))
    flags = [F.when(F.col("__there").isNull() | ~F.col(f).eqNullSafe(F.col("__" + f)), f) for f in fields]
    out = exported.join(seen, key, "left").withColumn("changed", F.array_compact(F.array(*flags)))
    return out.select(*exported.columns, "changed")


def job_states(jobs: DataFrame, results: DataFrame, failures: DataFrame, key: str, request: str) -> DataFrame:
    """``jobs`` with state: DONE with a result of this request, FAILED with a failure of it, STALE with a result of another one, else PENDING."""
    done = results.select(key, request, F.lit(1).alias("__d")).distinct()
    failed = failures.select(key, request, F.lit(1).alias("__f")).distinct()
    other = results.groupBy(key).agg(F.lit(1).alias("__o"))
    out = jobs.join(done, [key, request], "left").join(failed, [key, request], "left").join(other, key, "left")
    state = F.when(F.col("__d").isNotNull(), "DONE").when(F.col("__f").isNotNull(), "FAILED").when(F.col("__o").isNotNull(), "STALE").otherwise("PENDING")
    return out.select(*jobs.columns, state.alias("state"))


def job_scope(work: DataFrame, unresolved: DataFrame, resolved: DataFrame, key: str) -> DataFrame:
    """``work`` that is unresolved and not resolved since; all of it if nothing is known to be unresolved.

    Whether something is unresolved is a one-row aggregate in the plan, so that nothing runs beforehand.
    """
    known = unresolved.select(F.lit(1)).limit(1).agg(F.count("*").alias("__known"))
    wanted = unresolved.select(key, F.lit(1).alias("__u")).distinct()
    out = work.join(wanted, key, "left").join(F.broadcast(known), F.lit(True))  # one row
    out = out.where((F.col("__u") == 1) | (F.col("__known") == 0)).select(*work.columns)
    return out.join(resolved.select(key).distinct(), key, "left_anti")


def apply_results(table: DataFrame, results: DataFrame, key: str, request: str, values: dict[str, Column]) -> DataFrame:
    """``table`` with each of ``values`` from the result of the same key and request, else the value's default.

    A result of an older request is not applied: the row falls back to the defaults, which is how a changed text
    or prompt resets what depends on it. ``results`` has one row for each key and request.
    """
    r = results.select(key, request, *(F.col(v).alias("__" + v) for v in values), F.lit(True).alias("__r"))
    kept = [c for c in table.columns if c not in values]
    out = table.join(r, [key, request], "left")
    return out.select(*kept, *(F.when(F.col("__r"), F.col("__" + v)).otherwise(default).alias(v) for v, default in values.items()))


def count_codes(rows: DataFrame, *codes: tuple[Column, str]) -> DataFrame:
    """(code, n): how many rows each condition holds for, 0 included; one pass and one row an aggregate before the shuffle."""
    sums = rows.agg(*(F.count_if(F.coalesce(test, F.lit(False))).alias(f"c{i}") for i, (test, _) in enumerate(codes)))
    pairs = F.array(*(F.struct(F.lit(name).alias("code"), F.col(f"c{i}").alias("n")) for i, (_, name) in enumerate(codes)))
    return sums.select(F.inline(pairs))


def gate_status(counts: DataFrame, rows: DataFrame) -> DataFrame:
    """(status, rows, failed): PASS if ``rows`` is not empty and no count of ``counts`` (code, n) is above 0."""
    failed = counts.agg(F.count_if(F.col("n") > 0).alias("failed"))
    out = rows.agg(F.count("*").alias("rows")).crossJoin(failed)  # one row each
    return out.select(F.when((F.col("rows") > 0) & (F.col("failed") == 0), "PASS").otherwise("FAIL").alias("status"), "rows", "failed")


def pairwise_overlaps(rows: DataFrame, fields: list[str], by: str) -> DataFrame:
    """(field, n): for each of ``fields`` how many pairs of values of ``by`` share one of its values.

    ``by`` has a handful of values (folds): each value's set of them is a small array, and pairs come of it.
    """
    packed = F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields)))
    held = rows.where(F.col(by).isNotNull()).select(F.col(by).alias("by"), packed.alias("x")).where("x.value is not null")
    sets = held.groupBy("x.field", "x.value").agg(F.array_sort(F.collect_set("by")).alias("s")).where(F.size("s") > 1).select("field", "s").distinct()
    pairs = sets.select("field", F.explode("s").alias("a"), "s").select("field", "a", F.explode("s").alias("b")).where("a < b").distinct()
    every = rows.sparkSession.createDataFrame([(f,) for f in fields], "field string")
    return every.join(pairs.groupBy("field").agg(F.count("*").alias("n")), "field", "left").select("field", F.coalesce("n", F.lit(0)).alias("n"))


def collapse_targets(members: DataFrame, closure: DataFrame, group: str, concept: str) -> DataFrame:
    """(group, targets, n): the sorted concepts of each group without those that are ancestors of another one of it."""
    from caseloom.operators.ontology import most_specific

    own = most_specific(members, closure, group, concept)
    return own.groupBy(group).agg(F.array_sort(F.collect_set(concept)).alias("targets")).withColumn("n", F.size("targets"))
