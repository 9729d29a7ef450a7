"""Reviews by an outside reviewer: source-bound requests, cached results, retries, atomic imports."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.functions.text import canonical_json, occurrences
from caseloom.session import ship

ship(__name__)

RESULT = "decision string, diagnosis_status string, evidence_quote string, confidence string, other_target_diseases array<string>, reason string"
# Fixed values of a review result.
DECISIONS, CONFIDENCE = ["accept", "reject", "uncertain"], ["low", "medium", "high"]
STATUSES = ["confirmed", "probable", "suspected", "differential", "ruled_out", "historical", "unclear"]


def valid_model(name: Column) -> Column:
    """Whether ``name`` can be a model's id: letters, digits, and dots, colons, slashes, underscores or hyphens inside."""
    return F.coalesce(name.rlike(r"^[A-Za-z0-9][A-Za-z0-9._:/-]{0,199}\z"), F.lit(False))


def requests(rows: DataFrame, kind: str, payload: dict[str, Column], model: str, prompt_version: str) -> DataFrame:
    """``rows`` with payload_json and request_sha256, the digest of all that the answer depends on."""
    body = canonical_json(**payload)
    key = canonical_json(kind=F.lit(kind), model=F.lit(model), payload=body, prompt_version=F.lit(prompt_version))
    return rows.withColumn("payload_json", body).withColumn("request_sha256", F.sha2(key, 256))


def problem(result_json: Column, source_text: Column) -> Column:
    """Why a result cannot be used, or null: shape, values, or a quote that is not in the source just once."""
    r = F.from_json(result_json, RESULT)
    others = F.size(F.coalesce(r["other_target_diseases"], F.array().cast("array<string>"))) > 0
    accepted = r["decision"] == "accept"
    return (
        F.when(F.json_object_keys(result_json).isNull(), "MALFORMED")
        .when(~F.coalesce(r["decision"].isin(DECISIONS), F.lit(False)), "DECISION")
        .when(~F.coalesce(r["diagnosis_status"].isin(STATUSES), F.lit(False)), "STATUS")
        .when(~F.coalesce(r["confidence"].isin(CONFIDENCE), F.lit(False)), "CONFIDENCE")
        .when(accepted & ((r["diagnosis_status"] != "confirmed") | others), "ACCEPT_CONTRADICTS")
        .when(accepted & (occurrences(source_text, r["evidence_quote"]) != 1), "EVIDENCE")
    )


class TooManyRequests(Exception):
    """A reviewer's service asks to stop; what is not answered yet stays due."""


class Limited:
    """``reviewer`` called no more than ``per_minute`` times a minute in one worker; failures wait longer each time.

    After ``tries`` failures in a row the last one goes on to the caller, TooManyRequests at once.
    """

    def __init__(self, reviewer: Callable[[str, int, str | None], str], per_minute: float, tries: int = 3, pause: float = 2.0, most_pause: float = 30.0) -> None:
        self.reviewer, self.gap, self.tries, self.pause, self.most_pause = reviewer, 60.0 / per_minute, tries, pause, most_pause
        self.next = 0.0

    def __call__(self, payload: str, attempt: int, problem: str | None) -> str:
        import time

        for n in range(self.tries):
            time.sleep(max(0.0, self.next - time.monotonic()))
            self.next = time.monotonic() + self.gap
            try:
                return self.reviewer(payload, attempt, problem)
            except TooManyRequests:
                raise
            except Exception:  # noqa: BLE001
                if n + 1 == self.tries:
                    raise
                time.sleep(min(self.pause * 2**n, self.most_pause))
        raise AssertionError


def run_reviews(jobs: DataFrame, reviewer: Callable[[str, int, str | None], str], check: Callable[[str, str], str | None], attempts: int = 3) -> DataFrame:
    """(request_sha256, result_json, attempts_json, problem, terminal) for ``jobs`` (request_sha256, payload_json).

    ``reviewer(payload, attempt, last problem)`` answers a request; ``check(payload, answer)`` names what
    is wrong with the answer. After ``attempts`` answers that do not hold the failure is terminal; an
    exception is not, so the job comes again. One job's failure leaves the others alone, but after
    TooManyRequests the partition's remaining jobs are not tried.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        stopped = False
        for batch in batches:
            out = []
            for key, payload in zip(batch["request_sha256"], batch["payload_json"], strict=True):
                if stopped:
                    out.append((key, None, "[]", "STOPPED", False))
                    continue
                tried, wrong, answer, terminal = [], None, None, False
                try:
                    for n in range(attempts):
                        answer = reviewer(payload, n, wrong)
                        tried.append(answer)
                        wrong = check(payload, answer)
                        if wrong is None:
                            break
                    terminal = wrong is not None
                except Exception as e:  # noqa: BLE001
                    wrong = f"{type(e).__name__}: {e}"[:300]
                    stopped = type(e).__name__ == TooManyRequests.__name__  # the class comes by value
                out.append((key, answer if wrong is None else None, json.dumps(tried), wrong, terminal))
            yield pd.DataFrame(out, columns=["request_sha256", "result_json", "attempts_json", "problem", "terminal"])

    return jobs.select("request_sha256", "payload_json").mapInPandas(run, "request_sha256 string, result_json string, attempts_json string, problem string, terminal boolean")


def due(jobs: DataFrame, cache: DataFrame, failures: DataFrame) -> DataFrame:
    """Jobs without a cached result and without a terminal failure; a changed request is due again."""
    out = jobs.join(cache.select("request_sha256").distinct(), "request_sha256", "left_anti")
    return out.join(failures.where("terminal").select("request_sha256").distinct(), "request_sha256", "left_anti")


def recover(failures: DataFrame, jobs: DataFrame, source: str) -> DataFrame:
    """(request_sha256, result_json): of failures of current jobs the last stored answer that now holds."""
    tried = failures.join(jobs.select("request_sha256", source), "request_sha256").select("request_sha256", source, F.posexplode(F.from_json("attempts_json", "array<string>")).alias("n", "answer"))
    good = tried.where(problem(F.col("answer"), F.col(source)).isNull())
    return good.groupBy("request_sha256").agg(F.max_by("answer", "n").alias("result_json"))


def import_results(lines: DataFrame, jobs: DataFrame, cache: DataFrame, source: str) -> DataFrame:
    """The rows that ``lines`` (request_sha256, result_json) add to ``cache``, or an error if any line does not hold.

    All lines are checked before one is taken: unknown or stale requests, unusable results, several
    results of one request, results that contradict the cache. What the cache has already is left out.
    """
    checked = lines.join(jobs.select("request_sha256", F.col(source).alias("__s")), "request_sha256", "left")
    bad = F.when(F.col("__s").isNull(), "STALE").otherwise(problem(F.col("result_json"), F.col("__s")))
    both = lines.select("request_sha256", "result_json").unionByName(cache.select("request_sha256", "result_json"))
    torn = both.groupBy("request_sha256").agg(F.min("result_json").alias("a"), F.max("result_json").alias("b")).where("a <> b").select("request_sha256", F.lit("CONFLICT").alias("bad"))
    wrong = checked.select("request_sha256", bad.alias("bad")).where("bad is not null").unionByName(torn.join(lines.select("request_sha256").distinct(), "request_sha256"))
    if rows := wrong.limit(5).collect():
        raise ValueError(f"nothing was imported: {[tuple(r) for r in rows]}")
    return lines.select("request_sha256", "result_json").distinct().join(cache.select("request_sha256").distinct(), "request_sha256", "left_anti")
