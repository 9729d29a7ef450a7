"""Problem 2: one decision per case from annotators of uneven reliability."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.session import discard, is_small, materialize

DECISIONS = ("accept", "reject", "uncertain")
#: Most annotators whose parameters are broadcast; beyond, they are joined by a shuffle.
MOST_BROADCAST = 100_000
#: Most rounds of the power iteration, the largest move that ends it, and the share of the old vector that is kept.
ROUNDS, CLOSE, KEPT = 30, 2e-3, 0.25
#: Rows that an annotator's estimates start with.
PRIOR_WEIGHT, PRIOR_ROWS = 5.0, 10.0


def clean_decision(value: Column) -> Column:
    """0, 1, 2 for accept, reject, uncertain (case, outer blanks, past tense aside); null for all else."""
    v = F.regexp_replace(F.lower(F.regexp_replace(value, r"(?U)^\s+|\s+$", "")), "^(accept|reject)ed$", "$1")
    return F.when(v == "accept", 0).when(v == "reject", 1).when(v == "uncertain", 2)


def latest_votes(reviews: DataFrame, cases: DataFrame) -> DataFrame:
    """(case_id, annotator, vote): of each annotator the latest decision that counts.

    ``reviews`` has (case_id, annotator, decision, raw_text_sha256, reviewed_at). A decision counts if it
    is one of the three and was made on the text that ``cases`` has. Times are compared as instants,
    unreadable ones as the earliest; of decisions at the same instant the later in DECISIONS holds.
    """
    text = cases.select("case_id", "raw_text_sha256").where("case_id is not null and raw_text_sha256 is not null").distinct()
    rows = reviews.withColumn("vote", clean_decision(F.col("decision"))).where("vote is not null and annotator is not null")
    rows = rows.join(text, ["case_id", "raw_text_sha256"])
    at = F.coalesce(F.unix_micros(F.expr("try_cast(reviewed_at as timestamp)")), F.lit(-(2**62)))
    return rows.groupBy("case_id", "annotator").agg(F.max(F.struct(at.alias("at"), "vote")).alias("last")).select("case_id", "annotator", F.col("last.vote").alias("vote"))


def _voted(k: int):
    """A test for votes ``k``; a second argument of the lambda would be taken for the index."""
    return lambda x: x["vote"] == k


class Consensus:
    """The consensus of ``votes`` (case_id, annotator, vote), one vote an annotator and case.

    Cases with the same ballot are counted as one pattern. The annotators' reliabilities are the leading
    eigenvector of the matrix of their agreement beyond chance, where chance follows each one's own
    shares of decisions and each entry is weighted by the number of cases both voted on. Its products are
    sums over the votes joined with the vector, so neither the matrix nor pairs of votes are formed. The
    reliabilities weight the votes, and the weighted votes decide. From that consensus each annotator's
    share of each vote given each merited decision is estimated for the report; only with ``refine`` above
    0 do these shares weight the votes anew, that many times, for annotators who err in one direction.
    """

    def __init__(self, votes: DataFrame, refine: int = 0) -> None:
        ballots = votes.groupBy("case_id").agg(F.sort_array(F.collect_set(F.struct("annotator", "vote"))).alias("ballot"))
        self.cases = materialize(ballots.withColumn("pattern", F.xxhash64("ballot")), "ballots")
        patterns = self.cases.groupBy("pattern").agg(F.first("ballot").alias("ballot"), F.count("*").cast("double").alias("n"))
        self.rows = materialize(patterns.select("pattern", "n", F.inline("ballot")), "patterns")
        share = [F.sum(F.when(F.col("vote") == k, F.col("n")).otherwise(0.0)) for k in range(3)]
        self.annotators = materialize(self.rows.groupBy("annotator").agg(F.sum("n").alias("total"), *((s / F.sum("n")).alias(f"c{k}") for k, s in enumerate(share))), "annotators")
        self.small = is_small(self.annotators, MOST_BROADCAST)
        self.reliability = self._power()
        self.scores = self._spectral_scores()
        for _ in range(refine):
            self._refine()

    def _with(self, rows: DataFrame, params: DataFrame) -> DataFrame:
        """``rows`` with the annotators' ``params``, a row each."""
        return rows.join(F.broadcast(params) if self.small else params, "annotator")

    def _power(self) -> DataFrame:
        """(annotator, total, c0, c1, c2, v, p): v of the eigenvector, p the chance of the merited decision."""
        state = self.annotators.withColumn("v", F.lit(0.7))
        usual, done, c = 0.49, None, [F.col(f"c{k}") for k in range(3)]
        for self.rounds in range(1, ROUNDS + 1):
            rows = self._with(self.rows, state)
            case = rows.groupBy("pattern").agg(
                *(F.sum(F.when(F.col("vote") == k, F.col("v")).otherwise(0.0)).alias(f"V{k}") for k in range(3)),
                *(F.sum(c[k] * F.col("v")).alias(f"U{k}") for k in range(3)),
                F.sum(F.col("v") * F.col("v")).alias("Q"),
            )
            both = rows.join(case, "pattern")
            alike = F.element_at(F.array("V0", "V1", "V2"), F.col("vote") + 1) - F.col("v")
            chance = sum((c[k] * (F.col(f"U{k}") - c[k] * F.col("v")) for k in range(3)), F.lit(0.0))
            sums = both.groupBy("annotator").agg(F.sum(F.col("n") * (alike - chance)).alias("num"), F.sum(F.col("n") * (F.col("Q") - F.col("v") * F.col("v"))).alias("den"))
            step = F.col("num") / (F.col("den") + PRIOR_WEIGHT * usual + 1e-9)
            new = state.withColumnRenamed("v", "old").join(sums, "annotator").select("annotator", "total", *c, step.alias("step"), "old")
            new = materialize(new, "vector")
            moved, size, old = new.agg(F.max(F.abs(F.col("step") - F.col("old"))), F.avg(F.col("step") * F.col("step")), F.avg(F.col("old") * F.col("old"))).first()
            if done is not None:
                discard(done)
            done = new
            if moved is None:  # no votes
                break
            # The step's length is inverse to the old one's: their geometric mean is what the fixed point has.
            scale = (old / size) ** 0.25 if size > 0 else 1.0
            state = new.select("annotator", "total", *c, (F.col("old") * KEPT + F.col("step") * (scale * (1 - KEPT))).alias("v"))
            usual = (old * size) ** 0.5
            if moved < CLOSE:
                break
        weight = F.pow(F.greatest("v", F.lit(0.0)), 2) * F.col("total")
        first = state.agg(*(F.sum(weight * x).alias(f"r{k}") for k, x in enumerate(c)), F.sum(weight).alias("w")).first()
        self.prior = [(first[f"r{k}"] or 0.0) / first["w"] if first["w"] else 1 / 3 for k in range(3)]
        spread = max(1e-6, 1 - sum(r * r for r in self.prior)) ** 0.5
        p = F.least(F.lit(0.98), F.greatest(F.lit(0.02), (1 + 2 * F.col("v") / spread) / 3))
        return materialize(state.withColumn("p", p), "reliability")

    def _totals(self, gains: list[Column], rows: DataFrame) -> DataFrame:
        """(pattern, s0, s1, s2): log scores of the decisions."""
        import math

        return materialize(rows.groupBy("pattern").agg(*((F.sum(g) + math.log(max(self.prior[k], 1e-6))).alias(f"s{k}") for k, g in enumerate(gains))), "scores")

    def _spectral_scores(self) -> DataFrame:
        rows = self._with(self.rows, self.reliability.select("annotator", "p"))
        weight = F.log(2 * F.col("p") / (1 - F.col("p")))
        return self._totals([F.when(F.col("vote") == k, weight).otherwise(0.0) for k in range(3)], rows)

    @staticmethod
    def _posterior(scores: DataFrame) -> DataFrame:
        top = F.greatest("s0", "s1", "s2")
        e = [F.exp(F.col(f"s{k}") - top) for k in range(3)]
        return scores.select("pattern", *((e[k] / (e[0] + e[1] + e[2])).alias(f"q{k}") for k in range(3)))

    def _confusion(self, rows: DataFrame) -> DataFrame:
        """(annotator, tck): the share of vote k given decision c, from ``rows`` with the posterior shares of their pattern."""
        cells = [F.sum(F.when(F.col("vote") == k, F.col("n") * F.col(f"q{c}")).otherwise(0.0)).alias(f"m{c}{k}") for c in range(3) for k in range(3)]
        counts = rows.groupBy("annotator").agg(*cells).join(self.reliability.select("annotator", "p"), "annotator")
        table = []
        for c in range(3):
            prior = [F.lit(PRIOR_ROWS) * (F.col("p") if k == c else (1 - F.col("p")) / 2) for k in range(3)]
            whole = sum((F.col(f"m{c}{k}") for k in range(3)), F.lit(PRIOR_ROWS))
            table += [((F.col(f"m{c}{k}") + prior[k]) / whole).alias(f"t{c}{k}") for k in range(3)]
        return materialize(counts.select("annotator", *table), "confusion")

    def _refine(self) -> None:
        rows = self.rows.join(self._posterior(self.scores), "pattern")
        sums = rows.select("pattern", "n", "q0", "q1", "q2").distinct().agg(*(F.sum(F.col("n") * F.col(f"q{k}")).alias(f"r{k}") for k in range(3)), F.sum("n").alias("n")).first()
        if sums["n"]:
            self.prior = [sums[f"r{k}"] / sums["n"] for k in range(3)]
        rows = self._with(self.rows, self._confusion(rows))
        self.scores = self._totals([F.log(F.element_at(F.array(*(F.col(f"t{c}{k}") for k in range(3))), F.col("vote") + 1)) for c in range(3)], rows)

    def decisions(self) -> DataFrame:
        """(case_id, votes, agreement, consensus_decision, confidence), one row for each case with a vote.

        agreement is the share of pairs of votes that are equal, null for a single vote; confidence is the
        posterior share of the decision. Ties go to the first of accept, reject, uncertain.
        """
        q = [F.col(f"q{k}") for k in range(3)]
        best = F.greatest(*q)
        name = F.when(q[0] == best, DECISIONS[0]).when(q[1] == best, DECISIONS[1]).otherwise(DECISIONS[2])
        n = F.size("ballot").cast("double")
        same = [F.size(F.filter("ballot", _voted(k))).cast("double") for k in range(3)]
        alike = F.when(n > 1, sum((m * (m - 1) for m in same), F.lit(0.0)) / (n * (n - 1)))
        out = self.cases.join(self._posterior(self.scores), "pattern")
        return out.select("case_id", n.cast("long").alias("votes"), F.round(alike, 6).alias("agreement"), name.alias("consensus_decision"), F.round(best, 6).alias("confidence"))

    def annotator_reliability(self) -> DataFrame:
        """(annotator, votes, reliability, right_accept, right_reject, right_uncertain)."""
        right = [F.round(f"t{k}{k}", 6).alias("right_" + d) for k, d in enumerate(DECISIONS)]
        shares = self._confusion(self.rows.join(self._posterior(self.scores), "pattern"))
        return self.reliability.join(shares, "annotator").select("annotator", F.col("total").cast("long").alias("votes"), F.round("p", 6).alias("reliability"), *right)


def contested(decisions: DataFrame) -> DataFrame:
    """(case_id, consensus_decision) of cases with at least three votes that are not all equal."""
    return decisions.where("votes >= 3 and agreement < 1").select("case_id", "consensus_decision")


def all_reviews(reviewer_a: DataFrame, reviewer_b: DataFrame, machine: DataFrame, people: DataFrame) -> DataFrame:
    """The four label tables as (case_id, annotator, decision, raw_text_sha256, reviewed_at)."""
    parts = []
    for tag, df, who, dec in (("a", reviewer_a, F.col("model"), "decision"), ("b", reviewer_b, F.col("model"), "decision"), ("m", machine, F.col("model"), "decision"), ("h", people, F.lower(F.trim("reviewer_id")), "human_decision")):
        parts.append(df.select("case_id", F.concat(F.lit(tag + ":"), who).alias("annotator"), F.col(dec).alias("decision"), "raw_text_sha256", "reviewed_at"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
