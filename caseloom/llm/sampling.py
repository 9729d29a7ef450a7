"""Problem 5: a sample that follows target proportions over cross-classified cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseloom.llm.flow import Network, round_margins
from caseloom.operators.ranks import group_rank, unit
from caseloom.session import is_small

#: Rows of quotas that are broadcast; beyond, they are joined by a shuffle.
MOST_BROADCAST = 100_000


def clean_label(value: Column) -> Column:
    """A label in upper case without outer blanks; null if blank."""
    v = F.upper(F.regexp_replace(value, r"(?U)^\s+|\s+$", ""))
    return F.when(v != "", v)


def labelled_samples(manifest: DataFrame, assignments: DataFrame) -> DataFrame:
    """Distinct (sample_id, label, fold): the label of the manifest, the fold of the case's assignment."""
    folds = assignments.select("case_id", "fold").where("fold is not null and case_id is not null").distinct()
    rows = manifest.select("sample_id", "case_id", clean_label(F.col("diagnosis_label")).alias("label"))
    return rows.where("sample_id is not null and label is not null").join(folds, "case_id").select("sample_id", "label", "fold").distinct()


def plan_quotas(cells: list[dict], seed: int = 7) -> list[dict]:
    """Integer quotas for ``cells`` (label, fold, target_share, target_rows, min_rows, available).

    A network from labels to folds: the arcs of the source carry the label margins, those of the sink
    the fold margins, those between the cells. A cell's floor, the larger of target_rows and min_rows,
    is a lower bound: as far as rows are there it is sent first over the cell's own arc, and what is
    missing over its slack arc, which is the cell's shortfall. Lower bounds leave the network with
    the margins they use, so no later path can take them back. The rest of the margins goes over the
    rows up to each cell's randomly rounded share and, at rising cost, over spare rows that make up
    for other cells of the same label and fold.
    """
    total = sum(c["target_rows"] or 0 for c in cells)
    share = sum(c["target_share"] or 0 for c in cells) or 1
    wish = round_margins({(c["label"], c["fold"]): total * (c["target_share"] or 0) / share for c in cells}, seed)
    net, rows, by_label, by_fold = Network(), [], {}, {}
    for c in cells:
        floor = max(c["target_rows"] or 0, c["min_rows"] or 0)
        goal, there = max(floor, wish[c["label"], c["fold"]]), c["available"]
        bound, slack = min(there, floor), max(0, floor - there)
        label, fold = ("label", c["label"]), ("fold", c["fold"])
        more = [net.arc(label, fold, max(0, min(there, goal) - floor), 0)]
        left = max(0, there - goal)
        for cost, part in ((10, goal // 4 + 1), (30, goal + 1), (90, left)):
            more.append(net.arc(label, fold, min(left, part), cost))
            left -= min(left, part)
        by_label[label] = by_label.get(label, 0) + goal - bound
        by_fold[fold] = by_fold.get(fold, 0) + goal - bound
        rows.append((c, floor, bound, more, slack))
    for name, margin in by_label.items():
        net.arc("source", name, margin)
    for name, margin in by_fold.items():
        net.arc(name, "sink", margin)
    net.solve("source", "sink")
    return [
        {"label": c["label"], "fold": c["fold"], "available": c["available"], "wanted": floor, "quota": bound + sum(map(net.flow, more)), "shortfall": slack}
        for c, floor, bound, more, slack in rows
    ]


QUOTAS = T.StructType([T.StructField("label", T.StringType()), T.StructField("fold", T.IntegerType()), *(T.StructField(n, T.LongType()) for n in ("available", "wanted", "quota", "shortfall"))])


def sample_quotas(samples: DataFrame, targets: DataFrame, seed: int = 7) -> DataFrame:
    """(label, fold, available, wanted, quota, shortfall), one row for each distinct cell of ``targets``.

    ``samples`` has distinct (sample_id, label, fold). Null targets count as 0; a cell that stands
    twice in ``targets`` takes the larger figures; cells of samples without a target are not drawn.
    The plan is made on the driver over the target cells, never over samples, in time about proportional
    to the cells.
    """
    spark = samples.sparkSession
    want = targets.select(clean_label(F.col("diagnosis_label")).alias("label"), F.col("fold").cast("int").alias("fold"), "target_share", "target_rows", "min_rows")
    want = want.where("label is not null and fold is not null").groupBy("label", "fold").agg(*(F.max(n).alias(n) for n in ("target_share", "target_rows", "min_rows")))
    have = samples.groupBy("label", "fold").agg(F.count("*").alias("available"))
    rows = want.join(have, ["label", "fold"], "left").fillna(0, ["available"]).collect()  # target cells
    cells = sorted((r.asDict() for r in rows), key=lambda r: (r["label"], r["fold"]))
    return spark.createDataFrame([tuple(q[f.name] for f in QUOTAS) for q in plan_quotas(cells, seed)], QUOTAS)


def draw_sample(samples: DataFrame, quotas: DataFrame, seed: int = 7) -> DataFrame:
    """(sample_id, label, fold): of each cell as many samples as its quota, those first in hash order."""
    wanted = quotas.select("label", "fold", "quota").where("quota > 0")
    rows = samples.join(F.broadcast(wanted) if is_small(wanted, MOST_BROADCAST) else wanted, ["label", "fold"])
    ranked = group_rank(rows.withColumn("u", unit("sample_id", seed=seed)), ["label", "fold"], "u", ["sample_id"])
    return ranked.where("rank < quota").select("sample_id", "label", "fold")
