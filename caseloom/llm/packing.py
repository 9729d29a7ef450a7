"""Problem 7: documents in containers of fixed capacity."""

from __future__ import annotations

from bisect import bisect_left, insort

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caseloom.operators.ranks import group_rank, unit
from caseloom.session import materialize

SLOTS = "size long, first long, upto long, each long, container long"


def plan_containers(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Slots (size, first, upto, each, container) for ``histogram`` {size: number of items}.

    Best fit over counts, the largest sizes first: equal containers are one entry with a number, and an
    entry takes as many items of the size as fit in each of its containers before the next is looked
    at. The items of rank first..upto-1 within a size go, ``each`` to a container, to consecutive
    containers from ``container`` on. The work depends on the capacity, not on the number of items.
    """
    room: list[tuple[int, int, int]] = []  # (room left, first container, number), sorted
    slots, fresh = [], 0
    for size in sorted((s for s, n in histogram.items() if n > 0), reverse=True):
        left, rank = histogram[size], 0

        def put(space: int, start: int, number: int, size: int = size) -> None:
            """Fill up to ``number`` equal containers; what stays of them goes back to ``room``."""
            nonlocal left, rank
            fit = space // size
            whole = min(number, left // fit)
            for boxes, each in ((whole, fit), (1 if whole < number and left % fit and whole == left // fit else 0, left % fit)):
                if boxes:
                    slots.append((size, rank, rank + boxes * each, each, start))
                    insort(room, (space - each * size, start, boxes))
                    rank, left, start, number = rank + boxes * each, left - boxes * each, start + boxes, number - boxes
            if number and start < fresh:
                insort(room, (space, start, number))

        while left:
            at = bisect_left(room, (size, -1, -1))
            if at < len(room):
                put(*room.pop(at))
            else:
                fit = capacity // size
                need = -(-left // fit)
                start, fresh = fresh, fresh + need
                put(capacity, start, need)
    return slots


def pack_documents(sizes: DataFrame, capacity: int, seed: int = 3) -> DataFrame:
    """(doc_id, piece, pieces, tokens, container) for ``sizes`` with (doc_id, tokens).

    Only a document larger than ``capacity`` is cut: in pieces of the whole capacity, each a container
    of its own, numbered -1, -2, ... by rank of the document among those of as many such pieces, and a
    rest that is packed as other documents are. Documents without tokens take part in no container and
    come out with piece null. Rows with a null doc_id are ignored; a repeated doc_id counts once, with
    its largest size. The sizes are computed once and written. No window or task holds a size.
    """
    spark = sizes.sparkSession
    cap = F.lit(capacity).cast("long")
    docs = sizes.where("doc_id is not null").select("doc_id", F.coalesce("tokens", F.lit(0)).cast("long").alias("tokens"))
    docs = docs.groupBy("doc_id").agg(F.max("tokens").alias("tokens"))
    full, rest = F.floor(F.col("tokens") / cap).cast("long"), F.col("tokens") % cap
    docs = materialize(docs.withColumn("full", full).withColumn("rest", rest).withColumn("pieces", full + (rest > 0).cast("long")), "sizes")
    histogram = {r[0]: r[1] for r in docs.where("rest > 0").groupBy("rest").count().collect()}  # fewer rows than the capacity
    plan = spark.createDataFrame(plan_containers(histogram, capacity), SLOTS)
    ranked = group_rank(docs.where("rest > 0").withColumn("u", unit("doc_id", seed=seed)), ["rest"], "u", ["doc_id"])
    slot = F.broadcast(plan.withColumnRenamed("size", "rest"))  # bounded by the capacity
    placed = ranked.join(slot, "rest").where("rank >= first and rank < upto")
    last = placed.select("doc_id", F.col("pieces").alias("piece"), "pieces", F.col("rest").alias("tokens"), (F.col("container") + F.expr("(rank - first) div each")).alias("container"))
    # A document of f whole pieces takes the f numbers after those of smaller f and of lower rank within f.
    long = docs.where("full > 0")
    ahead = Window.orderBy("full").rowsBetween(Window.unboundedPreceding, -1)
    starts = long.groupBy("full").agg(F.count("*").alias("n")).select("full", F.coalesce(F.sum(F.col("full") * F.col("n")).over(ahead), F.lit(0)).alias("start"))  # n documents of m tokens have at most sqrt(2 m) different numbers of pieces
    numbered = group_rank(long.withColumn("u", unit("doc_id", seed=seed)), ["full"], "u", ["doc_id"]).join(starts, "full")
    whole = numbered.select("doc_id", F.explode(F.expr("sequence(1L, full)")).alias("piece"), "pieces", cap.alias("tokens"), (-(F.col("start") + F.col("rank") * F.col("full"))).alias("base"))
    whole = whole.withColumn("container", F.col("base") - F.col("piece")).drop("base")
    none = docs.where("tokens = 0").select("doc_id", F.lit(None).cast("long").alias("piece"), F.lit(0).cast("long").alias("pieces"), F.lit(0).cast("long").alias("tokens"), F.lit(None).cast("long").alias("container"))
    return last.unionByName(whole).unionByName(none)
