import random
from itertools import combinations

from pyspark.sql import functions as F

from caseloom.llm import components, flow, matching, sampling, splits
from caseloom.operators import hamming
from caseloom.operators.ranks import group_rank, unit


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def brute(edges, nodes=()):
    root = {n: n for n in nodes}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {n: find(n) for n in list(root)}


def test_components_random(spark):
    rnd = random.Random(4)
    edges = [(f"n{rnd.randrange(300):03}", f"n{rnd.randrange(300):03}") for _ in range(220)]
    chain = [f"z{x:03}" for x in rnd.sample(range(200), 150)]
    edges += list(zip(chain, chain[1:]))  # a long chain in random order
    edges += [("hub", f"m{i:03}") for i in range(120)] + edges[:30] + [(b, a) for a, b in edges[:30]] + [("solo", "solo")]
    df = spark.createDataFrame([*edges, (None, "x"), ("y", None)], "a string, b string").withColumn("node", F.lit("clash"))
    got = {r["node"]: r["component"] for r in components.connected_components(df).collect()}
    assert got == brute(edges)
    assert components.connected_components(df.limit(0)).count() == 0


def test_star_edges_have_no_pairs(spark):
    df = spark.createDataFrame([("k", i) for i in range(50)] + [("k", 3), (None, 1), ("j", None), ("q", 7)], "k string, n int")
    assert rows(components.star_edges(df, "k", "n").distinct()) == [(0, i) for i in range(1, 50)]


def test_hamming_pairs(spark):
    rnd = random.Random(9)
    base = [rnd.getrandbits(64) for _ in range(30)]
    vals = base + [b ^ sum(1 << k for k in rnd.sample(range(64), n % 7)) for n, b in enumerate(base)]
    crowd = [(1 << 63) | sum(1 << k for k in rnd.sample(range(20), rnd.randrange(1, 6))) for _ in range(120)]  # agree in most blocks
    signed = sorted({v - 2**64 if v >= 2**63 else v for v in vals + crowd})
    want = [(a, b) for a, b in combinations(signed, 2) if bin((a ^ b) & (2**64 - 1)).count("1") <= 4]
    df = spark.createDataFrame([(v,) for v in signed] + [(None,), (signed[0],)], "v long")
    assert rows(hamming.hamming_pairs(df, "v", 4)) == want
    assert rows(hamming.hamming_pairs(df, "v", 4, hot=3)) == want
    assert rows(hamming.hamming_pairs(df.limit(0), "v", 4)) == []


def test_matches(spark):
    img = [("c1", "AB", "0000000000000000"), ("c2", "ab ", "ff00"), ("c3", "", "0xFF03"), ("c4", None, "FF0000000000FF03"), ("c5", "000", None), ("c6", "x", "zz"), ("c1", "AB", "0000000000000000"), ("c7", "000", " "), ("c8", "q", "000000000000ff0f"), (None, "ab", "ff00")]
    grp = [("c6", "g"), ("c9", "g"), ("c5", None), ("c7", ""), ("c8", " 00")]
    i = spark.createDataFrame(img, "case_id string, image_sha256 string, perceptual_hash string").withColumn("group_case_id", F.lit("clash"))
    g = spark.createDataFrame(grp, "case_id string, split_group string")
    got = dict(rows(matching.consolidate_matches(i, g)))
    assert got == {"c1": "c1", "c2": "c1", "c3": "c1", "c8": "c1", "c4": "c4", "c5": "c5", "c6": "c6", "c9": "c6", "c7": "c7"}
    assert rows(matching.consolidate_matches(i.limit(0), g.limit(0))) == []


def test_flow_against_enumeration():
    rnd = random.Random(3)
    for _ in range(30):
        cost = [[rnd.randrange(-5, 9) for _ in range(3)] for _ in range(3)]
        cap = [[rnd.randrange(0, 3) for _ in range(3)] for _ in range(3)]
        net = flow.Network()
        arcs = {(i, j): net.arc(("l", i), ("r", j), cap[i][j], cost[i][j]) for i in range(3) for j in range(3)}
        for i in range(3):
            net.arc("s", ("l", i), 2)
            net.arc(("r", i), "t", 2)
        total = net.solve("s", "t")
        best = None
        cells = list(arcs)

        def walk(k, used, value, price, cells=cells, cap=cap, cost=cost):
            nonlocal best
            if k == len(cells):
                best = max(best, (value, -price)) if best else (value, -price)
                return
            i, j = cells[k]
            for f in range(cap[i][j] + 1):
                if used[i] + f <= 2 and used[3 + j] + f <= 2:
                    u = list(used)
                    u[i] += f
                    u[3 + j] += f
                    walk(k + 1, u, value + f, price + f * cost[i][j])

        walk(0, [0] * 6, 0, 0)
        assert (total, -sum(net.flow(a) * cost[i][j] for (i, j), a in arcs.items())) == best


def test_rounding_keeps_margins():
    rnd = random.Random(8)
    for seed in range(20):
        cells = {(r, c): rnd.random() * 3 for r in range(5) for c in range(4)}
        got = flow.round_margins(cells, seed)
        assert all(abs(got[k] - v) < 1 for k, v in cells.items())
        for axis, n in ((0, 5), (1, 4)):
            for x in range(n):
                assert abs(sum(v for k, v in got.items() if k[axis] == x) - sum(v for k, v in cells.items() if k[axis] == x)) < 1 + 1e-6
    mean = sum(flow.round_margins({("a", "b"): 0.3, ("a", "c"): 0.7}, s)["a", "b"] for s in range(400)) / 400
    assert 0.22 < mean < 0.38


def test_quotas_keep_floors_and_show_what_is_missing():
    for seed in range(150):
        rnd = random.Random(seed)
        cells = [{"label": f"l{i}", "fold": j, "target_share": rnd.random(), "target_rows": rnd.randrange(12), "min_rows": rnd.randrange(6), "available": rnd.choice([0, 1, 3, 8, 20, 50])} for i in range(rnd.randrange(1, 7)) for j in range(rnd.randrange(1, 5))]
        for c, q in zip(cells, sampling.plan_quotas(cells, seed), strict=True):
            floor = max(c["target_rows"], c["min_rows"])
            assert q["wanted"] == floor and q["shortfall"] == max(0, floor - c["available"])
            assert min(floor, c["available"]) <= q["quota"] <= c["available"]


def test_spare_rows_make_up_within_margins():
    cell = lambda label, fold, there: {"label": label, "fold": fold, "target_share": 0.25, "target_rows": 10, "min_rows": 0, "available": there}
    quota = {(q["label"], q["fold"]): q["quota"] for q in sampling.plan_quotas([cell("a", 0, 4), cell("a", 1, 30), cell("b", 0, 30), cell("b", 1, 30)])}
    assert quota["a", 0] == 4 and quota["a", 1] == 10 and sum(quota.values()) == 34  # fold 1 and label b have their margins
    quota = sampling.plan_quotas([{**cell("a", 0, 4), "target_share": 0.5}, {**cell("a", 1, 3), "target_share": 0.5}])
    assert [q["shortfall"] for q in quota] == [6, 7] and [q["quota"] for q in quota] == [4, 3]


def test_many_cells():
    rnd = random.Random(1)
    cells = [{"label": f"l{i}", "fold": j, "target_share": rnd.random(), "target_rows": rnd.randrange(90), "min_rows": 5, "available": rnd.choice([0, 40, 200])} for i in range(12_000) for j in range(5)]
    got = sampling.plan_quotas(cells)
    assert len(got) == 60_000 and all(q["quota"] >= min(q["wanted"], q["available"]) for q in got)


def test_group_rank(spark):
    df = spark.range(2000).select("id", (F.col("id") % 3 == 0).cast("int").alias("g"), unit("id").alias("u"))
    got = group_rank(df, ["g"], "u", ["id"], bins=16).collect()
    for g in (0, 1):
        own = sorted((r for r in got if r["g"] == g), key=lambda r: (r["u"], r["id"]))
        assert [r["rank"] for r in own] == list(range(len(own)))


def test_sample(spark):
    m = [(f"s{i}", f"c{i}", " idx:1" if i % 2 else "IDX:1") for i in range(60)] + [(f"t{i}", f"d{i}", "IDX:2") for i in range(5)] + [("s0", "c0", "IDX:1"), ("n", "c1", None), (None, "c2", "IDX:1"), ("o", "gone", "IDX:1")]
    a = [(f"c{i}", i % 2) for i in range(60)] + [(f"d{i}", 0) for i in range(5)] + [("c0", 0), ("c5", None)]
    t = [("IDX:1", 0, 0.4, 8, 1), ("IDX:1", 1, 0.3, 6, 1), ("IDX:2", 0, 0.2, 4, 6), ("IDX:2", 1, 0.1, 2, 1), ("IDX:3", 0, 0.0, 0, 0)]
    targets = spark.createDataFrame(t, "diagnosis_label string, fold int, target_share double, target_rows long, min_rows long")
    samples = sampling.labelled_samples(spark.createDataFrame(m, "sample_id string, case_id string, diagnosis_label string").withColumn("fold", F.lit(99)), spark.createDataFrame(a, "case_id string, fold int"))
    q = {(r["label"], r["fold"]): r for r in sampling.sample_quotas(samples, targets).collect()}
    assert {k: r["shortfall"] for k, r in q.items()} == {("IDX:1", 0): 0, ("IDX:1", 1): 0, ("IDX:2", 0): 1, ("IDX:2", 1): 2, ("IDX:3", 0): 0}
    assert q["IDX:2", 0]["quota"] == 5 and q["IDX:1", 0]["quota"] >= 8 and q["IDX:1", 1]["quota"] >= 6
    got = sampling.draw_sample(samples, sampling.sample_quotas(samples, targets)).collect()
    assert len(got) == len({r["sample_id"] for r in got}) == sum(r["quota"] for r in q.values())
    assert sampling.sample_quotas(samples.limit(0), targets.limit(0)).count() == 0
    assert all(r["quota"] == 0 for r in sampling.sample_quotas(samples.limit(0), targets).collect())


def test_related_and_torn(spark):
    cases = [("a1", "A", None), ("a2", "A", " P1"), ("b1", "B", "p1 "), ("c1", "C", "unknown"), ("d1", "D", "UNKNOWN "), ("e1", "E", "-"), ("f1", "F", None), ("a1", "A", None), (None, "A", "p1"), ("h1", None, None)]
    groups = [("f1", "g"), ("c1", "g"), ("zz", "g"), ("e1", None)]
    c, g = spark.createDataFrame(cases, "case_id string, article_id string, patient_link_id string"), spark.createDataFrame(groups, "case_id string, split_group string")
    rel = splits.related_cases(c.withColumn("component", F.lit("clash")), g)
    assert dict(rows(rel)) == {"a1": "a1", "a2": "a1", "b1": "a1", "c1": "c1", "f1": "c1", "d1": "d1", "e1": "e1", "h1": "h1"}
    asg = spark.createDataFrame([("a1", "frozen_test"), ("b1", "Frozen-Test "), ("c1", "development"), ("f1", "frozen_test"), ("d1", "development"), ("q", "x"), ("f1", "frozen_test")], "case_id string, partition string")
    assert [r["case_id"] for r in splits.torn_cases(rel, asg).orderBy("case_id").collect()] == ["c1", "f1"]


def test_split_assignment(spark):
    rnd = random.Random(5)
    rel, lab = [], []
    for k in range(900):
        size = 1 if k < 800 else rnd.randrange(2, 6) if k < 899 else 150
        for j in range(size):
            rel.append((f"c{k}_{j}", f"k{k:03}"))
            lab.append((f"c{k}_{j}", f"L{rnd.randrange(3)}" if k % 7 else None))
    t = spark.createDataFrame([("train", 0.7), ("validation", 0.1), ("test", 0.2), (None, 0.5)], "split_name string, target_share double")
    r, l = spark.createDataFrame(rel, "case_id string, component string"), spark.createDataFrame(lab, "case_id string, label string")
    got = splits.assign_splits(r, l, t).collect()
    assert len(got) == len(rel) and len({(x["component"], x["split"]) for x in got}) == 900
    n = {s: sum(x["split"] == s for x in got) / len(got) for s in ("train", "validation", "test")}
    assert abs(n["train"] - 0.7) < 0.03 and abs(n["validation"] - 0.1) < 0.03 and abs(n["test"] - 0.2) < 0.03
    for name in ("L0", "L1", "L2"):
        own = [x["split"] for x in got if dict(lab)[x["case_id"]] == name]
        assert abs(own.count("train") / len(own) - 0.7) < 0.06
    assert splits.assign_splits(r, l, t.limit(0)).count() == 0 and splits.assign_splits(r.limit(0), l, t).count() == 0


def test_split_plan_keeps_every_profile():
    """More bundles than fit in a block, none larger than the others: rare labels are spread as well."""
    rnd = random.Random(4)
    bundles = [{"size": s, "components": rnd.randrange(1, 9), "profile": {f"L{i}": s - s // 3, **({f"M{i % 7}": s // 3} if s > 2 else {})}} for i in range(400) for s in (9, 4, 1)]
    bundles.sort(key=lambda b: -b["size"])
    labels: dict = {}
    for b in bundles:
        for p, n in b["profile"].items():
            labels[p] = labels.get(p, 0) + n * b["components"]
    whole = sum(b["size"] * b["components"] for b in bundles)
    plan, given = splits.SplitPlan({"train": 0.8, "test": 0.2}, whole, labels), []
    for block in splits.plan_blocks(bundles, most=100):
        assert len(block) <= 100
        got = plan.block(block)
        assert all(sum(n) == b["components"] for n, b in zip(got, block, strict=True))
        given += [(b, dict(zip(plan.names, n, strict=True))) for b, n in zip(block, got, strict=True)]
    assert len(given) == len(bundles) and plan.left == 0
    assert abs(sum(b["size"] * n["test"] for b, n in given) / whole - 0.2) < 0.01
    for i in range(7):
        own = [(b["profile"].get(f"M{i}", 0), b["components"], n["test"]) for b, n in given]
        assert abs(sum(a * t for a, _, t in own) / sum(a * c for a, c, _ in own) - 0.2) < 0.1
