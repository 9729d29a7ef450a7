import random
import zlib
from struct import pack

import pytest
from pyspark.sql import functions as F

from caseloom.operators import assertions, components, decisions, matcher, normalize, ontology, quality, records, splits


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_matcher_offsets():
    f = matcher.AliasFinder([("Virus Infection", "c1"), ("infection", "c2"), ("İx", "c3"), ("", "c4")])
    t = "α virus infection β; myvirus infection_ and İX."
    assert [(c, t[a:b]) for c, _, a, b in f.find(t)] == [("c1", "virus infection"), ("c2", "infection"), ("c2", "infection"), ("c3", "İX")]
    assert f.find(None) == [] and f.find("") == [] and matcher.AliasFinder([]).find("x") == []


def test_matcher_frame(spark):
    t = spark.createDataFrame([("a", "Dengue and dengue fever."), ("b", None), ("c", "")], "id string, x string")
    al = spark.createDataFrame([("dengue", "d"), ("dengue fever", "df"), (None, "n")], "alias string, concept_id string")
    got = rows(matcher.find_aliases(t, al, "id", "x").select("id", "concept_id", "start", "end"))
    assert got == [("a", "d", 0, 6), ("a", "d", 11, 17), ("a", "df", 11, 23)]
    assert rows(matcher.find_aliases(t, al.limit(0), "id", "x")) == []


CASES = [
    ("PCR confirmed ", ".", "confirmed"), ("The patient was diagnosed with severe ", " today", "confirmed"), ("Suspected ", ".", "suspected"), ("", " was ruled out.", "ruled_out"),
    ("History of ", ".", "historical"), ("The mother had ", ".", "historical"), ("No evidence of ", ".", "ruled_out"), ("Dengue versus ", ".", "differential"), ("Probable ", "", "probable"),
    ("History of asthma; confirmed ", "", "confirmed"), ("It was never formally diagnosed as ", "", "ruled_out"), ("Seen with ", " but not confirmed", "unclear"), (None, None, "unclear"), ("", " was confirmed", "confirmed"), ("", "\u00a0confirmed", "confirmed"),
]


def test_mention_status(spark):
    df = spark.createDataFrame(CASES, "b string, a string, want string").select("want", assertions.mention_status(F.col("b"), F.col("a")).alias("got"))
    assert all(r["want"] == r["got"] for r in df.collect()), df.collect()


def test_diagnose(spark):
    t = "The PCR confirmed dengue. Dengue was not confirmed. Possible measles.\nno end mark measles\nX."
    texts = spark.createDataFrame([("a", t)], "id string, t string")
    al = spark.createDataFrame([("dengue", "d"), ("measles", "m")], "alias string, concept_id string")
    got = {r["concept_id"]: r for r in assertions.diagnose(texts, matcher.find_aliases(texts, al, "id", "t"), "id", "t").collect()}
    assert got["d"]["status"] == "unclear" and got["d"]["reason"] == "CONTRADICTORY_ASSERTIONS" and got["d"]["evidence"] == "The PCR confirmed dengue."
    assert got["m"]["status"] == "suspected" and t[got["m"]["evidence_start"] : got["m"]["evidence_end"]] == got["m"]["evidence"] == " Possible measles."


OBO = """format-version: 1.2

[Term]
id: X:1
name: viral disease
synonym: "virus disease" EXACT []
synonym: "vd" EXACT []

[Term]
id: X:2
name: old
is_obsolete: true

[Term]
id: X:3
name: flu
synonym: "influenza" EXACT []
synonym: "grippe" RELATED []
is_a: X:1 ! viral disease

[Typedef]
id: part_of
name: part of
"""


def test_ontology(spark, tmp_path):
    (tmp_path / "o.obo").write_text(OBO)
    terms = ontology.read_obo(spark, str(tmp_path / "o.obo"), 3, spark.createDataFrame([("X:3", "grip")], "concept_id string, alias string"))
    got = {r["concept_id"]: r for r in terms.collect()}
    assert set(got) == {"X:1", "X:3"} and got["X:3"]["aliases"] == ["flu", "grip", "influenza"] and got["X:3"]["parents"] == ["X:1"] and got["X:1"]["aliases"] == ["viral disease", "virus disease"]
    e = spark.createDataFrame([("d", "c"), ("c", "b"), ("b", "a"), ("e", "b"), ("e", None)], "x string, y string")
    up = ontology.ancestors(e, "x", "y")
    assert rows(up) == sorted([("d", "c"), ("d", "b"), ("d", "a"), ("c", "b"), ("c", "a"), ("b", "a"), ("e", "b"), ("e", "a")])
    m = spark.createDataFrame([(1, "d"), (1, "b"), (1, "e"), (2, "a")], "g int, c string")
    assert rows(ontology.most_specific(m, up, "g", "c")) == [(1, "d"), (1, "e"), (2, "a")]
    with pytest.raises(ValueError, match="cycle"):
        ontology.ancestors(spark.createDataFrame([("a", "b"), ("b", "a")], "x string, y string"), "x", "y")


def brute_components(edges):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {n: find(n) for n in list(root)}


def test_components(spark):
    rnd = random.Random(2)
    edges = [(rnd.randrange(200), rnd.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 360)] + [(500, 500 + i) for i in range(1, 40)]
    want = {n: r for n, r in brute_components([e for e in edges if e[0] != e[1]]).items()}
    got = components.components(spark.createDataFrame(edges, "u long, v long"))
    assert {r["node"]: r["root"] for r in got.collect()} == want
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_near_hashes(spark):
    rnd = random.Random(1)
    base = [rnd.getrandbits(64) for _ in range(40)]
    vals = base + [b ^ sum(1 << k for k in rnd.sample(range(64), n % 7)) for n, b in enumerate(base)] + [base[0]]
    signed = [v - 2**64 if v >= 2**63 else v for v in vals]
    df = spark.createDataFrame([(f"k{i:03}", v) for i, v in enumerate(signed)], "k string, v long").withColumn("r", F.lit("clash"))
    first = {v: f"k{vals.index(v):03}" for v in vals}
    want = sorted((*sorted((first[x], first[y])), bin(x ^ y).count("1")) for x in first for y in first if x < y and bin(x ^ y).count("1") <= 4)
    pairs, members = components.near_hashes(df, "k", F.col("v"), 4)
    assert rows(pairs) == want and rows(members) == sorted((f"k{i:03}", first[v]) for i, v in enumerate(vals))
    assert all(x.count() == 0 for x in components.near_hashes(df.limit(0), "k", F.col("v"), 4))


def test_records(spark, tmp_path):
    df = spark.createDataFrame([("a", "2025-01-01T10:00:00+05:30", 1), ("a", "2025-01-01T05:00:00Z", 2), ("a", "bad", 3), ("b", None, 4)], "k string, t string, n int")
    assert rows(records.latest_by(df, ["k"], [records.instant(F.col("t")), F.col("n")]).select("k", "n")) == [("a", 2), ("b", 4)]
    img = spark.createDataFrame([("c", "i2", "weak", "ct", "x", 5, 5), ("c", "i1", "strong", "mri", "", 9, 9), ("c", "i0", "strong", "mri", "cap", 1, 1), ("d", "i9", None, None, None, None, None)], "case_id string, image_id string, image_relevance string, image_modality string, caption string, width int, height int")
    assert rows(records.best_images(img, ["strong", "weak"], ["ct", "mri"]).select("case_id", "image_id")) == [("c", "i0"), ("d", "i9")]
    old, new = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n int"), spark.createDataFrame([("b", 3), ("c", 4), ("c", 4)], "k string, n int")
    assert rows(records.upsert(old, new.distinct(), ["k"])) == [("a", 1), ("b", 3), ("c", 4)]
    assert rows(records.append_new(old, new, ["k"])) == [("a", 1), ("b", 2), ("c", 4)]
    log = str(tmp_path / "log")
    for frame in (old, new, new):
        records.append_audit(log, frame, ["k"])
    assert rows(spark.read.parquet(log)) == [("a", 1), ("b", 2), ("c", 4)]
    again = records.append_new(records.append_new(old, new, ["k"]), new, ["k"])
    assert again.count() == 3
    assert rows(records.first_pending(old, new, ["k"], 5)) == [("a", 1)]
    assert records.same_set(old, old.unionByName(old)) and not records.same_set(old, new)
    flags = spark.createDataFrame([(True, None), (None, True), (None, None)], "x boolean, y boolean")
    assert [r[0] for r in flags.select(records.ladder((F.col("x"), "X"), (F.col("y"), "Y"), otherwise="Z")).collect()] == ["X", "Y", "Z"]
    assert [r[0] for r in flags.select(records.reasons((F.col("x"), "X"), (F.col("y"), "Y"))).collect()] == [["X"], ["Y"], []]
    cache = spark.createDataFrame([("h1", "r"), ("h2", "s"), ("h2", "t")], "h string, r string")
    assert rows(records.conflicting(cache, "h", "r")) == [("h2",)]
    assert rows(records.reuse_results(spark.createDataFrame([("h1",), ("h9",)], "h string"), cache.where("h = 'h1'"), "h")) == [("h1", "r", True), ("h9", None, False)]


def test_normalize(spark):
    df = spark.createDataFrame([("a", [("c1", "t"), ("c2", None)]), ("b", [])], "article_id string, cases array<struct<case_id:string,t:string>>")
    assert rows(normalize.flatten_records(df, "cases", ["article_id"])) == [("a", "c1", "t"), ("a", "c2", None)]
    one = spark.createDataFrame([("a", ("c1", "own"))], "article_id string, cases struct<case_id:string,article_id:string>")
    assert rows(normalize.flatten_records(one, "cases", ["article_id"])) == [("c1", "own")]
    flat = spark.createDataFrame([("a", "c")], "article_id string, case_id string")
    assert rows(normalize.flatten_records(flat, "cases")) == [("a", "c")]
    assert {tuple(r) for r in normalize.duplicate_keys(spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "k string"), "k").collect()} == {(None, 1), ("a", 2)}
    with pytest.raises(ValueError, match="orphan"):
        normalize.require_empty(normalize.orphans(flat, spark.createDataFrame([("z",)], "article_id string"), "article_id"), "orphan")
    assert df.select(normalize.field(df, "missing.x", "article_id")).first()[0] == "a"


def test_splits(spark):
    data = [(f"g{c}{i}", f"c{c}") for c in range(2) for i in range(35)]
    out = splits.greedy_split(spark.createDataFrame(data, "g string, l string"), "g", "l").join(spark.createDataFrame(data, "g string, l string"), "g").collect()
    assert len(out) == 70 and {(r["l"], r["partition"]) for r in out} == {(c, p) for c in ("c0", "c1") for p in ("test", "development")}
    assert {(r["l"], r["fold"]) for r in out if r["partition"] == "development"} == {(c, f) for c in ("c0", "c1") for f in range(5)}
    again = splits.greedy_split(spark.createDataFrame(list(reversed(data)), "g string, l string"), "g", "l")
    assert rows(again.select("g", "partition")) == sorted((r["g"], r["partition"]) for r in out)
    assert splits.split_problems(spark.createDataFrame(out).select("g", "partition", "fold"), spark.createDataFrame(data, "g string, l string"), "g", "l", 5).count() == 0
    with pytest.raises(ValueError, match="fewer than 6"):
        splits.greedy_split(spark.createDataFrame(data + [("lone", "c9")], "g string, l string"), "g", "l")
    hot = spark.createDataFrame([(f"g{i}", "hot" if i % 3 else "other") for i in range(300)], "g string, l string")
    per = {(r["l"], r["fold"]): r["count"] for r in splits.hash_folds(hot, "g", "l", 5).groupBy("l", "fold").count().collect()}
    assert sorted(per.values()) == [20] * 5 + [40] * 5
    a = spark.createDataFrame([("x", "k1", "dev"), ("y", "k1", "test"), ("x", None, "dev"), ("z", "k2", None)], "a string, b string, p string")
    assert rows(splits.overlaps(a, ["a", "b"], "p")) == [("a", 0), ("b", 1)]
    assert rows(splits.uncovered(spark.createDataFrame([("l1", 0), ("l1", 1), ("l2", 0)], "l string, f int"), "l", "f")) == [("l2", 1)]


def test_alignment(spark):
    base = "alpha beta\ngamma delta"
    cases = [(base, "beta gamma"), ("alpha beta\\ngamma", "beta gamma"), ("a\r\nb  c", "a b c"), ("a b a b", "a b"), ("abc", "zz"), ("abc", "  "), (None, "x"), ("abc", None), ("x\t\ty", "x\\ny")]
    got = quality.align_quotes(spark.createDataFrame(cases, "t string, q string"), "t", "q").collect()
    spans = [None if r["aligned_start"] is None else r["t"][r["aligned_start"] : r["aligned_end"]] for r in got]
    assert spans == ["beta\ngamma", "beta\\ngamma", "a\r\nb  c", None, None, None, None, None, "x\t\ty"]


def test_clean_prefix(spark):
    words = " ".join(["word"] * 35)
    text = f"{words}. Fever followed. PCR confirmed dengue. Later."
    start = text.index(" PCR")
    r = [("a", text, "PCR confirmed dengue.", start, ""), ("b", "Short. Treated well. Dengue.", "Dengue.", 21, ""), ("c", f"{words} dengue fever x. End", "none", 10**6, "")]
    df = spark.createDataFrame(r, "id string, raw_case_text string, evidence string, evidence_start int, title string")
    al = spark.createDataFrame([("dengue", "d")], "alias string, concept_id string")
    got = {x["id"]: x for x in quality.clean_prefix(df, matcher.find_aliases(df, al, "id", "raw_case_text"), "id").collect()}
    assert got["a"]["clinical_text"] == f"{words}. Fever followed." and got["a"]["reason"] == "PASS"
    assert got["b"]["clinical_text"] == "Short." and got["b"]["reason"] == "TEXT_TOO_SHORT"
    assert got["c"]["clinical_text"] == "" and got["c"]["clinical_source_end"] == 0


def png(pixels, kind=0):
    h, w = len(pixels), len(pixels[0])
    body, above = b"", [0] * (3 * w)
    for line in pixels:
        flat = [v for p in line for v in p]
        if kind == 1:
            out = [(v - (flat[i - 3] if i >= 3 else 0)) & 255 for i, v in enumerate(flat)]
        elif kind == 2:
            out = [(v - above[i]) & 255 for i, v in enumerate(flat)]
        else:
            out = flat
        body += bytes([kind, *out])
        above = flat
    chunk = lambda k, d: pack(">I", len(d)) + k + d + pack(">I", zlib.crc32(k + d))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(body)) + chunk(b"IEND", b"")


def test_images(spark):
    px = [[((x * 3) % 256, (y * 5) % 256, (x * y) % 256) for x in range(80)] for y in range(70)]
    small = [[(1, 2, 3)] * 4] * 4
    files = [("a.png", png(px)), ("b.png", png(px, 1)), ("c.png", png(px, 2)), ("d.png", png(small)), ("e.png", b"no"), ("f.png", b"")]
    got = {r["path"]: r for r in quality.inspect_images(spark.createDataFrame(files, "path string, content binary")).collect()}
    assert [got[p[0]]["reason"] for p in files] == ["PASS", "PASS", "PASS", "IMAGE_TOO_SMALL", "IMAGE_UNREADABLE", "IMAGE_EMPTY"]
    assert got["a.png"]["pixel_sha256"] == got["b.png"]["pixel_sha256"] == got["c.png"]["pixel_sha256"] and got["a.png"]["image_sha256"] != got["b.png"]["image_sha256"]
    assert (got["a.png"]["width"], got["a.png"]["height"], len(got["a.png"]["perceptual_hash"])) == (80, 70, 16)


def test_decisions(spark):
    new, prior = spark.createDataFrame([("a", "n"), ("b", None)], "k string, why string"), spark.createDataFrame([("b", "p"), ("c", "q")], "k string, why string")
    assert rows(decisions.merge_requirements(new, prior, "k", ["why"])) == [("a", "n", "NEW"), ("b", "p", "RENEWED"), ("c", "q", "PRIOR")]
    shown = spark.createDataFrame([("a", "x", None), ("b", "x", 1), ("gone", "x", 1)], "k string, t string, n int")
    now = spark.createDataFrame([("a", "x", None), ("b", "y", 1)], "k string, t string, n int")
    assert [(r["k"], r["changed"]) for r in decisions.context_changes(shown, now, "k", ["t", "n"]).orderBy("k").collect()] == [("a", []), ("b", ["t"]), ("gone", ["t", "n"])]
    jobs = spark.createDataFrame([("a", "1"), ("b", "1"), ("c", "1"), ("d", "1")], "k string, h string")
    done, failed = spark.createDataFrame([("a", "1"), ("c", "0"), ("a", "1")], "k string, h string"), spark.createDataFrame([("b", "1")], "k string, h string")
    assert [(r["k"], r["state"]) for r in decisions.job_states(jobs, done, failed, "k", "h").orderBy("k").collect()] == [("a", "DONE"), ("b", "FAILED"), ("c", "STALE"), ("d", "PENDING")]
    work = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    assert rows(decisions.job_scope(work, work.where("k < 'c'"), work.where("k = 'a'"), "k")) == [("b",)]
    assert rows(decisions.job_scope(work, work.limit(0), work.where("k = 'a'"), "k")) == [("b",), ("c",)]
    qc = spark.createDataFrame([("a", "1", True, 7), ("b", "2", True, 8)], "k string, h string, ok boolean, x int")
    res = spark.createDataFrame([("a", "1", False), ("b", "1", True)], "k string, h string, ok boolean")
    assert rows(decisions.apply_results(qc, res, "k", "h", {"ok": F.lit(None).cast("boolean")})) == [("a", "1", 7, False), ("b", "2", 8, None)]
    joined = decisions.look_up(work, "k", s=spark.createDataFrame([("a", "clash")], "k string, why string"), t=prior)
    assert rows(joined.select("k", "s.why", "t.why")) == [("a", "clash", None), ("b", None, "p"), ("c", None, "q")]
    with pytest.raises(Exception, match="no t for a"):
        decisions.strict_join(work, "k", t=prior).collect()
    counts = decisions.count_codes(qc, (F.col("ok"), "OK"), (F.col("x") > 7, "X"), (F.lit(None).cast("boolean"), "NONE"))
    assert rows(counts) == [("NONE", 0), ("OK", 2), ("X", 1)] and rows(decisions.count_codes(qc.limit(0), (F.col("ok"), "OK"))) == [("OK", 0)]
    assert rows(decisions.gate_status(counts.where("code = 'NONE'"), qc)) == [("PASS", 2, 0)] and rows(decisions.gate_status(counts, qc.limit(0))) == [("FAIL", 0, 2)]
    over = spark.createDataFrame([("a", "g", 0), ("b", "g", 1), ("c", "g", 2), ("a", "h", 0), (None, "h", 1), ("a", None, 3), ("z", "q", None)], "k string, g string, fold int")
    assert rows(decisions.pairwise_overlaps(over, ["g", "k"], "fold")) == [("g", 3), ("k", 1)]
    member, closure = spark.createDataFrame([("p", "top"), ("p", "low"), ("q", "top")], "g string, c string"), spark.createDataFrame([("low", "top")], "node string, ancestor string")
    assert rows(decisions.collapse_targets(member, closure, "g", "c")) == [("p", ["low"], 1), ("q", ["top"], 1)]
    reviews = spark.createDataFrame([("a", "1", 1), ("a", "0", 9), ("a", "1", 2)], "k string, h string, n int")
    assert rows(decisions.current(reviews, jobs, ["k", "h"], [F.col("n")])) == [("a", "1", 2)]
    flags = spark.createDataFrame([(None, ["x"], 0.0), (True, [], 0.0), (True, None, 0.0)], "ok boolean, l array<string>, u double")
    assert [tuple(r) for r in flags.select(decisions.all_true(F.col("ok")), decisions.none_listed(F.col("l"))).collect()] == [(False, False), (True, True), (True, True)]


def test_review_images(spark):
    import numpy as np

    pixels = np.arange(5 * 7 * 3, dtype=np.uint8).reshape(5, 7, 3)
    assert (quality.decode_png(quality.encode_png(pixels)) == pixels).all()
    assert quality.shrink(pixels, 4).shape == (3, 4, 3) and quality.shrink(pixels, 9) is pixels
    assert quality.shrink(np.full((4, 4, 1), 9, dtype=np.uint8), 2).tolist() == [[[9], [9]], [[9], [9]]]
    df = spark.createDataFrame([("a", bytearray(quality.encode_png(pixels))), ("b", bytearray(b"zz")), ("c", None)], "path string, content binary")
    got = {r["path"]: r["image"] for r in quality.review_images(df, 4).collect()}
    assert got["b"] is None and got["c"] is None and quality.decode_png(bytes(got["a"])).shape == (3, 4, 3)
