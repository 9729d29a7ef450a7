import random
import re
import unicodedata
from fractions import Fraction
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from caseloom.llm import consensus, keywords, lookalike, mixing, neardup, packing, shingles
from caseloom.llm.sizes import vocabulary_count, word_count


def rows(df):
    return sorted(tuple(r) for r in df.collect())


# Look-alike text


def test_character_map_is_idempotent_and_plain():
    for c, r in lookalike.CHARACTER_MAP.items():
        assert all(ord(x) not in lookalike.CHARACTER_MAP or x == " " for x in r), (hex(c), r)
    assert len(lookalike.CYRILLIC) == len(lookalike.CYRILLIC_AS) and len(lookalike.GREEK) == len(lookalike.GREEK_AS)


def test_canonical_text(spark):
    same = ["the café fever", "the café fever", "ｔｈｅ café f​ever", "thе caf­é  fеver ", "⁠the\tcafé\nfever"]
    other = ["the cafe fever", "The café fever", "the café fevers", "the café fеver1", "ﬁle µg", "file μg"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*same, *other, None, "", " ​ "])], "k int, t string").withColumn("word", F.lit("clash"))
    got = [r["t"] for r in lookalike.canonical_text(df, ["t"], "k").orderBy("k").collect()]
    assert len(set(got[:5])) == 1 and unicodedata.normalize("NFC", got[0]) == "the café fever"
    assert len({got[0], *got[5:9]}) == 5 and got[9] == got[10] == "file µg"
    assert got[11:] == [None, "", ""]


def test_quotes(spark):
    text = "Smear conﬁrmed Vérell fever on day 2.\nNext: patient 10 mg."
    quotes = [("exact", "c", "Vérell fever"), ("lig", "c", "confirmed Vérell"), ("accent", "c", "Verell fever"), ("nfd", "c", "Vérell fever"), ("case", "c", "VÉRELL FEVER"), ("blank", "c", "day 2. Next"), ("zero", "c", "pa​tient １０ mg"), ("cyr", "c", "fеver оn"), ("digit", "c", "day 3"), ("none", "c", None), ("empty", "c", ""), ("unseen", "c", "​​"), ("gone", "x", "fеver"), ("zero", "c", "pa​tient １０ mg"), (None, "c", "fеver"), ("notext", "n", "fеver")]
    labels = spark.createDataFrame(quotes, "request_sha256 string, case_id string, evidence_quote string").withColumn("text", F.lit(1))
    cases = spark.createDataFrame([("c", text), ("c", text), ("n", None)], "case_id string, raw_case_text string")
    assert [r[0] for r in rows(lookalike.lookalike_quotes(labels, cases))] == ["blank", "cyr", "lig", "nfd", "zero"]
    labels = spark.createDataFrame([("cut", "c1", "cafe\u0301"), ("end", "c1", "na\u0131\u0308ve")], "request_sha256 string, case_id string, evidence_quote string")
    text = spark.createDataFrame([("c1", "A café, rarely.")], "case_id string, raw_case_text string")
    assert [r[0] for r in rows(lookalike.lookalike_quotes(labels, text))] == ["cut"]  # the composed word stands nowhere by itself
    assert rows(lookalike.lookalike_quotes(labels.limit(0), cases.limit(0))) == []


def test_very_long_text(spark):
    long = "wé " * 200_000 + "wé"
    df = spark.createDataFrame([(1, long)], "k int, t string")
    got = lookalike.canonical_text(df, ["t"], "k").first()["t"]
    assert len(set(got.split(" "))) == 1


# Near duplicates


def brute(texts, width, t):
    sets = {}
    for k, x in texts:
        w = shingles.words_of(x or "")
        sets.setdefault(k, []).append(frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1)))
    out = set()
    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if any(x & y and Fraction(len(x & y), len(x | y)) >= t for x in sets[a] for y in sets[b]):
                out.add((a, b))
    return out


def edited(rnd, words, n, vocabulary):
    w = list(words)
    for _ in range(n):
        k = rnd.randrange(3)
        at = rnd.randrange(len(w))
        if k == 0:
            w[at] = rnd.choice(vocabulary)
        elif k == 1:
            w.insert(at, rnd.choice(vocabulary))
        elif len(w) > 4:
            del w[at]
    return w


@pytest.mark.parametrize(("width", "t", "frequent"), [(3, Fraction(3, 5), 40), (5, Fraction(4, 5), 4000), (1, Fraction(1, 2), 300)])
def test_near_duplicates(spark, width, t, frequent):
    rnd = random.Random(width)
    vocabulary = [f"w{i}" for i in range(frequent)]
    docs = []
    for f in range(50):
        base = [rnd.choice(vocabulary) for _ in range(rnd.choice([4, 12, 40, 90, 200, 420]))]
        docs += [edited(rnd, base, int(len(base) * rnd.random() * 0.2), vocabulary) for _ in range(rnd.randrange(1, 5))]
        if f % 5 == 0:
            docs.append(base[rnd.randrange(3) :] + base[: rnd.randrange(3)])
    texts = [(f"d{i:04}", " ".join(w)) for i, w in enumerate(docs)]
    texts += [("copy1", texts[0][1]), ("copy2", texts[0][1]), ("copy2", texts[0][1]), ("wide", texts[1][1].replace("w", "ｗ")), ("none", None), ("void", ""), ("void2", ""), ("short", "w1"), ("short2", "w1")]
    df = spark.createDataFrame([(k, "f", x) for k, x in texts] + [(k, "g", "other words here " + k) for k, _ in texts[:3]], "doc_id string, field string, text string").withColumn("h", F.lit("clash"))
    near = neardup.NearDuplicates(df, width, t, parts=3)
    got = rows(near.document_pairs())
    assert len(got) == len(set(got)) and set(got) == brute(texts, width, t)
    links = {k: 0 for k, _ in texts}
    for a, b in got:
        links[a] += 1
        links[b] += 1
    found = {}
    for r in near.classes().collect():
        found[r["doc_id"]] = max(found.get(r["doc_id"], 0), r["links"])
    assert found == {k: v for k, v in links.items() if k != "none"}
    root = {k: k for k, x in texts if x is not None}
    first: dict[str, str] = {}
    edges = [*got, *((first.setdefault(x, k), k) for k, x in texts if x is not None)]  # equal texts are one class, however short

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in edges:
        a, b = sorted((top(a), top(b)))
        root[b] = a  # the smaller one; nothing if they are the same
    assert {r["doc_id"]: r["group"] for r in near.groups().where("field = 'f'").collect()} == {k: top(k) for k in root}


def test_signatures_are_shared_at_any_threshold():
    rnd = np.random.default_rng(0)
    codes = rnd.integers(0, 160, 1 << 16).astype(np.uint8)
    t = Fraction(3, 5)
    for _ in range(150):
        n = int(rnd.integers(3, 700))
        m = int(rnd.integers(max(3, int(n * 0.6)), int(n / 0.6) + 1))
        common = int(np.ceil((n + m) * 3 / 8 + 1e-9))
        if common > min(n, m):
            continue
        toks = np.unique(rnd.integers(0, 1 << 44, n + m + 10).astype(np.uint64))[: n + m - common]
        toks = rnd.permutation(toks)
        x, y = np.sort(toks[:n]), np.sort(toks[n - common :])
        sig = []
        for s in (x, y):
            _, g, passed = neardup.signatures(np.zeros(len(s), dtype=np.int64), s, np.array([len(s)]), codes, t)
            sig.append(set(g[passed <= len(s) - common].tolist()))
        assert sig[0] & sig[1], (n, m, common)


def test_near_duplicates_empty(spark):
    df = spark.createDataFrame([], "doc_id string, field string, text string")
    near = neardup.NearDuplicates(df)
    assert near.document_pairs().count() == 0 and near.classes().count() == 0 and near.groups().count() == 0


# Sizes, packing, mixing


def test_sizes(spark):
    texts = ["", "a b", "don't", "x_1—y  ...!", "é β2 ½", "​", None, "a" * 100_000, "éx"]
    got = [r[0] for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(word_count(F.col("t"))).collect()]
    assert got == [len(re.findall(r"\w+|[^\w\s]+", t or "")) for t in texts]


def test_vocabulary_sizes(spark):
    path = Path("/opt/tokenizers/byte_bpe_50k.json")
    if not path.exists():
        pytest.skip("no vocabulary files")
    df = spark.createDataFrame([("hello world",), (None,), ("",)], "t string")
    assert [r[0] for r in df.select(vocabulary_count(F.col("t"), str(path))).collect()] == [2, 0, 0]


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_everything_once(seed):
    rnd = random.Random(seed)
    cap = rnd.choice([10, 64, 300])
    hist = {s: rnd.choice([0, 1, 2, 7, 500]) for s in rnd.sample(range(1, cap + 1), min(cap, 40))}
    used, placed = {}, dict.fromkeys(hist, 0)
    for size, first, upto, each, start in packing.plan_containers(hist, cap):
        assert first == placed[size]
        for rank in range(first, upto):
            c = start + (rank - first) // each
            used[c] = used.get(c, 0) + size
        placed[size] = upto
    assert placed == {s: n for s, n in hist.items() if n or s in placed} and all(v <= cap for v in used.values())
    assert sorted(used) == list(range(len(used)))
    volume = sum(s * n for s, n in hist.items())
    assert len(used) <= 11 / 9 * -(-volume // cap) + 1 + sum(n for s, n in hist.items() if 2 * s > cap)


def test_pack(spark):
    sizes = [(1, 5), (2, 10), (3, 25), (4, 0), (5, None), (6, 20), (7, 5), (7, 5), (None, 3), (8, 7), (9, 3)]
    df = spark.createDataFrame(sizes, "doc_id long, tokens long").withColumn("rank", F.lit("clash"))
    got = packing.pack_documents(df, 10).collect()
    held, docs = {}, {}
    for r in got:
        docs.setdefault(r["doc_id"], []).append(r)
        if r["container"] is not None:
            held[r["container"]] = held.get(r["container"], 0) + r["tokens"]
    assert all(v <= 10 for v in held.values()) and set(docs) == {1, 2, 3, 4, 5, 6, 7, 8, 9}
    assert {d: sum(r["tokens"] for r in x) for d, x in docs.items()} == {1: 5, 2: 10, 3: 25, 4: 0, 5: 0, 6: 20, 7: 5, 8: 7, 9: 3}
    assert [len(docs[d]) for d in (1, 3, 6)] == [1, 3, 2] and docs[4][0]["piece"] is None
    assert len(held) == 8  # 2 + 2 whole pieces; 10; 7 + 3; 5 + 5; the rest of 25 alone
    assert packing.pack_documents(df.limit(0), 10).count() == 0


def test_mixture(spark):
    docs = [(i, "big", "t%d" % i) for i in range(400)] + [(1000 + i, " Small ", "s%d" % i) for i in range(20)] + [(2000 + i, "twin", "same") for i in range(4)] + [(2100 + i, "twin", "x%d" % i) for i in range(6)] + [(3000, None, "z"), (3001, "", "z"), (1, "big", "t1"), (None, "big", "t")]
    df = spark.createDataFrame(docs, "doc_id long, source string, text string").withColumn("tokens", F.lit("clash"))
    t = spark.createDataFrame([("Big", 0.5, 1), ("small", 0.1, 3), ("twin", 0.02, 2), ("lost", 0.1, 4), ("rest", 0.0, 0)], "source string, target_share double, max_repeats int")
    sized = mixing.sized_documents(df, F.lit(10).cast("long"))
    assert sized.count() == 432
    plan = {r["source"]: r for r in mixing.plan_mixture(sized, t).collect()}
    assert {s: r["filled"] for s, r in plan.items()} == {"Big": True, "small": True, "twin": True, "lost": False, "rest": True}
    mixture = mixing.mix_documents(sized, mixing.plan_mixture(sized, t))
    got = mixture.collect()
    n = lambda s: sum(r["repeats"] for r in got if r["source"] == s)
    assert (n("Big"), n("small")) == (216, 43) and max(r["repeats"] for r in got if r["source"] == "small") == 3
    assert n("twin") in (8, 9) and all(r["repeats"] <= 2 for r in got if r["source"] == "twin")
    assert sum(r["repeats"] for r in got if r["source"] == "twin" and r["doc_id"] < 2100) < sum(r["repeats"] for r in got if r["source"] == "twin" and r["doc_id"] >= 2100)
    report = {r["source"]: r for r in mixing.mixture_report(mixing.plan_mixture(sized, t), mixture).collect()}
    assert report["lost"]["actual_tokens"] == 0 and report["Big"]["actual_tokens"] == 2160 and not report["lost"]["filled"]
    assert mixing.mix_documents(sized.limit(0), mixing.plan_mixture(sized.limit(0), t)).count() == 0
    assert mixing.plan_mixture(sized, t.limit(0)).count() == 0


def test_many_copies_share_the_weight_of_one_text(spark):
    df = spark.createDataFrame([(i, "s", "same" if i < 200 else "t%d" % i) for i in range(400)], "doc_id long, source string, text string")
    t = spark.createDataFrame([("s", 0.25, 1), ("other", 0.0, 1)], "source string, target_share double, max_repeats int")
    sized = mixing.sized_documents(df, F.lit(10).cast("long"))
    plan = mixing.plan_mixture(sized, t)
    assert plan.where("source = 's'").first()["scale"] == pytest.approx(100 / 201)  # 200 texts and one that 200 rows share
    drawn = [mixing.mix_documents(sized, plan, seed=k).where("doc_id < 200").count() for k in range(6)]
    assert sum(drawn) <= 6 and mixing._scale([(1, 10), (3, 30), (1000, 1000)], 53.0, 2) == pytest.approx(3.0)


def test_pareto_keeps_inclusion_probabilities(spark):
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.lit("s").alias("source_key"), F.lit(1).cast("long").alias("tokens"), F.when(F.col("id") < 100, 4).otherwise(1).alias("copies"))
    t = spark.createDataFrame([("s", 0.5, 1)], "source string, target_share double, max_repeats int")
    plan = mixing.plan_mixture(docs, t)
    p = plan.first()["scale"]
    rare = [mixing.mix_documents(docs, plan, seed=s).where("doc_id < 100").count() for s in range(8)]
    assert abs(sum(rare) / 800 - p / 4) < 0.05


# Consensus


def test_consensus(spark):
    rnd = random.Random(6)
    right = {f"m{i}": p for i, p in enumerate([0.95, 0.9, 0.9, 0.85, 0.6, 0.4])} | {"yes": None, "swap": None}
    truth, votes = {}, []
    for i in range(1500):
        truth[f"c{i}"] = t = rnd.choice([0, 0, 0, 1, 1, 2])
        for a in rnd.sample(sorted(right), 5):
            v = 0 if a == "yes" else (1, 0, 2)[t] if a == "swap" else t if rnd.random() < right[a] else rnd.choice([k for k in range(3) if k != t])
            votes.append((f"c{i}", a, v))
    c = consensus.Consensus(spark.createDataFrame(votes, "case_id string, annotator string, vote int"))
    got = {r["case_id"]: r for r in c.decisions().collect()}
    share = sum(got[k]["consensus_decision"] == consensus.DECISIONS[t] for k, t in truth.items()) / len(truth)
    assert share > 0.93 and len(got) == 1500
    rel = {r["annotator"]: r["reliability"] for r in c.annotator_reliability().collect()}
    assert rel["m0"] > rel["m3"] > rel["m4"] > rel["m5"] and rel["yes"] < 0.5 and rel["swap"] < 0.4 and abs(rel["m0"] - 0.95) < 0.06


def test_votes(spark):
    r = [("c1", "a", "Accepted ", "h", "2025-01-01T00:00:00Z"), ("c1", "a", " REJECT", "h", "2025-01-01T01:00:00+05:30"), ("c1", "b", "human_review", "h", "2025-01-01T00:00:00Z"), ("c1", "d", "uncertain", "old", "2025-01-01T00:00:00Z"), ("gone", "a", "accept", "h", "2025-01-01T00:00:00Z"), ("c1", None, "accept", "h", None), ("c1", "e", "rejected", "h", "no time"), ("c1", "f", None, "h", None), ("c1", "a", "Accepted ", "h", "2025-01-01T00:00:00Z")]
    reviews = spark.createDataFrame(r, "case_id string, annotator string, decision string, raw_text_sha256 string, reviewed_at string").withColumn("at", F.lit("clash"))
    cases = spark.createDataFrame([("c1", "h"), ("c1", "h"), (None, "h")], "case_id string, raw_text_sha256 string")
    votes = consensus.latest_votes(reviews, cases)
    assert rows(votes) == [("c1", "a", 0), ("c1", "e", 1)]
    assert consensus.contested(consensus.Consensus(votes).decisions()).count() == 0
    empty = consensus.Consensus(votes.limit(0))
    assert empty.decisions().count() == 0 and empty.annotator_reliability().count() == 0
    tie = consensus.Consensus(spark.createDataFrame([("c", "x", 2), ("c", "y", 1), ("c", "z", 0)], "case_id string, annotator string, vote int")).decisions().collect()
    assert len(tie) == 1 and tie[0]["agreement"] == 0.0 and tie[0]["votes"] == 3


def test_agreement_of_mixed_ballots(spark):
    ballots = {"same": (2, 2, 2), "torn": (1, 1, 0), "pair": (0, 0), "mixed": (0, 0, 1, 1), "one": (1,)}
    votes = [(c, f"m{i}", v) for c, b in ballots.items() for i, v in enumerate(b)]
    got = consensus.Consensus(spark.createDataFrame(votes, "case_id string, annotator string, vote int")).decisions()
    assert {r["case_id"]: r["agreement"] for r in got.collect()} == {"same": 1.0, "torn": 0.333333, "pair": 1.0, "mixed": 0.333333, "one": None}
    assert [r["case_id"] for r in consensus.contested(got).orderBy("case_id").collect()] == ["mixed", "torn"]


def test_spectral_vector(spark):
    """The sparse iteration ends at the eigenvector that a dense agreement matrix has."""
    rnd = random.Random(11)
    good = [0.95, 0.85, 0.75, 0.6, 0.45]
    votes = []
    for i in range(800):
        t = rnd.choice([0, 0, 1, 2])
        votes += [(i, a, t if rnd.random() < good[a] else rnd.randrange(3)) for a in rnd.sample(range(5), 4)]
    c = consensus.Consensus(spark.createDataFrame([(f"c{i}", f"m{a}", v) for i, a, v in votes], "case_id string, annotator string, vote int"))
    table = np.full((800, 5), -1)
    for i, a, v in votes:
        table[i, a] = v
    share = np.array([[(table[:, a] == k).sum() / (table[:, a] >= 0).sum() for k in range(3)] for a in range(5)])
    num, overlap = np.zeros((5, 5)), np.zeros((5, 5))
    for a in range(5):
        for b in range(5):
            both = (table[:, a] >= 0) & (table[:, b] >= 0)
            if a != b:
                overlap[a, b] = both.sum()
                num[a, b] = (table[both, a] == table[both, b]).sum() - both.sum() * share[a] @ share[b]
    v = np.full(5, 0.7)
    for _ in range(500):
        v = (v + num @ v / (overlap @ (v * v) + consensus.PRIOR_WEIGHT * np.mean(v * v))) / 2
    got = {r["annotator"]: r["v"] for r in c.reliability.collect()}
    assert all(abs(got[f"m{a}"] - v[a]) < 0.01 for a in range(5))


# Keyword pages


def test_keywords(spark):
    rnd = random.Random(7)
    common = "the a of and was with in at by for".split()
    nouns = [f"noun{chr(97 + i)}{chr(97 + j)}".replace("noun", "no") for i in range(12) for j in range(12)]

    def prose(n):
        return " ".join(" ".join([rnd.choice(common), rnd.choice(nouns), rnd.choice(common), rnd.choice(common), rnd.choice(nouns)]).capitalize() + "." for _ in range(n))

    docs = [(i, "en", prose(rnd.randrange(5, 40))) for i in range(300)]
    docs += [(1000, "en", "cheap pills best price cheap pills coupon buy cheap pills online " * 20), (1001, None, "#pills #coupon #pills #cheap #pills " * 20), (1002, "en", "\n".join(f"https://shop{chr(97 + i)}.test/buy/{i}" for i in range(20)))]
    docs += [(2000, "en", "\n".join(f"Sodium {i}\nKalium {i + 3}\nZinc: {i}" for i in range(15))), (2001, "en", ""), (2002, None, None), (2003, "en", "word"), (0, "en", docs[0][2]), (None, "en", "cheap " * 50), (2004, "en", prose(30) + " cheap pills")]
    df = spark.createDataFrame(docs, "doc_id long, lang string, text string").withColumn("word", F.lit("clash"))
    got = {r["doc_id"]: r for r in keywords.keyword_features(df).collect()}
    assert sorted(k for k, r in got.items() if r["flagged"]) == [1000, 1001, 1002]
    assert 2001 not in got and 2002 not in got and not got[2000]["flagged"]
    assert keywords.keyword_features(df.limit(0)).count() == 0


def test_copies_do_not_shift_prose(spark):
    rnd = random.Random(8)
    common = "the a of and was with in at by for".split()
    nouns = [f"no{chr(97 + i)}{chr(97 + j)}" for i in range(12) for j in range(12)]
    prose = lambda: " ".join(" ".join([rnd.choice(common), rnd.choice(nouns), rnd.choice(common), rnd.choice(common), rnd.choice(nouns)]).capitalize() + "." for _ in range(rnd.randrange(5, 40)))
    junk = " ".join(f"{'pqrs'[i % 4]}{'aeiou'[i % 5]}{'lmnt'[i // 9 % 4]}{'xyz'[i % 3]}" for i in range(60)) + " "
    docs = [(i, "en", prose()) for i in range(300)] + [(1000 + i, "en", junk * 4) for i in range(150)] + [(1000, "en", junk * 4)]
    df = spark.createDataFrame(docs, "doc_id long, lang string, text string")
    got = keywords.keyword_features(df).collect()
    assert sorted(r["doc_id"] for r in got) == [*range(300), *range(1000, 1150)]
    assert sorted(r["doc_id"] for r in got if r["flagged"]) == [*range(1000, 1150)]
    assert len({r["total"] for r in got if r["doc_id"] >= 1000}) == 1


def test_stuffing_with_a_prose_word(spark):
    rnd = random.Random(9)
    common = "the a of and was with in at by for".split()
    nouns = [f"no{chr(97 + i)}{chr(97 + j)}" for i in range(12) for j in range(12)]
    prose = lambda n: " ".join(" ".join([rnd.choice(common), rnd.choice(nouns), rnd.choice(common), rnd.choice(common), rnd.choice(nouns)]).capitalize() + "." for _ in range(n))
    docs = [(i, "en", prose(rnd.randrange(5, 40))) for i in range(300)]
    docs += [(1000 + k, "en", "\n".join(f"noaa {rnd.choice(nouns)}" for _ in range(60))) for k in range(3)]
    docs += [(2000, "en", " ".join(rnd.choice(nouns) for _ in range(120)))]
    got = {r["doc_id"]: r for r in keywords.keyword_features(spark.createDataFrame(docs, "doc_id long, lang string, text string")).collect()}
    assert sorted(k for k, r in got.items() if r["flagged"]) == [1000, 1001, 1002]
    assert got[1000]["foreign"] == 0 and got[1000]["excess"] > 0.3 > got[2000]["excess"]


def test_each_measure_flags_alone(spark):
    """Of prose pages that differ in one measure only, each extreme one is flagged; the limits move with language and length."""
    rnd = random.Random(12)
    rows = [(i, lang, 64 + rnd.randrange(60), 0.4, 0.0, base + rnd.random() * 0.02, 0.01, slope + rnd.random() * 0.05, 0.03) for i in range(60) for lang, base, slope in ((1, 0.0, -0.5), (2, 0.4, -0.9))]
    odd = {"repeated": 0.15, "foreign": 0.6, "excess": 0.4, "slope": -1.6, "residual": 0.6}
    page = lambda lang, **k: (lang, 100, 0.1, *({"repeated": 0.0, "foreign": 0.01, "excess": 0.01, "slope": -0.5, "residual": 0.03} | k).values())
    rows = [(f"prose{lang}-{i}", lang, *x) for i, lang, *x in rows]
    rows += [(c, *page(1, **{c: v})) for c, v in odd.items()] + [("usual", *page(1)), ("foreign2", *page(2, foreign=0.6, slope=-0.9)), ("slope2", *page(2, foreign=0.4, slope=0.2))]
    rows += [("short", 1, 5, 0.1, 0.9, 0.9, 0.9, -0.5, 0.03), ("unknown", None, 100, 0.0, None, None, None, -1.6, 0.9), ("long", 1, 5000, 0.1, 0.0, 0.0, 0.01, -1.6, 0.9), ("long tags", 1, 5000, 0.1, 0.2, 0.9, 0.01, -0.5, 0.03)]
    df = spark.createDataFrame(rows, "page string, language int, total long, share double, repeated double, foreign double, excess double, slope double, residual double")
    got = keywords._flagged(df.withColumn("bin", F.floor(F.log2(F.col("total").cast("double"))).cast("int"))).where("flagged")
    assert sorted(r["page"] for r in got.collect()) == sorted([*odd, "slope2", "long tags"])


def test_prose_of_a_rare_language_is_left_alone(spark):
    rnd = random.Random(13)
    common = "the a of and was with in at by for".split()
    nouns = [f"no{chr(97 + i)}{chr(97 + j)}" for i in range(12) for j in range(12)]
    prose = lambda n: " ".join(" ".join([rnd.choice(common), rnd.choice(nouns), rnd.choice(common), rnd.choice(common), rnd.choice(nouns)]).capitalize() + "." for _ in range(n))
    finnish = "Potilas tuli vastaanotolle kuumeen takia ja kertoi yskän alkaneen edellisenä päivänä, ja kuume jatkui yön yli. Potilas sai lääkkeen ja lähti kotiin."
    docs = [(i, "en", prose(rnd.randrange(5, 40))) for i in range(300)] + [(1000 + i, "fi", finnish + f" Käynti {i}.") for i in range(3)] + [(1010, "en", "cheap pills best price cheap pills coupon " * 20)]
    got = {r["doc_id"]: r for r in keywords.keyword_features(spark.createDataFrame(docs, "doc_id long, lang string, text string")).collect()}
    assert [k for k, r in got.items() if r["flagged"]] == [1010] and got[1000]["language"] is None and got[1000]["foreign"] is None
    assert got[0]["language"] == "en"


def test_rank_frequency_fit(spark):
    counts = [50, 20, 20, 5, 1, 1, 1, 1]
    spectrum = spark.createDataFrame([(1, f, counts.count(f)) for f in set(counts)] + [(2, 3, 1)], "doc_id long, freq int, words long")
    got = {r["doc_id"]: r for r in spark.sql(keywords.CURVES, spectrum=spectrum).collect()}
    x = np.log([1, 2.5, 2.5, 4, 6.5, 6.5, 6.5, 6.5])
    y = np.log(counts)
    slope, cut = np.polyfit(x, y, 1)
    assert got[1]["slope"] == pytest.approx(slope) and got[1]["residual"] == pytest.approx(np.sqrt(np.mean((y - slope * x - cut) ** 2)), abs=1e-9)
    assert (got[2]["slope"], got[2]["residual"]) == (0.0, 0.0)
