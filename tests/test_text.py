import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from caseloom.functions import stats, text

def spans(t):
    """Sentences by walking over the characters: a run without marks that marks or the end of the text close."""
    out, at = [], 0
    while at < len(t):
        stop = next((i for i in range(at, len(t)) if t[i] in ".!?\n"), len(t))
        end = next((i for i in range(stop, len(t)) if t[i] not in ".!?"), len(t))
        closed = end > stop or stop == len(t) or (t[stop] == "\n" and stop == len(t) - 1)
        if stop > at and closed and t[at:end].strip():
            out.append((at, end))
        at = max(end, stop + 1)
    return out


@pytest.mark.parametrize("t", ["", "One. Two! Three", "Heading line\nBody text here. Dose 2.5 mg given", "α😀 b. c😀d? e", "...", " \n. a", "a.b.c"])
def test_sentence_spans(spark, t):
    got = spark.createDataFrame([(t,)], "t string").select(text.sentence_spans(F.col("t")).alias("s"), text.sentence_count(F.col("t")).alias("n")).first()
    assert [(s["start"], s["end"]) for s in got["s"]] == spans(t)
    assert got["n"] == len(spans(t))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab .!?😀é\t", max_size=30), min_size=1, max_size=20))
def test_sentence_spans_any(spark, texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", text.sentence_spans(F.col("t")).alias("s")).collect()
    assert {r["i"]: [(s["start"], s["end"]) for s in r["s"]] for r in rows} == {i: spans(t) for i, t in enumerate(texts)}


def test_quotes(spark):
    rows = [("a b a", "b", 2, 3), ("a b a", "a", 0, 1), ("x", "", 0, 0), ("😀 fever", "fever", 2, 7), ("abc", "b", 1, 9), (None, "b", 0, 1), ("abc", None, None, None)]
    df = spark.createDataFrame(rows, "t string, q string, a int, b int")
    got = df.select(text.exact_evidence(F.col("t"), F.col("q"), F.col("a"), F.col("b")).alias("e"), text.unique_quote_start(F.col("t"), F.col("q")).alias("u")).collect()
    assert [r["e"] for r in got] == [True, True, False, True, False, False, False]
    assert [r["u"] for r in got] == [2, None, None, 2, 1, None, None]


def test_words_fraction_json(spark):
    df = spark.createDataFrame([("  two words\n", 1, None)], "t string, n int, z string")
    r = df.select(text.word_count(F.col("t")).alias("w"), text.strip(F.col("t")).alias("s"), text.hash_fraction(F.lit("case:B")).alias("f"), text.canonical_json(b=F.col("n"), a=F.col("z")).alias("j")).first()
    import hashlib

    assert (r["w"], r["s"], r["j"]) == (2, "two words", '{"a":null,"b":1}')
    assert r["f"] == int(hashlib.sha256(b"case:B").hexdigest()[:8], 16) / 2**32


def test_ngram_leak(spark):
    df = spark.createDataFrame([("one two three four", "x One, two three FOUR y"), ("one two", "one two"), (None, "a"), ("a b c d e", "")], "a string, b string")
    assert [r[0] for r in df.select(text.shares_ngram(F.col("a"), F.col("b"), 4)).collect()] == [True, False, False, False]


def test_statistics(spark):
    df = spark.createDataFrame([(8, 10), (0, 0)], "k long, n long")
    a, b = df.select(*stats.wilson(F.col("k"), F.col("n"))).collect()
    assert a["low"] < a["rate"] == 0.8 < a["high"] and b["rate"] is None and b["low"] is None
    pairs = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("b", "b"), (None, "a")], "l string, r string")
    r = stats.cohen_kappa(pairs, "l", "r").first()
    assert (r["n"], r["agreement"], r["kappa"]) == (4, 0.75, 0.5)
    assert stats.cohen_kappa(pairs.limit(0), "l", "r").first()["kappa"] is None
