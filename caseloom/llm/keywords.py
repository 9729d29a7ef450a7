"""Problem 9: pages of repeated keywords, links or product tags instead of sentences.

Per page a rank-frequency curve is fitted with SQL windows; its slope and residual and the page's divergence
from the prose of its language are held against prose pages of the same language and comparable length, and
any of them flags a page that is extreme. Prose pages are those with many of the language's commonest words,
prose words those that enough prose pages hold. The divergence has three measures, as shares of a page's
words: repeated words that prose does not have, all words that prose does not have, and the excess of the most
repeated prose word over the repeats that are usual for it in prose pages, which grow with the length. Words
that label a number, as in laboratory panels and medication lists, count for the length but not as divergent.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.session import discard, is_small, materialize, ship

ship(__name__)

#: A word of at least two letters, with the first digit of a number if it stands before one on its line; lower-case text.
WORD = re.compile(r"[^\W\d_]{2,}+(?:[^\w\n]{0,4}[0-9])?")
LETTERS = re.compile(r"[^\W\d_]+")
#: Commonest words of a language that tell prose, the least share of them in prose, and the share of pages they are sought among.
COMMON, PROSE_SHARE, COMMON_LEAST = 40, 0.30, 0.01
#: Distinct pages that name a language before it has a model; pages of other languages are not held against any prose.
LEAST_PAGES = 50
#: A prose word stands in this share of the prose pages, and in this many at least; so there are at most (words of a page / share) of them.
VOCABULARY_SHARE, VOCABULARY_PAGES = 0.002, 3
#: Rows of a lookup table that are broadcast; beyond, it is joined by a shuffle.
MOST_BROADCAST = 2_000_000
#: A measure is extreme this many deviations from the median of comparable prose. A deviation is that of the
#: quartiles, and at least the measure's tolerance.
EXTREME = 4.5
TOLERANCE = {"repeated": 0.02, "foreign": 0.1, "excess": 0.06, "slope": 0.1, "residual": 0.09}
#: What the slope's tolerance is larger by for a page of one word; it falls with the root of the number of words, as a fit's error does.
SLOPE_ERROR = 0.6
CURVE = ("slope", "residual")
#: Prose pages of a length (power of two) that make it comparable; below, divergence is held against all the language's prose, and the curve, which depends on the length, against none.
COMPARABLE = 20
LEAST_WORDS = 6

CURVES = """
WITH steps AS (
  SELECT doc_id, freq, words,
    sum(words) OVER (PARTITION BY doc_id ORDER BY freq DESC ROWS UNBOUNDED PRECEDING) AS upto
  FROM {spectrum}
), points AS (
  SELECT doc_id, CAST(words AS DOUBLE) AS k, ln(upto - (words - 1) / 2.0D) AS x, ln(CAST(freq AS DOUBLE)) AS y FROM steps
), sums AS (
  SELECT doc_id, sum(k) AS n, sum(k * x) AS sx, sum(k * y) AS sy, sum(k * x * y) AS sxy, sum(k * x * x) AS sxx, sum(k * y * y) AS syy
  FROM points GROUP BY doc_id
), fits AS (
  SELECT *, coalesce(try_divide(n * sxy - sx * sy, n * sxx - sx * sx), 0.0D) AS slope FROM sums
)
SELECT doc_id, slope, sqrt(greatest(0.0D, syy - sy * sy / n - slope * (sxy - sx * sy / n)) / n) AS residual FROM fits
"""


def language_code(lang: Column) -> Column:
    """A number for a language name, case and outer blanks aside; 0 for null and blank names."""
    v = F.lower(F.trim(lang))
    return F.when(v != "", F.xxhash64(v)).otherwise(F.lit(0)).cast("long")


def text_ids(documents: DataFrame) -> DataFrame:
    """(doc_id, lang, page, row) of the rows with id and text: page tells texts of a language apart, row those of an id as well."""
    rows = documents.where("doc_id is not null and text is not null").select("doc_id", language_code(F.col("lang")).alias("lang"), "text")
    return rows.select("doc_id", "lang", F.xxhash64("lang", "text").alias("page"), F.xxhash64("doc_id", "lang", "text").alias("row"))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stage that counts the words of texts: (page, lang, text) to (page, lang, total, words)."""
    for batch in batches:
        words, n, free, cut, total = [], [], [], [0], []
        for text in batch.column("text").to_pylist():
            found = Counter(WORD.findall(text.lower()))
            each = {}
            for w, k in found.items():
                if w[-1] <= "9":  # a letter is above the digits
                    w = LETTERS.match(w)[0]
                    each[w] = (each[w][0] + k, each[w][1]) if w in each else (k, 0)
                else:
                    each[w] = (each[w][0] + k, each[w][1] + k) if w in each else (k, k)
            words.extend(each)
            n.extend(k for k, _ in each.values())
            free.extend(k for _, k in each.values())
            cut.append(len(words))
            total.append(found.total())
        items = pa.StructArray.from_arrays([pa.array(words, pa.string()), pa.array(n, pa.int32()), pa.array(free, pa.int32())], ["word", "n", "free"])
        listed = pa.ListArray.from_arrays(pa.array(np.array(cut, dtype=np.int32)), items)
        yield pa.RecordBatch.from_arrays([batch.column("page"), batch.column("lang"), pa.array(total, pa.int64()), listed], ["page", "lang", "total", "words"])


def page_words(documents: DataFrame, ids: DataFrame) -> DataFrame:
    """(page, lang, total, words) of distinct texts with words; words holds (word, n, free), free without those before a number.

    lang is the language's code. ``ids`` is text_ids of ``documents``. One row stands for all copies of a text;
    it is chosen before texts move, so copies are not gathered. Words are counted in Python, a text at a time:
    exploding them in the JVM to count them took three times the processor time (see the README).
    """
    chosen = materialize(ids.groupBy("page").agg(F.min("row").alias("row"), F.max("lang").alias("lang")), "chosen")
    rows = documents.where("doc_id is not null and text is not null").select(F.xxhash64("doc_id", language_code(F.col("lang")), "text").alias("row"), "text")
    once = rows.groupBy("row").agg(F.first("text").alias("text"))  # a row that is delivered several times counts once
    rows = once.join(chosen.hint("shuffle_hash"), "row").select("page", "lang", "text")
    return rows.mapInArrow(_count_words, "page long, lang long, total long, words array<struct<word string, n int, free int>>").where("total > 0")


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if is_small(df, MOST_BROADCAST) else df


def common_words(pages: DataFrame) -> DataFrame:
    """(language, size, word): the commonest words by distinct texts of each language that LEAST_PAGES pages name, size of them."""
    sizes = pages.where("lang <> 0").groupBy("lang").agg(F.count("*").alias("size")).where(F.col("size") >= LEAST_PAGES)
    sizes = _small(materialize(sizes, "languages"))
    held = pages.where("lang <> 0").join(sizes, "lang").select("lang", "size", F.explode("words.word").alias("word")).groupBy("lang", "word").agg(F.count("*").alias("pages"), F.max("size").alias("size"))
    often = held.where(F.col("pages") >= COMMON_LEAST * F.col("size"))  # at most a page's words / COMMON_LEAST a language
    ranked = often.selectExpr("lang", "size", "word", "row_number() OVER (PARTITION BY lang ORDER BY pages DESC, word) AS r")
    return materialize(ranked.where(F.col("r") <= COMMON).select(F.col("lang").alias("language"), "size", "word"), "common")


def _find_language(models: dict[int, pa.Array]):
    """Stage that adds language and share to (page, lang, total, words); ``models`` has the commonest words by language, in order of size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, lang = batch.column("words"), batch.column("lang").to_numpy()
            sizes = np.diff(lists.offsets.to_numpy())
            items, row = lists.flatten(), np.repeat(np.arange(len(lang)), sizes)
            words, n = items.field("word"), items.field("n").to_numpy()
            best, language = np.full(len(lang), -1, dtype=np.int64), np.zeros(len(lang), dtype=np.int64)

            def held(rows: np.ndarray, code: int) -> np.ndarray:
                """How many words of each of ``rows`` are among the commonest of the language; 0 for other rows."""
                mine = rows[row]
                known = pc.is_in(words.filter(pa.array(mine)), value_set=models[code]).to_numpy(zero_copy_only=False)
                return np.bincount(row[mine], weights=known * n[mine], minlength=len(lang)).astype(np.int64)

            for code in np.unique(lang):
                for model in (models if code == 0 else [int(code)] if code in models else []):
                    rows = lang == code
                    count = held(rows, model)
                    better = rows & (count > best)
                    best[better], language[better] = count[better], model
            unknown = best < 0
            share = np.maximum(best, 0) / np.maximum(1, batch.column("total").to_numpy())
            yield pa.RecordBatch.from_arrays([batch.column("page"), pa.array(language, pa.int64(), mask=unknown), pa.array(share), batch.column("total"), lists], ["page", "language", "share", "total", "words"])

    return run


def with_language(pages: DataFrame, common: DataFrame) -> DataFrame:
    """``pages`` with language and share, the part of their words that are among its commonest.

    The language is the page's own. A page that names none has the one with the largest share, of equals
    that with the most pages; one that names a language without a model has null. The models, COMMON words a
    language of LEAST_PAGES pages or more, go to the pages, so no page is moved.
    """
    listed: dict[int, list[str]] = {}
    for r in common.orderBy(F.desc("size"), "language", "word").collect():
        listed.setdefault(r["language"], []).append(r["word"])
    models = {code: pa.array(words, pa.string()) for code, words in listed.items()}
    return pages.mapInArrow(_find_language(models), "page long, language long, share double, total long, words array<struct<word string, n int, free int>>")


def keyword_features(documents: DataFrame) -> DataFrame:
    """(doc_id, language, total, share, repeated, foreign, excess, slope, residual, flagged) of every page with words.

    language is null for pages of a language without a model, which have no divergence and are never flagged;
    a page that names no language has the model that fits best. What is common, prose or usual is counted
    over distinct texts, so copies of a page do not shift it. An id with several texts has the largest value
    of each column. Pages without words do not come out; those of fewer than LEAST_WORDS words are never flagged.
    """
    spark = documents.sparkSession
    ids = materialize(text_ids(documents), "ids")
    pages = materialize(page_words(documents, ids), "pages")
    common = common_words(pages)
    known = materialize(with_language(pages, common), "known")
    discard(pages)
    prose = known.where(F.col("share") >= PROSE_SHARE)
    sizes = prose.groupBy("language").agg(F.count("*").alias("prose_pages"))
    held = prose.select("language", F.col("total").alias("length"), F.inline("words")).groupBy("language", "word").agg(F.count("*").alias("held"), F.sum(F.col("n") - 1).alias("repeats"), F.sum("length").alias("length"))
    least = F.greatest(F.lit(VOCABULARY_PAGES), F.col("prose_pages") * VOCABULARY_SHARE)
    vocabulary = held.join(sizes, "language").where(F.col("held") >= least).select("language", "word", (F.col("repeats") / F.col("length")).alias("rate"))
    vocabulary = _small(materialize(vocabulary, "vocabulary"))
    each = known.select("page", "language", "share", "total", F.inline("words")).join(vocabulary, ["language", "word"], "left")
    odd = F.col("rate").isNull()
    sums = each.groupBy("page").agg(
        *(F.max(c).alias(c) for c in ("language", "share", "total")),
        F.sum(F.when(odd & (F.col("n") > 1), F.col("free")).otherwise(0)).alias("r"), F.sum(F.when(odd, F.col("free")).otherwise(0)).alias("f"),
        F.max(F.greatest(F.lit(0.0), F.col("free") - 1 - F.col("rate") * F.col("total"))).alias("x")
    )
    spectrum = known.select(F.col("page").alias("doc_id"), F.explode("words.n").alias("freq")).groupBy("doc_id", "freq").agg(F.count("*").alias("words"))
    rows = sums.join(spark.sql(CURVES, spectrum=spectrum).withColumnRenamed("doc_id", "page"), "page")
    part = lambda c: F.when(F.col("language").isNotNull(), F.coalesce(c, F.lit(0.0)) / F.col("total"))
    rows = materialize(rows.select("page", "language", "total", "share", part("r").alias("repeated"), part("f").alias("foreign"), part("x").alias("excess"), "slope", "residual", F.floor(F.log2(F.col("total").cast("double"))).cast("int").alias("bin")), "features")
    values = ["language", "total", "share", *TOLERANCE, "flagged"]
    rows = _flagged(rows).select("page", *values)
    rows = ids.select("doc_id", "page").join(rows, "page").groupBy("doc_id").agg(*(F.max(c).alias(c) for c in values))
    names = documents.where("lang is not null").groupBy(language_code(F.col("lang")).alias("language")).agg(F.min(F.lower(F.trim("lang"))).alias("name"))
    names = _small(names.join(common.select("language").distinct(), "language", "left_semi"))
    rows = rows.join(names, "language", "left").withColumn("language", F.col("name"))
    return rows.select("doc_id", "language", "total", *(F.round(c, 6).alias(c) for c in ("share", *TOLERANCE)), "flagged")


def _flagged(rows: DataFrame) -> DataFrame:
    """``rows`` with flagged: whether a measure is extreme among the prose pages of the language and length."""
    prose = rows.where(F.col("share") >= PROSE_SHARE)
    quartiles = lambda names: [F.percentile_approx(c, [0.25, 0.5, 0.75], 1000).alias("q_" + c) for c in names]
    near = prose.groupBy("language", "bin").agg(F.count("*").alias("near"), *quartiles(TOLERANCE))
    wide = prose.groupBy("language").agg(*(x.alias("w_" + c) for c, x in zip(TOLERANCE, quartiles(TOLERANCE), strict=True) if c not in CURVE))
    rows = rows.join(_small(near), ["language", "bin"], "left").join(_small(wide), "language", "left")
    comparable = F.coalesce(F.col("near") >= COMPARABLE, F.lit(False))
    out = F.lit(False)
    for c, tolerance in TOLERANCE.items():
        q = F.when(comparable, F.col("q_" + c)) if c in CURVE else F.when(comparable, F.col("q_" + c)).otherwise(F.col("w_" + c))
        away = F.col(c) - F.get(q, F.lit(1))
        least = tolerance + SLOPE_ERROR / F.sqrt(F.col("total").cast("double")) if c == "slope" else F.lit(tolerance)
        scale = F.greatest((F.get(q, F.lit(2)) - F.get(q, F.lit(0))) / 1.349, least)
        out = out | F.coalesce((F.abs(away) if c in CURVE else away) / scale > EXTREME, F.lit(False))
    return rows.withColumn("flagged", out & (F.col("total") >= LEAST_WORDS))
