"""Problem 3: one consistent form for text that looks the same but differs in characters.

Characters with an own look-alike are mapped first (full-width forms, ligatures, letters of other
scripts, kinds of blanks and hyphens, invisible characters). The words that still hold other
characters than plain ones are grouped under the accent- and case-sensitive Unicode collation, which
equates what the mapping cannot, such as an accent of its own and one that is part of its letter; the
shortest, then smallest member of each class is its canonical form and is joined back.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.session import discard, materialize, ship

ship(__name__)

# Letters of other scripts and the Latin letters that look the same, in the same order.
CYRILLIC = "аеорсухіјѕһԁԛԝӏАВЕКМНОРСТХІЈЅԚԜҮ"
CYRILLIC_AS = "aeopcyxijshdqwlABEKMHOPCTXIJSQWY"
GREEK = "οϳΑΒΕΖΗΙΚΜΝΟΡΤΥΧͿμ"
GREEK_AS = "ojABEZHIKMNOPTYXJµ"
HYPHENS = "‐‑"
LIGATURES = {"ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "st", "ﬆ": "st"}
BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0                　"
#: Ranges of characters that do not show.
INVISIBLE = [(0x00, 0x08), (0x0E, 0x1B), (0x7F, 0x84), (0x86, 0x9F), (0xAD, 0xAD), (0x034F, 0x034F), (0x061C, 0x061C), (0x180B, 0x180F), (0x200B, 0x200F), (0x202A, 0x202E), (0x2060, 0x2064), (0x2066, 0x206F), (0xFE00, 0xFE0F), (0xFEFF, 0xFEFF), (0xFFF9, 0xFFFB)]
#: What the mapping leaves untouched: texts of such characters only, with single blanks inside.
PLAIN = r"^[\x21-\x7e]*( [\x21-\x7e]+)*$"


def _character_map() -> dict[int, str]:
    out = {c: "" for lo, hi in INVISIBLE for c in range(lo, hi + 1)}
    out |= {0xFF01 + i: chr(0x21 + i) for i in range(94)}
    out |= {ord(c): " " for c in BLANKS} | {ord(c): "-" for c in HYPHENS}
    out |= {ord(a): b for a, b in zip(CYRILLIC + GREEK, CYRILLIC_AS + GREEK_AS, strict=True)}
    return out | {ord(a): b for a, b in LIGATURES.items()}


#: Code point to its replacement, ligatures included; the empty string deletes.
CHARACTER_MAP = _character_map()


def map_lookalikes(text: Column) -> Column:
    """``text`` after the character mapping, runs of blanks as one blank, none at the ends."""
    single = {c: r for c, r in CHARACTER_MAP.items() if len(r) == 1}
    gone = "".join(chr(c) for c, r in CHARACTER_MAP.items() if r == "" and c)
    source = "".join(map(chr, single)) + gone + "\0"
    out = F.translate(text, source, "".join(single.values()))
    for a, b in LIGATURES.items():
        out = F.replace(out, F.lit(a), F.lit(b))
    out = F.trim(F.regexp_replace(out, " {2,}", " "))
    return F.when(text.rlike(PLAIN), text).otherwise(out)


CLASSES = """
WITH words AS (
  SELECT DISTINCT word FROM {words}
), members AS (
  SELECT word FROM words
  UNION
  SELECT regexp_replace(word, '[^!-~]', '') FROM words
  UNION
  SELECT composed FROM {words}
), classes AS (
  SELECT min(struct(char_length(word) AS size, word)).word AS canonical
  FROM members WHERE word <> '' GROUP BY word COLLATE UNICODE
)
SELECT w.word, c.canonical
FROM words w JOIN classes c ON w.word COLLATE UNICODE = c.canonical COLLATE UNICODE
WHERE w.word <> c.canonical
"""


def canonical_words(words: DataFrame) -> DataFrame:
    """(word, canonical) for the words of column ``word`` that are not the canonical member of their class.

    A class also holds the plain characters and the composed form of each of its words, whether these were
    seen or not: a word that only adds characters without a weight of their own goes to the plain word, and
    an accent of its own to the letter that has it, whatever punctuation stands beside.
    """

    @F.pandas_udf("string")
    def composed(word: pd.Series) -> pd.Series:
        return word.map(lambda w: unicodedata.normalize("NFC", w), na_action="ignore")

    return words.sparkSession.sql(CLASSES, words=words.select("word").distinct().withColumn("composed", composed("word")))


def canonical_text(rows: DataFrame, columns: list[str], key: str) -> DataFrame:
    """``rows`` with each of ``columns`` brought to the canonical form; ``key`` tells the rows apart.

    Nulls stay null; empty texts and those of blanks or invisible characters only become empty. All
    other columns are kept as they are. Texts meet no other row: words travel, and only odd ones.
    """
    mapped = rows
    for c in columns:
        mapped = mapped.withColumn(c, map_lookalikes(F.col(c)))
    mapped = materialize(mapped, "mapped")
    odd = lambda c: F.filter(F.split(F.col(c), " "), lambda w: w.rlike("[^!-~]"))
    words = mapped.select(key, F.explode(F.array_distinct(F.flatten(F.array(*(F.coalesce(odd(c), F.array().cast("array<string>")) for c in columns))))).alias("word"))
    changed = materialize(canonical_words(words.select("word")), "canonical")
    if changed.limit(1).count() == 0:
        discard(changed)
        return mapped
    own = words.join(changed, "word").groupBy(key).agg(F.map_from_entries(F.collect_set(F.struct("word", "canonical"))).alias("__to"))
    out = mapped.join(own, key, "left")
    for c in columns:
        renamed = F.array_join(F.transform(F.split(F.col(c), " "), lambda w: F.coalesce(F.try_element_at(F.col("__to"), w), w)), " ")
        out = out.withColumn(c, F.when(F.col("__to").isNull(), F.col(c)).otherwise(renamed))
    return out.drop("__to")


def lookalike_quotes(labels: DataFrame, cases: DataFrame) -> DataFrame:
    """(request_sha256) of quotes that are not literally in their case's text but read the same as a passage.

    Null and empty quotes, those that show nothing, and rows without a case are none. Repeated rows
    count once; a case with several texts is tried with each.
    """
    quotes = labels.where("evidence_quote <> '' and request_sha256 is not null").select("request_sha256", "case_id", F.col("evidence_quote").alias("quote"))
    texts = cases.select("case_id", F.col("raw_case_text").alias("text")).where("text is not null")
    pairs = quotes.join(texts, "case_id").where(~F.col("text").contains(F.col("quote"))).select("request_sha256", "quote", "text")
    pairs = pairs.withColumn("pair", F.xxhash64("request_sha256", "quote", "text"))
    same = canonical_text(pairs, ["quote", "text"], "pair")
    return same.where("quote <> ''").where(F.col("text").contains(F.col("quote"))).select("request_sha256").distinct()
