"""Text expressions that stay in the JVM; offsets are zero-based code points, half open."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_OPEN, _CLOSE = "\ue000", "\ue001"
#: Fixed value: a run without sentence marks and line breaks, ended by marks or the end of the text.
SENTENCE = r"[^.!?\n]+(?:[.!?]+|$)"


def strip(x: Column) -> Column:
    """Without Unicode white space at the ends; ``trim`` would take blanks only."""
    return F.regexp_replace(x, r"(?U)^\s+|\s+$", "")


def word_count(x: Column) -> Column:
    """Words between white space; 0 for blank texts, null for null."""
    return F.regexp_count(x, F.lit(r"(?U)\S+"))


def tokens(x: Column) -> Column:
    """Lower-case runs of word characters as an array."""
    return F.regexp_extract_all(F.lower(x), F.lit(r"(?U)\w+"), F.lit(0))


def hash_fraction(x: Column) -> Column:
    """The first 32 bits of the SHA-256 of ``x`` as a number in [0, 1)."""
    return F.conv(F.substring(F.sha2(x, 256), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def utc_iso(at: Column | None = None) -> Column:
    """A timestamp, now by default, as an ISO time in UTC with seconds; sessions run in UTC."""
    return F.date_format(F.current_timestamp() if at is None else at, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


def canonical_json(**fields: Column) -> Column:
    """JSON with sorted keys, no blanks and nulls kept, so equal records give equal strings."""
    return F.to_json(F.struct(*(fields[k].alias(k) for k in sorted(fields))), {"ignoreNullFields": "false"})


def sentence_count(text: Column) -> Column:
    return F.size(F.filter(F.regexp_extract_all(text, F.lit(SENTENCE), F.lit(0)), lambda s: strip(s) != ""))


def sentence_spans(text: Column) -> Column:
    """array<struct<start, end>> of the non-blank sentences of ``text``.

    The sentences are marked in the text, which is cut at the marks; the offsets are running lengths,
    as positions of the regular-expression functions count UTF-16 units. Lines without a sentence mark
    that do not end the text belong to no sentence.
    """
    pieces = F.split(F.regexp_replace(text, f"({SENTENCE})", f"{_OPEN}$1{_CLOSE}"), _CLOSE)
    empty = F.array().cast("array<struct<start:int,end:int>>")
    zero = F.struct(F.lit(0).alias("at"), empty.alias("spans"))

    def step(acc: Column, piece: Column) -> Column:
        opened = F.instr(piece, _OPEN)
        start, end = acc["at"] + opened - 1, acc["at"] + F.length(piece) - 1
        body = F.substring(piece, opened + 1, F.length(piece))
        span = F.struct(start.cast("int").alias("start"), end.cast("int").alias("end"))
        spans = F.when((opened > 0) & (strip(body) != ""), F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"])
        return F.struct(F.when(opened > 0, end).otherwise(acc["at"] + F.length(piece)).cast("int").alias("at"), spans.alias("spans"))

    return F.aggregate(pieces, zero, step, lambda acc: acc["spans"])


def enclosing_span(spans: Column, start: Column, end: Column) -> Column:
    """The first of ``spans`` that holds [start, end), or null."""
    return F.get(F.filter(spans, lambda s: (s["start"] <= start) & (start < end) & (end <= s["end"])), F.lit(0))


def slice_text(text: Column, start: Column, end: Column) -> Column:
    return F.substring(text, start + 1, end - start)


def exact_evidence(text: Column, quote: Column, start: Column, end: Column) -> Column:
    """Whether ``quote`` is not blank and stands in ``text`` at [start, end); false for nulls."""
    inside = (start >= 0) & (start < end) & (end <= F.length(text))
    return F.coalesce(inside & (strip(quote) != "") & (slice_text(text, start, end) == quote), F.lit(False))


def occurrences(text: Column, quote: Column) -> Column:
    """How often ``quote`` stands in ``text`` without overlap; 0 for an empty or null quote."""
    cut = F.length(text) - F.length(F.replace(text, quote, F.lit("")))
    return F.coalesce(F.when(quote != "", (cut / F.length(quote)).cast("int")), F.lit(0))


def unique_quote_start(text: Column, quote: Column) -> Column:
    """Offset of ``quote`` if it stands in ``text`` just once, else null."""
    return F.when(occurrences(text, quote) == 1, F.instr(text, quote) - 1)


def shares_ngram(needle: Column, text: Column, n: int) -> Column:
    """Whether a run of ``n`` tokens of ``needle`` stands in the tokens of ``text``; shorter needles have none."""
    words = tokens(needle)
    runs = F.when(F.size(words) >= n, F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(words) - n + 1)), lambda i: F.array_join(F.slice(words, i, n), " ")))
    joined = F.array_join(tokens(text), " ")
    return F.coalesce(F.exists(runs, lambda r: joined.contains(r)), F.lit(False))
