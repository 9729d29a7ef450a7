"""Problem 4: near-duplicate texts, by combinations of rare and frequent tokens.

A text is the set of its runs of ``width`` words, the tokens, ordered from rare to frequent. Of two
texts that share enough, both prefixes hold common tokens. The prefix is extended so far that the
common part must hold one rare token or two frequent tokens of one class: tokens of the frequent kind
are dealt to classes by hash, each class of j tokens in the prefix answers for j - 1 that may be
missing, each rare token for one. So rare tokens are indexed alone, frequent ones by the pairs within
a class, which few texts share. Texts that meet are told apart by their sizes, by how much of the
prefix lies before the meeting point and by a parity bitmap that bounds their difference from below;
what remains is verified on the texts. No step samples or caps, so no pair is lost.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.llm.components import connected_components
from caseloom.llm.shingles import BLOCK, TOKEN_BITS, distinct_tokens, mix, shingle_hashes, sorted_unique
from caseloom.session import is_small, materialize, ship

ship(__name__)

#: Tokens in at most this many texts are indexed alone.
RARE = 12
#: The frequency table has 8 counters for a text, at most 2 ** 26 of one byte; tokens that share one only order worse.
MOST_COUNTER_BITS = 26
SLICE_BITS = 16
#: Classes of the levels; a level serves texts of more tokens than (classes + 1) / similarity.
LEVELS = (8, 32, 128, 512, 2048, 8192, 32768)
#: Rows of keys that are broadcast; beyond, they are joined by a shuffle.
MOST_BROADCAST = 1_000_000
PAIRS_AT_ONCE = 2_000_000
#: Postings of a part, and how many a text has; fewer parts hold fewer copies of a text's bitmap.
PART_POSTINGS, TEXT_POSTINGS, LEAST_PARTS = 4_000_000, 130, 16


def _code(counts: np.ndarray) -> np.ndarray:
    """Counts on a logarithmic scale in one byte."""
    return np.minimum(255, np.round(12 * np.log2(counts.astype(np.float64) + 1))).astype(np.uint8)


def _blocks(batches: Iterator[pd.DataFrame], *columns: str) -> Iterator[tuple]:
    for batch in batches:
        for at in range(0, len(batch), BLOCK):
            part = batch.iloc[at : at + BLOCK]
            yield tuple(part[c].tolist() for c in columns)


def frequency_table(texts: DataFrame, width: int, count: int) -> np.ndarray:
    """Byte codes of how many rows hold a token, by its low bits: counted over all rows, in slices."""
    bits = min(MOST_COUNTER_BITS, max(SLICE_BITS, math.ceil(math.log2(8 * max(1, count)))))

    def tally(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(1 << bits, dtype=np.uint32)
        for (own,) in _blocks(batches, "text"):
            doc, tok = distinct_tokens(*shingle_hashes(own, width))
            at = np.sort((tok & np.uint64((1 << bits) - 1)).astype(np.uint32))
            cut = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1]))) if len(at) else at
            total[at[cut]] += np.diff(np.append(cut, len(at))).astype(np.uint32)
        rows = []
        for s in range(1 << (bits - SLICE_BITS)):
            part = total[s << SLICE_BITS : (s + 1) << SLICE_BITS]
            at = np.flatnonzero(part)
            if len(at):
                rows.append((s, zlib.compress(at.astype(np.uint16).tobytes(), 1) , zlib.compress(part[at].tobytes(), 1)))
        yield pd.DataFrame(rows, columns=["slice", "at", "n"])

    def merge(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(1 << SLICE_BITS, dtype=np.uint32)
        for at, n in zip(rows["at"], rows["n"], strict=True):
            total[np.frombuffer(zlib.decompress(at), dtype=np.uint16)] += np.frombuffer(zlib.decompress(n), dtype=np.uint32)
        return pd.DataFrame([(key[0], _code(total).tobytes())], columns=["slice", "codes"])

    counted = texts.select("text").mapInPandas(tally, "slice int, at binary, n binary")
    out = np.zeros(1 << bits, dtype=np.uint8)
    for r in counted.groupBy("slice").applyInPandas(merge, "slice int, codes binary").toLocalIterator():
        out[r["slice"] << SLICE_BITS : (r["slice"] + 1) << SLICE_BITS] = np.frombuffer(r["codes"], dtype=np.uint8)
    return out


def _starts(key: np.ndarray) -> np.ndarray:
    """For each element of sorted ``key`` the position where its run of equal values starts."""
    first = np.ones(len(key), dtype=bool)
    first[1:] = key[1:] != key[:-1]
    return np.maximum.accumulate(np.where(first, np.arange(len(key)), 0))


def signatures(doc: np.ndarray, tok: np.ndarray, size: np.ndarray, codes: np.ndarray, t: Fraction) -> tuple[np.ndarray, ...]:
    """(text number, signature, passed) of texts with ``size`` tokens each, ``doc`` and ``tok`` sorted.

    passed is how many missing tokens the prefix before the signature answers for.
    """
    code = codes[(tok & np.uint64(len(codes) - 1)).astype(np.int64)].astype(np.uint64)
    key = np.sort((doc.astype(np.uint64) << np.uint64(52)) | (code << np.uint64(TOKEN_BITS)) | tok)
    doc, code = (key >> np.uint64(52)).astype(np.int64), (key >> np.uint64(TOKEN_BITS)) & np.uint64(255)
    tok = mix(key & np.uint64((1 << TOKEN_BITS) - 1))
    need = size - np.ceil(size * t.numerator / t.denominator - 1e-9).astype(np.int64) + 1
    rare = code <= _code(np.array([RARE]))[0]
    out = []
    top = size.max(initial=0)
    for level in range(-1, len(LEVELS)):
        least = 0 if level < 0 else math.ceil((LEVELS[level] + 1) / t)
        if least > top:
            break
        # A pair belongs to the level of its smaller text; the larger one has at most 1 / t times as many.
        upto = math.ceil((LEVELS[level + 1] + 1) / t) / t if level + 1 < len(LEVELS) else math.inf
        pick = (size >= least) & (size < upto)
        sel = np.flatnonzero(pick[doc])
        if not len(sel):
            continue
        d, x = doc[sel], tok[sel]
        alone = np.ones(len(sel), dtype=bool) if level < 0 else rare[sel]
        if level < 0:
            cls = np.zeros(len(sel), dtype=np.uint64)
            seen = np.zeros(len(sel), dtype=np.int64)
        else:
            cls = np.where(alone, np.uint64(LEVELS[level]), x % np.uint64(LEVELS[level]))
            by = np.lexsort((cls, d)) if LEVELS[level] > 2048 else np.argsort(d.astype(np.uint64) * np.uint64(4096) + cls, kind="stable")
            group = d[by] * 65536 + cls[by].astype(np.int64)
            seen = np.empty(len(sel), dtype=np.int64)
            seen[by] = np.arange(len(sel)) - _starts(group)
        gives = np.where(alone, 1, (seen > 0).astype(np.int64))
        before = np.cumsum(gives) - gives
        before -= before[_starts(d)]
        inside = before < need[d]
        salt = np.uint64((level + 2) * 0x9E3779B97F4A7C15 % 2**64)
        one = inside & alone
        out.append((d[one], mix(x[one] + salt), before[one]))
        if level < 0:
            continue
        keep = np.flatnonzero((inside & ~alone)[by])
        g, gx, gd, gb = group[keep], x[by][keep], d[by][keep], before[by][keep]
        lag = 1
        while True:
            same = np.flatnonzero(g[lag:] == g[:-lag]) if lag < len(g) else np.zeros(0, dtype=np.int64)
            if not len(same):
                break
            out.append((gd[same], mix((gx[same] * np.uint64(31)) ^ mix(gx[same + lag]) ^ salt), gb[same + lag]))
            lag += 1
    if not out:
        z = np.zeros(0, dtype=np.int64)
        return z, z.astype(np.uint64), z
    return tuple(np.concatenate(p) for p in zip(*out, strict=True))


def _parity(doc: np.ndarray, tok: np.ndarray, n: int) -> np.ndarray:
    """256 bits for each text: the parity of its tokens by hash; two texts differ in no more bits than tokens."""
    bit = (mix(tok ^ np.uint64(0x5DEECE66D)) >> np.uint64(56)).astype(np.int64)
    return np.packbits((np.bincount(doc * 256 + bit, minlength=n * 256) & 1).astype(np.uint8).reshape(n, 256), axis=1)


def _postings(width: int, codes, t: Fraction, parts: int):
    """Stage that turns texts into packed postings by part: signatures with the texts' numbers, then the texts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table, known = codes.value, set()
        for ids, salts, texts in _blocks(batches, "h", "salt", "text"):
            new = [i for i, x in enumerate(ids) if x not in known and not known.add(x)]
            if len(known) > 1_000_000:
                known.clear()
            ids, texts = np.array([ids[i] for i in new], dtype=np.int64), [texts[i] for i in new]
            salt = np.array([salts[i] for i in new], dtype=np.int64).astype(np.uint64)
            doc, h = shingle_hashes(texts, width)
            if not len(doc):
                continue
            doc, tok = distinct_tokens(doc, h)
            size = np.bincount(doc, minlength=len(texts))
            bits = _parity(doc, tok, len(texts))
            doc, sig, passed = signatures(doc, tok, size, table, t)
            sig = mix(sig ^ salt[doc])
            part = (sig % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part * BLOCK + doc)
            doc, sig, passed, part = doc[order], sig[order], passed[order], part[order]
            starts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1]))) if len(part) else part
            narrow = np.min_scalar_type(int(passed.max(initial=0)))
            rows = []
            for first, end in zip(starts, [*starts[1:], len(part)], strict=True):  # only parts that have postings
                at, p = slice(first, end), int(part[first])
                number = np.bincount(doc[at], minlength=len(ids))
                own = np.flatnonzero(number)
                rows.append((p, (sig[at] >> np.uint64(32)).astype(np.uint32).tobytes(), passed[at].astype(narrow).tobytes(), ids[own].tobytes(), number[own].astype(np.uint32).tobytes(), size[own].astype(np.uint32).tobytes(), bits[own].tobytes()))
            yield pd.DataFrame(rows, columns=["part", "sig", "passed", "id", "number", "size", "bits"])

    return run


POSTINGS = "part int, sig binary, passed binary, id binary, number binary, size binary, bits binary"


def _meet(t: Fraction):
    """Stage that finds the texts that meet in a part and may be alike."""
    most = t / (1 + t)

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        join = lambda c, kind: np.concatenate([np.frombuffer(x, dtype=kind) for x in rows[c]])
        ids, number, size, bits = join("id", np.int64), join("number", np.uint32), join("size", np.uint32).astype(np.int64), join("bits", np.uint64).reshape(-1, 4)
        passed = np.concatenate([np.frombuffer(p, dtype=f"u{4 * len(p) // len(x)}").astype(np.int32) for p, x in zip(rows["passed"], rows["sig"], strict=True)])
        sig, doc = join("sig", np.uint32), np.repeat(np.arange(len(ids)), number)
        # Copies of a text that came from several tasks become one.
        ids, first, same = np.unique(ids, return_index=True, return_inverse=True)
        size, bits, doc = size[first], bits[first], same[doc]
        order = np.argsort(sig, kind="stable")
        sig = sig[order]
        shared = np.zeros(len(sig), dtype=bool)
        shared[1:] = sig[1:] == sig[:-1]
        shared[:-1] |= shared[1:]
        order = order[shared]
        group = np.cumsum(np.concatenate(([0], sig[shared][1:] != sig[shared][:-1]))) if len(order) else order
        doc, passed = doc[order], passed[order]
        order = np.lexsort((doc, size[doc], group))
        group, doc, passed = group[order], doc[order], passed[order]
        twice = np.ones(len(group), dtype=bool)
        twice[1:] = (group[1:] != group[:-1]) | (doc[1:] != doc[:-1])
        group, doc, passed = group[twice], doc[twice], passed[twice]
        n = size[doc]
        # A text may meet those of at most this size here, else too many of its tokens would be missing.
        limit = ((n - passed) * most.denominator) // most.numerator - n
        wide = int(n.max(initial=0)) + 2
        upto = np.minimum(np.searchsorted(group * wide + n, group * wide + np.clip(limit, 0, wide - 1), side="right"), np.arange(len(group)))
        start = _starts(group)
        count = np.maximum(upto - start, 0)
        found, done = [], 0
        ends = np.cumsum(count)
        while done < len(count):
            stop = max(done + 1, int(np.searchsorted(ends, (ends[done - 1] if done else 0) + PAIRS_AT_ONCE, side="right")))
            c = count[done:stop]
            y = np.repeat(np.arange(done, stop), c)
            x = start[y] + np.arange(len(y)) - np.repeat(np.cumsum(c) - c, c)
            ok = n[y] <= limit[x]
            pair = sorted_unique(doc[x[ok]] * len(ids) + doc[y[ok]])
            a, b = pair // len(ids), pair % len(ids)
            both = size[a] + size[b]
            apart = both - 2 * ((both * most.numerator + most.denominator - 1) // most.denominator)
            found.append(pair[np.bitwise_count(bits[a] ^ bits[b]).sum(axis=1) <= apart])
            done = stop
        pair = sorted_unique(np.concatenate(found)) if found else np.zeros(0, dtype=np.int64)
        a, b = (ids[pair // len(ids)], ids[pair % len(ids)]) if len(pair) else (pair, pair)
        return pd.DataFrame({"x": np.minimum(a, b), "y": np.maximum(a, b)})

    return run


def _token_sets(width: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for ids, texts in _blocks(batches, "h", "text"):
            doc, h = shingle_hashes(texts, width)
            cut = np.searchsorted(doc, np.arange(len(texts) + 1))
            yield pd.DataFrame({"h": ids, "tokens": [np.unique(h[cut[i] : cut[i + 1]]).astype(np.int64) for i in range(len(texts))]})

    return run


class NearDuplicates:
    """Texts of which at least the share ``similarity`` of their distinct word runs is common.

    ``rows`` has (doc_id, field, text): texts are compared within a field. Null texts and those shorter
    than ``width`` words are like no other. Equal texts are one class, known by its hash; ``pairs``
    holds the similar pairs of classes, a class with itself if several documents have its text.
    """

    def __init__(self, rows: DataFrame, width: int = 5, similarity: Fraction = Fraction(4, 5), parts: int | None = None) -> None:
        spark = rows.sparkSession
        rows = rows.where("text is not null and doc_id is not null")
        count = rows.count()
        codes = spark.sparkContext.broadcast(frequency_table(rows, width, count))  # at most 2 ** MOST_COUNTER_BITS bytes
        rows = rows.select("doc_id", "field", "text", F.xxhash64("field").alias("salt"), F.xxhash64("field", "text").alias("h"))
        self.rows = rows
        if parts is None:
            least = min(LEAST_PARTS, int(spark.conf.get("spark.sql.shuffle.partitions")))
            parts = max(least, math.ceil(count * TEXT_POSTINGS / PART_POSTINGS))
        posted = rows.select("h", "salt", "text").mapInPandas(_postings(width, codes, similarity, parts), POSTINGS)
        met = posted.groupBy("part").applyInPandas(_meet(similarity), "x long, y long")
        copies = rows.select("doc_id", "h").distinct().groupBy("h").count().where("count > 1").select(F.col("h").alias("x"), F.col("h").alias("y"))
        met = materialize(met.unionByName(copies).distinct(), "met")
        keys = materialize(met.select(F.explode(F.array("x", "y")).alias("h")).distinct(), "keys")
        self.keys = F.broadcast(keys) if is_small(keys, MOST_BROADCAST) else keys
        texts = rows.join(self.keys, "h", "left_semi").dropDuplicates(["h"]).select("h", "text")
        sets = materialize(texts.mapInPandas(_token_sets(width), "h long, tokens array<long>"), "sets")
        both = met.join(sets.select(F.col("h").alias("x"), F.col("tokens").alias("tx")), "x").join(sets.select(F.col("h").alias("y"), F.col("tokens").alias("ty")), "y")
        common, whole = F.size(F.array_intersect("tx", "ty")), F.size("tx") + F.size("ty")
        alike = (common * similarity.denominator >= (whole - common) * similarity.numerator) & (common > 0)
        self.pairs = materialize(both.where(alike).select("x", "y"), "pairs")

    def members(self) -> DataFrame:
        """(doc_id, h) of the documents that take part in a pair."""
        return self.rows.join(self.keys, "h", "left_semi").select("doc_id", "h").distinct()

    def document_pairs(self) -> DataFrame:
        """(a, b), a < b: all similar pairs of different documents, those of equal texts included."""
        own = materialize(self.members(), "members")
        out = self.pairs.join(own.select(F.col("h").alias("x"), F.col("doc_id").alias("a")), "x").join(own.select(F.col("h").alias("y"), F.col("doc_id").alias("b")), "y")
        return out.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    def _named(self) -> tuple[DataFrame, DataFrame]:
        """(doc_id, field, h) of all texts, and (h, first, n): the smallest document of each class and how many it has."""
        own = self.rows.select("doc_id", "field", "h").distinct()
        return own, own.groupBy("h").agg(F.min("doc_id").alias("first"), F.count("*").alias("n"))

    def groups(self) -> DataFrame:
        """(doc_id, field, group): the texts that similar pairs link, directly or through others; group is the smallest document of it.

        Classes are linked, not documents, so copies of a text add nothing to the graph; a text that is like
        no other is a group of its own class.
        """
        own, classes = self._named()
        found = connected_components(self.pairs.where("x <> y"), "x", "y").select(F.col("node").alias("h"), "component")
        classes = classes.join(found, "h", "left").withColumn("component", F.coalesce("component", "h"))
        least = classes.groupBy("component").agg(F.min("first").alias("group"))
        return own.join(classes.join(least, "component").select("h", "group"), "h").select("doc_id", "field", "group")

    def classes(self) -> DataFrame:
        """(doc_id, field, class, links): for each text the smallest document with an equal text, and how many other documents' texts are like it."""
        own, size = self._named()
        size = materialize(size, "classes")
        ends = self.pairs.where("x <> y").select(F.col("x").alias("h"), F.col("y").alias("o")).unionByName(self.pairs.where("x <> y").select(F.col("y").alias("h"), F.col("x").alias("o")))
        ends = ends.unionByName(self.pairs.where("x = y").select(F.col("x").alias("h"), F.col("y").alias("o")))
        links = ends.join(size.select(F.col("h").alias("o"), "n"), "o").groupBy("h").agg(F.sum(F.col("n") - F.when(F.col("h") == F.col("o"), 1).otherwise(0)).alias("links"))
        named = size.select("h", F.col("first").alias("class")).join(links, "h", "left")
        return own.join(named, "h").select("doc_id", "field", "class", F.coalesce("links", F.lit(0)).alias("links"))


def case_texts(cases: DataFrame, text_qc: DataFrame) -> DataFrame:
    """(doc_id, field, text) of the raw and the clinical texts of cases."""
    raw = cases.select(F.col("case_id").alias("doc_id"), F.lit("raw").alias("field"), F.col("raw_case_text").alias("text"))
    return raw.unionByName(text_qc.select(F.col("case_id").alias("doc_id"), F.lit("clinical").alias("field"), F.col("clinical_text").alias("text")))
