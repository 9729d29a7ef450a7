"""Text cleaning and leak checks, quote alignment, image inspection."""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.functions.text import occurrences, sentence_spans, shares_ngram, slice_text, strip, word_count
from caseloom.session import ship

ship(__name__)

# Fixed value: words that tell that the diagnosis is already known.
AFTER_DIAGNOSIS = (
    r"(?iU)\b(?:diagnos\w*|confirmed|positive for|treated|treatment|therapy|therapeutic|administered|prescribed|"
    r"discharged|follow.up|recovered|recovery|died|antibiotic\w*|antiviral\w*|antifungal\w*|antituberc\w*)\b"
)


def clean_prefix(rows: DataFrame, mentions: DataFrame, key: str, least_words: int = 30, title_run: int = 8) -> DataFrame:
    """``rows`` with clinical_text, clinical_source_end, reason: the source up to the first sentence that tells the diagnosis.

    ``rows`` has (key, raw_case_text, evidence, evidence_start, title); ``mentions`` (key, start, end) the
    alias matches. The prefix ends at the evidence or at an earlier sentence with an alias or a cue. It
    fails as too short, or, whatever its length, as leaking if it holds an alias, the evidence or a run
    of ``title_run`` title words. Without evidence nothing is cut by it.
    """
    hits = mentions.groupBy(key).agg(F.collect_set(F.struct("start", "end")).alias("__hits"))
    df = rows.join(hits, key, "left").withColumn("__hits", F.coalesce("__hits", F.array().cast("array<struct<start:int,end:int>>")))
    text, at = F.col("raw_case_text"), F.coalesce(F.col("evidence_start"), F.length("raw_case_text"))
    tells = F.filter(
        sentence_spans(text),
        lambda s: (s["start"] < at)
        & (F.exists("__hits", lambda h: (h["start"] >= s["start"]) & (h["end"] <= s["end"])) | slice_text(text, s["start"], s["end"]).rlike(AFTER_DIAGNOSIS)),
    )
    end = F.coalesce(F.get(tells, F.lit(0))["start"], at)
    df = df.withColumn("clinical_source_end", end.cast("int")).withColumn("clinical_text", strip(F.substring(text, F.lit(1), end)))
    inside = F.exists("__hits", lambda h: h["end"] <= F.col("clinical_source_end"))
    quoted = (strip(F.col("evidence")) != "") & F.col("clinical_text").contains(strip(F.col("evidence")))
    leaks = F.coalesce(inside, F.lit(False)) | F.coalesce(quoted, F.lit(False)) | shares_ngram(F.col("title"), F.col("clinical_text"), title_run)
    short = F.coalesce(word_count(F.col("clinical_text")), F.lit(0)) < least_words
    return df.withColumn("reason", F.when(leaks, "TEXT_LABEL_LEAKAGE").when(short, "TEXT_TOO_SHORT").otherwise("PASS")).drop("__hits")


#: Fixed value: white space of any kind, and line breaks that are spelled out as a backslash with r or n.
BLANKS = r"(?U)(?:[\s\x{1c}-\x{1f}]|\\r\\n|\\[nr])+"


def squeeze(x: Column) -> Column:
    """``x`` with every run of white space and spelled-out line breaks as one blank."""
    return F.regexp_replace(x, BLANKS, " ")


def align_quotes(rows: DataFrame, text: str, quote: str) -> DataFrame:
    """``rows`` with aligned_start and aligned_end of ``quote`` in ``text``, null if it is not there just once.

    Runs of white space and spelled-out line breaks are alike. An offset in the squeezed text plus what
    the runs before it lost is the offset in the text. What stands at the offsets must be unique as well.
    """
    out = rows.withColumn("__s", squeeze(F.col(text))).withColumn("__q", F.trim(squeeze(F.col(quote))))
    lost = F.transform(F.regexp_extract_all(F.col(text), F.lit(BLANKS), F.lit(0)), lambda r: F.length(r) - 1)

    def raw(at: Column) -> Column:
        """Offset in the text of the character at offset ``at`` of the squeezed text."""
        before = F.substring("__s", F.lit(1), at)
        blanks = F.length(before) - F.length(F.replace(before, F.lit(" "), F.lit("")))
        return at + F.aggregate(F.slice("__lost", F.lit(1), blanks), F.lit(0), lambda a, x: a + x)

    out = out.withColumn("__lost", lost).withColumn("__i", F.when(occurrences(F.col("__s"), F.col("__q")) == 1, F.instr("__s", F.col("__q")) - 1))
    out = out.withColumn("__a", raw(F.col("__i"))).withColumn("__b", raw(F.col("__i") + F.length("__q") - 1) + 1)
    once = occurrences(F.col(text), slice_text(F.col(text), F.col("__a"), F.col("__b"))) == 1
    out = out.withColumn("aligned_start", F.when(once, F.col("__a")).cast("int")).withColumn("aligned_end", F.when(once, F.col("__b")).cast("int"))
    return out.drop("__s", "__q", "__lost", "__i", "__a", "__b")


def decode_png(data: bytes) -> np.ndarray:
    """Pixels (height, width, channels) of an 8-bit grey, RGB or RGBA image without interlacing."""
    if data[:8] != b"\x89PNG\r\n\x1a\n":
        raise ValueError("not a PNG file")
    at, body, head = 8, b"", None
    while at < len(data):
        size, kind = struct.unpack(">I4s", data[at : at + 8])
        chunk = data[at + 8 : at + 8 + size]
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", chunk)
        elif kind == b"IDAT":
            body += chunk
        at += 12 + size
    if head is None or head[2] != 8 or head[3] not in (0, 2, 6) or head[6]:
        raise ValueError("unsupported PNG")
    width, height, channels = head[0], head[1], {0: 1, 2: 3, 6: 4}[head[3]]
    raw = np.frombuffer(zlib.decompress(body), dtype=np.uint8).reshape(height, width * channels + 1)
    out = np.zeros((height, width * channels), dtype=np.uint8)
    above = np.zeros(width * channels, dtype=np.int32)
    for y in range(height):
        line, kind = raw[y, 1:].astype(np.int32), raw[y, 0]
        if kind == 2:
            line = (line + above) & 255
        elif kind in (1, 3, 4):
            for x in range(len(line)):
                a = line[x - channels] if x >= channels else 0
                b, c = above[x], above[x - channels] if x >= channels else 0
                if kind == 1:
                    guess = a
                elif kind == 3:
                    guess = (a + b) // 2
                else:
                    p = a + b - c
                    guess = min((a, b, c), key=lambda v, p=p: abs(p - v))
                line[x] = (line[x] + guess) & 255
        out[y], above = line, line
    return out.reshape(height, width, channels)


def encode_png(pixels: np.ndarray) -> bytes:
    """A PNG file of 8-bit grey, RGB or RGBA ``pixels`` (height, width, channels)."""
    height, width, channels = pixels.shape
    raw = np.concatenate([np.zeros((height, 1), dtype=np.uint8), pixels.reshape(height, width * channels)], axis=1)
    chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    head = struct.pack(">IIBBBBB", width, height, 8, {1: 0, 3: 2, 4: 6}[channels], 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(raw.tobytes())) + chunk(b"IEND", b"")


def shrink(pixels: np.ndarray, most: int = 3072) -> np.ndarray:
    """``pixels`` with no side above ``most``, proportions kept: each new pixel is the mean of those it stands for."""
    step = -(-max(pixels.shape[:2]) // most)
    if step <= 1:
        return pixels
    height, width = (-(-n // step) * step for n in pixels.shape[:2])
    full = np.pad(pixels, ((0, height - pixels.shape[0]), (0, width - pixels.shape[1]), (0, 0)), mode="edge")
    return full.reshape(height // step, step, width // step, step, -1).mean(axis=(1, 3)).round().astype(np.uint8)


def review_images(files: DataFrame, most: int = 3072) -> DataFrame:
    """(path, image) for ``files`` (path, content): what a reviewer is sent, no side above ``most``; null if unreadable."""

    @F.pandas_udf("binary")
    def small(content: pd.Series) -> pd.Series:
        def one(data):
            try:
                return encode_png(shrink(decode_png(bytes(data or b"")), most))
            except (ValueError, struct.error, zlib.error):
                return None

        return content.map(one)

    return files.select("path", small("content").alias("image"))


def perceptual_hash(pixels: np.ndarray) -> str:
    """64 bits in hex: signs of the low cosine frequencies of the 32 x 32 grey image against their median."""
    grey = pixels[..., :3].mean(axis=2) if pixels.shape[2] >= 3 else pixels[..., 0].astype(float)
    ys, xs = (np.linspace(0, n, 33).astype(int) for n in grey.shape)
    total = np.pad(grey.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    hi_y, hi_x = np.maximum(ys[1:], ys[:-1] + 1).clip(max=grey.shape[0]), np.maximum(xs[1:], xs[:-1] + 1).clip(max=grey.shape[1])
    lo_y, lo_x = np.minimum(ys[:-1], hi_y - 1), np.minimum(xs[:-1], hi_x - 1)
    small = (total[hi_y][:, hi_x] - total[lo_y][:, hi_x] - total[hi_y][:, lo_x] + total[lo_y][:, lo_x]) / np.outer(hi_y - lo_y, hi_x - lo_x)
    k, n = np.arange(8)[:, None], np.arange(32)[None]
    basis = np.cos(np.pi * k * (2 * n + 1) / 64)
    low = basis @ small @ basis.T
    bits = (low > np.median(low)).ravel()
    return f"{int(''.join('1' if b else '0' for b in bits), 2):016x}"


def inspect_images(files: DataFrame, least_side: int = 64, most_bytes: int = 50_000_000) -> DataFrame:
    """(path, image_sha256, width, height, pixel_sha256, perceptual_hash, reason) for ``files`` (path, content).

    reason is PASS, IMAGE_EMPTY, IMAGE_TOO_LARGE, IMAGE_UNREADABLE or IMAGE_TOO_SMALL.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for path, data in zip(batch["path"], batch["content"], strict=True):
                data = bytes(data or b"")
                row = [path, hashlib.sha256(data).hexdigest(), None, None, None, None]
                try:
                    if not data:
                        reason = "IMAGE_EMPTY"
                    elif len(data) > most_bytes:
                        reason = "IMAGE_TOO_LARGE"
                    else:
                        pixels = decode_png(data)
                        row[2:] = [pixels.shape[1], pixels.shape[0], hashlib.sha256(pixels.tobytes()).hexdigest(), perceptual_hash(pixels)]
                        reason = "PASS" if min(pixels.shape[:2]) >= least_side else "IMAGE_TOO_SMALL"
                except (ValueError, struct.error, zlib.error):
                    reason = "IMAGE_UNREADABLE"
                out.append((*row, reason))
            yield pd.DataFrame(out, columns=["path", "image_sha256", "width", "height", "pixel_sha256", "perceptual_hash", "reason"]).astype({"width": "Int32", "height": "Int32"})

    return files.select("path", "content").mapInPandas(run, "path string, image_sha256 string, width int, height int, pixel_sha256 string, perceptual_hash string, reason string")


def usable(*conditions: Column) -> Column:
    """All of ``conditions``, where null means no."""
    out = F.lit(True)
    for c in conditions:
        out = out & F.coalesce(c, F.lit(False))
    return out
