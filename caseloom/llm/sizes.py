"""Sizes of texts in tokens."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from caseloom.session import ship

ship(__name__)

#: Fixed value: a maximal run of letters, digits and underscores, or one of other non-blank characters.
WORD_OR_MARK = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def word_count(text: Column) -> Column:
    """Number of tokens of ``text`` by the word-and-punctuation rule; 0 for null and blank texts."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_OR_MARK)), F.lit(0)).cast("long")


_encoders: dict = {}


def _encoder(path: str):
    if path not in _encoders:
        from tokenizers import Tokenizer

        _encoders[path] = Tokenizer.from_file(path)
        _encoders[path].encode_special_tokens = True
    return _encoders[path]


def vocabulary_count(text: Column, path: str) -> Column:
    """Number of tokens of ``text`` by the public tokenizer file at ``path`` (JSON); 0 for null texts."""

    @F.pandas_udf("long")
    def count(texts: pd.Series) -> pd.Series:
        return pd.Series([len(e.ids) for e in _encoder(path).encode_batch(texts.fillna("").tolist(), add_special_tokens=False)], dtype="int64")

    return count(text)
