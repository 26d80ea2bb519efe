"""Token counts by a public byte-level BPE; the vocabulary file is a parameter."""

from __future__ import annotations

import base64
import functools
import os

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Pattern of the public vocabulary's words (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@functools.lru_cache(maxsize=4)
def encoding(path: str):
    """The tokenizer of a file of ranks, loaded once for each worker. Special tokens are ordinary text."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(os.path.basename(path), pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def count(text: str, path: str) -> int:
    return len(encoding(path).encode_ordinary(text))


def tail(text: str, n: int, path: str) -> str:
    """The last n tokens of a text; a character that is cut becomes U+FFFD."""
    ids = encoding(path).encode_ordinary(text)
    return text if len(ids) <= n else encoding(path).decode(ids[-n:]) if n > 0 else ""


def head(text: str, n: int, path: str) -> str:
    """The first n tokens of a text."""
    ids = encoding(path).encode_ordinary(text)
    return text if len(ids) <= n else encoding(path).decode(ids[:n])


def token_count(text: Column, path: str) -> Column:
    """Number of tokens; 0 for null and empty texts."""

    @F.pandas_udf("int")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([count(x, path) if x else 0 for x in texts], dtype="int32")

    return run(text)


def first_tokens(text: Column, n: int, path: str) -> Column:
    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([None if x is None else head(x, n, path) for x in texts])

    return run(text)


def last_tokens(text: Column, n: int, path: str) -> Column:
    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([None if x is None else tail(x, n, path) for x in texts])

    return run(text)
