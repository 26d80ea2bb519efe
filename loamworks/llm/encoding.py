"""Encoding of texts by a public byte-level BPE, as a tree reduction over pieces of a text.

Encodings form a monoid under ``join``: halves are encoded apart, and neighbours are joined by encoding a window
around their seam again. The window grows from the seam to the nearest places where a character that is not white space
is followed by a blank, tab or line end. The tokenizer's pattern never matches across such a place, whatever stands around it, so
the tokens outside the window are those of the whole text.
"""

from __future__ import annotations

import base64
import functools
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from loamworks.functions.tokens import PATTERN

FOLDER = "/opt/tokenizers"
LEAF = 1 << 13
_SAFE = re.compile(r"\S(?=[ \n\t])")


@dataclass(frozen=True)
class Encoded:
    """A text, its ids, and the number of bytes of each token."""

    text: str
    ids: list[int]


class Encoder:
    """byte_bpe_50k from a file of ranks; strings that look like special tokens are ordinary text."""

    def __init__(self, path: str) -> None:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.plain = tiktoken.Encoding(os.path.basename(path), pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.width = {v: len(k) for k, v in ranks.items()}

    def leaf(self, text: str) -> Encoded:
        return Encoded(text, self.plain.encode_ordinary(text))

    def encode(self, text: str | None) -> list[int]:
        """Ids of a text; empty for null and empty texts."""
        return self.tree(text).ids if text else []

    def tree(self, text: str) -> Encoded:
        if len(text) <= LEAF:
            return self.leaf(text)
        half = len(text) // 2
        return self.join(self.tree(text[:half]), self.tree(text[half:]))

    def join(self, a: Encoded, b: Encoded) -> Encoded:
        """Encoding of a's text followed by b's."""
        left, right = self._before(a.text), self._after(b.text)
        seam = self.plain.encode_ordinary(a.text[left:] + b.text[:right])
        keep_a = a.ids[: len(a.ids) - self._tokens(reversed(a.ids), len(a.text[left:].encode()))]
        keep_b = b.ids[self._tokens(iter(b.ids), len(b.text[:right].encode())) :]
        return Encoded(a.text + b.text, keep_a + seam + keep_b)

    def _tokens(self, ids: Iterator[int], size: int) -> int:
        """Number of tokens from the start of ids that make up so many bytes."""
        n = 0
        while size > 0:
            size -= self.width[next(ids)]
            n += 1
        return n

    @staticmethod
    def _before(text: str) -> int:
        """Last safe place of a text, 0 if it has none; the window doubles until it holds one."""
        size = 64
        while True:
            start = max(0, len(text) - size)
            found = [m.end() for m in _SAFE.finditer(text, start)]
            if found:
                return found[-1]
            if not start:
                return 0
            size *= 2

    @staticmethod
    def _after(text: str) -> int:
        """First safe place of a text, its length if it has none."""
        m = _SAFE.search(text)
        return m.end() if m else len(text)


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def encode(docs: DataFrame, folder: str = FOLDER) -> DataFrame:
    """(doc_id, ids): ids of every document of (doc_id, text); an empty list for null and empty text."""
    path = f"{folder}/byte_bpe_50k.tiktoken"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [np.array(encoder(path).encode(x), np.int32) for x in batch["text"].to_pylist()]
            ends = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*ids, np.empty(0, np.int32)])))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], lists], names=["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def token_counts(docs: DataFrame, folder: str = FOLDER) -> DataFrame:
    """(doc_id, tokens) of every document of (doc_id, text)."""
    path = f"{folder}/byte_bpe_50k.tiktoken"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [len(encoder(path).encode(x)) for x in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(counts, pa.int64())], names=["doc_id", "tokens"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, tokens long")


def decode(encoded: DataFrame, folder: str = FOLDER) -> DataFrame:
    """(doc_id, text) of (doc_id, ids): the tokens' bytes one after the other."""
    path = f"{folder}/byte_bpe_50k.tiktoken"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if x is None else encoder(path).plain.decode_bytes(x).decode("utf-8", "replace") for x in batch["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {encoded.schema['doc_id'].dataType.simpleString()}, text string")
