"""Word shingles of a batch of texts as 50-bit hashes, vectorised with numpy.

A word is a longest run of letters and digits, lower-cased; a shingle is a sequence of ``k``
consecutive words. Null and empty texts have no shingles.
"""

from __future__ import annotations

import functools
import re

import numpy as np

BITS = 50
_MASK = np.uint64((1 << BITS) - 1)
_BASE = 0x9E3779B97F4A7C15
_BATCH = 1 << (64 - BITS)
_CHARS = 1 << 20
_BLANK = re.compile(r"\n\s*\n")


@functools.cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """For each code point: is it a letter or digit, and a random value of its lower case."""
    chars = [chr(i) for i in range(0x30000)]
    alnum = np.fromiter((c.isalnum() for c in chars), bool, len(chars))
    lower = np.fromiter((ord(x) if len(x := c.lower()) == 1 else ord(c) for c in chars), np.uint64, len(chars))
    return alnum, mix(lower + np.uint64(0x51ED))


@functools.lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    inverse = pow(_BASE, -1, 1 << 64)
    out = []
    for base in (_BASE, inverse):
        p = np.full(n, base, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads each input bit over all 64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(index of the text, hash) of each word, in reading order; works through about _CHARS characters at a time."""
    at, held, out = 0, 0, []
    for i, x in enumerate(texts):
        held += len(x or "")
        if held >= _CHARS or i == len(texts) - 1:
            doc, word = _word_hashes(texts[at : i + 1])
            out.append((doc + at, word))
            at, held = i + 1, 0
    if not out:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    return np.concatenate([x for x, _ in out]), np.concatenate([x for _, x in out])


def _word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    joined = "\n".join(x or "" for x in texts)
    codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    if not len(codes):
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    alnum, value = _tables()
    codes = np.minimum(codes, np.uint32(len(alnum) - 1))
    inside = alnum[codes]
    edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    start, end = edge[::2], edge[1::2]
    if not len(start):
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    power, inverse = _powers(1 << max(16, int(len(codes)).bit_length()))
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(value[codes] * power[: len(codes)], out=sums[1:])
    word = mix((sums[end] - sums[start]) * inverse[start])
    ends = np.cumsum([len(x or "") + 1 for x in texts])
    return np.searchsorted(ends, start, side="right"), word


def shingles(texts: list[str | None], k: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text: offsets (one more than texts) and hashes, ascending in each text."""
    parts = [(len(some), *word_hashes(some)) for at in range(0, len(texts), _BATCH) if (some := texts[at : at + _BATCH])]
    return _sets(parts, k)


def _sets(parts: list[tuple[int, np.ndarray, np.ndarray]], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of the words (texts, index of the text, hash) of some batches of texts."""
    hashes, counts = [], []
    for texts, doc, word in parts:
        n = max(0, len(word) - k + 1)
        h = np.zeros(n, np.uint64)
        for i in range(k):
            h = mix(h * np.uint64(0xD6E8FEB86659FD93) + word[i : n + i])
        whole = doc[:n] == doc[k - 1 : n + k - 1] if n else np.zeros(0, bool)
        key = np.sort((doc[:n][whole].astype(np.uint64) << np.uint64(BITS)) | (h[whole] & _MASK))
        if len(key):
            key = key[np.concatenate(([True], key[1:] != key[:-1]))]
        counts.append(np.bincount((key >> np.uint64(BITS)).astype(np.int64), minlength=texts))
        hashes.append(key & _MASK)
    offsets = np.concatenate(([0], np.cumsum(np.concatenate(counts)))) if counts else np.zeros(1, np.int64)
    return offsets.astype(np.int64), np.concatenate(hashes) if hashes else np.empty(0, np.uint64)


def with_paragraphs(texts: list[str | None], k: int = 3) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """As shingles, and (index of the text, hash, words) of each distinct paragraph with words: its words in their order."""
    parts, docs, prints, words = [], [], [], []
    for at in range(0, len(texts), _BATCH):
        some = [_BLANK.split(x) if x else [] for x in texts[at : at + _BATCH]]
        owner = np.repeat(np.arange(len(some)), [len(x) for x in some])
        place, word = word_hashes([x for one in some for x in one])
        parts.append((len(some), owner[place], word))
        start = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1]))) if len(place) else np.empty(0, np.int64)
        if len(start):
            n = np.diff(np.append(start, len(place)))
            nth = (np.arange(len(place)) - np.repeat(start, n)).astype(np.uint64)
            both = np.stack((owner[place[start]].astype(np.uint64), mix(np.add.reduceat(mix(word + mix(nth)), start)), n.astype(np.uint64)), axis=1)
            both = np.unique(both, axis=0)
            docs.append(both[:, 0].astype(np.int64) + at)
            prints.append(both[:, 1])
            words.append(both[:, 2].astype(np.int32))
    offsets, h = _sets(parts, k)
    joined = lambda x, kind: np.concatenate(x) if x else np.empty(0, kind)
    return offsets, h, joined(docs, np.int64), joined(prints, np.uint64), joined(words, np.int32)


def fingerprints(offsets: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """One 64-bit value for each set of shingles; equal sets have equal values, 0 stands for no shingles."""
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(mix(hashes + np.uint64(0xA5A5)), out=sums[1:])
    out = mix(sums[offsets[1:]] - sums[offsets[:-1]] + np.diff(offsets).astype(np.uint64))
    return np.where(np.diff(offsets) == 0, np.uint64(0), np.maximum(out, np.uint64(1)))
