"""Language of texts and of the stretches of mixed texts, by word-first backoff.

A word that the labelled samples hold is scored by its log frequency in each language. Any other word is scored by its
longest character n-grams that the samples hold: those of five characters, where none is known those of four, and so on
down to single letters. Units (sentences and lines) take the language of the best sum; short foreign pieces are absorbed,
and what is left in one language is a stretch.
"""

from __future__ import annotations

import heapq
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of labelled samples the model is fitted on at most; the smallest sample ids are taken.
SAMPLE_ROWS = 20_000
LONGEST = 5
#: Words, or Japanese characters, that make a stretch.
WORDS, CHARACTERS = 20, 40
_MEMO = 400_000

_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*|\d+")
_KANA = re.compile(r"[぀-ヿ㐀-鿿豈-﫿々〆ー]")
_HIDDEN = re.compile("[­​-‏‪-‮⁠-⁤﻿\x00-\x08\x0b\x0c\x0e-\x1f\x7f]")
_FENCE = re.compile(r"^[ \t]*(```|~~~)[^\n]*\n.*?(?:^[ \t]*\1[ \t]*$|\Z)", re.M | re.S)
_QUOTE = re.compile(r"\"[^\"\n]+\"|“[^”\n]+”|„[^“”\n]+[“”]|«[^»\n]+»|»[^«\n]+«|「[^」\n]+」|『[^』\n]+』")
_DROP = re.compile(r"^\s*(?:\|.*|[-*_=]{3,}|(?:\S*\d[\d.:/-]*,?\s+){1,3}\S+:?|[^\s]+ \(?\d{1,2}[.:]\d{2}\)?:?|@\S+:?|(?:https?://|www\.)\S+)\s*$")
_UNIT = re.compile(r"(?<=[.!?…。！？])[\s)\"”»]+|(?<=[。！？])|\n+")
_BROKEN = re.compile("[ÃÂÐÑÅâ][\u0080-¿Œ-Ÿ–-™]")


def fold(word: str) -> str:
    """A word without diacritics."""
    return "".join(c for c in unicodedata.normalize("NFD", word.replace("ß", "ss").replace("ł", "l")) if not unicodedata.combining(c))


def repaired(text: str) -> str:
    """A text with broken UTF-8 put right where possible, composed, and without control and zero-width characters."""
    if len(_BROKEN.findall(text)) > 2:
        for code in ("cp1252", "latin-1"):
            try:
                text = text.encode(code).decode("utf-8")
                break
            except UnicodeError:
                continue
        else:
            text = re.sub("[\u0080-ÿŒ-Ÿ–-™]{2,}", _repair_piece, text)
    return _HIDDEN.sub("", unicodedata.normalize("NFC", text))


def _repair_piece(m: re.Match) -> str:
    for code in ("cp1252", "latin-1"):
        try:
            return m[0].encode(code).decode("utf-8")
        except UnicodeError:
            continue
    return m[0]


class Model:
    """Log frequencies of words and character n-grams in each language."""

    def __init__(self, samples: list[tuple[str, str]]) -> None:
        self.langs = sorted({lang for _, lang in samples})
        index = {x: i for i, x in enumerate(self.langs)}
        words: dict[str, Counter] = defaultdict(Counter)
        grams: list[dict[str, Counter]] = [defaultdict(Counter) for _ in range(LONGEST + 1)]
        for text, lang in samples:
            text = repaired(text)
            for w in {"ja": _KANA}.get(lang, _WORD).findall(text):
                low = w.lower()
                if low.isdigit():
                    continue
                for form in {low, fold(low)}:
                    words[form][index[lang]] += 1
                    if w[0].isupper() and text.find(w) and len(w) > 1:
                        continue
                    padded = f"<{form}>"
                    for n in range(1, LONGEST + 1):
                        for i in range(len(padded) - n + 1):
                            grams[n][padded[i : i + n]][index[lang]] += 1
        self.words = self._log(words)
        self.grams = [self._log(g) for g in grams]

    def _log(self, table: dict[str, Counter]) -> dict[str, np.ndarray]:
        """Log probability of each language for each key, all languages taken as equally likely before."""
        total = np.ones(len(self.langs))
        for c in table.values():
            for i, n in c.items():
                total[i] += n
        unseen, out = 0.02 / total.max(), {}
        for key, c in table.items():
            p = np.full(len(self.langs), unseen)
            for i, n in c.items():
                p[i] += n / total[i]
            out[key] = np.log(p / p.sum()).astype(np.float32)
        return out

    def known(self, low: str) -> bool:
        return low in self.words

    def score(self, low: str) -> np.ndarray:
        """Log probability of each language given a lower-cased word."""
        found = self.words.get(low)
        if found is not None:
            return found
        padded = f"<{low}>"
        for n in range(LONGEST, 0, -1):
            hits = [g for i in range(len(padded) - n + 1) if (g := self.grams[n].get(padded[i : i + n])) is not None]
            if hits:
                return np.mean(hits, axis=0) * np.float32(0.2 * n)
        return np.zeros(len(self.langs), np.float32)


class _Memo(dict):
    """Number of each word form met; the rows of scores belong to the numbers."""

    def __init__(self, model: Model) -> None:
        super().__init__()
        self.model, self.rows, self.count, self.sure = model, [], [], []

    def __missing__(self, word: str) -> int:
        low = word.lower()
        known = self.model.known(low)
        number = low.isdigit()
        name = not known and word[0].isupper() and not low[0].isdigit() and not (word.isupper() and len(word) > 1)
        self.rows.append(np.zeros(len(self.model.langs), np.float32) if number or name else self.model.score(low))
        self.count.append(not name)
        self.sure.append(known)
        self[word] = at = len(self.rows) - 1
        return at


def units(text: str) -> list[str]:
    """Sentences and lines of a text without code, tables, user lines and shorter quotations."""
    text = repaired(text).replace("\r\n", "\n").replace("\r", "\n")
    if "```" in text or "~~~" in text:
        text = _FENCE.sub("\n", text)
    if '"' in text or any(c in text for c in "“„«»「『"):
        text = _QUOTE.sub(lambda m: m[0] if len(_WORD.findall(m[0])) >= WORDS else " ", text)
    out = []
    for line in text.split("\n"):
        if line and not _DROP.match(line):
            out += [x for x in _UNIT.split(line) if x]
    return out


def stretches(parts: list[tuple[int, int, float]], least: list[int]) -> list[tuple[int, int, float]]:
    """(language, size, evidence) of each stretch, from (language, size, evidence) of each unit in reading order."""
    runs: list[list] = []
    for lang, size, weight in parts:
        if runs and runs[-1][0] == lang:
            runs[-1][1] += size
            runs[-1][2] += weight
        else:
            runs.append([lang, size, weight])
    kept = _merged([x for x in _absorbed(runs, least) if x[1] >= least[x[0]]])
    if not kept and runs:
        total: dict[int, list] = {}
        for lang, size, weight in runs:
            t = total.setdefault(lang, [lang, 0, 0.0])
            t[1] += size
            t[2] += weight
        best = max(total.values(), key=lambda x: x[1])
        kept = [best] if best[1] >= least[best[0]] else []
    return [tuple(x) for x in kept]


def _absorbed(runs: list[list], least: list[int]) -> list[list]:
    """Runs in which no short one stands between two of one language: it goes, smallest first, and its neighbours are one."""
    if all(x[1] >= least[x[0]] for x in runs):
        return runs
    runs, n = [list(x) for x in runs], len(runs)
    before, after, gone = list(range(-1, n - 1)), list(range(1, n + 1)), [False] * n
    heap = [(x[1] / least[x[0]], i) for i, x in enumerate(runs) if x[1] < least[x[0]]]
    heapq.heapify(heap)
    while heap:
        size, i = heapq.heappop(heap)
        a, b = before[i], after[i]
        if gone[i] or size != runs[i][1] / least[runs[i][0]] or a < 0 or b == n or runs[a][0] != runs[b][0]:
            continue
        runs[a][1] += runs[b][1]
        runs[a][2] += runs[b][2]
        gone[i] = gone[b] = True
        after[a] = after[b]
        if after[b] < n:
            before[after[b]] = a
        for x in (before[a], a, after[a]):
            if 0 <= x < n and runs[x][1] < least[runs[x][0]]:
                heapq.heappush(heap, (runs[x][1] / least[runs[x][0]], x))
    return [x for x, out in zip(runs, gone) if not out]


def _merged(runs: list[list]) -> list[list]:
    out: list[list] = []
    for x in runs:
        if out and out[-1][0] == x[0]:
            out[-1][1] += x[1]
            out[-1][2] += x[2]
        else:
            out.append(list(x))
    return out


class Detector:
    """Finds the stretches of many texts with one model."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.memo = _Memo(model)
        self.ja = model.langs.index("ja") if "ja" in model.langs else -1
        self.least = [CHARACTERS if i == self.ja else WORDS for i in range(len(model.langs))]

    def find(self, texts: list[str | None]) -> list[list[tuple[str, int, float]]]:
        """(language, words or characters, confidence) of each stretch of each text, in reading order."""
        if len(self.memo) > _MEMO:
            self.memo = _Memo(self.model)
        ids: list[int] = []
        starts: list[int] = []
        owner: list[int] = []
        look = self.memo.__getitem__
        for at, text in enumerate(texts):
            if not text or text.isspace():
                continue
            for unit in units(text):
                japanese = len(_KANA.findall(unit)) if not unit.isascii() else 0
                words = _WORD.findall(unit) if japanese < 3 else _KANA.findall(unit)
                if not words:
                    continue
                starts.append(len(ids))
                owner.append(at)
                ids.extend(map(look, words))
        out: list[list[tuple[str, int, float]]] = [[] for _ in texts]
        if not ids:
            return out
        i = np.array(ids)
        score = np.add.reduceat(np.array(self.memo.rows)[i], starts, axis=0)
        size = np.add.reduceat(np.array(self.memo.count)[i].astype(np.int64), starts)
        sure = np.add.reduceat(np.array(self.memo.sure)[i].astype(np.int64), starts)
        lang = score.argmax(axis=1)
        top = score.max(axis=1, keepdims=True)
        chance = 1 / np.exp(np.maximum(score - top, -50)).sum(axis=1)
        per_text: dict[int, list[tuple[int, int, float]]] = defaultdict(list)
        for n, (o, x, s, k, p) in enumerate(zip(owner, lang.tolist(), size.tolist(), sure.tolist(), chance.tolist())):
            if k == 0 or k * 4 < s or p < 0.5:
                if not per_text[o] or k == 0:
                    continue
                x = per_text[o][-1][0]
                if x == self.ja:
                    continue
            per_text[o].append((x, s, p * s))
        for o, parts in per_text.items():
            out[o] = [(self.model.langs[x], s, w / s) for x, s, w in stretches(parts, self.least)]
        return out


def fit(samples: DataFrame) -> Model:
    """Model from (sample_id, text, lang), on at most SAMPLE_ROWS rows with both text and language."""
    rows = samples.where("text is not null and lang is not null").orderBy("sample_id").limit(SAMPLE_ROWS).select("text", "lang").collect()
    if not rows:
        raise ValueError("no labelled samples")
    return Model([(r["text"], r["lang"]) for r in rows])


def _segments(docs: DataFrame, samples: DataFrame) -> DataFrame:
    """(doc_id, said, seg_no, lang, size, confidence, segments) of each stretch; said is the document's own label."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(samples))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        detector = Detector(shared.value)
        for batch in batches:
            found = detector.find(batch["text"].to_pylist())
            rows = [(at, n, *x, len(some)) for at, some in enumerate(found) for n, x in enumerate(some, 1)]
            at, no, lang, size, sure, segments = zip(*rows) if rows else ((), (), (), (), (), ())
            where = pa.array(at, pa.int64())
            arrays = [batch["doc_id"].take(where), batch["said"].take(where), pa.array(no, pa.int32()), pa.array(lang, pa.string()), pa.array(size, pa.int32()), pa.array(sure, pa.float64()), pa.array(segments, pa.int32())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "said", "seg_no", "lang", "size", "confidence", "segments"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    said = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    return docs.select("doc_id", said.alias("said"), "text").mapInArrow(run, f"doc_id {kind}, said string, seg_no int, lang string, size int, confidence double, segments int")


def language_stretches(docs: DataFrame, samples: DataFrame) -> DataFrame:
    """(doc_id, seg_no, lang, size, confidence): one row for each stretch of each text of (doc_id, text).

    size counts words, for Japanese characters. Null, empty, blank and wordless texts, and texts with less than a
    stretch in any language, have no rows. Extra columns are ignored.
    """
    return _segments(docs, samples).select("doc_id", "seg_no", "lang", "size", "confidence")


def mislabelled(docs: DataFrame, samples: DataFrame, notations: DataFrame) -> DataFrame:
    """(doc_id, seg_no, lang, confidence) of every stretch of the texts whose label is missing or wrong.

    docs: (doc_id, text, lang); notations: (label, lang). A text with one stretch is listed unless notations gives its
    language for exactly its label; a text with several always. A null label is never right.
    """
    meant = notations.select(F.col("label").alias("said"), F.col("lang").alias("meant")).dropDuplicates()
    meant = F.broadcast(meant) if meant.count() <= 10_000 else meant
    found = _segments(docs, samples)
    right = (found["segments"] == 1) & (found["said"] == meant["said"]) & (found["lang"] == meant["meant"])
    return found.join(meant, right, "left_anti").select("doc_id", "seg_no", "lang", "confidence")
