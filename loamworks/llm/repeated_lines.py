"""Lines that stand on many pages of one site.

The texts are read once: each page becomes the hashes of its lines, as they stand and by their letters alone. The
documents of a site have dense numbers, so the documents of a line are a bitmap: 64-bit words, of which the empty ones are
not stored. Variants of a line (letter case, digits, punctuation, list marks) have the same letters; their bitmaps are
united by ``bit_or``, and the exact cardinality is the sum of the words' set bits. An occurrence is repeated if the
bitmap of its line holds its document. Words of one line are aggregated apart, so a line that stands on a third of all
pages is no hot group.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loamworks.llm.common import cut_lineage, normalised_url, shuffle_partitions, site_of, written
from loamworks.llm.shingles import _powers, mix

#: Rows of a table up to which it is sent to every task, counted first; beyond that it is joined by shuffle.
FEW_ROWS = 1_000_000
_CHARS = 1 << 20


@functools.cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """For each code point: is it a letter, and a random value of its lower case."""
    chars = [chr(i) for i in range(0x33480)]
    letter = np.fromiter((c.isalpha() for c in chars), bool, len(chars))
    return letter, mix(np.fromiter((ord(c.lower()[0]) for c in chars), np.uint64, len(chars)) + np.uint64(0x51ED))


def _sums(value: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each slice of values, which depends on their order and number; 0 for an empty one."""
    power, inverse = _powers(1 << max(16, (len(value) + 1).bit_length()))
    sums = np.zeros(len(value) + 1, np.uint64)
    np.cumsum(value * power[: len(value)], out=sums[1:])
    h = mix((sums[end] - sums[start]) * inverse[start] + mix((end - start).astype(np.uint64)))
    return np.where(end > start, np.maximum(h, np.uint64(1)), np.uint64(0))


def line_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lines of each text, and for each line, split at line feeds, a hash of it as it stands and one of its letters in lower case.

    The hash of a line without characters, or without letters, is 0. A null text has no lines.
    """
    counts = np.array([0 if x is None else x.count("\n") + 1 for x in texts], np.int64)
    raws, keys, held, at = [], [], 0, 0
    for i, x in enumerate(texts):
        held += len(x or "")
        if held >= _CHARS or i == len(texts) - 1:
            raw, key = _line_hashes([y for y in texts[at : i + 1] if y is not None])
            raws.append(raw)
            keys.append(key)
            held, at = 0, i + 1
    joined = lambda x: np.concatenate(x) if x else np.empty(0, np.uint64)
    return counts, joined(raws), joined(keys)


def _line_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    if not texts:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    codes = np.frombuffer("\n".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    feed = np.flatnonzero(codes == 10)
    start, end = np.concatenate(([0], feed + 1)), np.append(feed, len(codes))
    letter, value = _tables()
    known = np.minimum(codes, np.uint32(len(letter) - 1))
    inside = letter[known]
    nth = np.concatenate(([0], np.cumsum(inside)))
    return _sums(mix(codes.astype(np.uint64) + np.uint64(0xA5)), start, end), _sums(value[known[inside]], nth[start], nth[end])


def read_lines(pages: DataFrame) -> DataFrame:
    """(page_id, site, url, raws, keys) of pages that have a site and text: 64-bit hashes, those of the lines in arrays."""
    kind = pages.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, raw, key = line_hashes(batch["markdown"].to_pylist())
            ends = pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32))
            arrays = [pa.ListArray.from_arrays(ends, pa.array(x.view(np.int64))) for x in (raw, key)]
            yield pa.RecordBatch.from_arrays([batch["page_id"], batch["site"], batch["url"], *arrays], names=["page_id", "site", "url", "raws", "keys"])

    at = pages.select("page_id", site_of(F.col("source_url")).alias("host"), normalised_url(F.col("source_url")).alias("url"), "markdown")
    at = at.where("host is not null and markdown is not null").select("page_id", F.xxhash64("host").alias("site"), F.xxhash64("url").alias("url"), "markdown")
    return at.mapInArrow(run, f"page_id {kind}, site long, url long, raws array<long>, keys array<long>")


def numbered(documents: DataFrame) -> DataFrame:
    """(site, url, doc): the different urls of each site (site, url), numbered from 0 without gaps, in salted groups."""
    salts = 4 * shuffle_partitions(documents.sparkSession)
    each = cut_lineage(documents.select("site", "url").distinct().withColumn("salt", F.pmod("url", F.lit(salts)).cast("int")))
    sizes = each.groupBy("site", "salt").agg(F.count("*").alias("n"))
    before = F.sum("n").over(W.partitionBy("site").orderBy("salt").rowsBetween(W.unboundedPreceding, -1))
    start = sizes.select("site", "salt", F.coalesce(before, F.lit(0)).alias("start"))
    nth = F.row_number().over(W.partitionBy("site", "salt").orderBy("url"))
    return each.withColumn("nth", nth).join(start, ["site", "salt"]).select("site", "url", (F.col("start") + F.col("nth") - 1).cast("long").alias("doc"))


def bitmaps(lines: DataFrame) -> DataFrame:
    """(site, raw, key, word, bits) of lines (site, raw, key, doc): the documents of each line as it stands, as a sparse bitmap."""
    bit = F.expr("shiftleft(1L, cast(doc & 63 as int))")
    return lines.groupBy("site", "raw", "key", F.shiftright("doc", 6).alias("word")).agg(F.bit_or(bit).alias("bits"))


def repeated(of_lines: DataFrame, least: int) -> DataFrame:
    """(site, key, word, bits) of the lines whose variants, bitmaps of lines as they stand, have ``least`` or more documents together."""
    united = of_lines.groupBy("site", "key", "word").agg(F.bit_or("bits").alias("bits"))
    united = written(united)
    often = united.groupBy("site", "key").agg(F.sum(F.bit_count("bits").cast("long")).alias("documents")).where(F.col("documents") >= least)
    return united.join(often.select("site", "key"), ["site", "key"], "left_semi")


def _small(rows: DataFrame) -> DataFrame:
    rows = cut_lineage(rows)
    return F.broadcast(rows) if rows.count() <= FEW_ROWS else rows


def numbered_lines(read: DataFrame, docs: DataFrame) -> DataFrame:
    """(page_id, line_no, site, raw, key, doc) of each line with a letter, from what read_lines and numbered give."""
    line = F.posexplode(F.arrays_zip("raws", "keys")).alias("at", "line")
    lines = read.join(docs, ["site", "url"]).select("page_id", "site", "doc", line).where("line.keys <> 0")
    return lines.select("page_id", (F.col("at") + 1).alias("line_no"), "site", F.col("line.raws").alias("raw"), F.col("line.keys").alias("key"), "doc")


def found_in(lines: DataFrame, held: DataFrame) -> DataFrame:
    """(page_id, line_no) of the lines whose document is in the bitmap (site, key, word, bits) of their letters."""
    found = lines.withColumn("word", F.shiftright("doc", 6)).join(held, ["site", "key", "word"])
    return found.where("bits & shiftleft(1L, cast(doc & 63 as int)) <> 0").select("page_id", "line_no")


def repeated_lines(pages: DataFrame, least: int = 8) -> DataFrame:
    """(page_id, line_no) of every occurrence of a line that stands on ``least`` or more documents of its site.

    Documents are the different normalised URLs of a site; a page without an http(s) host has no site and no rows.
    Null or blank markdown has no lines; lines without a letter never count. page_id must be unique, extra columns are
    ignored, an empty table gives no rows.
    """
    read = written(read_lines(pages))
    lines = numbered_lines(read, _small(numbered(read)))
    return found_in(lines, _small(repeated(bitmaps(lines), least)))


def without_repeated_lines(pages: DataFrame, least: int = 8) -> DataFrame:
    """(page_id, markdown) with every repeated line removed; pages without one keep their text as it is."""
    drop = repeated_lines(pages, least).groupBy("page_id").agg(F.collect_set("line_no").alias("drop"))
    left = F.expr("array_join(filter(split(markdown, '\\n', -1), (x, i) -> not array_contains(drop, i + 1)), '\\n')")
    return pages.select("page_id", "markdown").join(drop, "page_id", "left").select("page_id", F.when(F.col("drop").isNull(), F.col("markdown")).otherwise(left).alias("markdown"))
