"""Exact set-similarity join of texts on word shingles, for one collection or new rows against old ones.

The shingles of each text are put in one global order, rare ones first. Two texts of Jaccard similarity ``t``
or more share at least ``l`` of the first ``n - ceil(t n) + l`` shingles of each, so with these dealt by hash
into ``m`` groups and ``l = 2 m + 1``, three shared ones lie in one group. The join keys are therefore n-grams
of a group's ordered prefix shingles: two shingles where that pair is already rare in the corpus, else three.
No similar pair is lost, and frequent phrases make no candidates by themselves.

Candidates pass a length and a positional filter where the keys meet, a suffix filter on bitmaps, and one exact
comparison for each pair. Texts with equal shingle sets form one class and are compared once. A class is named by a
64-bit fingerprint of its set: among n different sets the odds that any two share one are n * n / 2**65, 3 % at 1e9.

A key meets where its first shingle is dealt to. The sets of a first shingle that more than ``hot`` texts may have are
salted into blocks of about ``hot`` sets, and each two blocks meet in a cell, a task's worth of its own.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamworks.llm import shingles as S
from loamworks.llm.common import cut_lineage, shuffle_partitions

#: Cells of the count sketch: this many bits at least, and enough that two shingles of the mean count are still a rare pair.
SKETCH_BITS = 20
SKETCH_BLOCK = 1 << 16
#: Shingles of a text that the size of the sketch reckons with.
USUAL = 150
#: (groups m, least overlap served) of each level; a level serves the pairs up to the least overlap of the one before.
#: About three shared shingles for each group keep the most frequent shingles of a text out of its keys.
LEVELS = (*((round(4 * 2.5**i), round(12.4 * 2.5**i)) for i in range(13, -1, -1)), (1, 3), (0, 1))
#: A pair of shingles is a key by itself if chance lets at most so many texts share it, whatever the size of the corpus.
RARE = 0.7
#: Shingles whose keys are made at a time, those of one block, and those of the corpus for each part of the key space.
AT_ONCE, BLOCK, PART = 300_000, 2_000_000, 2_500_000
#: Texts that may share a first shingle before its sets are salted, at least, and as a multiple of the mean that the counts show.
HOT, HOT_MEAN = 4096, 4
#: Pairs formed at a time, different pairs held before they are passed on, and bytes of salted blocks passed on at a time.
PAIRS, HELD, CHUNK = 1 << 20, 1 << 21, 1 << 24
#: Members of a class that one block of the expansion into pairs holds.
MEMBERS = 1024
#: Ids up to which a semi-join sends them to every task instead of shuffling texts.
FEW_IDS = 1_000_000
_STEP = np.uint64(0xD6E8FEB86659FD93)
NEW, OLD = 1, 2


@dataclass
class SimilarTexts:
    """classes: (class, id, side) of each text that has shingles. links: (class_a, class_b, similarity), a < b."""

    classes: DataFrame
    links: DataFrame


def least_overlap(t: float, n: np.ndarray) -> np.ndarray:
    """Shingles that a set of n shares at least with any set of similarity t or more."""
    return np.ceil(t * n - 1e-9).astype(np.int64)


def bitmaps(offsets: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """256-bit parity bitmap of each set; bits that differ never outnumber shingles that differ."""
    n = len(offsets) - 1
    doc = np.repeat(np.arange(n), np.diff(offsets))
    cell = doc * 256 + ((hashes >> np.uint64(21)) & np.uint64(255)).astype(np.int64)
    odd = (np.bincount(cell, minlength=n * 256) & 1).astype(np.uint8)
    return np.packbits(odd.reshape(n, 256), axis=1)


def sketch_bits(texts: int) -> int:
    """Bits of the sketch for a corpus of so many texts; its size grows with the square root of the corpus."""
    return max(SKETCH_BITS, ceil(log2(USUAL * max(1, texts) / (RARE * max(1, texts)) ** 0.5)))


def sketch_rows(counts: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """(block, compressed counts) of each block of a sketch that isn't empty."""
    for at in range(0, len(counts), SKETCH_BLOCK):
        part = counts[at : at + SKETCH_BLOCK]
        if part.any():
            yield at // SKETCH_BLOCK, zlib.compress(part.tobytes(), 1)


def add_to_sketch(counts: np.ndarray, hashes: np.ndarray) -> None:
    cell, n = np.unique((hashes & np.uint64(len(counts) - 1)).astype(np.int64), return_counts=True)
    counts[cell] += n.astype(counts.dtype)


def _profile(batches: Iterator[pa.RecordBatch], k: int, bits: int) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(1 << bits, np.uint32)
    for batch in batches:
        offsets, h = S.shingles(batch["text"].to_pylist(), k)
        add_to_sketch(counts, h)
        some = np.flatnonzero(np.diff(offsets) > 0)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(S.fingerprints(offsets, h).view(np.int64)[some]),
                batch["id"].take(pa.array(some)),
                batch["side"].take(pa.array(some)),
                pa.nulls(len(some), pa.binary()),
                pa.nulls(len(some), pa.int32()),
            ],
            names=["class", "id", "side", "bits", "block"],
        )
    for block, part in sketch_rows(counts):
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int32()), pa.array([part], pa.binary()), pa.array([block], pa.int32())],
            names=["class", "id", "side", "bits", "block"],
        )


def _sum_block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranks (an eighth of a power of two each) and sum of one block of the sketch, over all tasks' counts."""
    total, block = np.zeros(SKETCH_BLOCK, np.int64), 0
    for batch in batches:
        for x in batch["bits"].to_pylist():
            total += np.frombuffer(zlib.decompress(x), np.uint32)
        block = batch["block"][0].as_py() if len(batch) else block
    ranks = np.minimum(255, 8 * np.log2(1 + total)).astype(np.uint8)
    yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([ranks.tobytes()], pa.binary()), pa.array([int(total.sum())])], names=["block", "ranks", "total"])


@dataclass(frozen=True)
class Order:
    """The order of all shingles, and how the key space is parted. Sets can be compared only if one order cut them.

    Any order loses no pair; one fitted on the corpus makes few candidates. ranks: of each cell of the sketch; texts: of
    the corpus; parts: labels of the parts of the key space, each in a hash partition of its own; blocks: those that the sets of a first shingle are salted
    into, by its rank.
    """

    ranks: np.ndarray
    texts: int
    parts: np.ndarray
    blocks: np.ndarray


def part_labels(spark: SparkSession, parts: int) -> np.ndarray:
    """Labels of so many parts, one for each of as many hash partitions."""
    more = 8 + ceil(2 * log2(parts + 1))
    while True:
        rows = spark.range(more * parts).groupBy(F.expr(f"pmod(hash(id), {parts})").alias("at")).agg(F.min("id").alias("id")).collect()
        if len(rows) == parts:
            return np.array(sorted(r["id"] for r in rows), np.int64)
        more *= 2


def fit_order(sketches: DataFrame, bits: int, texts: int, partitions: int, parts: int | None = None, hot: int | None = None) -> Order:
    """Order from the sketches (block, bits) of all tasks; the driver gets one byte for each cell."""
    ranks, total = np.zeros(1 << bits, np.uint8), 0
    for row in sketches.groupBy("block").applyInArrow(_sum_block, "block int, ranks binary, total long").collect():
        ranks[row["block"] * SKETCH_BLOCK : (row["block"] + 1) * SKETCH_BLOCK] = np.frombuffer(bytes(row["ranks"]), np.uint8)
        total += row["total"]
    parts = parts or max(1, 2 * partitions // 3, -(-total // PART))
    return Order(ranks, texts, part_labels(sketches.sparkSession, parts), salts(total / len(ranks), hot))


def join_keys(offsets: np.ndarray, hashes: np.ndarray, counts: np.ndarray, texts: int, t: float) -> tuple[np.ndarray, ...]:
    """(index of the set, key, key's first shingle, its rank, position of the last shingle) of every join key of these sets.

    counts: a count, or its rank, for each value of a shingle's lowest bits, from the whole corpus of so many texts.
    """
    out: list[tuple[np.ndarray, ...]] = []
    size = np.diff(offsets)
    for at in range(0, len(size), S._BATCH):
        n = size[at : at + S._BATCH]
        h = hashes[offsets[at] : offsets[at + len(n)]]
        doc = np.repeat(np.arange(len(n)), n).astype(np.uint64)
        rank = counts[(h & np.uint64(len(counts) - 1)).astype(np.int64)].astype(np.uint64)
        low = np.uint64(S.BITS - 8)
        order = np.sort((doc << np.uint64(S.BITS)) | (rank << low) | (h & np.uint64((1 << (S.BITS - 8)) - 1)))
        doc = (order >> np.uint64(S.BITS)).astype(np.int64)
        pos = np.arange(len(order)) - np.repeat(np.cumsum(n) - n, n)
        share = least_overlap(t, n)
        above = np.iinfo(np.int64).max
        for m, low_end in LEVELS:
            use = (n >= low_end) & (share < above)
            prefix = np.where(use, np.minimum(n, n - np.maximum(share, low_end) + 2 * m + 1), 0)
            keep = pos < prefix[doc]
            for d, *x in _grams(order[keep], pos[keep], m, texts):
                out.append((d + at, *x))
            above = low_end
    if not out:
        return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.uint64), np.empty(0, np.uint8), np.empty(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*out))


def _grams(order: np.ndarray, pos: np.ndarray, m: int, texts: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Keys of one level from (set, rank, hash) values in order."""
    low = S.BITS - 8
    value = S.mix((order & S._MASK) + np.uint64(m))
    doc = (order >> np.uint64(S.BITS)).astype(np.int64)
    rank = (order >> np.uint64(low)).astype(np.uint8)
    if m == 0:
        yield doc, value, value, rank, pos
        return
    group = doc * m + ((order >> np.uint64(17)) % np.uint64(m)).astype(np.int64) if m > 1 else doc
    if m > 1:
        by = np.argsort(group, kind="stable")
        group, value, pos, rank = group[by], value[by], pos[by], rank[by]
    often = np.exp2(rank.astype(np.float32) / 8)
    start = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1]))) if len(group) else np.empty(0, np.int64)
    length = np.diff(np.append(start, len(group)))
    end = np.repeat(start + length, length)
    at = np.arange(len(group))
    for a in range(1, int(length.max(initial=0))):
        i = at[at + a + 1 < end]
        j = i + a
        pair = S.mix(value[i] * _STEP + value[j])
        rare = often[i] * often[j] <= RARE * texts
        yield group[i[rare]] // m, pair[rare], value[i[rare]], rank[i[rare]], pos[j[rare]]
        i, j, pair = i[~rare], j[~rare], pair[~rare]
        for b in range(1, int(length.max(initial=0)) - a):
            more = j + b < end[i]
            if not more.any():
                break
            i, j, pair = i[more], j[more], pair[more]
            last = j + b
            yield group[i] // m, S.mix(pair * _STEP + value[last]), value[i], rank[i], pos[last]


def runs(sizes: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Consecutive ranges of sets that hold about ``most`` shingles each, at least one set."""
    group = (np.cumsum(sizes) - sizes) // most
    start = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1]))) if len(sizes) else np.empty(0, np.int64)
    return list(zip(start.tolist(), [*start[1:].tolist(), len(sizes)]))


def pack(part_of: int, docs: tuple[np.ndarray, ...], doc: np.ndarray, key: np.ndarray, part: np.ndarray, pos: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """The keys of some sets as one compact block for each part of the key space: sets, then the keys of each set.

    Keys with the same first shingle share a part, so a set is in few parts however many there are. A key is stored by
    32 bits within its part, its position by sixteenths of the set; collisions only make candidates.
    """
    ids, sizes, sides, bits = docs
    by = np.argsort(part.astype(np.int64) * len(ids) + doc, kind="stable")
    part, doc = part[by], doc[by]
    short, where = key[by], (pos[by] * 16 // sizes[doc]).astype(np.uint8)
    edges = np.searchsorted(part, np.arange(part_of + 1))
    for x in np.flatnonzero(np.diff(edges)):
        lo, hi = edges[x], edges[x + 1]
        first = np.flatnonzero(np.concatenate(([True], doc[lo + 1 : hi] != doc[lo : hi - 1])))
        here, count = doc[lo:hi][first], np.diff(np.append(first, hi - lo))
        size = sizes[here] * 4 + sides[here]
        wide = bool(size.max() >> 16 or count.max() >> 16)
        kind = np.uint32 if wide else np.uint16
        q = np.append(where[lo:hi], np.zeros((hi - lo) % 2, np.uint8))
        head = np.array([len(here), hi - lo, wide, 0], np.int64)
        yield int(x), b"".join(y.tobytes() for y in (head, ids[here], bits[here], size.astype(kind), count.astype(kind), short[lo:hi], q[::2] << 4 | q[1::2]))


def salts(counts: np.ndarray | float, hot: int | None = None) -> np.ndarray:
    """Blocks, for each rank of a key's first shingle, that its sets are salted into; 1 where they stay together.

    counts: those of the sketch, or their mean.
    """
    hot = hot or max(HOT, HOT_MEAN * int(np.mean(counts)))
    return np.exp2(np.ceil(np.maximum(0, np.arange(256) / 8 - np.log2(hot)))).astype(np.int64)


def pack_salted(docs: tuple[np.ndarray, ...], doc: np.ndarray, key: np.ndarray, lead: np.ndarray, blocks: np.ndarray, pos: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """Keys whose first shingle is hot, once for each cell (a block of its sets against another or itself); cells are negative."""
    salt = (S.mix(docs[0].view(np.uint64)[doc]) % blocks.astype(np.uint64)).astype(np.int64)
    by = np.lexsort((salt, lead))
    new = np.concatenate(([True], (lead[by][1:] != lead[by][:-1]) | (salt[by][1:] != salt[by][:-1])))
    first, group = by[new], np.empty(len(by), np.int64)
    group[by] = np.cumsum(new) - 1
    for g, block in pack(len(first), docs, doc, key, group, pos):
        mine, n = int(salt[first[g]]), int(blocks[first[g]])
        other = np.arange(n)
        cell = (np.minimum(mine, other) << 31 | np.maximum(mine, other)).astype(np.uint64)
        cell = -1 - (S.mix(lead[first[g]] + S.mix(cell)) >> np.uint64(1)).astype(np.int64)
        for x, at in enumerate(cell.tolist()):
            yield at, block[:24] + int(0 if x == mine else 1 if mine < x else 2).to_bytes(8, "little") + block[32:]


def unpack(block: bytes) -> tuple[np.ndarray, ...]:
    """(class, bitmap, size, side, half of the cell) of the sets of a block; (index of the set, key, sixteenth of the position) of its keys."""
    docs, keys, wide, half = np.frombuffer(block, np.int64, 4)
    kind = np.uint32 if wide else np.uint16
    at, out = 32, []
    for what, n in ((np.int64, docs), (np.uint64, 4 * docs), (kind, docs), (kind, docs), (np.uint32, keys), (np.uint8, (keys + 1) // 2)):
        out.append(np.frombuffer(block, what, n, at))
        at += out[-1].nbytes
    ids, bits, size, count, key, q = out
    q = np.stack((q >> 4, q & 15), axis=1).reshape(-1)[:keys]
    return ids, bits.reshape(-1, 4), (size >> 2).astype(np.int64), (size & 3).astype(np.uint8), np.full(docs, half, np.uint8), np.repeat(np.arange(docs), count), key, q


def meeting_pairs(blocks: list[bytes], t: float, old: int = 0) -> Iterator[np.ndarray]:
    """Pairs (a, b) of classes that meet in a key and pass the length, the positional and the suffix filter, in batches.

    The sets of the last ``old`` blocks count as old, whatever they were when they were packed.

    The sets of a key are ordered by half of the cell, new before old, and size, so that each set has to look at two
    ranges only: new and old ones of the other half (of its own if the cell has one) that are near it in size.
    """
    sets, keys, held = [], [], 0
    for no, x in enumerate(blocks):
        ids, bits, n, side, half, doc, key, q = unpack(x)
        sets.append((ids, bits, n, np.full_like(side, OLD) if no >= len(blocks) - old else side, half))
        keys.append((key.astype(np.uint64) << np.uint64(32)) | ((doc + held).astype(np.uint64) << np.uint64(4)) | q)
        held += len(ids)
    ids, bits, n, side, half = (np.concatenate(x) for x in zip(*sets))
    ids, first, same = np.unique(ids, return_index=True, return_inverse=True)
    sides = np.zeros(len(ids), np.uint8)
    np.bitwise_or.at(sides, same, side)
    n, segment = n[first], 2 * (half[first] == 2) + (sides & NEW == 0)
    order = np.lexsort((n, segment))
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    ids, bits, n, same = ids[order], bits[first[order]], n[order], place[same]
    edge = np.searchsorted(segment[order], np.arange(5))
    crossed = bool((half > 0).any())
    four, low = np.uint64(4), np.uint64((1 << 28) - 1)
    key = np.concatenate(keys)
    del keys, sets
    key = (key & ~(low << four)) | (same[(key >> four & low).astype(np.int32)].astype(np.uint64) << four)
    key.sort()
    key = key[np.concatenate(([True], key[1:] >> four != key[:-1] >> four))]
    start = np.flatnonzero(np.concatenate(([True], key[1:] >> np.uint64(32) != key[:-1] >> np.uint64(32))))
    length = np.diff(np.append(start, len(key)))
    start, length = start[length > 1], length[length > 1]
    held_pairs: list[np.ndarray] = []
    for at, to in runs(length, PAIRS):
        u = np.repeat(start[at:to] - np.cumsum(length[at:to]) + length[at:to], length[at:to]) + np.arange(length[at:to].sum())
        end = np.repeat(start[at:to] + length[at:to], length[at:to])
        mine = (key[u] >> four & low).astype(np.int64)
        old = mine >= edge[1]
        u, end, mine, old = (x[mine < edge[2 if crossed else 1]] for x in (u, end, mine, old))
        for seg in (2, 3) if crossed else (0, 1):
            look = np.ones(len(u), bool) if seg % 2 == 0 else ~old
            v, d, stop = u[look], mine[look], end[look]
            if not len(v) or edge[seg] == edge[seg + 1]:
                continue
            sizes = n[edge[seg] : edge[seg + 1]]
            near = np.searchsorted(sizes, np.ceil(t * n[d] - 1e-9)) + edge[seg]
            far = np.searchsorted(sizes, np.floor(n[d] / t + 1e-9), side="right") + edge[seg]
            head = key[v] >> np.uint64(32) << np.uint64(32)
            lo = np.maximum(v + 1, np.searchsorted(key, head | near.astype(np.uint64) << four))
            hi = np.minimum(stop, np.searchsorted(key, head | far.astype(np.uint64) << four))
            some = hi > lo
            v, lo, many = v[some], lo[some], (hi - lo)[some]
            for x, y in runs(many, PAIRS):
                a = np.repeat(v[x:y], many[x:y])
                b = np.repeat(lo[x:y] - np.cumsum(many[x:y]) + many[x:y], many[x:y]) + np.arange(len(a))
                held_pairs.append(_filtered(key[a], key[b], n, bits, t))
            if sum(len(x) for x in held_pairs) > HELD:
                held_pairs = [np.unique(np.concatenate(held_pairs))]
                if len(held_pairs[0]) > HELD // 2:
                    yield _named(held_pairs.pop(), ids)
    if held_pairs:
        yield _named(np.unique(np.concatenate(held_pairs)), ids)


def _filtered(u: np.ndarray, v: np.ndarray, n: np.ndarray, bits: np.ndarray, t: float) -> np.ndarray:
    """Different pairs, as one number each, of these entries (key, set, sixteenth) that the filters let pass."""
    a, b = ((x >> np.uint64(4) & np.uint64((1 << 28) - 1)).astype(np.int64) for x in (u, v))
    p, q = ((x & np.uint64(15)).astype(np.int64) for x in (u, v))
    x, y = n[a], n[b]
    need = np.ceil(t / (1 + t) * (x + y) - 1e-9)
    last = np.minimum(np.minimum(x - 1, ((p + 1) * x + 15) // 16), np.minimum(y - 1, ((q + 1) * y + 15) // 16))
    left = np.minimum(x - 1 - p * x // 16, y - 1 - q * y // 16)
    ok = (np.minimum(x, y) >= t * np.maximum(x, y) - 1e-9) & (last + 1 + left >= need)
    pair = np.unique(a[ok] << 32 | b[ok])
    a, b = pair >> 32, pair & 0xFFFFFFFF
    apart = np.bitwise_count(bits[a] ^ bits[b]).sum(axis=1)
    return pair[apart <= np.floor((1 - t) / (1 + t) * (n[a] + n[b]) + 1e-9)]


def _named(pair: np.ndarray, ids: np.ndarray) -> np.ndarray:
    both = np.stack((ids[pair >> 32], ids[pair & 0xFFFFFFFF]), axis=1)
    return np.sort(both, axis=1)


def _rows(rows: list[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in rows], pa.int64()), pa.array([x for _, x in rows], pa.binary())], names=["part", "block"])


def similarities(a: list[str], b: list[str], k: int) -> np.ndarray:
    """Exact Jaccard similarity of the shingles of each two texts."""
    texts = list(dict.fromkeys([*a, *b]))
    where = {x: i for i, x in enumerate(texts)}
    offsets, h = S.shingles(texts, k)
    out = np.zeros(len(a))
    for at, (x, y) in enumerate(zip(a, b)):
        i, j = where[x], where[y]
        u, v = h[offsets[i] : offsets[i + 1]], h[offsets[j] : offsets[j + 1]]
        both = np.concatenate((u, v))
        both.sort()
        same = int((both[1:] == both[:-1]).sum())
        out[at] = same / (len(both) - same) if len(both) else 0.0
    return out


def few(ids: DataFrame, rows: int | None = None) -> DataFrame:
    """Distinct ids, sent to every task while they are few, counted first. rows: what there are at most, if that is known."""
    little = (ids.count() if rows is None else rows) <= FEW_IDS
    ids = ids.select("id").distinct()
    return F.broadcast(ids) if little else ids


def texts_of(texts: DataFrame, ids: DataFrame, rows: int | None = None) -> DataFrame:
    """(id, text) of the given ids; while they are few, no text is shuffled."""
    return texts.select("id", "text").join(few(ids, rows), "id", "left_semi")


def key_blocks(texts: DataFrame, order: Order, threshold: float, k: int) -> DataFrame:
    """(part, block): the join keys of texts (id, text, side), packed for each part of the key space."""
    shared = texts.sparkSession.sparkContext.broadcast(order)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = shared.value
        parts = len(by.parts)
        for batch in batches:
            offsets, h = S.shingles(batch["text"].to_pylist(), k)
            print_of, side = S.fingerprints(offsets, h), np.asarray(batch["side"])
            at = np.argsort(print_of, kind="stable")
            first = np.concatenate(([True], print_of[at][1:] != print_of[at][:-1])) & (print_of[at] != 0)
            if not first.any():
                continue
            sides = np.bitwise_or.reduceat(side[at], np.flatnonzero(np.concatenate(([True], print_of[at][1:] != print_of[at][:-1]))))
            sides = sides[1:] if print_of[at[0]] == 0 else sides
            one = at[first]
            sizes = np.diff(offsets)[one]
            for lo, hi in runs(sizes, BLOCK):
                made, bits = [], []
                for start, end in runs(sizes[lo:hi], AT_ONCE):
                    some = one[lo + start : lo + end]
                    picked = np.concatenate([h[offsets[i] : offsets[i + 1]] for i in some])
                    ends = np.concatenate(([0], np.cumsum(sizes[lo + start : lo + end])))
                    doc, key, lead, rank, pos = join_keys(ends, picked, by.ranks, by.texts, threshold)
                    doc, key, pos, often = (doc + start).astype(np.int32), key.astype(np.uint32), pos.astype(np.int32), by.blocks[rank] > 1
                    made.append(((doc, key, ((lead >> np.uint64(24)) % np.uint64(parts)).astype(np.int32), pos), often, lead[often], by.blocks[rank[often]]))
                    bits.append(bitmaps(ends, picked))
                sets = (print_of[one[lo:hi]].view(np.int64), sizes[lo:hi], sides[lo:hi], np.concatenate(bits))
                cold = (np.concatenate([x[~often] for x, often in zip(c, [m[1] for m in made])]) for c in zip(*(m[0] for m in made)))
                yield from _rows([(int(by.parts[x]), block) for x, block in pack(parts, sets, *cold)])
                doc, key, pos = (np.concatenate([m[0][i][m[1]] for m in made]) for i in (0, 1, 3))
                if len(doc):
                    rows, held = [], 0
                    for row in pack_salted(sets, doc, key, np.concatenate([m[2] for m in made]), np.concatenate([m[3] for m in made]), pos):
                        rows.append(row)
                        held += len(row[1])
                        if held > CHUNK:
                            yield from _rows(rows)
                            rows, held = [], 0
                    yield from _rows(rows)

    return texts.select("id", "text", "side").mapInArrow(keys, "part long, block binary")


def verified(candidates: DataFrame, texts: DataFrame, threshold: float, k: int) -> DataFrame:
    """(class_a, class_b, similarity) of the candidates (class_a, class_b, id_a, id_b) that are similar, by their texts (id, text)."""
    bodies = texts_of(texts, candidates.select(F.explode(F.array("id_a", "id_b")).alias("id")), 2 * candidates.count())
    body = lambda x: bodies.select(F.col("id").alias(f"id_{x}"), F.col("text").alias(f"text_{x}"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            value = similarities(batch["text_a"].to_pylist(), batch["text_b"].to_pylist(), k)
            yield pa.RecordBatch.from_arrays([batch["class_a"], batch["class_b"], pa.array(value)], names=["class_a", "class_b", "similarity"])

    both = candidates.join(body("a"), "id_a").join(body("b"), "id_b").select("class_a", "class_b", "text_a", "text_b")
    return both.mapInArrow(verify, "class_a long, class_b long, similarity double").where(F.col("similarity") >= threshold - 1e-12)


def similar_texts(texts: DataFrame, threshold: float = 0.8, k: int = 5, *, parts: int | None = None, hot: int | None = None) -> SimilarTexts:
    """All pairs of different shingle sets whose similarity is ``threshold`` or more.

    texts: (id long, text string, side int); side NEW for rows to be compared with everything, OLD for rows that are
    compared with new ones only. Ids must be unique. Null, empty and too short texts belong to no class and no pair.
    parts: parts of the key space, by default two for three shuffle partitions, more for large corpora, so that no part grows.
    hot: texts that may share a first shingle before its sets are salted, by default as HOT and HOT_MEAN say.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be in (0, 1]")
    texts = texts.select(F.col("id").cast("long"), F.col("text"), F.col("side").cast("int"))
    bits = sketch_bits(texts.count())
    profile = cut_lineage(texts.mapInArrow(lambda it: _profile(it, k, bits), "class long, id long, side int, bits binary, block int"))
    classes = profile.where("block is null").select("class", "id", "side")
    order = fit_order(profile.where("block is not null").select("block", "bits"), bits, classes.count(), shuffle_partitions(texts.sparkSession), parts, hot)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for both in meeting_pairs([x for batch in batches for x in batch["block"].to_pylist()], threshold):
            yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["class_a", "class_b"])

    met = key_blocks(texts, order, threshold, k).repartition(len(order.parts), "part").groupBy("part").applyInArrow(meet, "class_a long, class_b long").distinct()
    one = classes.groupBy("class").agg(F.min("id").alias("id"))
    side = lambda x: one.select(F.col("class").alias(f"class_{x}"), F.col("id").alias(f"id_{x}"))
    candidates = cut_lineage(met.join(side("a"), "class_a").join(side("b"), "class_b"))
    return SimilarTexts(classes, verified(candidates, texts, threshold, k))


def similar_pairs(texts: DataFrame, threshold: float = 0.8, k: int = 5) -> DataFrame:
    """(id_a, id_b), id_a < id_b: all pairs of rows of (id, text) whose similarity is ``threshold`` or more.

    Equal shingle sets count. Null, empty and too short texts are in no pair; an empty table gives no rows. The members
    of a class are salted into blocks, and each two blocks of linked classes meet in a key of their own.
    """
    found = similar_texts(texts.select("id", "text", F.lit(NEW).alias("side")), threshold, k)
    sizes = found.classes.groupBy("class").agg(F.count("*").alias("n"))
    blocks = sizes.select("class", F.expr(f"cast(ceil(n / {MEMBERS}) as int)").alias("blocks"))
    member = found.classes.join(blocks, "class").select("class", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("salt"), "id")
    side = lambda df, x: df.select(*[F.col(c).alias(f"{c}_{x}") for c in df.columns])
    same = sizes.where("n > 1").select(F.col("class").alias("class_a"), F.col("class").alias("class_b"))
    each = lambda x: F.explode(F.sequence(F.lit(0), F.col(f"blocks_{x}") - 1)).alias(f"salt_{x}")
    cells = found.links.select("class_a", "class_b").unionByName(same).join(side(blocks, "a"), "class_a").join(side(blocks, "b"), "class_b")
    cells = cells.select("class_a", "class_b", "blocks_b", each("a")).select("class_a", "salt_a", "class_b", each("b"))
    pairs = cells.join(side(member, "a"), ["class_a", "salt_a"]).join(side(member, "b"), ["class_b", "salt_b"])
    pairs = pairs.where("class_a <> class_b or id_a < id_b")
    return pairs.select(F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b"))


def similar_groups(texts: DataFrame, threshold: float = 0.8, k: int = 5) -> DataFrame:
    """(id, class, links): one row for each text that has shingles, the smallest id of its class, and the class's links to other classes."""
    found = similar_texts(texts.select("id", "text", F.lit(NEW).alias("side")), threshold, k)
    ends = found.links.select(F.explode(F.array("class_a", "class_b")).alias("class")).groupBy("class").agg(F.count("*").alias("links"))
    named = found.classes.groupBy("class").agg(F.min("id").alias("first")).join(ends, "class", "left")
    return found.classes.join(named, "class").select("id", F.col("first").alias("class"), F.coalesce("links", F.lit(0)).cast("long").alias("links"))
