"""Packing of documents into containers of fixed capacity by minimum bin slack.

Only the number of pieces of each size matters for the plan, and there are at most ``capacity`` sizes. Each step takes
the largest size left and finds, by a subset-sum over bit sets, the multiset of sizes left that fills the container
best; that pattern is used as often as the counts allow, which uses up a size, so the number of steps depends on the
capacity and not on the number of documents. The documents then get their places by their rank within their size, which
is counted in salted groups.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loamworks.llm.common import cut_lineage, shuffle_partitions


def fill(counts: Counter, capacity: int) -> list[int]:
    """Sizes, at most as many of each as counts has, whose sum comes closest to capacity without passing it."""
    sizes = sorted((w for w, n in counts.items() if n > 0 and w <= capacity), reverse=True)
    reach, mask, steps = 1, (1 << (capacity + 1)) - 1, []
    for w in sizes:
        left, take = min(counts[w], capacity // w), 1
        while left > 0:
            take = min(take, left)
            steps.append((w, take, reach))
            reach |= (reach << (w * take)) & mask
            left -= take
            take *= 2
        if reach >> capacity & 1:
            break
    total, out = reach.bit_length() - 1, []
    for w, take, before in reversed(steps):
        if not before >> total & 1:
            out += [w] * take
            total -= w * take
    return out


def patterns(counts: dict[int, int], capacity: int) -> list[tuple[int, list[int]]]:
    """(number of containers, sizes in each) that hold all pieces, largest sizes first."""
    left, out = Counter(counts), []
    for w in sorted(counts, reverse=True):
        while left[w] > 0:
            left[w] -= 1
            sizes = [w, *fill(left, capacity - w)]
            left[w] += 1
            use = Counter(sizes)
            times = min(left[x] // n for x, n in use.items())
            for x, n in use.items():
                left[x] -= times * n
            out.append((times, sizes))
    return out


def pieces(sized: DataFrame, capacity: int) -> DataFrame:
    """(doc_id, piece, tokens): a document of more than capacity tokens is cut into full pieces and a rest."""
    whole = sized.where("tokens > 0")
    cut = F.expr(f"explode(sequence(1, cast(ceil(tokens / {capacity}) as int)))")
    parts = whole.select("doc_id", "tokens", cut.alias("piece"))
    return parts.select("doc_id", "piece", F.least(F.lit(capacity), F.col("tokens") - (F.col("piece") - 1) * capacity).cast("int").alias("tokens"))


def pack(sized: DataFrame, capacity: int = 2048) -> DataFrame:
    """(doc_id, piece, tokens, container, position) for (doc_id, tokens); both numbers count from 1.

    position is the place among the pieces of a container. Documents without tokens (null or empty text) get no
    container. doc_id must be unique; equal sizes are filled in order of a salt and doc_id, so the result is stable.
    """
    if capacity < 1:
        raise ValueError("capacity must be positive")
    kind = sized.schema["doc_id"].dataType.simpleString()
    salts = 4 * shuffle_partitions(sized.sparkSession)
    parts = cut_lineage(pieces(sized.select("doc_id", "tokens"), capacity).withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts))))
    groups = parts.groupBy("tokens", "salt").agg(F.count("*").alias("n"))
    counts = {r["tokens"]: r["n"] for r in groups.groupBy("tokens").agg(F.sum("n").alias("n")).collect()}
    rows, container = [], 0
    used: Counter = Counter()
    for times, sizes in patterns(counts, capacity):
        at = 0
        for w, n in sorted(Counter(sizes).items(), reverse=True):
            rows.append((w, used[w], n, container, at))
            used[w] += times * n
            at += n
        container += times
    rows.sort()
    plan = sized.sparkSession.sparkContext.broadcast(np.array(rows, np.int64).reshape(-1, 5))
    before = F.sum("n").over(W.partitionBy("tokens").orderBy("salt").rowsBetween(W.unboundedPreceding, -1))
    start = groups.select("tokens", "salt", F.coalesce(before, F.lit(0)).alias("start"))
    rank = F.row_number().over(W.partitionBy("tokens", "salt").orderBy("doc_id", "piece"))
    ranked = parts.withColumn("nth", rank).join(start, ["tokens", "salt"]).select("doc_id", "piece", "tokens", (F.col("start") + F.col("nth") - 1).cast("long").alias("rank"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, first, each, base, offset = plan.value.T
        key = (size << 44) | first
        for batch in batches:
            w, rank = np.asarray(batch["tokens"]).astype(np.int64), np.asarray(batch["rank"])
            i = np.searchsorted(key, (w << 44) | rank, side="right") - 1
            nth = rank - first[i]
            columns = [batch["doc_id"], batch["piece"], batch["tokens"], pa.array(base[i] + nth // each[i] + 1), pa.array((offset[i] + nth % each[i] + 1).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "piece", "tokens", "container", "position"])

    return ranked.mapInArrow(place, f"doc_id {kind}, piece int, tokens int, container long, position int")
