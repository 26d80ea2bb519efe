"""Cosine top-k of many questions over a collection, exact by blocks or through a fitted index."""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loamworks.functions.text import uuid5
from loamworks.operators.lineage import cut_lineage, written

#: Questions and vectors of a block, and scores that a task holds at a time.
QUESTIONS, VECTORS, SCORES = 1024, 32_768, 1 << 21
#: Values of the bounded sample that an index is fitted on, and its rows at most.
SAMPLE_VALUES, SAMPLE = 1 << 25, 50_000
#: Share of its lists that an index looks at. 0.56 finds 0.9 of the best five of vectors without any clusters.
PROBED = 0.5625
#: Values of a column up to which their block counts are sent to every task instead of shuffling vectors.
FEW_SPACES = 100_000


@dataclass(frozen=True)
class Profile:
    """How a backend differs: whether a namespace or a metadata filter narrows a search, and what comes back."""

    by_namespace: bool = False
    by_metadata: bool = False
    uuid_ids: bool = False  # points are named by a UUID of the id
    fields: tuple[str, ...] = ()  # of the metadata; none: all
    half: bool = False  # vectors compared in half precision
    shows_namespace: bool = False  # the namespace is part of the metadata


PROFILES = {
    "pgvector": Profile(by_namespace=True, half=True),
    "pinecone": Profile(by_namespace=True, by_metadata=True),
    "qdrant": Profile(uuid_ids=True, shows_namespace=True),
    "weaviate": Profile(uuid_ids=True),
    "milvus": Profile(fields=("source_url", "title", "section")),
}


def profile(backend: str) -> Profile:
    if backend not in PROFILES:
        raise ValueError(f"unknown vector backend {backend!r}; known: {sorted(PROFILES)}")
    return PROFILES[backend]


def unit(rows: list | np.ndarray, half: bool = False) -> np.ndarray:
    """Vectors of length 1 in double precision; a zero vector becomes NaN."""
    m = np.array(rows, np.float64)
    if half:
        m = m.astype(np.float16).astype(np.float64)
    with np.errstate(invalid="ignore", divide="ignore"):
        return m / np.linalg.norm(m, axis=1, keepdims=True)


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Rows of an array column of one length, without going through Python lists."""
    array = column.combine_chunks()
    array = array.chunk(0) if isinstance(array, pa.ChunkedArray) and array.num_chunks else array
    flat = np.asarray(array.flatten(), np.float64)
    return flat.reshape(len(array), len(flat) // max(1, len(array)))


def best_of(questions: pa.Table, vectors: pa.Table, k: int, half: bool) -> pa.Table:
    """The k best vectors of each question within two blocks; ties go to the smaller id, NaN scores are left out."""
    ids = vectors["id"].to_numpy()
    by = np.argsort(ids, kind="stable")
    held, found = unit(matrix(vectors["vector"]), half)[by].T if len(by) else None, []
    step = max(1, SCORES // max(1, len(by)))
    for at in range(0, questions.num_rows if len(by) else 0, step):
        some = questions.slice(at, step)
        score = np.round(unit(matrix(some["vector"]), half) @ held, 12)
        np.copyto(score, -np.inf, where=np.isnan(score))
        n = min(k, len(by))
        least = np.partition(score, len(by) - n, axis=1)[:, len(by) - n]
        row, col = np.nonzero((score >= least[:, None]) & np.isfinite(score))
        order = np.lexsort((col, -score[row, col], row))
        row, col = row[order], col[order]
        nth = np.arange(len(row)) - np.searchsorted(row, row)
        row, col = row[nth < n], col[nth < n]
        found.append((some["qid"].to_numpy()[row], by[col], score[row, col]))
    qid, place, score = (np.concatenate(x) for x in zip(*found)) if found else (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
    return pa.table({"qid": pa.array(qid, questions.schema.field("qid").type), "id": vectors["id"].take(pa.array(place)), "score": score})


def _found(questions: DataFrame, vectors: DataFrame) -> str:
    kind = lambda df, c: df.schema[c].dataType.simpleString()
    return f"qid {kind(questions, 'qid')}, id {kind(vectors, 'id')}, score double"


def _ranked(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(W.partitionBy("qid").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("qid", "rank", "id", "score")


def top_k(questions: DataFrame, vectors: DataFrame, k: int = 5, half: bool = False, by: str | None = None) -> DataFrame:
    """(qid, rank, id, score) of questions (qid, vector) over vectors (id, vector), exact.

    Both sides are cut into blocks of bounded size; each pair of blocks is one matrix product in one task that gives k
    rows for each question, so no task holds more than two blocks. Null and zero vectors match nothing. by: a column of both sides, if a question
    looks only at the vectors that have its value there; null matches nothing. Only ids are counted, so vectors that are
    made by a function are made once.
    """
    if k < 1:
        return questions.join(vectors.select("id"), F.lit(False)).select("qid", F.lit(0).alias("rank"), "id", F.lit(0.0).alias("score"))
    if by is not None:
        return _ranked(_found_by(questions, vectors, k, half, by), k)
    n_q = max(1, -(-questions.select("qid").count() // QUESTIONS))
    n_v = max(1, -(-vectors.select("id").count() // VECTORS))
    questions = questions.where("vector is not null").select("qid", "vector")
    vectors = vectors.where("vector is not null").select("id", "vector")
    block = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    left = questions.withColumn("qb", block("qid", n_q)).withColumn("vb", F.explode(F.sequence(F.lit(0), F.lit(n_v - 1))))
    right = vectors.withColumn("vb", block("id", n_v)).withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(n_q - 1))))
    found = left.groupBy("qb", "vb").cogroup(right.groupBy("qb", "vb")).applyInArrow(lambda a, b: best_of(a, b, k, half), _found(questions, vectors))
    return _ranked(found, k)


def _found_by(questions: DataFrame, vectors: DataFrame, k: int, half: bool, by: str) -> DataFrame:
    """As top_k, with the blocks cut within each value of a column."""

    def cut(rows: DataFrame, name: str, most: int) -> tuple[DataFrame, DataFrame]:
        sizes = rows.where(F.col(by).isNotNull()).select(F.col(by).alias("space"))
        rows = rows.where(F.col("vector").isNotNull() & F.col(by).isNotNull()).select(name, "vector", F.col(by).alias("space"))
        sizes = cut_lineage(sizes.groupBy("space").agg(F.expr(f"cast(ceil(count(*) / {most}) as int)").alias("n")))
        return rows, F.broadcast(sizes) if sizes.count() <= FEW_SPACES else sizes

    (asked, n_q), (held, n_v) = cut(questions, "qid", QUESTIONS), cut(vectors, "id", VECTORS)
    both = lambda rows: rows.join(n_q.withColumnRenamed("n", "n_q"), "space").join(n_v.withColumnRenamed("n", "n_v"), "space")
    block = lambda c, n: F.pmod(F.xxhash64(c), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    named = lambda *names: [F.col(x).alias(x) for x in names]
    left = both(asked).select(block("qid", "n_q").alias("qb"), each("n_v").alias("vb"), *named("space", "qid", "vector"))
    right = both(held).select(each("n_q").alias("qb"), block("id", "n_v").alias("vb"), *named("space", "id", "vector"))
    keys = ("space", "qb", "vb")
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(lambda a, b: best_of(a, b, k, half), _found(questions, vectors))


class Index:
    """Inverted lists around centroids: a question looks at the lists of its nearest centroids only."""

    def __init__(self, centroids: np.ndarray) -> None:
        self.centroids = centroids

    @classmethod
    def fit(cls, vectors: DataFrame, lists: int | None = None, rounds: int = 8) -> Index:
        """Fitted by k-means on at most SAMPLE vectors, and SAMPLE_VALUES values, of the smallest hashes; every vector is
        indexed all the same. lists: by default the root of the number of vectors, 64 at least, so that the vectors that a
        question looks at list by list don't grow with the table as fast as it does."""
        some = vectors.where("vector is not null")
        width = some.select(F.size("vector").alias("n")).first()
        if width is None:
            return cls(np.zeros((1, 1)))
        rows = min(SAMPLE, max(1, SAMPLE_VALUES // max(1, width["n"])))
        m = unit(matrix(some.select("vector", F.xxhash64("id").alias("h"), "id").orderBy("h", "id").limit(rows).select("vector").toArrow()["vector"]))
        m = m[np.isfinite(m).all(axis=1)]
        lists = max(1, min(lists or max(64, int(vectors.select("id").count() ** 0.5)), len(m) // 4))
        centre = m[np.linspace(0, len(m) - 1, lists).astype(int)]
        for _ in range(rounds):
            near = np.argmax(m @ centre.T, axis=1)
            sums = np.zeros_like(centre)
            np.add.at(sums, near, m)
            length = np.linalg.norm(sums, axis=1, keepdims=True)
            centre = np.where(length > 0, sums / np.maximum(length, 1e-12), centre)
        return cls(centre)

    def near(self, rows: DataFrame, n: int) -> DataFrame:
        """rows with a column ``list`` for each of their n nearest centroids."""
        shared = rows.sparkSession.sparkContext.broadcast(self.centroids)

        @F.pandas_udf("array<int>")
        def nearest(v):
            import pandas as pd

            score = np.nan_to_num(unit(list(v)) @ shared.value.T, nan=-2)
            return pd.Series(list(np.argsort(-score, axis=1, kind="stable")[:, :n].astype(np.int32)))

        return rows.where("vector is not null").withColumn("list", F.explode(nearest("vector")))

    def top_k(self, questions: DataFrame, vectors: DataFrame, k: int = 5, probes: int | None = None) -> DataFrame:
        """(qid, rank, id, score) over the lists that are probed, by default PROBED of all; lists are cut into blocks, so none is unbounded."""
        probes = probes or max(1, round(PROBED * len(self.centroids)))
        held = written(self.near(vectors.select("id", "vector"), 1))
        sizes = held.groupBy("list").agg(F.expr(f"cast(ceil(count(*) / {VECTORS}) as int)").alias("blocks"))
        right = held.join(F.broadcast(sizes), "list").select(F.col("list").alias("list"), F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block"), F.col("id").alias("id"), F.col("vector").alias("vector"))
        asked = self.near(questions.select("qid", "vector"), probes).join(F.broadcast(sizes.select(F.col("list").alias("list"), F.col("blocks").alias("n"))), "list")
        left = asked.select("list", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("block"), "qid", "vector")
        found = left.groupBy("list", "block").cogroup(right.groupBy("list", "block")).applyInArrow(lambda a, b: best_of(a, b, k, False), _found(questions, vectors))
        return _ranked(found, k)


def narrowed(rows: DataFrame, p: Profile, namespace: str, where: dict | None) -> DataFrame:
    """rows that a search looks at: filters apply as far as the backend has them. A value is compared as JSON writes it."""
    if p.by_namespace:
        rows = rows.where(F.col("namespace") == namespace)
    for key, value in (where or {}).items() if p.by_metadata else ():
        field = F.get_json_object("metadata", f"$.{key}")
        rows = rows.where(field.isNull() if value is None else field == (value if isinstance(value, str) else json.dumps(value)))
    return rows


def _shown(found: DataFrame, rows: DataFrame, p: Profile) -> DataFrame:
    """found (…, id, score) with text, metadata and point of the rows: what the backend gives back of them."""
    meta = F.col("metadata")
    if p.fields:
        meta = F.to_json(F.struct(*[F.get_json_object("metadata", f"$.{f}").alias(f) for f in p.fields]))
    if p.shows_namespace:
        known = F.coalesce(F.from_json("metadata", "map<string,string>"), F.create_map().cast("map<string,string>"))
        meta = F.to_json(F.map_concat(F.map_filter(known, lambda k, _: k != "namespace"), F.create_map(F.lit("namespace"), F.col("namespace"))))
    point = uuid5(F.col("id")) if p.uuid_ids else F.col("id")
    return found.join(rows.select("id", "text", "metadata", "namespace"), "id").withColumn("metadata", meta).withColumn("point", point).drop("namespace")


def search_many(rows: DataFrame, questions: DataFrame, k: int = 5, backend: str = "pgvector", namespace: str = "default", where: dict | None = None) -> DataFrame:
    """(qid, rank, id, point, text, score, metadata) of the k rows (id, embedding, text, metadata, namespace) nearest to each question (qid, vector)."""
    p = profile(backend)
    rows = narrowed(rows, p, namespace, where)
    found = top_k(questions, rows.select("id", F.col("embedding").alias("vector")), k, p.half)
    return _shown(found, rows, p).select("qid", "rank", "id", "point", "text", "score", "metadata")


def search(rows: DataFrame, vector: list[float], k: int = 5, backend: str = "pgvector", namespace: str = "default", where: dict | None = None) -> DataFrame:
    """(rank, id, point, text, score, metadata) of the k rows (id, embedding, text, metadata, namespace) nearest to one vector.

    Scores are made first and the texts fetched for the k best only.
    """
    p = profile(backend)
    rows = narrowed(rows, p, namespace, where)
    asked = unit([vector], p.half)[0]

    @F.pandas_udf("double")
    def score(v):
        import pandas as pd

        return pd.Series(np.round(unit(list(v), p.half) @ asked, 12)).replace({np.nan: None})

    best = rows.where("embedding is not null").select("id", score("embedding").alias("score")).where("score is not null").orderBy(F.desc("score"), "id").limit(max(k, 0))
    ranked = best.withColumn("rank", F.row_number().over(W.orderBy(F.desc("score"), "id")))
    return _shown(F.broadcast(ranked), rows, p).select("rank", "id", "point", "text", "score", "metadata").orderBy("rank")
