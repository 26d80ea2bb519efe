"""New batches against everything accepted before, by tables of hashes that each batch is joined with and appended to.

``History`` keeps what it needs of the accepted texts in bucketed tables, so that no batch reads or shuffles their texts
again: content hashes, fingerprints of the normalised content, paragraph hashes with their holders, and the prefix keys
of ``near_duplicates``. A batch is settled in steps, and each step sees only what the one before left open:

1. content hash or normalised content that is booked: bucket-local semi-joins;
2. paragraphs: the holder that shares most of an arrival's words is compared with it exactly. A paragraph of very many
   holders points to its first one only; what that loses is left to the next step;
3. prefix keys, cut by the order that the first batch fixed: every pair that is similar enough. Edits inside every
   paragraph leave no equal hash, so paragraph hashes alone, the named method, cannot give these;
4. arrivals among themselves, in order of arrival.

What is accepted is appended, its content hash last. A batch that broke off before may be given again: the tables then
hold some rows twice, which changes no result.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamworks.llm import near_duplicates as N
from loamworks.llm import shingles as S
from loamworks.llm.common import content_hash, cut_lineage, normalised_url, shared_folder, shuffle_partitions

#: Holders of a paragraph up to which each of them is looked at.
HOLDERS = 64
#: Files of one append up to which tasks write their buckets without a shuffle.
FILES = 20_000
TABLES = {
    "hashes": ("content_hash string", "content_hash"),
    "contents": ("class long, id long", "class"),
    "paragraphs": ("paragraph long, id long, words int", "paragraph"),
    "keys": ("batch string, part long, block binary", "part"),
}
_READ = "id long, class long, paragraph long, words int, block int, bits binary"


def at_once(*jobs: Callable[[], None]) -> None:
    """Run jobs that don't depend on each other beside each other."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        for done in [pool.submit(x) for x in jobs]:
            done.result()


def read_texts(texts: DataFrame, k: int, folder: str, bits: int | None = None) -> DataFrame:
    """One reading of (id, text), written in the folder: rows (id, class) of each text that has shingles, (id, paragraph, words) of each distinct
    paragraph, and with bits (block, bits) of the sketch of the shingles' counts."""

    def rows(**columns) -> pa.RecordBatch:
        n = len(next(iter(columns.values())))
        kinds = {"id": pa.int64(), "class": pa.int64(), "paragraph": pa.int64(), "words": pa.int32(), "block": pa.int32(), "bits": pa.binary()}
        return pa.RecordBatch.from_arrays([pa.array(columns[c], t) if c in columns else pa.nulls(n, t) for c, t in kinds.items()], names=list(kinds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << (bits or 0), np.uint32)
        for batch in batches:
            offsets, h, doc, paragraph, words = S.with_paragraphs(batch["text"].to_pylist(), k)
            ids, some = np.asarray(batch["id"]), np.flatnonzero(np.diff(offsets) > 0)
            if bits:
                N.add_to_sketch(counts, h)
            yield rows(id=ids[some], **{"class": S.fingerprints(offsets, h).view(np.int64)[some]})
            yield rows(id=ids[doc], paragraph=paragraph.view(np.int64), words=words)
        if bits:
            for block, part in N.sketch_rows(counts):
                yield rows(block=[block], bits=[part])

    place = f"{folder}/read-{uuid.uuid4().hex}"
    texts.select("id", "text").mapInArrow(run, _READ).write.parquet(place)
    return texts.sparkSession.read.schema(_READ).parquet(place)


def first_come(nodes_links: DataFrame) -> DataFrame:
    """(node) of the nodes that an earlier kept node covers, from links (early, late) with comparable values.

    A node is kept unless linked to an earlier kept one. Each round settles, in joins, all nodes without an unsettled
    earlier neighbour. The rounds are as many as the longest chain of such dependencies, which for n nodes in random
    order is O(log(n)^2) with high probability, whatever the links (Blelloch, Fineman and Shun, 2012).
    """
    links = cut_lineage(nodes_links.select("early", "late").distinct())
    covered: list[DataFrame] = []
    while not links.isEmpty():
        late = links.select(F.col("late").alias("early")).distinct()
        kept = links.select("early").distinct().join(late, "early", "left_anti")
        hit = cut_lineage(links.join(kept, "early", "left_semi").select("late").distinct())
        covered.append(hit.select(F.col("late").alias("node")))
        gone = kept.unionByName(hit.select(F.col("late").alias("early")))
        links = cut_lineage(links.join(gone, "early", "left_anti").join(hit, "late", "left_anti").select("early", "late"))
    out = links.select(F.col("early").alias("node"))
    for x in covered:
        out = out.unionByName(x)
    return out


class History:
    """Everything accepted, as bucketed tables in a folder that all executors reach.

    A folder that holds a history is opened again with the threshold, the length of shingles and the buckets it was made
    with. The order of shingles is that of the first append; a history that has grown many times over works on with it,
    only with more candidates, and is best rebuilt.
    """

    def __init__(self, spark: SparkSession, folder: str, threshold: float = 0.8, k: int = 5, buckets: int | None = None) -> None:
        if not 0 < threshold <= 1:
            raise ValueError("threshold must be in (0, 1]")
        self.spark, self.folder = spark, folder.rstrip("/")
        self.threshold, self.k, self.buckets, self._order = threshold, k, buckets or shuffle_partitions(spark), None
        self._name = f"history_{hashlib.sha256(self.folder.encode()).hexdigest()[:16]}"
        try:
            row = spark.read.parquet(f"{self.folder}/order").first()
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            row = None
        if row:
            self.threshold, self.k, self.buckets = row["threshold"], row["k"], row["buckets"]
            ranks, parts, blocks = (np.frombuffer(bytes(row[x]), t) for x, t in (("ranks", np.uint8), ("parts", np.int64), ("blocks", np.int64)))
            self._order = N.Order(ranks, row["texts"], parts, blocks)

    def table(self, kind: str) -> DataFrame:
        name = f"{self._name}_{kind}"
        if not self.spark.catalog.tableExists(name):
            columns, key = TABLES[kind]
            self.spark.sql(f"create table {name} ({columns}) using parquet clustered by ({key}) into {self._buckets(kind)} buckets location '{self.folder}/{kind}'")
        return self.spark.table(name)

    def _buckets(self, kind: str) -> int:
        return len(self._order.parts) if kind == "keys" else self.buckets

    def _write(self, kind: str, rows: DataFrame, tasks: int = FILES) -> None:
        """Append rows; of so many tasks, each writes its buckets itself while that makes no more than FILES files."""
        columns = self.table(kind).columns
        if tasks * self._buckets(kind) > FILES:
            rows = rows.repartition(self._buckets(kind), TABLES[kind][1])
        rows.select(*columns).write.insertInto(f"{self._name}_{kind}")

    def _fit(self, read: DataFrame, bits: int) -> None:
        texts = read.where("class is not null").count()
        self._order = N.fit_order(read.where("block is not null").select("block", "bits"), bits, texts, self.buckets)
        o = self._order
        row = (o.ranks.tobytes(), o.texts, o.parts.tobytes(), o.blocks.tobytes(), self.threshold, self.k, self.buckets)
        self.spark.createDataFrame([row], "ranks binary, texts long, parts binary, blocks binary, threshold double, k int, buckets int").write.mode("overwrite").parquet(f"{self.folder}/order")

    def _book(self, read: DataFrame, ids: DataFrame, hashes: DataFrame, *first: Callable[[], None]) -> None:
        """Append what read holds of the given ids, beside the jobs of first, and the content hashes, last."""
        mine = read.join(N.few(ids), "id", "left_semi")
        new = mine.where("class is not null").groupBy("class").agg(F.min("id").alias("id"))
        fresh = hashes.select("content_hash").where("content_hash is not null").distinct()
        at_once(
            *first,
            lambda: self._write("paragraphs", mine.where("paragraph is not null")),
            lambda: self._write("contents", new.join(self.table("contents").select("class"), "class", "left_anti")),
        )
        self._write("hashes", fresh.join(self.table("hashes"), "content_hash", "left_anti"))

    def append(self, texts: DataFrame, accepted: DataFrame, hashes: DataFrame) -> None:
        """Book the texts (id, text) of the accepted (id), and the content hashes (content_hash).

        Ids are unique over all that is ever appended or checked. Texts that aren't accepted stay unknown; they are told
        apart by their ids, so that no text is shuffled.
        """
        texts = texts.select(F.col("id").cast("long"), "text")
        bits = N.sketch_bits(texts.count()) if self._order is None else None
        read = read_texts(texts, self.k, self.folder, bits)
        if bits:
            self._fit(read, bits)
        self._book(read, accepted.select("id"), hashes, lambda: self._write("keys", self._keys(texts, "old"), texts.rdd.getNumPartitions()))

    def _keys(self, texts: DataFrame, batch: str) -> DataFrame:
        blocks = N.key_blocks(texts.withColumn("side", F.lit(N.NEW)), self._order, self.threshold, self.k)
        return blocks.withColumn("batch", F.lit(batch))

    def copies(self, rows: DataFrame) -> DataFrame:
        """Rows (content_hash, class, …) with the column evidence: hash, where that is booked, content, where the class is, else null."""
        same = self.table("hashes").distinct().withColumn("same", F.lit(True))
        alike = self.table("contents").select("class").distinct().withColumn("alike", F.lit(True))
        both = rows.join(same, "content_hash", "left").join(alike, "class", "left")
        return both.withColumn("evidence", F.when(F.col("same"), "hash").when(F.col("alike"), "content")).drop("same", "alike")

    def holders(self, paragraphs: DataFrame) -> DataFrame:
        """(id, holder, words): the accepted text that shares the most words in whole paragraphs with each id of (id, paragraph, words)."""
        held = self.table("paragraphs").join(paragraphs.select("paragraph").distinct(), "paragraph", "left_semi")
        sizes = held.groupBy("paragraph").agg(F.count("*").alias("n"), F.min("id").alias("first"))
        few = held.join(sizes.where(F.col("n") <= HOLDERS).select("paragraph"), "paragraph", "left_semi").select("paragraph", F.col("id").alias("holder"))
        holder = few.unionByName(sizes.where(F.col("n") > HOLDERS).select("paragraph", F.col("first").alias("holder"))).distinct()
        shared = paragraphs.join(holder, "paragraph").groupBy("id", "holder").agg(F.sum("words").alias("words"))
        return shared.groupBy("id").agg(F.max_by(F.struct("holder", "words"), F.struct("words", "holder")).alias("x")).select("id", "x.holder", "x.words")

    def _meetings(self, batch: str) -> DataFrame:
        """(class_a, class_b, both): pairs of a class of the batch and another one, of the batch too (both) or accepted, that may be similar."""
        threshold = self.threshold

        def meet(new: pa.Table, old: pa.Table) -> pa.Table:
            mine, theirs = new["block"].to_pylist(), old["block"].to_pylist()
            found = list(N.meeting_pairs(mine + theirs, threshold, old=len(theirs))) if mine else []
            both = np.concatenate(found) if found else np.empty((0, 2), np.int64)
            is_new = np.isin(both, np.unique(np.concatenate([N.unpack(x)[0] for x in mine])) if mine else [])
            a = np.where(is_new[:, 0], both[:, 0], both[:, 1])
            return pa.table({"class_a": a, "class_b": both.sum(axis=1) - a, "both": is_new.all(axis=1)})

        keys = self.table("keys")
        new, old = keys.where(F.col("batch") == batch).select("part", "block"), keys.where(F.col("batch") != batch).select("part", "block")
        return new.groupBy("part").cogroup(old.groupBy("part")).applyInArrow(meet, "class_a long, class_b long, both boolean").distinct()

    def check(self, batch: DataFrame, texts: DataFrame) -> DataFrame:
        """(id, evidence) of the rows (id, at, text, content_hash) of a batch that repeat something accepted or an earlier row of it.

        at: what rows are ordered by, different for each. texts: (id, text) of the accepted, of which only those that an
        arrival is compared with are read. evidence: hash, content, paragraphs, near or arrival, the first step that
        settles the row. All other rows are accepted, and booked before this returns.
        """
        batch = batch.select(F.col("id").cast("long"), "at", "text", "content_hash")
        number = uuid.uuid4().hex
        bits = N.sketch_bits(batch.count()) if self._order is None else None
        read = read_texts(batch, self.k, self.folder, bits)
        if bits:
            self._fit(read, bits)
        named = batch.select("id", "at", "content_hash").join(read.where("class is not null").select("id", "class"), "id", "left")
        named = cut_lineage(self.copies(named))
        copied, open_ = named.where("evidence is not null").select("id", "evidence"), named.where("evidence is null").drop("evidence")

        # The holder of most of an arrival's paragraphs is compared with it.
        own = read.where("paragraph is not null").select("id", "paragraph", "words").join(open_.select("id"), "id", "left_semi")
        pairs = self.holders(own).join(open_.select("id", "class"), "id").where("class is not null")
        pairs = cut_lineage(pairs.select(F.col("id").alias("class_a"), F.col("holder").alias("class_b"), F.col("id").alias("id_a"), F.col("holder").alias("id_b")))
        every = texts.select("id", "text").unionByName(batch.select("id", "text"))
        shared = cut_lineage(N.verified(pairs, every, self.threshold, self.k).select(F.col("class_a").alias("id"), F.lit("paragraphs").alias("evidence")))
        open_ = open_.join(shared, "id", "left_anti")

        # What is left open meets the accepted, and itself, in prefix keys.
        self._write("keys", self._keys(N.texts_of(batch, open_), number), batch.select("text").rdd.getNumPartitions())
        mine = open_.where("class is not null")
        first = mine.groupBy("class").agg(F.min_by("id", "at").alias("id"), F.min("at").alias("at"))
        met = cut_lineage(self._meetings(number))
        of = lambda df, x: df.select(F.col("class").alias(f"class_{x}"), F.col("id").alias(f"id_{x}"))
        past = met.where("not both").join(of(self.table("contents"), "b"), "class_b")
        candidates = cut_lineage(past.unionByName(met.where("both").join(of(first, "b"), "class_b")).join(of(first, "a"), "class_a"))
        links = cut_lineage(N.verified(candidates.select("class_a", "class_b", "id_a", "id_b", "both"), every, self.threshold, self.k).join(candidates.select("class_a", "class_b", "both"), ["class_a", "class_b"]).select("class_a", "class_b", "both"))
        near_past = links.where("not both").select(F.col("class_a").alias("class")).distinct()
        near = mine.join(near_past, "class", "left_semi").select("id", F.lit("near").alias("evidence"))

        # Arrivals among themselves: the first of a class stands for it, and an earlier kept one covers a later one.
        first = cut_lineage(first.join(near_past, "class", "left_anti").select("class", "at"))
        ends = lambda x: first.select(F.col("class").alias(f"class_{x}"), F.col("at").alias(f"at_{x}"))
        edges = links.where("both").join(ends("a"), "class_a").join(ends("b"), "class_b")
        covered = first_come(edges.select(F.least("at_a", "at_b").alias("early"), F.greatest("at_a", "at_b").alias("late")))
        late = first.join(covered, first["at"] == covered["node"], "left_semi").select("class")
        again = mine.join(first.select("class", F.col("at").alias("first")), "class").where("at > first").select("id")
        hashes = open_.where("content_hash is not null")
        same = hashes.join(hashes.groupBy("content_hash").agg(F.min("at").alias("first"), F.count("*").alias("n")).where("n > 1"), "content_hash").where("at > first").select("id")
        inside = again.unionByName(same).unionByName(mine.join(late, "class", "left_semi").select("id")).distinct()
        found = copied.unionByName(shared).unionByName(near).unionByName(inside.join(near, "id", "left_anti").select("id", F.lit("arrival").alias("evidence")))
        found = cut_lineage(found)
        kept = named.join(found, "id", "left_anti")
        self._book(read, kept.select("id"), kept)
        return found


def repeated_arrivals(arrivals: DataFrame, ledger: DataFrame, kept: DataFrame, threshold: float = 0.8, k: int = 5, folder: str | None = None) -> DataFrame:
    """(arrival_id, evidence) of the arrivals that repeat or nearly repeat something accepted before them.

    arrivals: (arrival_id, batch_no, text, source_url), in order of batch_no (null first) and arrival_id.
    ledger: (content_hash) of all accepted before; kept: (chunk_no, text, content_hash), of which those in the ledger count.
    A null text or URL has no hash; a text of fewer than k words is near no other. Extra columns are ignored. An empty
    ledger or no kept texts is fine. folder: of the history that is made of the ledger and the kept texts; one of its own
    in the shared folder by default.
    """
    spark = arrivals.sparkSession
    history = History(spark, folder or f"{shared_folder(spark)}/history-{uuid.uuid4().hex}", threshold, k)
    old = kept.select((F.col("chunk_no") * 2).alias("id"), "text", "content_hash")
    booked = old.select("id", "content_hash").join(ledger.select("content_hash"), "content_hash", "left_semi").select("id")
    history.append(old, cut_lineage(booked), ledger)
    at = F.struct(F.coalesce(F.col("batch_no").cast("long"), F.lit(-(2**31))).alias("batch_no"), F.col("arrival_id").cast("long").alias("arrival_id"))
    batch = arrivals.select((F.col("arrival_id") * 2 + 1).alias("id"), at.alias("at"), "text", content_hash(normalised_url(F.col("source_url")), F.col("text")).alias("content_hash"))
    return history.check(batch, old.select("id", "text")).select(((F.col("id") - 1) / 2).cast("long").alias("arrival_id"), "evidence")
