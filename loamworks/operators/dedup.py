"""Keep-first deduplication and the ledger of what is indexed already."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_first(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The first row of each key in the given order. Aggregated before the shuffle, so a hot key costs one row a task.

    Rows of a null key are one group. Ties in the order are broken by nothing, so the order should be total.
    """
    rest = [c for c in rows.columns if c != key]
    first = rows.groupBy(key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("__first"))
    return first.select(*[F.col(key) if c == key else F.col(f"__first.{c}").alias(c) for c in rows.columns])


def skip_indexed(chunks: DataFrame, ledger: DataFrame, key: str = "content_hash") -> DataFrame:
    """Rows whose hash the ledger doesn't hold; rows of a null hash stay."""
    return chunks.join(ledger.select(key), key, "left_anti")


def new_chunks(chunks: DataFrame, ledger: DataFrame, order: list[str]) -> DataFrame:
    """First row of each hash that isn't indexed. Runs before anything is embedded."""
    return keep_first(skip_indexed(chunks, ledger), "content_hash", order)


def dedup_counts(chunks: DataFrame, ledger: DataFrame) -> DataFrame:
    """One row (chunks_total, chunks_new, chunks_skipped)."""
    known = ledger.select("content_hash").distinct().withColumn("known", F.lit(True))
    groups = chunks.groupBy("content_hash").agg(F.count("*").alias("n")).join(known, "content_hash", "left")
    new = F.coalesce(F.sum(F.when(F.col("known").isNull(), 1)), F.lit(0)).cast("long")
    total = F.coalesce(F.sum("n"), F.lit(0)).cast("long")
    return groups.agg(total.alias("chunks_total"), new.alias("chunks_new"), (total - new).alias("chunks_skipped"))


def ledger_insert(ledger: DataFrame, rows: DataFrame, order: list[str]) -> DataFrame:
    """Ledger with rows whose hash is new appended; the first row of a hash wins, what is there stays as it is."""
    fresh = skip_indexed(keep_first(rows, "content_hash", order), ledger)
    return ledger.unionByName(fresh.select(*ledger.columns))
