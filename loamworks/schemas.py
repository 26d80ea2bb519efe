"""Schemas of the tables."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _I, _TS = T.StringType(), T.IntegerType(), T.TimestampType()

PAGE = T.StructType(
    [T.StructField("source_url", _S, False), T.StructField("page_title", _S), T.StructField("markdown", _S), T.StructField("content_type", _S), T.StructField("parent_url", _S), T.StructField("crawl_timestamp", _TS), T.StructField("depth", _I), T.StructField("links", T.ArrayType(_S))]
)
CHUNK_METADATA = T.StructType(
    [T.StructField(x, _S) for x in ("chunk_id", "source_url", "title", "section")]
    + [T.StructField("token_count", _I), T.StructField("parent_url", _S), T.StructField("content_type", _S), T.StructField("crawl_timestamp", _TS), T.StructField("chunk_index", _I), T.StructField("content_hash", _S)]
)
CHUNK = T.StructType([T.StructField("text", _S), T.StructField("metadata", CHUNK_METADATA)])
VECTOR = T.StructType([T.StructField("id", _S, False), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("text", _S), T.StructField("metadata", _S), T.StructField("namespace", _S)])
COUNTERS = ("pages_crawled", "chunks_total", "chunks_new", "chunks_skipped", "chunks_upserted")
JOB_EVENT = T.StructType(
    [T.StructField("job_id", _S, False), T.StructField("seq", T.LongType(), False), T.StructField("url", _S), T.StructField("status", _S)] + [T.StructField(x, _I) for x in COUNTERS] + [T.StructField("error", _S), T.StructField("at", _TS), T.StructField("finished_at", _TS)]
)
LEDGER = T.StructType([T.StructField("content_hash", _S, False), T.StructField("chunk_id", _S), T.StructField("source_url", _S), T.StructField("job_id", _S), T.StructField("token_count", _I), T.StructField("created_at", _TS)])
STATUSES = ("pending", "crawling", "chunking", "embedding", "upserting", "completed", "failed")
