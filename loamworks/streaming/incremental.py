"""Continuous ingestion: each micro-batch of pages goes through the batch plan; the ledger is the state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loamworks.plans.ingest import Engine


def ingest_stream(engine: Engine, pages: DataFrame, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Start ingesting a stream of pages; a batch that is delivered again finds its chunks booked and adds nothing."""

    def batch(rows: DataFrame, number: int) -> None:
        result = engine.ingest(rows, job_id=f"batch-{number}")
        if result.status == "failed":
            raise RuntimeError(result.error)

    writer = pages.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def pages_by_window(pages: DataFrame, length: str = "1 day", late: str = "2 days") -> DataFrame:
    """(start, site, pages) of a stream of pages in tumbling windows; rows later than the watermark are dropped."""
    site = F.lower(F.regexp_extract("source_url", r"^https?://([^/?#]+)", 1))
    counted = pages.withWatermark("crawl_timestamp", late).groupBy(F.window("crawl_timestamp", length), site.alias("site")).count()
    return counted.select(F.col("window.start").alias("start"), "site", F.col("count").alias("pages"))
