"""From pages to a collection: chunk, keep what is new, embed, upsert, book."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamworks.config import Settings
from loamworks.functions.chunking import Budget, chunk_pages
from loamworks.functions.embedding import embedding
from loamworks.functions.text import payload
from loamworks.operators.collection import Collection
from loamworks.operators.crawl import checked_seed, crawl, sitemap_urls, usable
from loamworks.operators.dedup import dedup_counts, new_chunks
from loamworks.operators.jobs import JobLog
from loamworks.operators.lineage import cut_lineage, written
from loamworks.schemas import CHUNK_METADATA, LEDGER
from loamworks.sources.http import fetched
from loamworks.sources.pages import read_html


@dataclass(frozen=True)
class Result:
    job_id: str
    status: str
    pages_crawled: int = 0
    chunks_total: int = 0
    chunks_new: int = 0
    chunks_skipped: int = 0
    chunks_upserted: int = 0
    error: str | None = None


def records(chunks: DataFrame, settings: Settings) -> DataFrame:
    """(id, embedding, text, metadata, namespace, seq) of chunk rows; the id is the content hash."""
    meta = F.struct(*CHUNK_METADATA.names)
    return chunks.select(F.col("content_hash").alias("id"), embedding(F.col("text"), settings).alias("embedding"), "text", payload(meta, CHUNK_METADATA.names).alias("metadata"), F.lit(settings.namespace).alias("namespace"), F.lit(0).cast("long").alias("seq"))


class Engine:
    """Ingestion and questions over tables in one folder that all executors reach."""

    def __init__(self, spark: SparkSession, folder: str, settings: Settings | None = None, budget: Budget | None = None) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")
        self.settings, self.budget = settings or Settings(), budget
        self.collection = Collection(spark, f"{self.folder}/collection")
        self.jobs = JobLog(spark, f"{self.folder}/jobs")

    def health(self) -> dict[str, str]:
        return {"status": "ok", "spark": self.spark.version}

    def ledger(self) -> DataFrame:
        """All content hashes booked so far."""
        try:
            return self.spark.read.schema(LEDGER).parquet(f"{self.folder}/ledger")
        except Exception as e:
            if "PATH_NOT_FOUND" in str(e):
                return self.spark.createDataFrame([], LEDGER)
            raise

    def ask(self, question: str, k: int | None = None, llm=None, where: dict | None = None):
        """Answer to a question from the collection, with its sources."""
        from loamworks.plans.rag import ask

        return ask(self.collection, question, k, self.settings, llm, where)

    def ingest_url(self, url: str, web: DataFrame | None = None, max_depth: int | None = None, max_pages: int | None = None, from_sitemap: bool = False, sitemaps: DataFrame | None = None, job_id: str | None = None, now: datetime | None = None) -> Result:
        """Crawl from a URL and index what is new.

        web: pages (url, page_title, markdown, content_type, links) that addresses are looked up in; none: they are fetched.
        from_sitemap: instead of following links, take the addresses that the host's sitemaps (url, xml; none: fetched)
        list, all of them unless max_pages is given. A URL that is none fails the job.
        """
        return self.ingest(lambda: self._pages(url, web, max_depth, max_pages, from_sitemap, sitemaps), url, job_id, now)

    def _pages(self, url: str, web: DataFrame | None, max_depth: int | None, max_pages: int | None, from_sitemap: bool, sitemaps: DataFrame | None) -> DataFrame:
        s = self.settings
        one = lambda x, name: self.spark.createDataFrame([(x,)], f"{name} string")
        if from_sitemap:
            files = sitemaps if sitemaps is not None else (lambda urls: fetched(urls, s.crawl_timeout).select("url", F.col("html").alias("xml")))
            order = sitemap_urls(files, one(url, "site"), s.max_sitemaps).select("url", "rank")
            order = cut_lineage(order if max_pages is None else order.where(F.col("rank") <= max_pages)).withColumn("parent_url", F.lit(None).cast("string"))
            found = usable(web, s.crawl_min_words) if web is not None else read_html(fetched(order.select("url"), s.crawl_timeout), s.crawl_min_words)
        else:
            kept: list[DataFrame] = []

            def look(urls: DataFrame) -> DataFrame:
                kept.append(written(read_html(fetched(urls, s.crawl_timeout), s.crawl_min_words)))
                return kept[-1]

            seed = one(checked_seed(url), "seed")
            order = crawl(look if web is None else web, seed, s.crawl_max_depth if max_depth is None else max_depth, s.crawl_max_pages if max_pages is None else max_pages, s.crawl_same_domain, s.crawl_min_words)
            order = order.select("url", "parent_url")
            found = functools.reduce(DataFrame.unionByName, kept) if web is None else web
        shown = found.select("url", "page_title", "markdown", "content_type").join(order, "url")
        return shown.select(F.col("url").alias("source_url"), "page_title", "markdown", "content_type", "parent_url", F.lit(datetime.now(UTC)).cast("timestamp").alias("crawl_timestamp"))

    def ingest(self, pages: DataFrame | Callable[[], DataFrame], url: str = "", job_id: str | None = None, now: datetime | None = None) -> Result:
        """Index what is new in pages; a second run of the same pages indexes nothing.

        A failure is written to the job with the counters so far and returned, not raised. The collection is written
        before the ledger, so a run that breaks off between them is repeated without harm.
        """
        job_id, now = job_id or uuid.uuid4().hex, now or datetime.now(UTC)
        self.jobs.create(job_id, url, now)
        seq, counts = 1, {}
        try:
            self.collection.ensure()
            self.jobs.append(job_id, seq, now, status="crawling")
            pages = pages() if callable(pages) else pages
            counts["pages_crawled"] = pages.count()
            if counts["pages_crawled"]:
                seq += 1
                self.jobs.append(job_id, seq, now, status="chunking", **counts)
                chunks = cut_lineage(chunk_pages(pages, self.budget, self.settings))
                counts |= dedup_counts(chunks, self.ledger()).first().asDict()
                if counts["chunks_new"]:
                    fresh = cut_lineage(new_chunks(chunks, self.ledger(), ["source_url", "chunk_index"]))
                    seq += 1
                    self.jobs.append(job_id, seq, now, status="embedding", **counts)
                    self.collection.upsert(records(fresh, self.settings))
                    counts["chunks_upserted"] = counts["chunks_new"]
                    booked = fresh.select("content_hash", "chunk_id", "source_url", F.lit(job_id).alias("job_id"), "token_count", F.lit(now).cast("timestamp").alias("created_at"))
                    booked.select(*LEDGER.names).write.mode("append").parquet(f"{self.folder}/ledger")
            self.jobs.finish(job_id, seq + 1, "completed", now, **counts)
            return Result(job_id, "completed", **counts)
        except Exception as e:
            error = f"{type(e).__name__}: {e}"
            self.jobs.finish(job_id, seq + 1, "failed", now, error=error, **counts)
            return Result(job_id, "failed", error=error, **counts)


def ingest_url(spark: SparkSession, folder: str, url: str, web: DataFrame | None = None, **options) -> Result:
    """``Engine.ingest_url`` with the settings of the environment."""
    return Engine(spark, folder, Settings.from_env()).ingest_url(url, web, **options)
