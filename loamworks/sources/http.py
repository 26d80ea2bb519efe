"""Pages over HTTP as a Spark data source: ``spark.read.format("http_pages").option("urls", "…\\n…").load()``."""

from __future__ import annotations

import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "url string, html string, content_type string, error string"


def fetch(url: str, timeout: float = 30, attempts: int = 3, wait: Callable[[float], None] = time.sleep) -> tuple[str, str | None, str | None, str | None]:
    """(url, html, content type, error) of one address: redirects followed, tried three times, never raising."""
    for attempt in range(1, attempts + 1):
        try:
            with urllib.request.urlopen(urllib.request.Request(url, headers={"User-Agent": "loamworks"}), timeout=timeout) as r:
                kind = (r.headers.get("content-type") or "text/html").split(";")[0].strip()
                return url, r.read().decode(r.headers.get_content_charset() or "utf-8", "replace"), kind, None
        except (urllib.error.URLError, TimeoutError, ConnectionError) as e:
            error = f"{type(e).__name__}: {e}"
            if attempt < attempts:
                wait(min(10, 2 ** (attempt - 1)))
        except ValueError as e:
            return url, None, None, f"{type(e).__name__}: {e}"
    return url, None, None, error


def fetched(urls: DataFrame, timeout: float = 30) -> DataFrame:
    """(url, html, content_type, error) of the addresses (url), fetched where Spark puts their rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for url in batch["url"].to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array([x], pa.string()) for x in fetch(url or "", timeout)], names=["url", "html", "content_type", "error"])

    spread = urls.select("url").distinct().repartition("url")
    return spread.mapInArrow(run, SCHEMA)


class _Reader(DataSourceReader):
    def __init__(self, options: dict) -> None:
        self.urls = [u for u in options.get("urls", "").split("\n") if u.strip()]
        self.size = int(options.get("batch", 16))
        self.timeout = float(options.get("timeout", 30))

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(self.urls[i : i + self.size]) for i in range(0, len(self.urls), self.size)] or [InputPartition([])]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        for url in partition.value:
            yield fetch(url.strip(), self.timeout)


class HttpPages(DataSource):
    @classmethod
    def name(cls) -> str:
        return "http_pages"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(HttpPages)
