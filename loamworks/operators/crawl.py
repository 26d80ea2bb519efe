"""Breadth-first crawls of many seeds at once, as rounds of joins, and sitemap discovery."""

from __future__ import annotations

import itertools
import re
import xml.etree.ElementTree as ET
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loamworks.functions.text import word_count
from loamworks.functions.urls import is_valid_url, netloc, normalize_url, sitemap_root
from loamworks.operators.lineage import cut_lineage

_SITEMAP = "struct<pages: array<string>, nested: array<string>>"


def checked_seed(url: str) -> str:
    """The normalised seed of a crawl; a ValueError for anything but an http(s) URL with a host."""
    if not re.match(r"[hH][tT][tT][pP][sS]?://[^/?#]+", url or ""):
        raise ValueError(f"not an http(s) URL: {url!r}")
    bare = url.partition("#")[0]
    return bare.rstrip("/") or bare


def usable(pages: DataFrame, min_words: int = 20) -> DataFrame:
    """Pages whose content type names HTML (null counts as HTML) and that have enough words."""
    html = F.coalesce(F.col("content_type"), F.lit("text/html")).contains("html")
    return pages.where(html & (word_count(F.col("markdown")) >= min_words))


def crawl(pages: DataFrame | Callable[[DataFrame], DataFrame], seeds: DataFrame, max_depth: int = 1, max_pages: int | None = 50, same_domain: bool = True, min_words: int = 20) -> DataFrame:
    """(seed, rank, depth, url, parent_url) of the pages that a breadth-first crawl of each seed keeps, in its order.

    pages: one row for each normalised url (url, markdown, content_type, links), or a function that gives those of (url);
    seeds: (seed). A page that is missing or
    not usable costs nothing and leads nowhere. The order within a depth is that of the path of link positions, so the
    first max_pages are those of a queue, without a rank over a whole frontier. Null links and invalid seeds are dropped;
    ``checked_seed`` raises for an invalid one.
    """
    look = pages if callable(pages) else lambda urls: pages
    start = seeds.where(is_valid_url(F.col("seed"))).select(normalize_url(F.col("seed")).alias("seed")).distinct()
    frontier = start.select("seed", F.col("seed").alias("url"), F.lit(None).cast("string").alias("parent_url"), F.array().cast("array<int>").alias("path"))
    seen = frontier.select("seed", "url")
    kept: list[DataFrame] = []
    for depth in range(max_depth + 1):
        ok = usable(look(frontier.select("url").distinct()), min_words).select("url", "links")
        found = cut_lineage(frontier.join(ok, "url").select("seed", F.lit(depth).alias("depth"), "url", "parent_url", "path", "links"))
        kept.append(found.drop("links"))
        if depth == max_depth:
            break
        if max_pages is not None:
            so_far = kept[0]
            for x in kept[1:]:
                so_far = so_far.unionByName(x)
            full = so_far.groupBy("seed").count().where(F.col("count") >= max_pages).select("seed")
            found = found.join(full, "seed", "left_anti")
        links = found.select("seed", F.col("url").alias("parent_url"), "path", F.posexplode("links").alias("pos", "raw"))
        links = links.select("seed", normalize_url(F.col("raw")).alias("url"), "parent_url", F.concat("path", F.array("pos")).alias("path")).where("url is not null")
        if same_domain:
            links = links.where(netloc(F.col("url")) == netloc(F.col("seed")))
        fresh = links.join(seen, ["seed", "url"], "left_anti")
        frontier = cut_lineage(fresh.groupBy("seed", "url").agg(F.min_by(F.struct("parent_url", "path"), "path").alias("first")).select("seed", "url", "first.parent_url", "first.path"))
        if frontier.isEmpty():
            break
        seen = cut_lineage(seen.unionByName(frontier.select("seed", "url")))
    out = kept[0]
    for x in kept[1:]:
        out = out.unionByName(x)
    return ranked(out, "seed", ["depth", "path"], max_pages).select("seed", "rank", "depth", "url", "parent_url")


def ranked(rows: DataFrame, key: str, order: list[str], most: int | None = None) -> DataFrame:
    """rows with their rank (from 1) within each key, the first ``most`` of each.

    Every key is cut into ranges of the order, over all keys together, each counted and ranked by itself, so no task
    holds a whole key: the rank is that within the range and the rows of the key in the ranges before.
    """
    parts = max(2, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    sorted_ = cut_lineage(rows.repartitionByRange(parts, key, *order).sortWithinPartitions(key, *order).withColumn("range", F.spark_partition_id()))
    sizes = sorted_.groupBy(key, "range").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(W.partitionBy(key).orderBy("range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select(key, "range", before.alias("start"))
    nth = F.row_number().over(W.partitionBy(key, "range").orderBy(*order))
    out = sorted_.withColumn("nth", nth).join(starts, [key, "range"]).withColumn("rank", (F.col("start") + F.col("nth")).cast("int")).drop("range", "nth", "start")
    return out if most is None else out.where(F.col("rank") <= most)


def fetch_list(pages: DataFrame, urls: DataFrame, min_words: int = 20) -> DataFrame:
    """(pos, url) of the addresses (pos, url) of a list whose pages are usable; no link is followed, the order is kept."""
    wanted = urls.select("pos", normalize_url(F.col("url")).alias("url"))
    return wanted.join(usable(pages, min_words).select("url"), "url", "left_semi").select("pos", "url")


def _read_sitemap(xml: str | None) -> tuple[list[str], list[str]]:
    """Page addresses and nested sitemaps; the first element tells which of both a file lists."""
    parser, kind, places = ET.XMLPullParser(("start", "end")), "", []
    try:
        parser.feed(xml or "")
        parser.close()
    except ET.ParseError:
        return [], []
    for event, node in parser.read_events():
        name = node.tag.split("}")[-1]
        if event == "start":
            kind = kind or name
        elif name == "loc" and (place := (node.text or "").strip()):
            places.append(place)
    return ([], places) if kind == "sitemapindex" else (places, [])


def parse_sitemap(xml: Column) -> Column:
    """Struct of the page addresses and the nested sitemaps of a file; both empty for anything that isn't a sitemap."""

    @F.pandas_udf(_SITEMAP)
    def run(files: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_read_sitemap(x) for x in files], columns=["pages", "nested"])

    return run(xml)


def sitemap_urls(files: DataFrame | Callable[[DataFrame], DataFrame], sites: DataFrame, max_sitemaps: int | None = 50, same_domain: bool = True) -> DataFrame:
    """(site, rank, url) of the pages that the sitemaps of each site (site) list, from sitemap files (url, xml), or a function
    that gives those of (url).

    Starts at /sitemap.xml of the host and follows index files in order, at most max_sitemaps files for a site (None: all
    of them); missing files count but list nothing. Addresses are normalised; the first place of each is kept.
    """
    look = files if callable(files) else lambda urls: files
    turn = sites.select("site", sitemap_root(F.col("site")).alias("url"), F.array(F.lit(0)).alias("path")).distinct()
    visited = turn.select("site", "url")
    kept: list[DataFrame] = []
    for _ in itertools.count() if max_sitemaps is None else range(max_sitemaps):
        parsed = look(turn.select("url").distinct()).select("url", parse_sitemap(F.col("xml")).alias("read"))
        read = cut_lineage(turn.join(parsed, "url", "left"))
        kept.append(read)
        nested = read.select("site", F.posexplode("read.nested").alias("pos", "url"), "path").select("site", "url", F.concat("path", F.array("pos")).alias("path"))
        turn = cut_lineage(nested.join(visited, ["site", "url"], "left_anti").groupBy("site", "url").agg(F.min("path").alias("path")))
        if turn.isEmpty():
            break
        visited = cut_lineage(visited.unionByName(turn.select("site", "url")))
    out = kept[0]
    for x in kept[1:]:
        out = out.unionByName(x)
    out = out.withColumn("turn", F.struct(F.size("path").alias("depth"), "path"))
    if max_sitemaps is not None:
        nth = F.row_number().over(W.partitionBy("site").orderBy("turn"))
        out = out.withColumn("nth", nth).where(F.col("nth") <= max_sitemaps)
    listed = out.select("site", "turn", F.posexplode("read.pages").alias("pos", "raw"))
    pages = listed.select("site", normalize_url(F.col("raw")).alias("url"), F.struct("turn", "pos").alias("at"))
    if same_domain:
        pages = pages.where(netloc(F.col("url")) == netloc(F.col("site")))
    first = pages.groupBy("site", "url").agg(F.min("at").alias("at"))
    return ranked(first, "site", ["at"]).select("site", "rank", "url")
