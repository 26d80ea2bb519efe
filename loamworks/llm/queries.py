"""Queries of this subpackage over the project's tables, each over whole tables and whole texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamworks.llm import boilerplate, encoding, history, language, near_duplicates, packing, repeated_lines, residue

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def wide(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """Columns of a table whose rows go through Python; one of fewer splits than cores is dealt out to all cores."""
    rows, cores = table(spark, folder, name).select(*columns), spark.sparkContext.defaultParallelism
    return rows if rows.rdd.getNumPartitions() >= cores else rows.repartition(cores)


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    arrivals = wide(spark, folder, "incoming_chunks", "arrival_id", "batch_no", "text", "metadata.source_url")
    kept = wide(spark, folder, "chunks", "chunk_no", "text", "metadata.content_hash")
    return history.repeated_arrivals(arrivals, table(spark, folder, "indexed_chunks"), kept, threshold=0.6, k=3).select("arrival_id")


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return boilerplate.furniture_lines(wide(spark, folder, "crawled_pages", "page_id", "source_url", "markdown"))


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    texts = wide(spark, folder, "chunks", "chunk_no", "text").withColumnRenamed("chunk_no", "id")
    return near_duplicates.similar_pairs(texts, threshold=0.6, k=3).select(F.col("id_a").alias("chunk_no_a"), F.col("id_b").alias("chunk_no_b"))


def p3_groups(spark: SparkSession, folder: str) -> DataFrame:
    """One row for each chunk with shingles: its class of equal sets, and the links of the class to other classes."""
    texts = wide(spark, folder, "chunks", "chunk_no", "text").withColumnRenamed("chunk_no", "id")
    return near_duplicates.similar_groups(texts, threshold=0.6, k=3).select(F.col("id").alias("chunk_no"), "class", "links")


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return residue.empty_pages(wide(spark, folder, "crawled_pages", "page_id", "source_url", "page_title", "markdown"))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return repeated_lines.repeated_lines(table(spark, folder, "crawled_pages"), least=8)


def p6_ids(spark: SparkSession, folder: str) -> DataFrame:
    return encoding.encode(wide(spark, folder, "documents", "doc_id", "text"))


def p7_containers(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(encoding.token_counts(wide(spark, folder, "documents", "doc_id", "text")), capacity=2048)


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    found = language.mislabelled(wide(spark, folder, "documents", "doc_id", "text", "lang"), table(spark, folder, "lang_samples"), table(spark, folder, "lang_notations"))
    return found.select("doc_id", "seg_no", "lang")


def p8_confidence(spark: SparkSession, folder: str) -> DataFrame:
    return language.language_stretches(wide(spark, folder, "documents", "doc_id", "text"), table(spark, folder, "lang_samples"))


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (p1_found, p2_found, p3_found, p3_groups, p4_found, p5_found, p6_ids, p7_containers, p8_found, p8_confidence)}


def oracle_sql() -> dict[str, str]:
    return {"p3_found": P3, "p3_groups": P3_GROUPS, "p5_found": P5}


P5 = r"""
with pages as (
  select page_id, lower(regexp_extract(source_url, '^[hH][tT][tT][pP][sS]?://([^/?#]+)', 1)) as site,
         regexp_replace(regexp_replace(source_url, '#.*$', '', 's'), '/+$', '') as url, string_split(markdown, chr(10)) as lines
  from crawled_pages where regexp_matches(source_url, '^[hH][tT][tT][pP][sS]?://[^/?#]+')
), numbered as (
  select page_id, site, url, lines, unnest(range(1, len(lines) + 1)) as line_no from pages
), keyed as (
  select page_id, site, url, cast(line_no as integer) as line_no, regexp_replace(lower(lines[line_no]), '[^\p{L}]+', '', 'g') as key from numbered
), often as (
  select site, key from keyed where key <> '' group by site, key having count(distinct url) >= 8
)
select page_id, line_no from keyed join often using (site, key)
"""

_P3 = r"""
with w as (select chunk_no, list_transform(regexp_extract_all(text, '[\p{L}\p{N}]+'), lambda x: lower(x)) as w from chunks),
s as (select distinct chunk_no, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as s from (select chunk_no, w, unnest(range(1, len(w) - 1)) as i from w)),
n as (select chunk_no, count(*) as n from s group by chunk_no),
p as (select a.chunk_no as a, b.chunk_no as b, count(*) as c from s a join s b on a.s = b.s and a.chunk_no < b.chunk_no group by 1, 2),
found as (select p.a as a, p.b as b from p join n x on x.chunk_no = p.a join n y on y.chunk_no = p.b where p.c * 1.0 / (x.n + y.n - p.c) >= 0.6)
"""

P3 = _P3 + "select a as chunk_no_a, b as chunk_no_b from found"

P3_GROUPS = _P3 + """, c as (select chunk_no, min(chunk_no) over (partition by h) as class from (select chunk_no, string_agg(s, '|' order by s) as h from s group by chunk_no)),
l as (select x.class, count(distinct y.class) as links from (select a, b from found union all select b, a from found) f join c x on x.chunk_no = f.a join c y on y.chunk_no = f.b where x.class <> y.class group by 1)
select chunk_no, c.class as class, coalesce(links, 0) as links from c left join l on l.class = c.class
"""
