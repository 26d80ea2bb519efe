"""Queries over the project's tables, each over whole tables, with the SQL that checks them."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loamworks.config import Settings
from loamworks.functions import text as X
from loamworks.functions import tokens as T
from loamworks.functions import urls as U
from loamworks.functions.chunking import Budget, chunk_array, chunk_pages
from loamworks.functions.embedding import cosine, embedding
from loamworks.functions.html import html_to_markdown
from loamworks.operators import collection, crawl, dedup, jobs, search
from loamworks.operators.lineage import cut_lineage, shared_folder
from loamworks.plans import rag
from loamworks.plans.ingest import Engine
from loamworks.schemas import CHUNK_METADATA
from loamworks.streaming.incremental import pages_by_window

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
DIM = 64


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def escaped(text):
    return F.replace(F.replace(F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;")), F.lit('"'), F.lit("&quot;"))


def url_pages(spark: SparkSession, folder: str, *more: str) -> DataFrame:
    """First row of each normalised URL of crawled_pages, with more of its columns."""
    pages = table(spark, folder, "crawled_pages").withColumn("url", U.normalize_url(F.col("source_url"))).where(U.is_valid_url(F.col("url")))
    return dedup.keep_first(pages.select("url", "page_id", "page_title", "markdown", "content_type", "links", *more), "url", ["page_id"])


_NORM = "case when regexp_replace({0}, '#.*$', '', 's') ~ '^/*$' then regexp_replace({0}, '#.*$', '', 's') else regexp_replace(regexp_replace({0}, '#.*$', '', 's'), '/+$', '') end"
_HOST = "regexp_extract({0}, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)"
_VALID = "regexp_matches({0}, '^[hH][tT][tT][pP][sS]?://[^/?#]+')"
_STRIP = r"regexp_replace(regexp_replace({0}, '^[\s\x1c-\x1f\x85\p{{Z}}]+', ''), '[\s\x1c-\x1f\x85\p{{Z}}]+$', '')"
_WORDS = r"coalesce(len(list_filter(string_split_regex({0}, '[\s\x1c-\x1f\x85\p{{Z}}]+'), lambda x: x <> '')), 0)"



def _hash(url: str, text: str) -> str:
    return rf"sha256(encode({url}) || '\x00'::blob || encode({_STRIP.format(text)}))"


def _n(url: str) -> str:
    return _NORM.format(url)


# URLs and scalars


@query("x01_normalize_url", f"select page_id, {_n('source_url')} as url from crawled_pages")
def x01(spark, folder):
    return table(spark, folder, "crawled_pages").select("page_id", U.normalize_url(F.col("source_url")).alias("url"))


_BASE = "regexp_extract(base, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1)"


@query(
    "x02_join_url",
    f"""with l as (select page_id, {_n("source_url")} as base, links, unnest(range(1, len(links) + 1)) as i from crawled_pages where {_VALID.format("source_url")}),
    p as (select page_id, base, i, regexp_extract(links[i], '^[a-z]+://[^/?#]*(/?.*)$', 1) as path from l where regexp_matches(links[i], '^https?://[^/?#]+')),
    f as (select *, unnest([0, 1, 2, 3, 4]) as form, {_BASE} as root, regexp_replace(regexp_extract(base, '^[^?#]*', 0), '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)(.*/)?.*$', '\\2') as folder from p)
    select page_id, cast(i - 1 as bigint) as pos, cast(form as bigint) as form, case form
      when 0 then root || '/x' || i || path
      when 1 then root || case when folder = '' then '/' else folder end || 'next-' || i || '.html?p=' || i
      when 2 then regexp_extract(base, '^[^?#]*', 0) || '?q=' || i
      when 3 then base || '#part-' || i
      else regexp_extract(base, '^([A-Za-z][A-Za-z0-9+.-]*:)', 1) || '//other.test/' || i end as url from f""",
)
def x02(spark, folder):
    """Each link of a page as a root path, a relative one, a query, a fragment and a host, resolved against the page."""
    pages = table(spark, folder, "crawled_pages").where(U.is_valid_url(F.col("source_url")))
    links = pages.select("page_id", U.normalize_url(F.col("source_url")).alias("base"), F.posexplode("links").alias("pos", "link")).where(F.col("link").rlike("^https?://[^/?#]+"))
    i = (F.col("pos") + 1).cast("string")
    path = F.regexp_extract("link", r"^[a-z]+://[^/?#]*(/?.*)$", 1)
    forms = [F.concat(F.lit("/x"), i, path), F.concat(F.lit("next-"), i, F.lit(".html?p="), i), F.concat(F.lit("?q="), i), F.concat(F.lit("#part-"), i), F.concat(F.lit("//other.test/"), i)]
    each = links.select("page_id", "base", F.col("pos").cast("long").alias("pos"), F.posexplode(F.array(*forms)).alias("form", "href"))
    return each.select("page_id", "pos", F.col("form").cast("long").alias("form"), U.join_url(F.col("base"), F.col("href")).alias("url"))


@query("x03_sitemap_root", f"select page_id, regexp_extract(source_url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1) || '/sitemap.xml' as root from crawled_pages where {_VALID.format('source_url')}")
def x03(spark, folder):
    pages = table(spark, folder, "crawled_pages").where(U.is_valid_url(F.col("source_url")))
    return pages.select("page_id", U.sitemap_root(F.col("source_url")).alias("root"))


@query("x04_content_hash", f"select chunk_no, {_hash('metadata.source_url', 'text')} as content_hash from chunks")
def x04(spark, folder):
    return table(spark, folder, "chunks").select("chunk_no", X.content_hash(F.col("metadata.source_url"), F.col("text")).alias("content_hash"))


@query("x05_chunk_id", f"select chunk_no, substr({_hash('metadata.source_url', 'text')}, 1, 16) || '-' || metadata.chunk_index as chunk_id from chunks")
def x05(spark, folder):
    named = X.content_hash(F.col("metadata.source_url"), F.col("text"))
    return table(spark, folder, "chunks").select("chunk_no", X.chunk_id(named, F.col("metadata.chunk_index")).alias("chunk_id"))


@query(
    "x06_uuid5",
    """with d as (select content_hash, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode(content_hash)) as h from indexed_chunks)
    select content_hash, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || substr('89ab', ('0x' || substr(h, 17, 1))::int % 4 + 1, 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12) as uuid from d""",
)
def x06(spark, folder):
    return table(spark, folder, "indexed_chunks").select("content_hash", X.uuid5(F.col("content_hash")).alias("uuid"))


@query("x07_vector_literal", "with v as (select vec_id, embedding, unnest(range(1, len(embedding) + 1)) as i from embeddings) select vec_id, cast(i - 1 as bigint) as pos, round(embedding[i]::double, 6) as value from v")
def x07(spark, folder):
    """Literals, read again as JSON."""
    made = table(spark, folder, "embeddings").select("vec_id", X.vector_literal(F.col("embedding")).alias("literal"))
    return made.select("vec_id", F.posexplode(F.from_json("literal", "array<float>")).alias("pos", "value")).select("vec_id", F.col("pos").cast("long").alias("pos"), F.round(F.col("value").cast("double"), 6).alias("value"))


@query(
    "x09_payload",
    """select chunk_no, metadata.chunk_id as chunk_id, metadata.parent_url as parent_url, cast(metadata.token_count as varchar) as token_count,
    case when epoch_us(metadata.crawl_timestamp) % 1000000 = 0 then strftime(metadata.crawl_timestamp at time zone 'UTC', '%Y-%m-%dT%H:%M:%S+00:00') else strftime(metadata.crawl_timestamp at time zone 'UTC', '%Y-%m-%dT%H:%M:%S.%f+00:00') end as at from chunks""",
)
def x09(spark, folder):
    made = table(spark, folder, "chunks").select("chunk_no", X.payload(F.col("metadata"), CHUNK_METADATA.names).alias("json"))
    field = lambda f, name: F.get_json_object("json", f"$.{f}").alias(name)
    return made.select("chunk_no", field("chunk_id", "chunk_id"), field("parent_url", "parent_url"), field("token_count", "token_count"), F.regexp_replace(field("crawl_timestamp", "at"), "Z$", "+00:00").alias("at"))


@query("x10_json", "select event_id, cast(json_extract_string(props, '$.k') as bigint) as k from events")
def x10(spark, folder):
    return table(spark, folder, "events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


@query("x11_flat_meta", """select event_id, case event_id % 3 when 0 then event_type when 1 then '{"inner":"' || event_type || '"}' else '["' || event_type || '"]' end as field, json_extract_string(props, '$.k') as k from events""")
def x11(spark, folder):
    """A string, an object or an array beside a number in one JSON object."""
    kind = F.col("event_type")
    nested = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit('"'), kind, F.lit('"'))).when(F.col("event_id") % 3 == 1, F.concat(F.lit('{"inner":"'), kind, F.lit('"}'))).otherwise(F.concat(F.lit('["'), kind, F.lit('"]')))
    made = table(spark, folder, "events").select("event_id", F.concat(F.lit('{"field":'), nested, F.lit(',"k":'), F.get_json_object("props", "$.k"), F.lit("}")).alias("json"))
    return made.select("event_id", X.scalar_or_json(F.col("json"), "field").alias("field"), X.scalar_or_json(F.col("json"), "k").alias("k"))


@query("x12_word_count", f"select doc_id, cast({_WORDS.format('text')} as bigint) as words from documents")
def x12(spark, folder):
    return table(spark, folder, "documents").select("doc_id", X.word_count(F.col("text")).cast("long").alias("words"))


@query("x13_token_count")
def x13(spark, folder):
    return table(spark, folder, "documents").select("doc_id", T.token_count(F.col("text"), Settings().tokenizer).alias("tokens"))


@query("x14_tail_tokens")
def x14(spark, folder):
    return table(spark, folder, "documents").select("doc_id", T.last_tokens(F.col("text"), 20, Settings().tokenizer).alias("tail"))


@query("x15_truncate_tokens")
def x15(spark, folder):
    return table(spark, folder, "documents").select("doc_id", T.first_tokens(F.col("text"), 20, Settings().tokenizer).alias("head"))


@query(
    "x16_breadcrumb",
    """select n_nationkey, 0::bigint as nth, r_name as section from nation join region on r_regionkey = n_regionkey
    union all select n_nationkey, 1, r_name || ' > ' || n_name from nation join region on r_regionkey = n_regionkey
    union all select s_suppkey + 1000000, 0, r_name || ' > ' || n_name || ' > ' || s_name from supplier join nation on n_nationkey = s_nationkey join region on r_regionkey = n_regionkey
    union all select s_suppkey + 1000000, 1, r_name || ' > other' from supplier join nation on n_nationkey = s_nationkey join region on r_regionkey = n_regionkey""",
)
def x16(spark, folder):
    """Sections of pages whose headings are regions, nations and suppliers; each text is a chunk of its own."""
    nation = table(spark, folder, "nation").join(table(spark, folder, "region"), F.col("r_regionkey") == F.col("n_regionkey"))
    small = nation.select("n_nationkey", F.concat(F.lit("# "), "r_name", F.lit("\n\nfirst text of it\n\n## "), "n_name", F.lit("\n\nsecond text of it")).alias("markdown"))
    held = table(spark, folder, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    deep = held.select((F.col("s_suppkey") + 1_000_000).alias("n_nationkey"), F.concat(F.lit("# "), "r_name", F.lit("\n## "), "n_name", F.lit("\n### "), "s_name", F.lit("\n\nfirst text of it\n\n## other\n\nsecond text")).alias("markdown"))
    pages = small.unionByName(deep)
    budget = Budget(2, 8, -1).filled(Settings())
    return pages.select(F.col("n_nationkey").cast("long").alias("n_nationkey"), F.posexplode(chunk_array(F.col("markdown"), budget)).alias("at", "c")).where(F.col("c.text").contains("text")).groupBy("n_nationkey", F.col("c.section").alias("section")).agg(F.min("at").alias("at")).select(
        "n_nationkey", (F.row_number().over(W.partitionBy("n_nationkey").orderBy("at")) - 1).cast("long").alias("nth"), "section"
    )


@query(
    "x19_cosine",
    """select a.vec_id, round(list_cosine_similarity(a.embedding::double[], b.embedding::double[]), 6) as score
    from embeddings a join embeddings b on b.vec_id = a.vec_id + 1""",
)
def x19(spark, folder):
    v = table(spark, folder, "embeddings").select("vec_id", "embedding")
    both = v.join(v.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other")), "vec_id")
    return both.select("vec_id", F.round(cosine(F.col("embedding"), F.col("other")), 6).alias("score"))


@query("x20_content_type", "select page_id, trim(split_part(content_type, ';', 1)) as kind from crawled_pages")
def x20(spark, folder):
    return table(spark, folder, "crawled_pages").select("page_id", U.content_type_base(F.col("content_type")).alias("kind"))


# Filters


@query("f01_valid_url", f"select page_id, {_VALID.format('source_url')} as valid from crawled_pages")
def f01(spark, folder):
    return table(spark, folder, "crawled_pages").select("page_id", U.is_valid_url(F.col("source_url")).alias("valid"))


@query("f02_html", "select page_id from crawled_pages where contains(content_type, 'html')")
def f02(spark, folder):
    return table(spark, folder, "crawled_pages").where(F.col("content_type").contains("html")).select("page_id")


@query("f03_min_words", f"select page_id from crawled_pages where {_WORDS.format('markdown')} >= 20")
def f03(spark, folder):
    return table(spark, folder, "crawled_pages").where(X.word_count(F.col("markdown")) >= 20).select("page_id")


@query("f04_host", f"select page_id, {_HOST.format('source_url')} as host from crawled_pages")
def f04(spark, folder):
    return table(spark, folder, "crawled_pages").select("page_id", U.netloc(F.col("source_url")).alias("host"))


@query(
    "f05_outlinks",
    f"""with l as (select page_id, source_url, links, unnest(range(1, len(links) + 1)) as i from crawled_pages)
    select page_id, cast(i - 1 as bigint) as pos, {_n("links[i]")} as url from l where {_HOST.format("links[i]")} = {_HOST.format("source_url")}""",
)
def f05(spark, folder):
    links = table(spark, folder, "crawled_pages").select("page_id", "source_url", F.posexplode("links").alias("pos", "link"))
    return links.where(U.same_domain(F.col("link"), F.col("source_url"))).select("page_id", F.col("pos").cast("long").alias("pos"), U.normalize_url(F.col("link")).alias("url"))


@query(
    "f08_http_links",
    f"with l as (select page_id, unnest(links) as link from crawled_pages) select page_id, count(*) as links, count(*) filter (where not {_VALID.format('link')} or link is null) as other from l group by page_id",
)
def f08(spark, folder):
    links = table(spark, folder, "crawled_pages").select("page_id", F.explode("links").alias("link"))
    return links.groupBy("page_id").agg(F.count("*").alias("links"), F.count_if(F.coalesce(~U.is_valid_url(F.col("link")), F.lit(True))).alias("other"))


@query("f13_metadata_filter", "select chunk_no from chunks where metadata.content_type = 'text/html' and metadata.chunk_index = 0")
def f13(spark, folder):
    made = table(spark, folder, "chunks").select("chunk_no", X.payload(F.col("metadata"), CHUNK_METADATA.names).alias("metadata"), F.lit("n").alias("namespace"))
    return search.narrowed(made, search.profile("pinecone"), "n", {"content_type": "text/html", "chunk_index": 0}).select("chunk_no")


@query("f12_namespace", "select chunk_no from chunks where metadata.content_type = 'text/html'")
def f12(spark, folder):
    made = table(spark, folder, "chunks").select("chunk_no", F.col("metadata.content_type").alias("namespace"), F.lit("{}").alias("metadata"))
    return search.narrowed(made, search.profile("pgvector"), "text/html", {"chunk_index": 0}).select("chunk_no")


@query("f14_skip_empty", f"select doc_id from documents where {_STRIP.format('text')} <> ''")
def f14(spark, folder):
    return table(spark, folder, "documents").where(X.stripped(F.col("text")) != "").select("doc_id")


# HTML: pages are written as HTML by Spark from the given tables and read again


def _as_html(spark: SparkSession, folder: str) -> DataFrame:
    chunks = table(spark, folder, "chunks").select("chunk_no", F.col("metadata.source_url").alias("url"), F.trim("metadata.title").alias("title"), "text").where("title <> ''")
    body = F.array_join(F.transform(F.split("text", "\n\n"), lambda p: F.concat(F.lit("<p>"), escaped(p), F.lit("</p>"))), "\n")
    nav = '<nav class="top"><a href="/start#x">Start</a></nav><div class="sidebar">Menu</div><script>var x = "<p>";</script>'
    page = F.concat(F.lit("<html><head><title>"), escaped(F.col("title")), F.lit(f"</title></head><body>{nav}<main><h1>"), escaped(F.col("title")), F.lit("</h1>"), body, F.lit('</main><footer><p>Imprint</p></footer></body></html>'))
    return chunks.select("chunk_no", html_to_markdown(page, F.col("url")).alias("d"))


_PARAGRAPHS = r"array_to_string(list_filter(list_transform(string_split(text, chr(10) || chr(10)), lambda p: " + _STRIP.format("p") + "), lambda p: p <> ''), chr(10) || chr(10))"


@query("h01_markdown", f"select chunk_no, '# ' || trim(metadata.title) || chr(10) || chr(10) || {_PARAGRAPHS} as markdown from chunks where trim(metadata.title) <> ''")
def h01(spark, folder):
    return _as_html(spark, folder).select("chunk_no", "d.markdown")


@query("h02_title", "select chunk_no, trim(metadata.title) as title from chunks where trim(metadata.title) <> ''")
def h02(spark, folder):
    return _as_html(spark, folder).select("chunk_no", "d.title")


@query(
    "h03_links",
    f"""with l as (select page_id, links, unnest(range(1, len(links) + 1)) as i from crawled_pages where {_VALID.format("source_url")})
    select page_id, cast(i - 1 as bigint) as pos, {_n("links[i]")} as url from l where links[i] is not null""",
)
def h03(spark, folder):
    pages = table(spark, folder, "crawled_pages").where(U.is_valid_url(F.col("source_url")))
    anchors = F.array_join(F.transform("links", lambda x: F.concat(F.lit('<p><a href="'), escaped(x), F.lit('">x</a></p>'))), "")
    made = pages.where("links is not null").select("page_id", html_to_markdown(F.concat(F.lit("<nav>"), anchors, F.lit("</nav>")), F.col("source_url")).alias("d"))
    return made.select("page_id", F.posexplode("d.links").alias("pos", "url")).select("page_id", F.col("pos").cast("long").alias("pos"), "url")


@query(
    "h07_table",
    """select o_custkey, '| order | status |' || chr(10) || '| --- | --- |' || chr(10) || string_agg('| ' || o_orderkey || ' | ' || o_orderstatus || ' |', chr(10) order by o_orderkey) as markdown
    from orders group by o_custkey""",
)
def h07(spark, folder):
    row = F.concat(F.lit("<tr><td>"), F.col("o_orderkey").cast("string"), F.lit("</td><td>"), F.col("o_orderstatus"), F.lit("</td></tr>"))
    rows = table(spark, folder, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("o_orderkey", row.alias("r")))).alias("rows"))
    html = F.concat(F.lit("<table><tr><th>order</th><th>status</th></tr>"), F.array_join(F.transform("rows", lambda x: x["r"]), ""), F.lit("</table>"))
    return rows.select("o_custkey", html_to_markdown(html, F.lit("")).alias("d")).select("o_custkey", "d.markdown")


# Chunks


def _to_chunk(pages: DataFrame) -> DataFrame:
    return pages.select(F.col("url").alias("source_url"), "page_title", "markdown", "parent_url", "content_type", "crawl_timestamp")


@query("c07_chunks")
def c07(spark, folder):
    return chunk_pages(_to_chunk(url_pages(spark, folder, "parent_url", "crawl_timestamp")), Budget(200, 300, 40))


@query("c04_chunk_counts")
def c04(spark, folder):
    return c07(spark, folder).groupBy("source_url").agg(F.count("*").alias("chunks"), F.max("token_count").alias("largest"))


@query(
    "c01_small_pages",
    f"""with p as (select c_custkey, c_mktsegment, c_name, c_nationkey from customer)
    select 'https://c.test/' || c_custkey as source_url, 0::bigint as chunk_index, c_mktsegment || ' > ' || c_name as section,
      '# ' || c_mktsegment || chr(10) || chr(10) || 'one' || chr(10) || chr(10) || '```' || chr(10) || '# no heading' || chr(10) || chr(10) || 'x = ' || c_nationkey || chr(10) || '```' || chr(10) || chr(10) || '## ' || c_name || chr(10) || chr(10) || '| a | b |' || chr(10) || '| - | - |' as text from p""",
)
def c01(spark, folder):
    """Pages below the target are one chunk: blocks joined by blank lines, code and table whole, the last heading's path."""
    lines = [F.concat(F.lit("#   "), "c_mktsegment"), F.lit("one"), F.lit("\n\n```"), F.lit("# no heading\n"), F.concat(F.lit("x = "), F.col("c_nationkey").cast("string")), F.lit("```"), F.concat(F.lit("## "), "c_name"), F.lit("| a | b |"), F.lit("| - | - |\n\n")]
    lines[0] = F.concat(F.lit("# "), "c_mktsegment")
    return _sections(table(spark, folder, "customer"), F.concat(F.lit("https://c.test/"), F.col("c_custkey").cast("string")), F.concat_ws("\n", *lines), Budget(500, 600, -1))


@query(
    "c04_atomic_blocks",
    """with o as (select o_custkey, string_agg('| ' || o_orderkey || ' | ' || o_orderstatus || ' |', chr(10) order by o_orderkey) as body from orders group by o_custkey)
    select 'https://o.test/' || o_custkey as source_url, 0::bigint as chunk_index, '' as section, 'before' as text from o
    union all select 'https://o.test/' || o_custkey, 1, '', body from o
    union all select 'https://o.test/' || o_custkey, 2, 'after', '# after' || chr(10) || chr(10) || 'text' from o""",
)
def c04_atomic(spark, folder):
    """A table beyond the limit stands alone and whole, what is before and after it apart."""
    row = F.concat(F.lit("| "), F.col("o_orderkey").cast("string"), F.lit(" | "), "o_orderstatus", F.lit(" |"))
    pages = table(spark, folder, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("o_orderkey", row.alias("r")))).alias("rows"))
    text = F.concat(F.lit("before\n"), F.array_join(F.transform("rows", lambda x: x["r"]), "\n"), F.lit("\n# after\ntext"))
    return _sections(pages, F.concat(F.lit("https://o.test/"), F.col("o_custkey").cast("string")), text, Budget(3, 6, -1))


@query(
    "c05_overlap",
    """select 'https://p.test/' || p_partkey as source_url, 0::bigint as chunk_index, '# ' || p_partkey || chr(10) || chr(10) || 'one two three' as text from part
    union all select 'https://p.test/' || p_partkey, 1, ' two three' || chr(10) || chr(10) || 'four five six' from part
    union all select 'https://p.test/' || p_partkey, 2, ' five six' || chr(10) || chr(10) || 'seven eight nine' from part""",
)
def c05(spark, folder):
    """Each chunk but the first begins with the last two tokens of the one before."""
    text = F.concat(F.lit("# "), F.col("p_partkey").cast("string"), F.lit("\n\none two three\n\nfour five six\n\nseven eight nine"))
    made = _sections(table(spark, folder, "part"), F.concat(F.lit("https://p.test/"), F.col("p_partkey").cast("string")), text, Budget(3, 20, 2))
    return made.select("source_url", "chunk_index", F.when(F.col("chunk_index") > 0, F.concat(F.lit(" "), "text")).otherwise(F.col("text")).alias("text"))


def _sections(rows: DataFrame, url, markdown, budget: Budget) -> DataFrame:
    none = lambda kind: F.lit(None).cast(kind)
    pages = rows.select(url.alias("source_url"), none("string").alias("page_title"), markdown.alias("markdown"), none("string").alias("parent_url"), none("string").alias("content_type"), none("timestamp").alias("crawl_timestamp"))
    return chunk_pages(pages, budget).select("source_url", F.col("chunk_index").cast("long").alias("chunk_index"), "section", "text")


@query(
    "h06_elements",
    """select chunk_no, '## ' || s || chr(10) || chr(10) || 'a ' || s || ' b' || chr(10) || '1. ' || s || ' inner one inner two' || chr(10) || '2. last' || chr(10) || chr(10) || '- dot' || chr(10) || chr(10) || '```' || chr(10) || 'x' || chr(10) || s || chr(10) || '  y' || chr(10) || '```' || chr(10) || chr(10) || 'quoted' as markdown
    from (select chunk_no, 'c' || chunk_no || ' & <t>' as s from chunks)""",
)
def h06(spark, folder):
    """Headings, inline marks, nested and numbered lists, code and quotations; furniture by role, class and id goes."""
    s = escaped(F.concat(F.lit("c"), F.col("chunk_no").cast("string"), F.lit(" & <t>")))
    parts = ["<html><body><div role='Navigation'><p>gone</p></div><div id='cookie-bar'>gone</div><article><h2>", s, "</h2>loose text<div><p>a <b>", s, "</b> b</p></div><ol><li>", s, "<ul><li>inner one</li><li>inner two</li></ul></li><li>last</li></ol><ul><li>dot</li></ul><pre>x<code>", s, "</code>  y</pre><section class='x  share-box'><p>gone</p></section><blockquote><p>quoted</p></blockquote></article><p>outside</p></body></html>"]
    html = F.concat(*[F.lit(x) if isinstance(x, str) else x for x in parts])
    return table(spark, folder, "chunks").select("chunk_no", html_to_markdown(html, F.lit("https://a.test/")).alias("d")).select("chunk_no", "d.markdown")


# Deduplication, ledger, jobs, collection


@query("r01_keep_first", "select sha256(text) as hash, min(doc_id) as doc_id from documents where text is not null group by 1")
def r01(spark, folder):
    docs = table(spark, folder, "documents").where("text is not null").select(F.sha2("text", 256).alias("hash"), "doc_id")
    return dedup.keep_first(docs, "hash", ["doc_id"])


@query("r02_skip_indexed", "select chunk_no from chunks where metadata.content_hash not in (select content_hash from indexed_chunks)")
def r02(spark, folder):
    chunks = table(spark, folder, "chunks").select("chunk_no", "metadata.content_hash")
    return dedup.skip_indexed(chunks, table(spark, folder, "indexed_chunks")).select("chunk_no")


_ARRIVED = f"(select arrival_id, batch_no, text, metadata.source_url as source_url, metadata.chunk_id as chunk_id, metadata.token_count as token_count, {_hash(_n('metadata.source_url'), 'text')} as content_hash from incoming_chunks)"


def _arrived(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "incoming_chunks").select("arrival_id", "batch_no", "text", "metadata.source_url", "metadata.chunk_id", "metadata.token_count")
    return rows.withColumn("content_hash", X.content_hash(U.normalize_url(F.col("source_url")), F.col("text")))


@query(
    "r03_dedup_counts",
    f"""with a as {_ARRIVED}, c as (select count(*) as total, count(distinct content_hash) filter (where content_hash not in (select content_hash from indexed_chunks)) as new from a)
    select total as chunks_total, new as chunks_new, total - new as chunks_skipped from c""",
)
def r03(spark, folder):
    return dedup.dedup_counts(_arrived(spark, folder), table(spark, folder, "indexed_chunks"))


@query("r05_records", "select metadata.content_hash as id, text, metadata.source_url as source_url from chunks")
def r05(spark, folder):
    rows = table(spark, folder, "chunks").select(F.col("metadata.content_hash").alias("id"), "text", X.payload(F.col("metadata"), CHUNK_METADATA.names).alias("metadata"))
    return rows.select("id", "text", F.get_json_object("metadata", "$.source_url").alias("source_url"))


@query("r06_counts", f"select {_HOST.format('metadata.source_url')} as host, count(*) as chunks, count(distinct metadata.source_url) as pages, cast(sum(metadata.token_count) as bigint) as tokens from chunks group by 1")
def r06(spark, folder):
    rows = table(spark, folder, "chunks").select(U.netloc(F.col("metadata.source_url")).alias("host"), "metadata.source_url", "metadata.token_count")
    return rows.groupBy("host").agg(F.count("*").alias("chunks"), F.countDistinct("source_url").alias("pages"), F.sum("token_count").alias("tokens"))


@query("r07_url_union", f"with u as (select {_n('source_url')} as url, page_id from crawled_pages union all select {_n('url')}, 1000000000 from ingest_jobs) select url, min(page_id) as first from u where url is not null group by url")
def r07(spark, folder):
    pages = table(spark, folder, "crawled_pages").select(U.normalize_url(F.col("source_url")).alias("url"), F.col("page_id").alias("first"))
    more = table(spark, folder, "ingest_jobs").select(U.normalize_url(F.col("url")).alias("url"), F.lit(1_000_000_000).cast("long").alias("first"))
    return dedup.keep_first(pages.unionByName(more).where("url is not null"), "url", ["first"])


@query("r10_rank", "select chunk_no, metadata.source_url as source_url, row_number() over (partition by metadata.source_url order by chunk_no) as nth from chunks")
def r10(spark, folder):
    rows = table(spark, folder, "chunks").select("chunk_no", "metadata.source_url")
    return rows.withColumn("nth", F.row_number().over(W.partitionBy("source_url").orderBy("chunk_no")).cast("long"))


@query(
    "k02_upsert",
    f"""with a as {_ARRIVED}, u as (select content_hash as id, null::varchar as text, 'old' as namespace, -1 as seq from indexed_chunks union all select content_hash, text, 'new', arrival_id from a)
    select id, arg_max_null(text, seq) as text, arg_min(namespace, seq) as namespace from u group by id""",
)
def k02(spark, folder):
    empty = F.array().cast("array<float>").alias("embedding")
    none = F.lit(None).cast("string")
    old = table(spark, folder, "indexed_chunks").select(F.col("content_hash").alias("id"), empty, none.alias("text"), none.alias("metadata"), F.lit("old").alias("namespace"))
    new = _arrived(spark, folder).select(F.col("content_hash").alias("id"), empty, "text", none.alias("metadata"), F.lit("new").alias("namespace"), F.col("arrival_id").alias("seq"))
    return collection.upserted(old, new).select("id", "text", "namespace")


@query("k03_delete", f"select content_hash as id from indexed_chunks where content_hash not in (select content_hash from {_ARRIVED})")
def k03(spark, folder):
    old = table(spark, folder, "indexed_chunks").select(F.col("content_hash").alias("id"))
    return collection.deleted(old, _arrived(spark, folder).select(F.col("content_hash").alias("id")))


@query(
    "k07_job_latest",
    "select user_id as job_id, arg_max(event_type, event_id) as status, arg_max(case when value > 50 then value end, event_id) as value, max(event_id) as seq from events group by user_id",
)
def k07(spark, folder):
    events = table(spark, folder, "events").select(F.col("user_id").alias("job_id"), F.col("event_type").alias("status"), F.expr("if(value > 50, value, null)").alias("value"), F.col("event_id").alias("seq"))
    return jobs.latest(events)


@query("k08_job_summary", "select lower(status) as status, count(*) as jobs, cast(sum(chunks_new) as bigint) as chunks_new, count(error) as errors, count(finished_at) as finished from ingest_jobs group by 1")
def k08(spark, folder):
    rows = table(spark, folder, "ingest_jobs")
    return rows.groupBy(F.lower("status").alias("status")).agg(F.count("*").alias("jobs"), F.sum("chunks_new").alias("chunks_new"), F.count("error").alias("errors"), F.count("finished_at").alias("finished"))


@query(
    "k09_ledger_insert",
    f"""with a as {_ARRIVED}, f as (select content_hash, arg_min(chunk_id, batch_no::bigint * 1000000000 + arrival_id) as chunk_id from a group by 1)
    select content_hash, chunk_id from indexed_chunks union all select content_hash, chunk_id from f where content_hash not in (select content_hash from indexed_chunks)""",
)
def k09(spark, folder):
    ledger = table(spark, folder, "indexed_chunks").select("content_hash", "chunk_id")
    return dedup.ledger_insert(ledger, _arrived(spark, folder).select("content_hash", "chunk_id", "batch_no", "arrival_id"), ["batch_no", "arrival_id"])


@query("s10_job_state", "select o_custkey as job_id, arg_max(case when o_orderstatus <> 'P' then o_orderstatus end, o_orderkey) as status, arg_max(o_orderpriority, o_orderkey) as url, max(o_orderkey) as seq from orders group by 1")
def s10(spark, folder):
    """State of jobs from their events; fields without a value keep the last one."""
    events = table(spark, folder, "orders").select(F.col("o_custkey").alias("job_id"), F.expr("if(o_orderstatus <> 'P', o_orderstatus, null)").alias("status"), F.col("o_orderpriority").alias("url"), F.col("o_orderkey").alias("seq"))
    return jobs.latest(events)


# Crawls


def _seeds(pages: DataFrame) -> DataFrame:
    return pages.groupBy(U.netloc(F.col("url")).alias("host")).agg(F.min("url").alias("seed")).select("seed")


@query(
    "s04_bfs",
    f"""with recursive p as (
      select url, arg_min(links, page_id) as links, arg_min(content_type, page_id) as content_type, arg_min(markdown, page_id) as markdown
      from (select {_n("source_url")} as url, page_id, [links] as links, [content_type] as content_type, [markdown] as markdown from crawled_pages) where {_VALID.format("url")} group by url
    ), ok as (select url, links[1] as links from p where contains(coalesce(content_type[1], 'text/html'), 'html') and {_WORDS.format("markdown[1]")} >= 20),
    e as (select distinct url as src, {_n("link")} as dst from (select url, unnest(links) as link from ok) where link is not null),
    s as (select min(url) as seed from p group by {_HOST.format("url")}),
    r as (select seed, seed as url, 0 as depth from s join ok on ok.url = seed
          union select r.seed, e.dst, r.depth + 1 from r join e on e.src = r.url join ok on ok.url = e.dst where r.depth < 3 and {_HOST.format("e.dst")} = {_HOST.format("r.seed")})
    select seed, url, cast(min(depth) as bigint) as depth from r group by seed, url""",
)
def s04(spark, folder):
    pages = url_pages(spark, folder)
    return crawl.crawl(pages, _seeds(pages), max_depth=3, max_pages=None).select("seed", "url", F.col("depth").cast("long").alias("depth"))


@query("s04_bfs_budget")
def s04_budget(spark, folder):
    pages = url_pages(spark, folder)
    return crawl.crawl(pages, _seeds(pages), max_depth=2, max_pages=10)


def _sitemaps(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Each host's pages written as sitemap files of about 1,000 addresses behind an index, and the hosts."""
    pages = url_pages(spark, folder).select(F.regexp_replace(U.sitemap_root(F.col("url")), "/sitemap.xml$", "").alias("site"), "url")
    parts = pages.groupBy("site").agg(F.expr("cast(ceil(count(*) / 1000) as int)").alias("parts"))
    loc = lambda x: F.concat(F.lit("<url><loc> "), escaped(x), F.lit(" </loc></url>"))
    name = F.concat("site", F.lit("/sitemap-"), F.col("part").cast("string"), F.lit(".xml"))
    split = pages.join(parts, "site").withColumn("part", F.pmod(F.xxhash64("url"), F.col("parts")).cast("int"))
    leaves = split.groupBy("site", "part").agg(F.array_join(F.sort_array(F.collect_list(loc(F.col("url")))), "").alias("body"))
    leaves = leaves.select(name.alias("url"), F.concat(F.lit('<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'), "body", F.lit("</urlset>")).alias("xml"))
    nested = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda i: F.concat(F.lit("<sitemap><loc>"), F.col("site"), F.lit("/sitemap-"), i.cast("string"), F.lit(".xml</loc></sitemap>")))
    index = parts.select(F.concat("site", F.lit("/sitemap.xml")).alias("url"), F.concat(F.lit("<sitemapindex>"), F.array_join(nested, ""), F.lit("</sitemapindex>")).alias("xml"))
    return index.unionByName(leaves), parts.select("site")


@query(
    "s05_sitemap",
    f"select distinct regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1) as site, url from (select {_n('source_url')} as url from crawled_pages) where {_VALID.format('url')}",
)
def s05(spark, folder):
    """The sitemap files of each host, all of them, are read."""
    return crawl.sitemap_urls(*_sitemaps(spark, folder), max_sitemaps=None).select("site", "url")


@query("s05_sitemap_budget")
def s05_budget(spark, folder):
    return crawl.sitemap_urls(*_sitemaps(spark, folder), max_sitemaps=50).select("site", "url")


@query(
    "s06_url_list",
    f"""with p as (select url, arg_min(content_type, page_id) as content_type, arg_min(markdown, page_id) as markdown
      from (select {_n("source_url")} as url, page_id, [content_type] as content_type, [markdown] as markdown from crawled_pages) where {_VALID.format("url")} group by url)
    select page_id as pos, {_n("source_url")} as url from crawled_pages c where {_n("source_url")} in
      (select url from p where contains(coalesce(content_type[1], 'text/html'), 'html') and {_WORDS.format("markdown[1]")} >= 20)""",
)
def s06(spark, folder):
    return crawl.fetch_list(url_pages(spark, folder), table(spark, folder, "crawled_pages").select(F.col("page_id").alias("pos"), F.col("source_url").alias("url")))


# Vectors


def _vectors(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    v = table(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), "label")
    return v.where("id % 20 = 0").select(F.col("id").alias("qid"), "vector", "label"), v


def _held(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The embeddings as rows of a collection, with their label as namespace and in the metadata, and each twentieth as a question."""
    v = table(spark, folder, "embeddings").withColumn("id", F.col("vec_id").cast("string"))
    even = (F.col("vec_id") % 2 == 0).alias("even")
    meta = F.to_json(F.struct(F.concat(F.lit("https://v.test/"), "id").alias("source_url"), F.lit("t").alias("title"), F.col("label").cast("string").alias("section"), F.col("vec_id").alias("number"), even))
    rows = v.select("id", "embedding", F.concat(F.lit("text "), "id").alias("text"), meta.alias("metadata"), F.concat(F.lit("n"), F.pmod("label", F.lit(2)).cast("string")).alias("namespace"))
    return v.where("vec_id % 20 = 0").select(F.col("vec_id").alias("qid"), F.col("embedding").alias("vector"), "label"), rows


_HALF = """list_transform({0}::double[], lambda x: case when x = 0 then 0.0 else round_even(x / pow(2, greatest(floor(log2(abs(x))), -14) - 10), 0) * pow(2, greatest(floor(log2(abs(x))), -14) - 10) end)"""
_BEST = """with v as (select vec_id, label, {0} as embedding from embeddings),
  s as (select q.vec_id as qid, v.vec_id::varchar as id, v.vec_id as number, v.label, round(list_cosine_similarity(q.embedding, v.embedding), 12) as score from v q, v where q.vec_id % 20 = 0 {1}),
  r as (select *, row_number() over (partition by qid order by score desc, id) as rank from s)
  """
_POINT = """substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || substr('89ab', ('0x' || substr(h, 17, 1))::int % 4 + 1, 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12)"""
_HASHED = "(select *, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode(id)) as h from r where rank <= 5)"


def _shown(found: DataFrame, *more) -> DataFrame:
    return found.select("qid", F.col("rank").cast("long").alias("rank"), "id", F.round("score", 6).alias("score"), *more)


@query("v01_vector_topk", _BEST.format(_HALF.format("embedding"), "and v.label % 2 = 1") + "select qid, rank, id, round(score, 6) as score, 'text ' || id as text from r where rank <= 5")
def v01(spark, folder):
    """Half precision, within one namespace."""
    asked, rows = _held(spark, folder)
    return _shown(search.search_many(rows, asked, 5, "pgvector", "n1"), "text")


@query("v02_filtered_topk", _BEST.format("embedding::double[]", "and q.label = v.label") + "select qid, rank, number as id, round(score, 6) as score from (select *, row_number() over (partition by qid order by score desc, number) as rank from s) where rank <= 5")
def v02(spark, folder):
    """Each question looks at the vectors of its own label."""
    asked, held = _vectors(spark, folder)
    return _shown(search.top_k(asked, held, 5, by="label"))


@query("v02_metadata_topk", _BEST.format("embedding::double[]", "and v.label % 2 = 0 and v.vec_id % 2 = 0 and v.label = 4") + "select qid, rank, id, round(score, 6) as score from r where rank <= 5")
def v02_metadata(spark, folder):
    """Within a namespace, with a boolean and a string of the metadata."""
    asked, rows = _held(spark, folder)
    return _shown(search.search_many(rows, asked, 5, "pinecone", "n0", {"even": True, "section": "4"}))


@query("v03_uuid_topk", _BEST.format("embedding::double[]", "") + f"select qid, rank, id, round(score, 6) as score, {_POINT} as point, 'n' || label % 2 as namespace, number from {_HASHED}")
def v03(spark, folder):
    """Points named by UUIDs; the namespace narrows nothing, but comes back with the metadata."""
    asked, rows = _held(spark, folder)
    found = search.search_many(rows, asked, 5, "qdrant", "n1", {"even": True})
    return _shown(found, "point", F.get_json_object("metadata", "$.namespace").alias("namespace"), F.get_json_object("metadata", "$.number").cast("long").alias("number"))


@query("v04_flat_topk", _BEST.format("embedding::double[]", "") + f"select qid, rank, id, round(score, 6) as score, {_POINT} as point, cast(label as varchar) as section from {_HASHED}")
def v04(spark, folder):
    asked, rows = _held(spark, folder)
    return _shown(search.search_many(rows, asked, 5, "weaviate"), "point", F.get_json_object("metadata", "$.section").alias("section"))


@query("v05_projected_topk", _BEST.format("embedding::double[]", "") + """select qid, rank, id, round(score, 6) as score, '{"source_url":"https://v.test/' || id || '","title":"t","section":"' || label || '"}' as metadata from r where rank <= 5""")
def v05(spark, folder):
    """Three fields of the metadata are fetched, for the best rows only."""
    asked, rows = _held(spark, folder)
    return _shown(search.search_many(rows, asked, 5, "milvus"), "metadata")


@query("v06_index_topk")
def v06(spark, folder):
    asked, held = _vectors(spark, folder)
    return _shown(search.Index.fit(held).top_k(asked, held, 5))


@query("v07_index_recall")
def v07(spark, folder):
    """How many of the five exact answers to each question the index finds."""
    asked, held = _vectors(spark, folder)
    exact = search.top_k(asked, held, 5).select("qid", F.col("id").alias("id"))
    found = search.Index.fit(held).top_k(asked, held, 5).select(F.col("qid").alias("qid"), F.col("id").alias("id"), F.lit(1).alias("hit"))
    return exact.join(found, ["qid", "id"], "left").groupBy("qid").agg(F.count("*").alias("wanted"), F.count("hit").alias("found"))


@query("v08_half_topk", _BEST.format(_HALF.format("embedding"), "") + "select qid, rank, number as id, round(score, 6) as score from (select *, row_number() over (partition by qid order by score desc, number) as rank from s) where rank <= 5")
def v08(spark, folder):
    asked, held = _vectors(spark, folder)
    return _shown(search.top_k(asked, held, 5, half=True))


# Embedding and prompts


@query(
    "e00_hash_buckets",
    f"""with w as (select chunk_no, unnest(string_split_regex(lower(text), '[\\s\\x1c-\\x1f\\x85\\p{{Z}}]+')) as w from chunks)
    select chunk_no, cast(('0x' || substr(md5(w), 1, 8))::bigint % {DIM} as bigint) as bucket, count(*) as n from w where w <> '' group by 1, 2""",
)
def e00(spark, folder):
    words = table(spark, folder, "chunks").select("chunk_no", F.explode(F.split(F.lower("text"), r"[\s\x1c-\x1f\x85\p{Z}]+")).alias("w")).where("w <> ''")
    bucket = F.conv(F.substring(F.md5("w"), 1, 8), 16, 10).cast("long") % DIM
    return words.groupBy("chunk_no", bucket.alias("bucket")).agg(F.count("*").alias("n"))


@query(
    "e01_embedding",
    f"""with w as (select chunk_no, unnest(string_split_regex(lower(text), '[\\s\\x1c-\\x1f\\x85\\p{{Z}}]+')) as w from chunks),
    b as (select chunk_no, ('0x' || substr(md5(w), 1, 8))::bigint % {DIM} as bucket, count(*) as n from w where w <> '' group by 1, 2),
    s as (select *, sqrt(sum(n * n) over (partition by chunk_no)) as norm from b)
    select chunk_no, cast(bucket as bigint) as bucket, round(cast(cast(n / norm as float) as double), 4) as value from s""",
)
def e01(spark, folder):
    made = table(spark, folder, "chunks").select("chunk_no", embedding(F.col("text"), Settings(embedding_dimension=DIM)).alias("v"))
    return made.select("chunk_no", F.posexplode("v").alias("bucket", "value")).where("value > 0").select("chunk_no", F.col("bucket").cast("long").alias("bucket"), F.round(F.col("value").cast("double"), 4).alias("value"))


@query(
    "e12_context",
    """with r as (select metadata.source_url as qid, row_number() over (partition by metadata.source_url order by chunk_no) as rank, metadata.section as section, text from chunks)
    select qid, string_agg('[' || rank || '] ' || qid || case when coalesce(section, '') <> '' then ' — ' || section else '' end || chr(10) || text, chr(10) || chr(10) || '---' || chr(10) || chr(10) order by rank) as context from r where rank <= 5 group by qid""",
)
def e12(spark, folder):
    rows = table(spark, folder, "chunks").select(F.col("metadata.source_url").alias("qid"), F.col("metadata.source_url").alias("source_url"), "metadata.section", "text", F.row_number().over(W.partitionBy("metadata.source_url").orderBy("chunk_no")).alias("rank"))
    return rag.contexts(rows.where("rank <= 5"))


# Windows and the flagship


@query(
    "st01_pages_by_day",
    "select date_trunc('day', crawl_timestamp at time zone 'UTC') as start, lower(regexp_extract(source_url, '^https?://([^/?#]+)', 1)) as site, count(*) as pages from crawled_pages where crawl_timestamp is not null group by 1, 2",
)
def st01(spark, folder):
    return pages_by_window(table(spark, folder, "crawled_pages")).select(F.col("start").cast("timestamp_ntz").alias("start"), "site", "pages")


@query(
    "a05_ingest_url",
    """with l as (select c_nationkey, c_custkey, row_number() over (partition by c_nationkey order by c_custkey) as nth from customer),
    f as (select c_custkey as seed_key, c_nationkey from l where nth = 1 and c_nationkey = (select min(c_nationkey) from customer))
    select 'https://n' || c_nationkey || '.test/start' as source_url, 1::bigint as chunks from f
    union all select 'https://n' || c_nationkey || '.test/' || c_custkey, 1 from l where c_nationkey = (select min(c_nationkey) from customer) and nth < 10""",
)
def a05_ingest_url(spark, folder):
    """A site whose start page links to all customers of a nation, ingested twice with a budget of ten pages: what the ledger holds."""
    address = lambda x: F.concat(F.lit("https://n"), F.col("c_nationkey").cast("string"), F.lit(".test/"), x)
    customers = table(spark, folder, "customer")
    words = F.lit(" word" * 25)
    leaves = customers.select(address(F.col("c_custkey").cast("string")).alias("url"), F.col("c_name").alias("page_title"), F.concat(F.lit("# "), "c_name", F.lit("\n\nText of"), words).alias("markdown"), F.array().cast("array<string>").alias("links"))
    links = F.transform(F.array_sort(F.collect_list("c_custkey")), lambda x: F.concat(F.lit("https://n"), F.col("c_nationkey").cast("string"), F.lit(".test/"), x.cast("string"), F.lit("/#top")))
    starts = customers.groupBy("c_nationkey").agg(links.alias("links"))
    starts = starts.select(address(F.lit("start")).alias("url"), F.lit("Start").alias("page_title"), F.concat(F.lit("# Start\n\nAll customers of a nation"), words).alias("markdown"), "links")
    web = starts.unionByName(leaves).withColumn("content_type", F.lit("text/html"))
    engine = Engine(spark, f"{shared_folder(spark)}/engine-{uuid.uuid4().hex}", Settings(embedding_dimension=DIM))
    seed = f"https://n{customers.agg(F.min('c_nationkey')).first()[0]}.test/start/"
    for _ in range(2):
        engine.ingest_url(seed, web, max_depth=1, max_pages=10)
    return engine.ledger().groupBy("source_url").agg(F.count("*").alias("chunks"))


@query("a05_flagship")
def flagship(spark: SparkSession, folder: str) -> DataFrame:
    """Pages to chunks, what is new of them embedded, and the five best passages for the title of every twentieth page."""
    settings = Settings()
    pages = url_pages(spark, folder, "parent_url", "crawl_timestamp")
    fresh = cut_lineage(dedup.new_chunks(chunk_pages(_to_chunk(crawl.usable(pages)), Budget(200, 300, 40)), table(spark, folder, "indexed_chunks"), ["source_url", "chunk_index"]))
    held = fresh.select(F.xxhash64("content_hash").alias("id"), "content_hash", "source_url", "section", "text")
    vectors = held.select("id", embedding(F.col("text"), settings).alias("vector"))
    asked = pages.where("page_id % 20 = 0 and page_title is not null").select(F.col("page_id").alias("qid"), embedding(F.col("page_title"), settings, "query").alias("vector"))
    found = search.top_k(asked, vectors, settings.top_k)
    return found.join(held, "id").select("qid", "rank", F.round("score", 6).alias("score"), "content_hash", "source_url", "section", "text")
