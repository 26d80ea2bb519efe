"""Raw HTML to pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamworks.functions.html import html_to_markdown
from loamworks.functions.text import word_count
from loamworks.functions.urls import content_type_base, normalize_url


def read_html(raw: DataFrame, min_words: int = 20) -> DataFrame:
    """Pages (url, page_title, markdown, content_type, links) of raw rows (url, html, content_type).

    Rows that aren't HTML are dropped before parsing, pages of too few words after it. A null type counts as HTML.
    """
    kind = F.coalesce(content_type_base(F.col("content_type")), F.lit("text/html"))
    html = raw.where(kind.contains("html") & F.col("html").isNotNull()).select("url", kind.alias("content_type"), html_to_markdown(F.col("html"), F.col("url")).alias("d"))
    pages = html.select(normalize_url(F.col("url")).alias("url"), F.col("d.title").alias("page_title"), "d.markdown", "content_type", "d.links")
    return pages.where(word_count(F.col("markdown")) >= min_words)
