import hashlib
import uuid
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from loamworks.config import Settings
from loamworks.functions import chunking as C
from loamworks.functions import embedding as E
from loamworks.functions import html as H
from loamworks.functions import text as X
from loamworks.functions import tokens as T
from loamworks.functions import urls as U

RANKS = Settings().tokenizer


def values(spark, rows, *columns):
    df = spark.createDataFrame([(x,) for x in rows], "v string")
    return [tuple(r) for r in df.select(*columns).collect()]


def test_urls(spark):
    v = F.col("v")
    got = values(spark, ["https://a.test/x/#top", "https://a.test//", "HTTP://A.test:8/q?x=1/", "ftp://a.test", "nothing", "", None], U.normalize_url(v), U.is_valid_url(v), U.netloc(v))
    assert got == [("https://a.test/x", True, "a.test"), ("https://a.test", True, "a.test"), ("HTTP://A.test:8/q?x=1", True, "A.test:8"), ("ftp://a.test", False, "a.test"), ("nothing", False, ""), ("", False, ""), (None, None, None)]
    links = spark.createDataFrame([("https://a.test/docs", "intro"), ("https://a.test/docs/", "intro"), ("https://a.test/x", "//b.test/y"), (None, "x"), ("https://a.test", "http://[bad")], "b string, h string")
    assert [r[0] for r in links.select(U.join_url("b", "h")).collect()] == ["https://a.test/intro", "https://a.test/docs/intro", "https://b.test/y", None, None]
    assert values(spark, ["text/html; charset=x", None], U.content_type_base(v)) == [("text/html",), (None,)]
    assert values(spark, ["https://a.test/x"], U.sitemap_root(v)) == [("https://a.test/sitemap.xml",)]


def test_identity(spark):
    text = "  hello \n\x1f"
    df = spark.createDataFrame([("https://a.test", text)], "u string, t string")
    row = df.select(X.content_hash(F.col("u"), F.col("t")).alias("h"), X.uuid5(F.col("u")).alias("i"), X.stripped(F.col("t")).alias("s")).first()
    assert row.h == hashlib.sha256(b"https://a.test\0hello").hexdigest() and row.s == text.strip()
    assert row.i == str(uuid.uuid5(uuid.NAMESPACE_URL, "https://a.test"))
    assert df.select(X.chunk_id(F.lit("0123456789abcdefXX"), F.lit(3))).first()[0] == "0123456789abcdef-3"
    assert values(spark, [" a  b c\n", "", None], X.word_count(F.col("v"))) == [(3,), (0,), (0,)]
    assert X.class_name("myDocs") == "Mydocs"


def test_payload_keeps_nulls_and_iso_times(spark):
    df = spark.createDataFrame([(("a", None, datetime(2025, 1, 2, 3, 4, 5)),), (("a", "b", datetime(2025, 1, 2, 3, 4, 5, 179575)),)], "m struct<id string, parent_url string, crawl_timestamp timestamp>")
    got = [r[0].replace("Z", "+00:00") for r in df.select(X.payload(F.col("m"), ["id", "parent_url", "crawl_timestamp"])).collect()]
    assert got == ['{"id":"a","parent_url":null,"crawl_timestamp":"2025-01-02T03:04:05+00:00"}', '{"id":"a","parent_url":"b","crawl_timestamp":"2025-01-02T03:04:05.179575+00:00"}']


@pytest.mark.parametrize(
    ("html", "markdown"),
    [
        ("<h1>A <b>b</b></h1><p>x &amp; y</p>", "# A b\n\nx & y"),
        ("<p>one<p>two", "one two"),
        ("text in <div>a div</div> is dropped<p>kept</p>", "kept"),
        ("<ol><li>a</li><li>b<ul><li>c</li></ul></li></ol>", "1. a\n2. b c"),
        ("<pre>a\n\n\n\nb</pre>", "```\na\n\nb\n```"),
        ("<table><tr><td>a</td></tr><tr><th>b</th><td>c</td></tr></table>", "| a |  |\n| --- | --- |\n| b | c |"),
        ("<table></table><p>x</p>", "x"),
        ("<body class='has-sidebar'><p>gone</p></body>", ""),
        ("<div class='ad'><p>stays</p></div><div id='Downloads'><p>gone</p></div>", "stays"),
        ("<p>out</p><article><p>art</p></article><main><p>in</p></main>", "in"),
        ("<p role='Banner'>x</p><!-- c --><p>a<br>b</p></div>", "a b"),
        ("", ""),
        (None, ""),
    ],
)
def test_html(html, markdown):
    assert H.convert(html, "https://a.test/x")[1] == markdown


def test_html_title_and_links():
    title, _, links = H.convert("<title> T </title><nav><a href='/n/#x'>n</a></nav><a href='mailto:x'>m</a><a href='y'>y</a><a href='y'>y</a><a>z</a>", "https://a.test/d/e")
    assert title == "T" and links == ["https://a.test/n", "https://a.test/d/y", "https://a.test/d/y"]
    assert H.convert("<title>a<b>c</b></title>", "")[0] == ""
    deep = "<div>" * 5000 + "<p>x</p>"
    assert H.convert(deep, "")[1] == "x"


def budget(target=200, most=300, overlap=40):
    return C.Budget(target, most, overlap, RANKS)


def test_chunks_keep_code_and_tables_whole():
    code = "```\n" + "\n".join(f"line {i} = {i}" for i in range(400)) + "\n```"
    rows = "| a | b |\n| --- | --- |\n" + "\n".join(f"| r{i} | {i} |" for i in range(100))
    out = C.chunks_of(f"# Code\n\n{code}\n\n## T\n\n{rows}", budget())
    assert sum(code in t for t, _, _ in out) == 1 and sum(rows in t for t, _, _ in out) == 1
    assert all(n == T.count(t, RANKS) for t, _, n in out)


def test_chunks_of_prose_keep_to_the_budget_and_lose_nothing():
    text = " ".join(f"Sentence number {i} says something." for i in range(400))
    parts = C.chunks_of(f"# H\n\n{text}", budget(overlap=0))
    assert len(parts) > 5 and all(n <= 300 for _, _, n in parts)
    assert "".join("".join(t.split()) for t, _, _ in parts) == "".join(f"# H {text}".split())
    overlapped = C.chunks_of(f"# H\n\n{text}", budget())
    assert overlapped[1][0].startswith(T.tail(parts[0][0], 40, RANKS))
    assert C.split_prose("x" * 5000, 10, lambda x: len(x)) == ["x" * 10] * 500


def test_chunk_sections_and_blocks():
    out = C.chunks_of("# A\n\n## B\n\ntext\n\n## C\n\n```py\nx\n```py\nafter", budget())
    assert [x for _, x, _ in out] == ["A > C"]
    kinds = [(b.kind, b.path) for b in C.blocks("# A\ntext\n| x |\n```\n# no\n```\n  # indented\n##nohash\n#### D\n## E")]
    assert kinds == [("heading", ("A",)), ("text", ("A",)), ("table", ("A",)), ("code", ("A",)), ("text", ("A",)), ("heading", ("A", "D")), ("heading", ("A", "E"))]
    assert C.chunks_of(None, budget()) == C.chunks_of(" \n", budget()) == []
    assert [b.text for b in C.blocks("```\nnever closed\n")] == ["```\nnever closed"]
    assert C.Budget().filled(Settings()).target == 1000


def test_chunk_table(spark):
    pages = spark.createDataFrame([("https://a.test/x", "T", "# H\n\nwords here", None, "text/html", None, 1), ("https://a.test/y", None, None, None, None, None, 2)], "source_url string, page_title string, markdown string, parent_url string, content_type string, crawl_timestamp timestamp, text int")
    rows = C.chunk_pages(pages, budget()).collect()
    assert len(rows) == 1 and rows[0].chunk_id == rows[0].content_hash[:16] + "-0" and rows[0].section == "H" and rows[0].title == "T"


def test_tokens(spark):
    v = F.col("v")
    got = values(spark, ["one two three <|endoftext|>", "", None], T.token_count(v, RANKS), T.first_tokens(v, 2, RANKS), T.last_tokens(v, 1, RANKS))
    assert got[0][0] > 4 and got[0][1] == "one two" and got[1] == (0, "", "") and got[2] == (0, None, None)


def test_embedders(spark):
    with pytest.raises(ValueError, match="no embeddings"):
        E.get_embedder("anthropic")
    with pytest.raises(ValueError, match="unknown"):
        E.get_embedder("other")
    v = E.HashingEmbedder(8).embed(["a b a", ""])
    assert round(sum(x * x for x in v[0]), 5) == 1 and v[1] == [0.0] * 8

    class Flaky:
        dimension, calls = 1, 0

        def embed(self, texts, purpose):
            self.calls += 1
            if self.calls < 3:
                raise OSError("busy")
            return [[1.0]] * (len(texts) - (purpose == "short"))

    assert E.embed_with_retry(Flaky(), ["x"], "document", 3, lambda s: None) == [[1.0]]
    with pytest.raises(OSError):
        E.embed_with_retry(Flaky(), ["x"], "document", 2, lambda s: None)
    with pytest.raises(ValueError, match="0 vectors"):
        E.embed_with_retry(Flaky(), ["x"], "short", 3, lambda s: None)
    got = values(spark, ["a b", None], E.embedding(F.col("v"), Settings(embedding_dimension=4)))
    assert len(got[0][0]) == 4 and got[1] == (None,)


def test_settings():
    s = Settings.from_env({"LOAMWORKS_TOP_K": "9", "LOAMWORKS_CRAWL_SAME_DOMAIN": "false"})
    assert s.top_k == 9 and s.crawl_same_domain is False
    for bad in ({"vector_backend": "x"}, {"crawl_max_depth": -1}, {"crawl_max_pages": 0}):
        with pytest.raises(ValueError):
            Settings(**bad)
