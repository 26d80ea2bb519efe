import threading
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest

from loamworks.config import Settings
from loamworks.functions.chunking import Budget
from loamworks.plans import rag
from loamworks.plans.ingest import Engine
from loamworks.schemas import PAGE
from loamworks.sources import http
from loamworks.sources.pages import read_html
from loamworks.streaming.incremental import ingest_stream, pages_by_window

SETTINGS = Settings(embedding_dimension=64)


def pages(spark, n=3):
    rows = [(f"https://a.test/{i}", f"Page {i}", f"# Topic {i}\n\nWord{i} explains matter number {i} in some detail.", "text/html", None, None, 0, []) for i in range(n)]
    return spark.createDataFrame(rows, PAGE)


def test_ingest_is_idempotent_and_answers(spark, tmp_path):
    engine = Engine(spark, str(tmp_path), SETTINGS, Budget(200, 300, 40))
    assert engine.health()["status"] == "ok"
    assert rag.ask(engine.collection, "anything", settings=SETTINGS).answer == rag.NOTHING
    first = engine.ingest(pages(spark), "https://a.test", "j1")
    assert (first.status, first.pages_crawled, first.chunks_new, first.chunks_upserted) == ("completed", 3, 3, 3)
    again = engine.ingest(pages(spark, 4), "https://a.test", "j2")
    assert (again.chunks_total, again.chunks_new, again.chunks_skipped) == (4, 1, 3)
    assert engine.ledger().count() == engine.collection.read().count() == 4
    got = rag.ask(engine.collection, "Word2 explains", 2, SETTINGS)
    assert got.sources[0]["text"].startswith("# Topic 2") and got.answer.endswith("[1]") and len(got.sources) == 2
    assert engine.jobs.get("j2").first().status == "completed"
    none = engine.ingest(pages(spark, 0), "x", "j3")
    assert (none.status, none.chunks_total) == ("completed", 0)


def test_failed_ingest_is_written_down(spark, tmp_path):
    engine = Engine(spark, str(tmp_path), SETTINGS)
    result = engine.ingest(pages(spark).drop("markdown"), "x", "j")
    row = engine.jobs.get("j").first()
    assert result.status == row.status == "failed" and row.error.startswith("AnalysisException") and row.pages_crawled == 3


def test_prompt_and_contexts(spark):
    rows = spark.createDataFrame([("q", 2, "u2", None, "t2"), ("q", 1, "u1", "A > B", "t1")], "qid string, rank int, source_url string, section string, text string")
    assert rag.contexts(rows).first().context == "[1] u1 — A > B\nt1\n\n---\n\n[2] u2\nt2"
    seen = {}

    class Model:
        def complete(self, system, user, temperature=0.1):
            seen.update(system=system, user=user)
            return " fine [1] "

    assert "[n]" in rag.SYSTEM_PROMPT and "Question: x" in rag.user_prompt("x", "c")
    assert Model().complete("s", "u") == " fine [1] "


def test_stream(spark, tmp_path):
    pages(spark, 5).write.parquet(str(tmp_path / "in"))
    engine = Engine(spark, str(tmp_path / "out"), SETTINGS, Budget(200, 300, 40))
    for _ in range(2):
        stream = spark.readStream.schema(PAGE).parquet(str(tmp_path / "in"))
        ingest_stream(engine, stream, str(tmp_path / "state")).awaitTermination(120)
    assert engine.ledger().count() == 5
    pages(spark, 6).write.mode("append").parquet(str(tmp_path / "in"))
    ingest_stream(engine, spark.readStream.schema(PAGE).parquet(str(tmp_path / "in")), str(tmp_path / "state")).awaitTermination(120)
    assert engine.ledger().count() == 6
    assert pages_by_window(pages(spark, 2)).count() == 0


class _Site(BaseHTTPRequestHandler):
    def do_GET(self):
        self.send_response(404 if self.path == "/gone" else 200)
        self.send_header("content-type", "text/html; charset=utf-8")
        self.end_headers()
        self.wfile.write(f"<title>T</title><main><p>{'wörd ' * 25}</p><a href='/next/'>n</a></main>".encode())

    def log_message(self, *args):
        pass


@pytest.fixture
def site():
    server = HTTPServer(("127.0.0.1", 0), _Site)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}"
    server.shutdown()


def test_http_source(spark, site):
    assert http.fetch("not a url")[3].startswith("ValueError")
    assert http.fetch(f"{site}/gone", attempts=2, wait=lambda s: None)[3].startswith("HTTPError")
    http.register(spark)
    raw = spark.read.format("http_pages").option("urls", f"{site}/a#x\n{site}/b").option("batch", 1).load()
    got = sorted(read_html(raw).collect())
    assert [r.url for r in got] == [f"{site}/a", f"{site}/b"] and got[0].links == [f"{site}/next"] and got[0].page_title == "T"
    assert read_html(raw, 26).count() == 0


def test_ingest_from_a_url(spark, site, tmp_path):
    engine = Engine(spark, str(tmp_path), SETTINGS, Budget(200, 300, 40))
    bad = engine.ingest_url("ftp://a.test", pages(spark), job_id="bad")
    assert bad.status == "failed" and bad.error.startswith("ValueError")
    live = engine.ingest_url(f"{site}/a", max_depth=1)
    assert (live.status, live.pages_crawled) == ("completed", 2) and engine.ingest_url(f"{site}/a", max_depth=0).pages_crawled == 1
    text = "some words of the page " * 6
    web = spark.createDataFrame([("https://w.test", "W", text + "w", "text/html", ["/x", "https://w.test/a/", "https://w.test/b"]), ("https://w.test/a", "A", text + "a", "text/html", []), ("https://w.test/b", "B", text + "b", None, [])], "url string, page_title string, markdown string, content_type string, links array<string>")
    assert engine.ingest_url("https://w.test/", web, max_depth=1, max_pages=2).pages_crawled == 2
    files = spark.createDataFrame([("https://w.test/sitemap.xml", "<urlset><url><loc>https://w.test/b</loc></url><url><loc>https://w.test/a</loc></url></urlset>")], "url string, xml string")
    took = [engine.ingest_url("https://w.test", web, from_sitemap=True, sitemaps=files, max_pages=n) for n in (1, None)]
    assert [(x.pages_crawled, x.chunks_new) for x in took] == [(1, 1), (2, 0)]
    assert engine.ask("page").sources and {r.source_url for r in engine.ledger().collect()} >= {"https://w.test", "https://w.test/a", "https://w.test/b"}
