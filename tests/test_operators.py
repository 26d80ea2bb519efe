import random
from collections import deque

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loamworks.operators import collection as K
from loamworks.operators import crawl as C
from loamworks.operators import dedup as D
from loamworks.operators import jobs as J
from loamworks.operators import search as V

HOST = "https://a.test"


def crawled(graph, bad, seed, depth, budget):
    """The same crawl with a queue."""
    seen, queue, out = {seed}, deque([(seed, 0, None)]), []
    while queue and len(out) < budget:
        url, d, parent = queue.popleft()
        if url not in graph or url in bad:
            continue
        out.append((url, d, parent))
        if d < depth:
            for x in graph[url]:
                if x not in seen and x.startswith(HOST):
                    seen.add(x)
                    queue.append((x, d + 1, url))
    return out


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.integers(0, 10**6))
def test_crawl_equals_a_queue(spark, seed):
    r = random.Random(seed)
    names = [f"{HOST}/{i}" for i in range(9)] + ["https://b.test/x", f"{HOST}/missing"]
    graph = {u: [r.choice(names) for _ in range(r.randint(0, 5))] for u in names[:9]}
    bad = {u for u in names if r.random() < 0.2}
    rows = [(u, "word " * (3 if u in bad else 20), "text/html", [x + r.choice(["", "/", "#f"]) for x in links]) for u, links in graph.items()]
    pages = spark.createDataFrame(rows, "url string, markdown string, content_type string, links array<string>")
    seeds = spark.createDataFrame([(names[0] + "/",), (names[1],), ("no url",), (None,)], "seed string")
    depth, budget = r.randint(0, 3), r.randint(1, 6)
    got = C.crawl(pages, seeds, depth, budget).collect()
    for s in names[:2]:
        mine = [(x.url, x.depth, x.parent_url) for x in sorted(got, key=lambda x: x.rank) if x.seed == s]
        assert mine == crawled(graph, bad, s, depth, budget)
    assert {x.seed for x in got} <= set(names[:2])


def test_usable_and_list(spark):
    rows = [(f"{HOST}/1", "w " * 20, "text/html"), (f"{HOST}/2", "w " * 19, "text/html"), (f"{HOST}/3", "w " * 20, "application/pdf"), (f"{HOST}/4", None, None), (f"{HOST}/5", "w " * 20, None)]
    pages = spark.createDataFrame(rows, "url string, markdown string, content_type string")
    urls = spark.createDataFrame([(3, f"{HOST}/5/"), (1, f"{HOST}/1#x"), (2, f"{HOST}/2"), (4, None)], "pos int, url string")
    assert sorted((r.pos, r.url) for r in C.fetch_list(pages, urls).collect()) == [(1, f"{HOST}/1"), (3, f"{HOST}/5")]


def test_sitemaps(spark):
    loc = lambda *u: "".join(f"<url><loc> {x} </loc></url>" for x in u)
    files = [
        (f"{HOST}/sitemap.xml", f"<sitemapindex xmlns='http://s'><sitemap><loc>{HOST}/a.xml</loc></sitemap><sitemap><loc>{HOST}/b.xml</loc></sitemap><sitemap><loc>{HOST}/sitemap.xml</loc></sitemap></sitemapindex>"),
        (f"{HOST}/a.xml", f"<urlset xmlns='http://s' xmlns:i='http://i'>{loc(f'{HOST}/1', f'{HOST}/2/')}<i:image><i:loc>{HOST}/pic</i:loc></i:image></urlset>"),
        (f"{HOST}/b.xml", f"<urlset>{loc(f'{HOST}/2', 'https://b.test/z', f'{HOST}/3#x')}</urlset>"),
        ("https://c.test/sitemap.xml", "<html><p>404"),
    ]
    sites = spark.createDataFrame([(HOST,), ("https://c.test",), ("https://d.test",)], "site string")
    df = spark.createDataFrame(files, "url string, xml string")
    assert [(r["rank"], r.url) for r in sorted(C.sitemap_urls(df, sites).collect())] == [(1, f"{HOST}/1"), (2, f"{HOST}/2"), (3, f"{HOST}/pic"), (4, f"{HOST}/3")]
    assert [r.url for r in sorted(C.sitemap_urls(df, sites, max_sitemaps=2).collect())] == [f"{HOST}/1", f"{HOST}/2", f"{HOST}/pic"]


def test_sitemap_query_reads_every_file_of_a_large_host(spark, tmp_path):
    from loamworks import queries as Q

    rows = spark.range(50_500).select(F.col("id").alias("page_id"), F.concat(F.lit(f"{HOST}/"), F.col("id")).alias("source_url"), F.expr("cast(null as string) as page_title"), F.lit("w").alias("markdown"), F.lit("text/html").alias("content_type"), F.expr("cast(array() as array<string>) as links"))
    rows.write.parquet(str(tmp_path / "crawled_pages.parquet"))
    assert Q.queries()["s05_sitemap"](spark, str(tmp_path)).distinct().count() == 50_500
    assert Q.queries()["s05_sitemap_budget"](spark, str(tmp_path)).distinct().count() < 50_500


def test_dedup(spark):
    rows = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 3, None), (None, 4, "n")], "content_hash string, pos int, text string")
    ledger = spark.createDataFrame([("b",)], "content_hash string")
    assert sorted(tuple(r) for r in D.new_chunks(rows, ledger, ["pos"]).collect() if r[0]) == [("a", 1, "y")]
    assert tuple(D.dedup_counts(rows, ledger).first()) == (4, 2, 2)
    assert tuple(D.dedup_counts(rows.limit(0), ledger).first()) == (0, 0, 0)
    both = D.ledger_insert(ledger, rows.where("content_hash is not null").select("content_hash", "pos"), ["pos"])
    assert sorted(r[0] for r in both.collect()) == ["a", "b"]


def test_collection(spark, tmp_path):
    c = K.Collection(spark, str(tmp_path / "c"))
    assert c.version() == 0 and c.read().count() == 0
    c.ensure()
    c.ensure()
    rows = spark.createDataFrame([("1", [1.0, 0.0], "old", "{}", "n1", 0), ("1", [1.0, 1.0], "new", "{}", "n2", 1), ("2", None, None, None, "n2", 0)], "id string, embedding array<float>, text string, metadata string, namespace string, seq int")
    c.upsert(rows)
    c.upsert(rows)
    got = {r.id: (r.text, r.namespace) for r in c.read().collect()}
    assert got == {"1": ("new", "n1"), "2": (None, "n2")} and c.version() == 3
    assert [r.id for r in c.read("n2").collect()] == ["2"]
    c.delete(spark.createDataFrame([], "id string"))
    c.delete(spark.createDataFrame([("1",), ("9",)], "id string"))
    assert [r.id for r in c.read().collect()] == ["2"] and c.version() == 4


def test_jobs(spark, tmp_path):
    log = J.JobLog(spark, str(tmp_path / "jobs"))
    assert log.get("j").count() == 0
    log.create("j", HOST)
    log.append("j", 1, status="crawling", pages_crawled=3)
    log.finish("j", 2, "failed", error="E: x")
    row = log.get("j").first()
    assert (row.status, row.pages_crawled, row.url, row.error, row.chunks_new) == ("failed", 3, HOST, "E: x", 0)
    assert log.events().count() == 3
    with pytest.raises(ValueError):
        log.append("j", 3, status="lost")
    with pytest.raises(ValueError):
        log.append("j", 3, colour="red")


def exact(q, v, k):
    def unit(m):
        with np.errstate(invalid="ignore"):
            return m / np.linalg.norm(m, axis=1, keepdims=True)

    score = np.round(unit(q) @ unit(v).T, 12)
    return {(i, int(j)) for i, row in enumerate(score) for j in sorted((j for j in range(len(v)) if not np.isnan(row[j])), key=lambda j: (-row[j], j))[:k]}


def vectors(spark, m, name):
    return spark.createDataFrame([(i, [float(x) for x in row], 7) for i, row in enumerate(m)], f"{name} long, vector array<float>, score int")


def test_top_k_by_blocks(spark, monkeypatch):
    rng = np.random.default_rng(1)
    v, q = rng.integers(-3, 4, (60, 4)).astype(float), rng.integers(-3, 4, (9, 4)).astype(float)
    v[5] = 0
    q[:, 0] += 0.5
    monkeypatch.setattr(V, "QUESTIONS", 4)
    monkeypatch.setattr(V, "VECTORS", 16)
    asked, held = vectors(spark, q, "qid"), vectors(spark, v, "id")
    got = V.top_k(asked, held, 5).collect()
    assert {(r.qid, r.id) for r in got} == exact(q, v, 5) and {r["rank"] for r in got} == {1, 2, 3, 4, 5}
    assert V.top_k(asked, held.limit(0), 5).count() == 0 and V.top_k(asked, held, 0).count() == 0
    assert V.top_k(asked, held, 100).count() == 9 * 59
    assert V.top_k(asked, held, 3, half=True).count() == 27


def test_filtered_top_k_serves_every_label(spark, tmp_path, monkeypatch):
    from loamworks import queries as Q

    v = np.random.default_rng(2).normal(size=(200, 4))
    labels = [None if i == 40 else (-3, 5, 10, 1000)[i // 20 % 4] for i in range(200)]
    spark.createDataFrame([(i, [float(x) for x in row], g) for i, (row, g) in enumerate(zip(v, labels))], "vec_id long, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    monkeypatch.setattr(V, "QUESTIONS", 2)
    monkeypatch.setattr(V, "VECTORS", 16)
    got = {(r.qid, r.id) for r in Q.queries()["v02_filtered_topk"](spark, str(tmp_path)).collect()}
    mine = {g: [i for i in range(200) if labels[i] == g] for g in labels}
    want = {(i, mine[g][j]) for i, g in enumerate(labels) if i % 20 == 0 and g is not None for _, j in exact(v[i : i + 1].astype(np.float32).astype(float), v[mine[g]].astype(np.float32).astype(float), 5)}
    assert got == want and len(want) == 45


def test_index_recall(spark):
    rng = np.random.default_rng(3)
    centre = rng.normal(size=(12, 16))
    v = centre[rng.integers(0, 12, 1500)] + 0.4 * rng.normal(size=(1500, 16))
    asked, held = vectors(spark, v[::20], "qid"), vectors(spark, v, "id")
    got = {(r.qid, r.id) for r in V.Index.fit(held, 32).top_k(asked, held, 5, probes=8).collect()}
    want = exact(v[::20], v, 5)
    assert len(got & want) / len(want) >= 0.9


def test_search_profiles(spark):
    rows = spark.createDataFrame([("a", [1.0, 0.0], "ta", '{"source_url":"u","section":"s","x":1}', "n"), ("b", [1.0, 0.0], "tb", '{"x":2}', "n"), ("c", [1.0, 0.1], "tc", "{}", "m"), ("z", [0.0, 0.0], "tz", "{}", "n"), ("y", None, "ty", "{}", "n")], "id string, embedding array<float>, text string, metadata string, namespace string")
    ids = lambda **x: [r.id for r in V.search(rows, [1.0, 0.0], **x).collect()]
    assert ids(namespace="n") == ["a", "b"] and ids(namespace="n", backend="qdrant") == ["a", "b", "c"]
    assert ids(namespace="n", backend="pinecone", where={"x": 2}) == ["b"] and ids(namespace="n", where={"x": 2}) == ["a", "b"]
    assert V.search(rows, [1.0, 0.0], 1, "milvus").first().metadata == '{"source_url":"u","section":"s"}'
    assert ids(namespace="none") == [] and ids(namespace="n", k=0) == []
    with pytest.raises(ValueError):
        V.profile("other")
    assert F is not None


def test_collection_writes_what_changed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(K, "SEGMENTS", 3)
    made = lambda rows: spark.createDataFrame([(i, [1.0], t, "{}", n, 0) for i, t, n in rows], "id string, embedding array<float>, text string, metadata string, namespace string, seq long")
    c = K.Collection(spark, str(tmp_path / "c"))
    c.upsert(made([("a", "1", "x"), ("b", "1", "x")]))
    before, rows = c.version(), c.read()
    c.upsert(made([("b", "2", "y"), ("c", "2", "y")]))
    c.delete(spark.createDataFrame([("a",)], "id string"))
    assert len(rows.collect()) == 2 and c.read(version=before).count() == 2  # a reader in between keeps its version
    seen = lambda: sorted((r.id, r.text, r.namespace) for r in c.read().collect())
    assert seen() == [("b", "2", "x"), ("c", "2", "y")] and c._manifest(c.version())["base"] == 0
    assert len(list((tmp_path / "c").glob("segment-*2/*.parquet"))) and c.read("y").count() == 1
    c.upsert(made([("a", "3", "z")]))
    assert seen() == [("a", "3", "z"), ("b", "2", "x"), ("c", "2", "y")] and c._manifest(c.version())["segments"] == []
    with pytest.raises(Exception, match="exist"):
        c._commit({"base": 0, "segments": []}, c.version())


def test_metadata_filter_compares_as_json(spark):
    rows = spark.createDataFrame([("a", '{"b":true,"n":1,"s":"1"}'), ("c", '{"b":false,"s":null}')], "id string, metadata string")
    ids = lambda where: [r.id for r in V.narrowed(rows, V.profile("pinecone").__class__(by_metadata=True), "", where).collect()]
    assert ids({"b": True}) == ids({"n": 1}) == ids({"s": "1"}) == ["a"] and ids({"b": False}) == ids({"s": None}) == ["c"] and ids({"b": "True"}) == []
