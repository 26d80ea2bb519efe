import random
from collections import Counter

import pytest

from loamworks.llm import encoding as E
from loamworks.llm import packing as P
from loamworks.llm import repeated_lines as R

RANKS = f"{E.FOLDER}/byte_bpe_50k.tiktoken"


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, source_url string, markdown string, site string")


def test_repeated_lines_by_hand(spark):
    rows = [(i, f"https://A.test/{i}{'/' * (i % 2)}#f", f"Own {i}\nShare this!\r\n\n12\n* SHARE  this {i}", "clash") for i in range(8)]
    rows += [(100, "https://a.test/0", "share this", "x"), (101, "ftp://a.test/9", "share this", "x"), (102, None, "share this", "x"), (103, "https://b.test/1", "Share this", "x"), (104, "https://a.test/50", None, "x"), (105, "https://a.test/51", " ", "x")]
    got = {(r.page_id, r.line_no) for r in R.repeated_lines(pages(spark, rows), 8).collect()}
    share = {(i, n) for i in range(8) for n in (2, 5)} | {(100, 1)}
    own = {(i, 1) for i in range(8)}
    assert got == share | own  # "Own 1" and "Own 2" have the same letters
    assert {(r.page_id, r.line_no) for r in R.repeated_lines(pages(spark, rows[1:]), 9).collect()} == set()
    left = {r.page_id: r.markdown for r in R.without_repeated_lines(pages(spark, rows), 8).collect()}
    assert left[0] == "\n12" and left[103] == "Share this" and left[104] is None


def test_recrawled_page_is_one_document(spark):
    rows = [(i, "https://a.test/same", "Share", "x") for i in range(20)] + [(50 + i, f"https://a.test/{i}", "Share", "x") for i in range(6)]
    assert R.repeated_lines(pages(spark, rows), 8).count() == 0
    assert R.repeated_lines(pages(spark, rows), 7).count() == 26
    assert R.repeated_lines(pages(spark, []), 8).count() == 0


def test_line_hashes_are_those_of_letters_and_of_lines(monkeypatch):
    monkeypatch.setattr(R, "_CHARS", 40)
    r = random.Random(3)
    texts = [None, "", "a", "\n", *["".join(r.choice("aAbBéÉ1 .-\n") for _ in range(r.randint(0, 30))) for _ in range(200)], "𠀀x\nİi"]
    counts, raw, key = R.line_hashes(texts)
    lines = [y for x in texts if x is not None for y in x.split("\n")]
    assert counts.tolist() == [0 if x is None else x.count("\n") + 1 for x in texts] and len(raw) == len(key) == len(lines)
    letters = ["".join(c for c in x if c.isalpha()).replace("İ", "i").lower() for x in lines]
    for values, hashes in ((lines, raw), (letters, key)):
        assert len(set(zip(values, hashes.tolist()))) == len(set(values)) == len(set(hashes.tolist()))
        assert all((x == "") == (h == 0) for x, h in zip(values, hashes.tolist()))


def test_documents_are_numbered_without_gaps(spark):
    df = spark.createDataFrame([(s, u) for s in (1, 2) for u in range(50 * s)] * 2, "site long, url long")
    got = [(r.site, r.doc) for r in R.numbered(df).collect()]
    assert sorted(got) == [(1, i) for i in range(50)] + [(2, i) for i in range(100)]


def test_large_tables_are_shuffled(spark, monkeypatch):
    monkeypatch.setattr(R, "FEW_ROWS", 0)
    rows = [(i, f"https://a.test/{i}", "Share\nown words", "x") for i in range(70)]
    assert R.repeated_lines(pages(spark, rows), 70).count() == 140


@pytest.mark.parametrize("leaf", [3, 40, 1 << 13])
def test_tree_encoding_is_that_of_the_whole(monkeypatch, leaf):
    monkeypatch.setattr(E, "LEAF", leaf)
    enc, r = E.encoder(RANKS), random.Random(leaf)
    for _ in range(300):
        text = "".join(r.choice("  \n\t'sdtreXé1中!?\x1c\xa0🙂") for _ in range(r.randint(0, 200)))
        ids = enc.encode(text)
        assert ids == enc.plain.encode_ordinary(text)
        assert enc.plain.decode(ids) == text
    assert enc.encode("x" * 5000 + " " + "y" * 5000) == enc.plain.encode_ordinary("x" * 5000 + " " + "y" * 5000)


def test_encode_and_decode_tables(spark):
    rows = [(1, "Hello <|endoftext|>"), (2, ""), (3, None), (4, "é" * 9000), (1, "Hello <|endoftext|>")]
    df = spark.createDataFrame([(*x, "e") for x in rows], "doc_id long, text string, ids string")
    out = E.encode(df)
    got = [(r.doc_id, r.ids) for r in out.collect()]
    assert [x for x in got if x[0] in (2, 3)] == [(2, []), (3, [])]
    assert sorted(r.text for r in E.decode(out).collect()) == sorted(x or "" for _, x in rows)
    assert {r.doc_id: r.tokens for r in E.token_counts(df).collect()}[3] == 0
    assert E.encode(df.limit(0)).count() == 0


def test_fill_is_the_best_subset():
    r = random.Random(4)
    for _ in range(60):
        counts = Counter(r.randint(1, 30) for _ in range(r.randint(0, 8)))
        room = r.randint(0, 60)
        got = P.fill(counts, room)
        sums = {0}
        for w, n in counts.items():
            sums |= {s + w * k for s in sums for k in range(n + 1)}
        assert sum(got) == max(s for s in sums if s <= room)
        assert all(Counter(got)[w] <= counts[w] for w in got)


def test_packing_places_every_piece_once(spark):
    r = random.Random(9)
    sizes = [r.choice([1, 5, 7, 50, 50, 50, 99, 100, 101, 250, 333]) for _ in range(400)]
    rows = [(i, n, 0) for i, n in enumerate(sizes)] + [(900, 0, 1), (901, None, 1)]
    df = spark.createDataFrame(rows, "doc_id long, tokens long, container int")
    got = P.pack(df, 100).collect()
    want = Counter((i, p) for i, n in enumerate(sizes) for p in range(1, -(-n // 100) + 1))
    assert Counter((x.doc_id, x.piece) for x in got) == want
    full, places = Counter(), Counter()
    for x in got:
        full[x.container] += x.tokens
        places[x.container, x.position] += 1
    assert max(full.values()) <= 100 and max(places.values()) == 1
    assert set(full) == set(range(1, len(full) + 1))
    assert all(sorted(p for c, p in places if c == k) == list(range(1, 1 + sum(c == k for c, _ in places))) for k in list(full)[:20])
    assert len(full) <= -(-sum(sizes) // 100) + 3
    assert sorted(got) == sorted(P.pack(df.repartition(3), 100).collect())
    assert P.pack(df.limit(0), 100).count() == 0
    with pytest.raises(ValueError):
        P.pack(df, 0)
