import random
import re

import numpy as np
import pytest

from loamworks.llm import history, near_duplicates as N, shingles as S

WORD = re.compile(r"[^\W_]+")


def plain(text, k):
    w = [x.lower() for x in WORD.findall(text or "")]
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def similarity(a, b):
    return len(a & b) / len(a | b) if a | b else 0.0


def corpus(n, seed, words=30, vocabulary=400):
    """Texts from a small vocabulary; about half are edited or reordered copies of earlier ones."""
    r = random.Random(seed)
    out = []
    for _ in range(n):
        if out and r.random() < 0.5:
            w = out[r.randrange(len(out))].split()
            for _ in range(r.randint(0, 6)):
                at = r.randrange(len(w))
                w[at : at + r.randint(0, 1)] = [f"w{r.randrange(vocabulary)}"] * r.randint(0, 2)
                if len(w) < 3:
                    w += ["x", "y", "z"]
            if r.random() < 0.2:
                cut = r.randrange(len(w))
                w = w[cut:] + w[:cut]
        else:
            w = [f"w{int(r.random() ** 2 * vocabulary)}" for _ in range(r.randint(2, words))]
        out.append(" ".join(w))
    return out


def test_shingles_are_those_of_plain_python():
    texts = ["", None, "One two", "Straße, élan! one TWO three", "a_b c-d 12 x", "日本 語 の 語", "x " * 50]
    offsets, h = S.shingles(texts, 2)
    assert np.diff(offsets).tolist() == [len(plain(x, 2)) for x in texts]
    same, _ = S.shingles(["a b c"], 2), None
    again = S.shingles(["zz", "A  b, C"], 2)
    assert same[1].tolist() == again[1][again[0][1] :].tolist()


@pytest.mark.parametrize(("threshold", "k"), [(0.6, 3), (0.8, 5), (0.5, 1), (1.0, 2)])
def test_pairs_equal_brute_force(spark, threshold, k):
    texts = corpus(160, seed=int(threshold * 10) + k) + ["", None, "a b", "Same words here now ok yes", "same, words here now: OK yes!"]
    df = spark.createDataFrame([(i, x, "extra") for i, x in enumerate(texts)], "id long, text string, class string")
    got = {(r.id_a, r.id_b) for r in N.similar_pairs(df, threshold, k).collect()}
    sets = [plain(x, k) for x in texts]
    want = {(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets)) if sets[i] and sets[j] and similarity(sets[i], sets[j]) >= threshold - 1e-12}
    assert got == want


def family(n, seed):
    """Texts with one to three of up to 30 words exchanged: they share first shingles, but many are not similar."""
    r, base, out = random.Random(seed), [f"b{i}" for i in range(30)], []
    for _ in range(n):
        w = base[: r.randint(20, 30)]
        for _ in range(r.randint(1, 3)):
            w[r.randrange(len(w))] = f"w{r.randrange(400)}"
        out.append(" ".join(w))
    return out


def test_hot_family_is_salted_and_equals_brute_force(spark):
    texts = family(90, 5) + corpus(60, 6)
    sets = [plain(x, 3) for x in texts]
    side = [N.OLD if i % 3 else N.NEW for i in range(len(texts))]
    df = spark.createDataFrame([(i, x, s) for i, (x, s) in enumerate(zip(texts, side))], "id long, text string, side int")
    found = N.similar_texts(df, 0.6, 3, hot=8)
    first = {r["class"]: r.id for r in found.classes.groupBy("class").agg({"id": "min"}).withColumnRenamed("min(id)", "id").collect()}
    new = {r["class"] for r in found.classes.where(f"side = {N.NEW}").collect()}
    got = {tuple(sorted((first[r.class_a], first[r.class_b]))) for r in found.links.collect()}
    ids = {i: c for c, i in first.items()}
    want = {(i, j) for i in ids for j in ids if i < j and (ids[i] in new or ids[j] in new) and similarity(sets[i], sets[j]) >= 0.6 - 1e-12}
    assert got == want and len(want) > 100


def test_hot_keys_meet_in_bounded_cells(monkeypatch):
    texts = family(400, 7)
    offsets, h = S.shingles(texts, 3)
    counts = np.bincount((h & np.uint64((1 << N.SKETCH_BITS) - 1)).astype(np.int64), minlength=1 << N.SKETCH_BITS)
    blocks_of = N.salts(counts, 32)
    assert N.salts(counts).max() > 1 and N.salts(counts)[8 * 12] == 1
    doc, key, lead, rank, pos = N.join_keys(offsets, h, np.minimum(255, 8 * np.log2(1 + counts)).astype(np.uint8), len(texts), 0.6)
    side = np.where(np.arange(len(texts)) % 4 == 0, N.NEW, N.OLD)
    docs = (S.fingerprints(offsets, h).view(np.int64), np.diff(offsets), side, N.bitmaps(offsets, h))
    whole = list(N.pack(1, docs, doc, key.astype(np.uint32), np.zeros(len(doc), np.int32), pos))
    hot = blocks_of[rank] > 1
    cells = {}
    for at, block in N.pack_salted(docs, doc[hot], key[hot].astype(np.uint32), lead[hot], blocks_of[rank[hot]], pos[hot]):
        cells.setdefault(at, []).append(block)
    cold = list(N.pack(1, docs, doc[~hot], key[~hot].astype(np.uint32), np.zeros((~hot).sum(), np.int32), pos[~hot]))
    assert max(sum(len(N.unpack(x)[0]) for x in c) for c in cells.values()) <= 100
    named = lambda blocks: {tuple(x) for both in N.meeting_pairs(blocks, 0.6) for x in both.tolist()}
    want = named([x for _, x in whole])
    sides = dict(zip(docs[0].tolist(), side.tolist()))
    assert set().union(*map(named, [*cells.values(), [x for _, x in cold]])) == want
    assert want and all(N.NEW in (sides[a], sides[b]) for a, b in want)
    monkeypatch.setattr(N, "PAIRS", 256)
    monkeypatch.setattr(N, "HELD", 512)
    parts = [len(x) for x in N.meeting_pairs([x for _, x in whole], 0.6)]
    assert len(parts) > 2 and named([x for _, x in whole]) == want


def test_long_texts_and_hot_copies(spark):
    long = " ".join(f"t{i}" for i in range(4000))
    texts = [long, long.replace("t17 ", "u "), *["hot copy of one text again"] * 40]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    groups = {r.id: r for r in N.similar_groups(df, 0.8, 3).collect()}
    assert groups[0].links == groups[1].links == 1 and groups[0]["class"] != groups[1]["class"]
    assert len({groups[i]["class"] for i in range(2, 42)}) == 1 and groups[5].links == 0


def test_empty_table_and_bad_threshold(spark):
    empty = spark.createDataFrame([], "id long, text string")
    assert N.similar_pairs(empty).count() == 0
    with pytest.raises(ValueError):
        N.similar_texts(empty, 0)


def arrivals_by_hand(arrivals, ledger, kept, threshold, k):
    import hashlib

    def key(url, text):
        return None if url is None or text is None else hashlib.sha256((url.split("#")[0].rstrip("/") + "\0" + text.strip()).encode()).hexdigest()

    known, sets, cases = set(ledger), [plain(t, k) for _, t, h in kept if h in ledger], set()
    for at, batch, text, url in sorted(arrivals, key=lambda r: (-(2**31) if r[1] is None else r[1], r[0])):
        h, s = key(url, text), plain(text, k)
        if (h and h in known) or any(s and x and similarity(s, x) >= threshold - 1e-12 for x in sets):
            cases.add(at)
        else:
            known |= {h} - {None}
            sets.append(s)
    return cases


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_arrivals_equal_sequential_acceptance(spark, seed):
    import hashlib

    r = random.Random(seed)
    texts = corpus(120, seed)
    url = lambda: r.choice(["https://a.test/x", "https://a.test/x/", "https://a.test/x#f", "https://b.test/y"])
    kept = [(i, t, hashlib.sha256(f"https://b.test/y\0{t.strip()}".encode()).hexdigest()) for i, t in enumerate(texts[:50])]
    ledger = [h for i, _, h in kept if i % 3] + ["0" * 64]
    arrivals = [(i, r.choice([1, 2, 3, None]), r.choice([t, f" {t}\n", t]), url()) for i, t in enumerate(texts[30:])]
    arrivals += [(900, 1, None, "https://a.test/x"), (901, 1, "", "https://a.test/x"), (902, 2, "", "https://a.test/x"), (903, 2, "two words", None), (904, 3, "two words", None)]
    df = spark.createDataFrame(arrivals, "arrival_id long, batch_no int, text string, source_url string")
    got = history.repeated_arrivals(df, spark.createDataFrame([(h,) for h in ledger], "content_hash string"), spark.createDataFrame(kept, "chunk_no long, text string, content_hash string"), 0.6, 3)
    assert sorted(x.arrival_id for x in got.collect()) == sorted(arrivals_by_hand(arrivals, ledger, kept, 0.6, 3))


def test_arrivals_without_history(spark):
    df = spark.createDataFrame([(1, 1, "a b c d", "https://a.test"), (2, 1, "a b c d", "https://b.test")], "arrival_id long, batch_no int, text string, source_url string")
    none = spark.createDataFrame([], "content_hash string")
    kept = spark.createDataFrame([], "chunk_no long, text string, content_hash string")
    assert [x.arrival_id for x in history.repeated_arrivals(df, none, kept, 0.6, 3).collect()] == [2]
    assert history.repeated_arrivals(df.limit(0), none, kept).count() == 0


def test_first_come_settles_chains(spark):
    links = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (1, 5), (5, 6), (7, 8)], "early long, late long")
    assert sorted(x.node for x in history.first_come(links).collect()) == [2, 4, 5, 8]


def rows_of(texts, start=0):
    return [(start + i, i, x, f"h{start + i}") for i, x in enumerate(texts)]


def test_history_takes_batch_after_batch(spark, tmp_path):
    """Batches one by one, each by a history opened anew, give what sequential acceptance gives; a repeated append changes nothing."""
    texts = corpus(150, 11) + ["one paragraph of a few words\n\nand another one here", "New words before it\n\none PARAGRAPH of a few words\n\nand another one here"]
    sets, kept, want = [plain(x, 3) for x in texts], [], {}
    for i, x in enumerate(sets):
        if i < 60 or not any(x and kept_set and similarity(x, kept_set) >= 0.6 - 1e-12 for kept_set in kept):
            kept.append(x)
        else:
            want[i] = True
    schema = "id long, at int, text string, content_hash string"
    made = spark.createDataFrame(rows_of(texts), schema)
    first = made.where("id < 60")
    h = history.History(spark, str(tmp_path / "h"), 0.6, 3, buckets=3)
    for _ in range(2):
        h.append(first.select("id", "text"), first.select("id"), first)
    got = {}
    for lo, hi in ((60, 100), (100, 152)):
        again = history.History(spark, str(tmp_path / "h"), 0.9, 7, buckets=2)
        assert (again.threshold, again.k, again.buckets) == (0.6, 3, 3)
        got |= {r.id: r.evidence for r in again.check(made.where(f"id >= {lo} and id < {hi}"), made.select("id", "text")).collect()}
    assert set(got) == set(want)
    assert {"content", "near", "arrival"} <= set(got.values()) and got[151] in ("paragraphs", "arrival")
    assert h.table("hashes").count() == len(texts) - len(got)
    repeat = again.check(spark.createDataFrame([(900, 1, texts[0], "x"), (901, 2, None, "h3"), (902, 3, "", None), (903, 4, None, None)], schema), made.select("id", "text"))
    assert {r.id: r.evidence for r in repeat.collect()} == {900: "content", 901: "hash"}


def test_history_compares_the_holder_of_most_paragraphs(spark, tmp_path, monkeypatch):
    """Paragraphs that many texts hold point to their first holder; own ones to all."""
    hot, own = "the same legal notice stands below every one of the texts", [f"text {i} says w{i} x{i} y{i} z{i} and a good deal more of it" for i in range(8)]
    monkeypatch.setattr(history, "HOLDERS", 4)
    h = history.History(spark, str(tmp_path / "h"), 0.6, 3, buckets=2)
    old = spark.createDataFrame([(i, f"{x}\n\n{hot}") for i, x in enumerate(own)], "id long, text string")
    h.append(old, old.select("id"), spark.createDataFrame([], "content_hash string"))
    batch = spark.createDataFrame([(50, 1, f"{own[5]}\n\n{hot}\n\nplus", "a"), (51, 2, f"quite another text\n\n{hot}", "b"), (52, 3, f"{hot}\n\n{own[7]}", "c")], "id long, at int, text string, content_hash string")
    read = history.read_texts(batch, 3, str(tmp_path))
    holders = {r.id: (r.holder, r.words) for r in h.holders(read.where("paragraph is not null").select("id", "paragraph", "words")).collect()}
    assert holders == {50: (5, 14), 51: (0, 11), 52: (7, 14)}
    assert {r.id: r.evidence for r in h.check(batch, old).collect()} == {50: "paragraphs", 52: "paragraphs"}


def test_paragraphs_of_texts():
    offsets, h, doc, paragraph, words = S.with_paragraphs(["One two\n \nthree, FOUR", None, "", "three four\n\none two\n\nOne, two!", "..."], 2)
    plain_offsets, plain_h = S.shingles(["One two\n \nthree, FOUR", None, "", "three four\n\none two\n\nOne, two!", "..."], 2)
    assert offsets.tolist() == plain_offsets.tolist() and h.tolist() == plain_h.tolist()
    assert doc.tolist() == [0, 0, 3, 3] and words.tolist() == [2] * 4 and set(paragraph[:2]) == set(paragraph[2:]) and len(set(paragraph)) == 2


def test_sketch_grows_with_the_root_of_the_corpus():
    assert N.sketch_bits(0) == N.sketch_bits(10**6) == N.SKETCH_BITS
    assert N.sketch_bits(10**9) == 23 and N.sketch_bits(10**11) == 26


def test_each_part_has_a_partition(spark):
    labels = N.part_labels(spark, 21)
    at = spark.createDataFrame([(int(x),) for x in labels], "x long").selectExpr("pmod(hash(x), 21) as at").distinct()
    assert len(labels) == at.count() == 21 and N.part_labels(spark, 1).tolist() == [0]


def test_hot_class_is_expanded_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(N, "MEMBERS", 8)
    texts = ["the same words in all of these texts"] * 30 + ["the same words in all of these texts today"] * 25 + ["something else stands here"]
    got = sorted((r.id_a, r.id_b) for r in N.similar_pairs(spark.createDataFrame(list(enumerate(texts)), "id long, text string"), 0.8, 3).collect())
    assert got == [(i, j) for i in range(55) for j in range(i + 1, 55)]
