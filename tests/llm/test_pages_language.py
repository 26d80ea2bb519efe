import random

import pytest

from loamworks.llm import boilerplate as B
from loamworks.llm import language as L
from loamworks.llm import residue as R

PAGE = """Skip to main content

- Home
- Quorvex
- Contact

Home > Guide > A title

# A title

*By Ann Other*
5 min read

Prose about the session cookie and how it works in practice.
- A point about the first thing
- Some thing

```
- Home
```

| a | b |
| --- | --- |

Related articles
- Another title without an end
Yet another title of the kind

Bob42 says:
I liked this text very much, thank you for it.
Reply

© 2024 Someone. All rights reserved."""


def test_furniture_of_a_page():
    lines = PAGE.split("\n")
    gone = {lines[i - 1] for i in B.furniture(PAGE)}
    assert gone == {"Skip to main content", "- Home", "- Quorvex", "- Contact", "Home > Guide > A title", "Related articles", "- Another title without an end", "Yet another title of the kind", "Bob42 says:", "I liked this text very much, thank you for it.", "Reply", "© 2024 Someone. All rights reserved."}
    assert "```\n- Home\n```" in PAGE and lines.index("```") + 2 not in B.furniture(PAGE)


def test_lookalikes_stay():
    text = "# T\n\n© signs in the text are removed before the first run.\n\nHome > Tools > Log is the path to the list.\n\n[your name] / {{ user.city }}\n\nNaN NaN"
    assert B.furniture(text) == []
    for x in (None, "", " \n ", "Just one plain sentence of prose."):
        assert B.furniture(x) == []


def test_cut_is_minimal():
    r = random.Random(2)
    for _ in range(200):
        n = r.randint(1, 7)
        supply = [r.randint(-9, 9) for _ in range(n)]
        links = [(a, b, r.randint(0, 6)) for a in range(n) for b in range(a + 1, n) if r.random() < 0.5]

        def cost(side):
            return sum(s for s, k in zip(supply, side) if s > 0 and not k) - sum(s for s, k in zip(supply, side) if s < 0 and k) + sum(c for a, b, c in links if side[a] != side[b])

        best = min(cost([bool(x >> i & 1) for i in range(n)]) for x in range(1 << n))
        assert cost(B.source_side(n, supply, links)) == best


def test_furniture_tables(spark):
    df = spark.createDataFrame([(1, PAGE, 5), (2, None, 5), (3, "", 5), (1, PAGE, 5)], "page_id long, markdown string, line_no int")
    got = [(r.page_id, r.line_no) for r in B.furniture_lines(df).collect()]
    assert len(got) == 2 * len(B.furniture(PAGE)) and {x for x, _ in got} == {1}
    body = {r.page_id: r.markdown for r in B.main_body(df).collect()}
    assert body[2] is None and body[3] == "" and body[1].startswith("# A title") and "Reply" not in body[1]
    assert B.furniture_lines(df.limit(0)).count() == 0


def foreign_page(i):
    """A page of a site in a language that no list of labels knows."""
    head = f"Siirry sisältöön\n\nEtusivu\n\nAsetukset\n\n# Otsikko numero {'abcdefgh'[i]}"
    body = f"Tämä teksti kertoo asiasta {'abcdefgh'[i]} ja sen hoidosta.\n\n## Johdanto\n\nJohdannossa sanotaan {'abcdefgh'[i]} toisella tavalla."
    return f"{head}\n\n{body}\n\n## Lue seuraavaksi\n- Vanha {'abcdefgh'[i]} talo meren rannalla\n- Uusi {'abcdefgh'[i]} tie metsän läpi\n\nKaikki oikeudet pidätetään"


def test_furniture_of_an_unknown_language(spark):
    df = spark.createDataFrame([(i, f"https://sivu.test/{i}", foreign_page(i)) for i in range(8)], "page_id long, source_url string, markdown string")
    body = {r.page_id: r.markdown for r in B.main_body(df).collect()}
    for i in range(8):
        left = [x for x in body[i].split("\n") if x]
        assert left == [x for x in foreign_page(i).split("\n") if x][3:7]


def test_heads_told_by_the_site():
    lines = B.read_lines(foreign_page(0))
    at = {x.text: i for i, x in enumerate(lines)}
    every = frozenset(x.first for x in lines if x.text in ("Johdanto", "Lue seuraavaksi", "Etusivu", "Asetukset"))
    assert B.site_heads(lines, every) == {at["Lue seuraavaksi"]}
    assert B.site_heads(lines, frozenset()) == frozenset() == B.site_heads([], frozenset({1}))
    assert B.site_heads(lines[-1:], frozenset({lines[-1].first})) == frozenset()


@pytest.mark.parametrize(
    ("title", "text", "case"),
    [
        ("{{title}}", "# A\n\nText of a page that is long enough.", True),
        ("A", "Hello %%user_name%%, the thing is ready.", True),
        ("A", "Hello `%%user_name%%`, the thing is ready.", False),
        ("A", "```\n{{ user.name }}\n```", False),
        ("A", "Lorem ipsum dolor sit amet commodo.", True),
        ("A", "Designers often paste lorem ipsum into a page and forget about it.", False),
        ("A", "kes rtqwdkg yxzxw ahwhx dfgd zhyryzj zre jjgxyh", True),
        ("undefined | Site", "x", True),
        ("A", "The set {5, 25} covers 100% of [see Other], null values included.", False),
        (None, None, False),
        ("", "  ", False),
    ],
)
def test_residue(title, text, case):
    assert R.shows_residue(title, text) == case


def test_empty_answers(spark):
    rows = [(1, "https://a.test/x", "Site", "# Page not found\n\nThe address you typed does not exist on this server any more.\nID 77"), (2, "https://a.test/y", "T", "- NaN\n- NaN NaN"), (3, None, None, None), (4, "https://a.test/z", "T", "")]
    rows += [(10 + i, f"https://h{i}.test/garden-tools-{i}", f"Garden {i}", f"# Garden {i}\n\nBitte gleich noch einmal probieren, es klemmt.") for i in range(5)]
    rows += [(20, "https://a.test/real-story-here", "Real", "# Real\n\nA real story stands here, short but of its own.")]
    rows += [(30, "https://a.test/errors", "Page not found: how to write one", "# Page not found: how to write one\n\n" + "A page not found message should say what to do next and why. " * 12)]
    df = spark.createDataFrame([(*x, True) for x in rows], "page_id long, source_url string, page_title string, markdown string, sure boolean")
    assert sorted(r.page_id for r in R.empty_pages(df).collect()) == [1, 2, 10, 11, 12, 13, 14]
    assert R.empty_pages(df.limit(0)).count() == 0


SAMPLES = [(i, t, lang) for i, (t, lang) in enumerate([
    ("the garden and the house are near the old road because nobody moves the stones in the morning", "en"),
    ("when it rains the neighbours keep the keys of the kitchen and the children read a book", "en"),
    ("der Garten und das Haus liegen an der alten Straße weil niemand die Steine am Morgen bewegt", "de"),
    ("wenn es regnet behalten die Nachbarn die Schlüssel der Küche und die Kinder lesen ein Buch", "de"),
    ("雨が降ると近所の人は台所の鍵を持ち子供は本を読みます庭と家は古い道の近くにあります", "ja"),
])]
EN = "When it rains the neighbours keep the book near the road. The children read in the old kitchen because nobody moves the keys in the morning."
DE = "Wenn es regnet lesen die Kinder ein Buch in der alten Küche. Niemand bewegt die Schlüssel und die Steine am Morgen weil die Nachbarn das Haus behalten."
JA = "雨が降ると子供は台所で本を読みます。近所の人は古い家の鍵を持ち、庭の道の近くにあります。子供は本を読みます。"


def found(text):
    model = L.Model([(t, x) for _, t, x in SAMPLES])
    return [(x, n) for x, n, _ in L.Detector(model).find([text])[0]]


def test_stretches():
    assert [x for x, _ in found(EN)] == ["en"]
    assert [x for x, _ in found(f"{EN}\n\n{DE}\n\n{JA}\n\n{EN}")] == ["en", "de", "ja", "en"]
    assert [x for x, _ in found(f'{DE} "When it rains the children read." {DE}')] == ["de"]
    assert [x for x, _ in found(f"{EN}\n```\ndef wenn_es(regnet): pass\n```\n| die | der |\n{EN}")] == ["en"]
    assert found("Quorvex Brint Alkstein 42") == found("12;0.3;1937-06\n99;1.2;1988-01") == found("too short here") == []
    assert [x for x, _ in found(EN.encode("utf-8").decode("cp1252"))] == ["en"]
    assert [x for x, _ in found(DE.encode("utf-8").decode("cp1252"))] == ["de"]
    assert [x for x, _ in found(DE.replace("ü", "u").replace("ß", "ss"))] == ["de"]


def test_unseen_words_fall_back_to_n_grams():
    model = L.Model([(t, x) for _, t, x in SAMPLES])
    assert not model.known("regnete") and model.langs[model.score("regnete").argmax()] == "de"
    assert not model.known("neighbour") and model.langs[model.score("neighbour").argmax()] == "en"
    assert model.score("").tolist() == [0, 0, 0] or len(model.score("")) == 3


def test_label_table(spark):
    samples = spark.createDataFrame(SAMPLES, "sample_id long, text string, lang string")
    notations = spark.createDataFrame([("en", "en"), ("English", "en"), ("de", "de")], "label string, lang string")
    rows = [(1, EN, "English"), (2, EN, "de"), (3, EN, None), (4, f"{EN}\n{DE}", "en"), (5, "", "en"), (6, None, None), (7, DE, "DE"), (1, EN, "English")]
    docs = spark.createDataFrame([(*x, 1) for x in rows], "doc_id long, text string, lang string, seg_no int")
    got = sorted((r.doc_id, r.seg_no, r.lang) for r in L.mislabelled(docs, samples, notations).collect())
    assert got == [(2, 1, "en"), (3, 1, "en"), (4, 1, "en"), (4, 2, "de"), (7, 1, "de")]
    assert all(0 < r.confidence <= 1 for r in L.language_stretches(docs, samples).collect())
    assert L.mislabelled(docs.limit(0), samples, notations).count() == 0
    with pytest.raises(ValueError):
        L.fit(samples.limit(0))


def test_short_pieces_are_absorbed_before_the_least_size_applies():
    from loamworks.llm.language import stretches

    sizes = lambda *parts: [(x, n) for x, n, _ in stretches([(x, n, float(n)) for x, n in parts], [20, 20])]
    assert sizes((0, 100), (1, 15), (0, 5), (1, 15)) == [(0, 100), (1, 30)]
    assert sizes((0, 100), (1, 15), (0, 5), (1, 15), (0, 100)) == [(0, 100), (1, 30), (0, 100)]
    assert sizes((0, 100), (1, 15), (0, 100)) == [(0, 200)] and sizes((0, 100), (1, 15)) == [(0, 100)]
    assert sizes((0, 30), (1, 5), (0, 10), (1, 8), (0, 2), (1, 7)) == [(0, 40)]


@pytest.mark.parametrize("few", [1_000_000, 0])
def test_furniture_in_unseen_words_is_what_the_site_repeats(spark, monkeypatch, few):
    monkeypatch.setattr(B.R, "FEW_ROWS", few)
    head, foot = "Ga naar de inhoud\n\nWij plaatsen kleine bestanden op uw toestel om de site te verbeteren.", "Deel dit verhaal met uw vrienden en buren.\n\nUitgegeven door de stichting aan de kade, overname alleen met toestemming."
    rows = [(i, f"https://site.test/{i}", f"{head}\n\n# Verhaal {i}\n\nDit is zin {'abcdefgh'[i]} van het verhaal over de haven.\nEn nog een zin {'hgfedcba'[i]} over het water.\n\n{foot}", "x") for i in range(8)]
    rows += [(20, None, head, "x"), (21, "https://other.test/1", f"{head}\n\nTekst.", "x"), (22, "https://site.test/22", None, "x")]
    rows += [(30 + i, f"https://site.test/e{i}", "De server antwoordt niet op dit moment.", "x") for i in range(6)]
    df = spark.createDataFrame(rows, "page_id long, source_url string, markdown string, lines string")
    got = {}
    for r in B.furniture_lines(df).collect():
        got.setdefault(r.page_id, set()).add(r.line_no)
    assert got == {i: {1, 3, 10, 12} for i in range(8)} | {x: got[x] for x in (20, 21) if x in got}
    assert not any(x in got for x in range(30, 36))  # an answer in place of a body stays
    assert B.main_body(df.where("page_id = 3")).first().markdown.startswith("Ga naar")  # one page repeats nothing


def test_long_lines_and_long_comments_are_judged_too():
    footer = "© 2024 " + "Some publisher of many books and papers, " * 12
    comment = "\n".join(["Ann writes:", *[f"My line {i} of a long comment goes on here." for i in range(20)], "Reply"])
    found = B.furniture(f"# Title\n\nThe story is told in this sentence of the page.\n\n{comment}\n\n{footer}")
    assert found == [*range(5, 27), 28]


def test_script_alone_decides_no_language():
    model = L.Model([("これはペンです。それは本です。" * 3, "ja"), ("this is a pen and that is a book on the table", "en")])
    found = L.Detector(model).find(["これは本です。それはペンです。" * 4, "天地玄黃宇宙洪荒日月盈昃辰宿列張寒來暑往秋收冬藏" * 3])
    assert [x[0] for x in found[0]] == ["ja"] and found[1] == []
