"""Pages that show template residue, filler text, an error message or a demand for scripts.

Placeholders and filler are found by detectors in the title and in the text outside code. A response that says nothing of
its own is found by comparison. The terms of its address and title are looked for in its main body; each statement of
the body is counted over the addresses, and the hosts, that it answers for among such mismatched pages; and the words of
the body are its information. All of these make one score:

    log2(addresses of its rarest statement) + 1 if that stands on several hosts + 2 * share of the address's terms that
    the body lacks + log2(16 / words), 1 at most + KNOWN if each statement is a known message

The title takes the place of an address without terms. Where the body says nothing but the title, that counts as a
statement only if it is known or answers on several hosts, as it may be the name of the site. An article has a statement of its own, so it scores 2 and less, whatever its length. Known messages are one feature, for
tables in which a message is met once or twice only.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamworks.llm.boilerplate import Line, labelled, letters
from loamworks.llm.common import normalised_url, site_of, written

#: Score of an empty answer, what a known message adds to it, and the share of terms from which a body matches its address.
SCORE, KNOWN, MATCH = 3.9, 2.5, 0.5

# Placeholder notations, filler sentences, and messages that stand in place of content.
PLACEHOLDER = re.compile(
    r"\{\{[^{}\n]+?\}\}|\$\{[^{}\n]+?\}|#\{[^{}\n]+?\}|\{%-?[^%\n]+?%\}|<%[=-]?[^%\n]+?%>|%%\w{2,}?%%|(?<![\w%])%[A-Z][A-Z_]+%|@@\w{2,}?@@|\[\[\w+:\w+\]\]"
    r"|\[(?:your|insert|enter|add) [\w ]+?\]|<[\w ]+? goes here>|(?<!\w)__[A-Z]+(?:_[A-Z]+)*__(?!\w)|(?<![\w{$#%])\{[a-z]+(?:_[a-z]+)*\}(?!\})",
    re.I,
)
FILLER = (
    "heading goes here", "your text goes here", "placeholder copy", "dummy content for layout purposes",
    "sample paragraph, replace before launch", "todo: real wording from the client",
    "write something about your company", "this is a text block. click to edit it",
    "insert a short description of the product", "blindtext, bitte ersetzen", "texte de remplissage",
    "texto de relleno", "asdf asdf", "jkl jkl",
)
LATIN = frozenset({
    "adipis", "adipiscing", "aliqua", "aliquip", "aliquo", "amet", "ametur", "anim", "animid", "aute", "autem",
    "cillum", "commodo", "commodum", "consectetur", "consector", "culpa", "culpam", "cupida", "cupidatat", "deserum",
    "deserunt", "dolor", "dolore", "dolorem", "duis", "duisque", "ea", "eiusmod", "eiusdem", "elit", "elitum", "enim",
    "esse", "est", "et", "eu", "ex", "excepta", "excepteur", "exerci", "exercitation", "fugiat", "id", "in", "incidit",
    "incididunt", "ipsum", "irure", "labora", "labore", "laboris", "laborum", "lorem", "magna", "magnam", "minim",
    "mollit", "nisi", "nisiat", "non", "nostrud", "nostrum", "nulla", "nullam", "occae", "occaecat", "officia",
    "pariat", "pariatur", "porta", "proident", "qui", "quis", "reprehenderit", "sed", "sedo", "sint", "sit", "sitam",
    "sunt", "tempor", "tempora", "ullamco", "ut", "velit", "velitum", "veniam", "viverra", "voluptate",
})
EMPTY = re.compile(r"(?:(?:undefined|null|nan|none|\[object object\]|\(empty string\)|\(null\)|n/a)\s*)+", re.I)
MESSAGES = (
    "javascript", "schiefgelaufen", "algo ha fallado", "inténtelo más tarde", "réessayez plus tard", "needs scripts to run",
    "does not support scripting", "allow scripts for this site", "page is gone", "page not found",
    "does not exist on this server", "access denied", "do not have permission to view", "internal server error",
    "something broke on our side", "too many requests", "sent more calls than allowed", "bad gateway", "invalid response",
    "service temporarily unavailable", "under maintenance or too busy", "application error", "unhandled exception occurred",
    "session has expired", "sign in once more", "checking your browser", "you are not a robot", "braucht skripte",
    "seite nicht gefunden", "gibt es auf diesem server nicht", "zugriff verweigert", "keine berechtigung für",
    "wartungsarbeiten", "dienst ist gerade nicht", "besoin de scripts", "erreur interne", "un problème est survenu",
    "page introuvable", "n existe plus sur ce serveur", "accès refusé", "página no encontrada", "ya no existe en este servidor",
    "servicio no disponible", "acceso denegado", "necesita scripts", "no tiene permiso",
)

#: The longest word of each message, and the messages that it stands for.
_ANCHORS: dict[str, list[str]] = {}
for _x in MESSAGES:
    _ANCHORS.setdefault(max(_x.split(), key=len), []).append(_x)

_CODE = re.compile(r"^[ \t]*(```|~~~).*?(?:^[ \t]*\1[ \t]*$|\Z)", re.M | re.S)
_TICKS = re.compile(r"`[^`\n]*`")
_WORD = re.compile(r"[^\W\d_]+")
_SENTENCE = re.compile(r"(?<=[.!?])\s+")
_PARTS = re.compile(r"\s+[|·–-]\s+")
_NUMBERED = re.compile(r"^(?:ID|Ref|Code|Trace)?[ #:]*\d+$", re.I)
_MARKS = ("{", "%", "@@", "<", "[", "__")
_VOWEL = re.compile("[aeiou]")


def _has_placeholder(text: str) -> bool:
    return any(x in text for x in _MARKS) and PLACEHOLDER.search(_TICKS.sub(" ", text)) is not None


def has_filler(text: str) -> bool:
    """Whether lower-cased text holds a filler sentence, a run of mock Latin, or a line of letters struck at random."""
    if any(x in text for x in FILLER):
        return True
    run = 0
    for w in _WORD.findall(text):
        run = run + 1 if w in LATIN else 0
        if run == 4:
            return True
    return False


def struck_at_random(line: str) -> bool:
    words = line.split()
    return len(words) >= 6 and all(x.isalpha() and x.isascii() for x in words) and 4 * sum(not _VOWEL.search(x) for x in words) >= len(words)


def shows_residue(title: str | None, markdown: str | None) -> bool:
    """Whether the title, or the text outside code, shows an unfilled placeholder or filler."""
    title = title or ""
    if _has_placeholder(title) or has_filler(title.lower()) or EMPTY.fullmatch(_PARTS.split(title)[0].strip()):
        return True
    text = markdown or ""
    if "```" in text or "~~~" in text:
        text = _CODE.sub("\n", text.replace("\r", ""))
    if "`" in text:
        text = _TICKS.sub(" ", text)
    return _has_placeholder(text) or has_filler(text.lower()) or any(x.islower() and struck_at_random(x) for x in text.split("\n"))


def _names(title: str) -> set[str]:
    return {letters(x) for x in (title, *_PARTS.split(title))}


def statements(title: str | None, markdown: str | None) -> tuple[list[str], bool, bool]:
    """What the main body of a page says, as letters: sentences, code and tables, without names, dates and numbers; headings,
    then names, only if there is nothing else. Whether these are names; whether printed empty values stand in the body."""
    body = [x for x, keep in labelled(markdown) if keep]
    if not body:
        return [], False, False
    names, lines = _names(title or ""), (markdown or "").split("\n")
    left: list[Line] = [x for x in body if x.role != "date" and not _NUMBERED.match(x.text)]
    said = [x for x in left if x.kind in ("code", "table") or not EMPTY.fullmatch(x.text.strip())]
    plain = [x for x in said if x.kind != "heading" and letters(x.text) not in names and not (x.kind == "short" and not x.text.endswith((".", "?", "!")) and len(said) > 1)]
    out, rest = [], plain or [x for x in said if letters(x.text) not in names]
    for x in rest or said:
        if x.kind in ("code", "table"):
            out.append(letters("\n".join(lines[x.first - 1 : x.last])) or x.kind)
        else:
            out += [y for part in _SENTENCE.split(x.text) if (y := letters(part))]
    return out, not rest, len(said) < len(left)


def is_known(said: list[str]) -> bool:
    """Whether the statements are known messages, or one of them is and all are short."""
    hits = [any(x in one for w in _ANCHORS.keys() & set(one.split()) for x in _ANCHORS[w]) for one in said]
    return all(hits) or (any(hits) and sum(len(x.split()) for x in said) <= 12 * len(said))


def terms(url: str | None, title: str | None) -> set[str]:
    """Words of four letters or more of the path of an address; those of the title if it has none."""
    path = (url or "").lower().split("://")[-1].partition("/")[2].partition("?")[0]
    return next((t for x in (path, (title or "").lower()) if (t := {w for w in _WORD.findall(x) if len(w) > 3})), set())


def match_of(url: str | None, title: str | None, said: list[str]) -> float:
    """Share of the terms of its address that a body has; 0 if there are none."""
    wanted = terms(url, title)
    return len(wanted & {w for x in said for w in x.split()}) / len(wanted) if wanted else 0.0


def answers(pages: DataFrame) -> DataFrame:
    """(page_id, url, host, sure, known, named, match, words, said) of the pages that show residue (sure) or whose main body lacks most terms of its address.

    said: hashes of the statements of the body; named: they are names; words: of all statements.
    """
    kind = pages.schema["page_id"].dataType.simpleString()
    pages = pages.select("page_id", normalised_url(F.col("source_url")).alias("url"), F.xxhash64(site_of(F.col("source_url"))).alias("host"), "page_title", "markdown")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for url, title, text in zip(batch["url"].to_pylist(), batch["page_title"].to_pylist(), batch["markdown"].to_pylist()):
                if shows_residue(title, text):
                    rows.append((True, False, False, 0.0, 0, []))
                    continue
                said, named, empty = statements(title, text) if text else ([], False, False)
                match = match_of(url, title, said)
                if empty and (named or not said):
                    rows.append((True, False, named, match, 0, []))
                elif said and match < MATCH:
                    rows.append((False, is_known(said), named, match, sum(len(x.split()) for x in said), said))
                else:
                    rows.append(None)
            some = [i for i, x in enumerate(rows) if x]
            sure, known, named, match, words, said = zip(*(rows[i] for i in some)) if some else ((),) * 6
            take = pa.array(some, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch[c].take(take) for c in ("page_id", "url", "host")] + [pa.array(sure, pa.bool_()), pa.array(known, pa.bool_()), pa.array(named, pa.bool_()), pa.array(match, pa.float64()), pa.array(words, pa.int32()), pa.array(said, pa.list_(pa.string()))],
                names=["page_id", "url", "host", "sure", "known", "named", "match", "words", "said"],
            )

    found = pages.mapInArrow(run, f"page_id {kind}, url string, host long, sure boolean, known boolean, named boolean, match double, words int, said array<string>")
    return written(found.withColumn("url", F.xxhash64("url")).withColumn("said", F.array_distinct(F.transform("said", lambda x: F.xxhash64(x)))))


def scored(seen: DataFrame, known: float = KNOWN) -> DataFrame:
    """(page_id, score) of each page of answers that says something."""
    open_ = seen.where("not sure and size(said) > 0")
    each = open_.select("url", "host", F.explode("said").alias("statement")).distinct()
    over = each.groupBy("statement", "host").count().groupBy("statement").agg(F.sum("count").alias("addresses"), F.count("*").alias("hosts"))
    rare = open_.select("page_id", F.explode("said").alias("statement")).join(over, "statement").groupBy("page_id").agg(F.min(F.struct("addresses", "hosts")).alias("rare"))
    alone = F.col("named") & ~F.col("known") & (F.col("rare.hosts") == 1)
    score = F.log2("rare.addresses") + F.when(F.col("rare.hosts") > 1, 1).otherwise(0) + 2 * (1 - F.col("match")) + F.least(F.lit(1.0), F.log2(16 / F.col("words"))) + F.when(F.col("known"), known).otherwise(0)
    return open_.join(rare, "page_id").where(~alone).select("page_id", score.alias("score"))


def empty_pages(pages: DataFrame, known: float = KNOWN) -> DataFrame:
    """(page_id) of (page_id, source_url, page_title, markdown): pages that show residue, filler or an empty answer.

    Null, empty or blank title or markdown alone is no case; a page of furniture only is none either. Extra columns are
    ignored, repeated rows are treated alike. known: what a known message adds to the score; 0 leaves it to the comparison.
    """
    seen = answers(pages)
    return seen.where("sure").select("page_id").unionByName(scored(seen, known).where(F.col("score") >= SCORE).select("page_id")).distinct()
