"""Main body of web pages, by minimum-cut labelling of their lines.

Each line of a page is a node. What a classifier says about the line is its capacity from the source (body) or to the sink
(furniture of the site): its form, whether it stands on several pages of the site in any wording, and known labels of
furniture. Repetition is counted over all pages of a site first; where it would leave a page without any body, as with an
error message that answers for many addresses, it counts for nothing. Neighbouring lines, the lines of one list, and a section's head with the lines that
hang on it are joined by edges whose capacity is the price of parting them. A maximum flow finds the cheapest cut; what
stays connected with the source is the body.
"""

from __future__ import annotations

import functools
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamworks.llm import repeated_lines as R
from loamworks.llm.common import site_of

# Labels and phrases of site furniture in English, German, French and Spanish, as their letters in lower case.
MENU = frozenset({
    "home", "topics", "pricing", "status", "shop", "search", "sign up", "log in", "press room", "contact", "gallery",
    "start here", "downloads", "members area", "help centre", "archive", "guides", "faq", "community", "careers",
    "calendar", "about us", "site map", "tutorials", "docs", "blog", "news", "help", "startseite", "themen", "hilfe",
    "termine", "registrieren", "preise", "kontakt", "laden", "presse", "gemeinschaft", "fragen und antworten",
    "anmelden", "archiv", "über uns", "suche", "anleitungen", "galerie", "stellen", "übersicht", "mitglieder",
    "accueil", "agenda", "tarifs", "archives", "connexion", "téléchargements", "boutique", "communauté", "inscription",
    "recherche", "à propos", "aide", "thèmes", "questions", "inicio", "temas", "precios", "tienda", "buscar",
    "registrarse", "entrar", "prensa", "contacto", "archivo", "ayuda", "descargas", "comunidad", "quiénes somos",
    "guías", "galería", "preguntas",
})
SERVICE = frozenset({
    "listen to this article", "skip to main content", "toggle dark mode", "choose language", "edit this page",
    "report a mistake", "back to top", "open menu", "was this page helpful yes no", "send by mail print copy address",
    "share this page mail chat copy link", "spread the word", "tell a friend", "stay in the loop",
    "get one letter a month no spam", "enter your e mail address to subscribe", "never miss an update sign up below",
    "change cookie settings", "accept all only necessary manage choices", "you can withdraw consent at any time",
    "save my selection more options", "read the cookie policy", "agree decline", "ok got it", "seite bearbeiten",
    "fehler melden", "nach oben", "menü öffnen", "zum inhalt springen", "war das hilfreich ja nein",
    "drucken senden merken", "weitersagen", "seite teilen mail chat link kopieren", "ein brief im monat kein spam",
    "mit ihrer e mail adresse anmelden", "cookie einstellungen ändern", "zur cookie richtlinie", "zustimmen ablehnen",
    "auswahl speichern", "alle annehmen nur notwendige auswahl", "haut de page", "aller au contenu",
    "signaler une erreur", "ouvrir le menu", "cette page vous a t elle aidé oui non", "faites passer le mot",
    "partager courriel messagerie lien", "une lettre par mois pas plus", "saisissez votre adresse pour vous abonner",
    "gérer les cookies", "enregistrer mes choix", "lire la politique des cookies", "tout accepter refuser choisir",
    "accepter refuser", "volver arriba", "saltar al contenido", "abrir menú", "avisar de un error",
    "le ha servido esta página sí no", "corra la voz", "compartir correo mensaje enlace",
    "una carta al mes sin publicidad", "escriba su correo para suscribirse", "configurar cookies",
    "guardar mi selección", "leer la política de cookies", "aceptar todo rechazar elegir", "aceptar rechazar",
})
FOOTER = frozenset({
    "made with care in a small office", "terms of use privacy imprint", "registered trade mark of the publisher",
    "all rights reserved", "no part of this site may be reproduced without permission", "accessibility statement",
    "alle rechte vorbehalten", "nachdruck nur mit genehmigung", "impressum datenschutz agb", "tous droits réservés",
    "reproduction interdite sans accord", "mentions légales confidentialité", "todos los derechos reservados",
    "prohibida la reproducción sin permiso", "aviso legal privacidad",
})
NOTICE = frozenset({
    "prices may change at any time without notice", "photos show examples and may differ from the delivered item",
    "figures are rounded and were not audited",
    "the information below is general and does not replace professional advice",
    "this text was first printed in our members magazine", "test results depend on your own equipment and weather",
    "zahlen sind gerundet", "die angaben sind allgemein und ersetzen keine beratung",
    "preise können sich jederzeit ändern", "chiffres arrondis",
    "ces informations sont générales et ne remplacent pas un conseil", "les prix peuvent changer à tout moment",
    "cifras redondeadas", "los datos son generales y no sustituyen el consejo profesional",
    "los precios pueden cambiar sin aviso",
})
RELATED = re.compile(
    r"(?:.{2,60}: )?(?:related articles|keep reading|you may also like|popular this week|recently added|more from this section|read next|ähnliche beiträge|mehr zum thema|das könnte sie auch interessieren|beliebt in dieser woche"
    r"|neu hinzugefügt|weiterlesen|articles liés|à lire aussi|dans la même rubrique|les plus lus de la semaine|derniers ajouts|vous aimerez aussi|artículos relacionados|también le puede interesar|lo más leído de la semana|en la misma sección|siga leyendo|añadido recientemente)"
)
AUTHOR = frozenset({
    "about the author", "über den autor", "über die autorin", "zur person", "à propos de l auteur", "l auteur",
    "l autrice", "sobre el autor", "sobre la autora", "acerca del autor",
})
ADVERT = frozenset({
    "advertisement", "sponsored content", "our partner offers", "ad continue reading below", "anzeige",
    "gesponserter inhalt", "werbung weiter unten geht es weiter", "angebote unserer partner", "unsere partner bieten",
    "publicité", "contenu sponsorisé", "nos partenaires vous proposent", "publicidad", "contenido patrocinado",
    "ofertas de nuestros socios",
})
REPLY = frozenset({
    "reply", "antworten", "répondre", "responder",
})
TALK = frozenset({
    "leave a reply", "log in to join the discussion", "antwort schreiben", "zum mitreden bitte anmelden",
    "laisser une réponse", "connectez vous pour participer", "dejar una respuesta", "inicie sesión para participar",
})
CONSENT = (
    "by staying on this page you agree to our use", "we and our partners use cookies",
    "this site stores small files on your device", "we would like to set optional cookies",
    "your privacy matters to us", "ihre privatsphäre ist uns wichtig", "wir verwenden cookies",
    "wir und unsere partner verwenden", "diese seite speichert", "wir möchten", "ce site enregistre des fichiers",
    "nous utilisons des cookies", "votre vie privée", "usamos cookies", "este sitio guarda archivos",
    "su privacidad nos importa", "nos importa su privacidad",
)

#: The longest of these labels, and the characters at the start of a line that are read before the rest of it.
LONGEST = max(len(x) for some in (MENU, SERVICE, FOOTER, NOTICE, AUTHOR, ADVERT, REPLY, TALK) for x in some)
HEAD_CHARS = 300

_MARK = re.compile(r"^(?:[-*+•]\s+|\d{1,3}[.)]\s+|#{1,6}\s+|>\s+)")
_LINK = re.compile(r"\[([^\]\n]*)\]\([^)\n]*\)")
_LETTERS = re.compile(r"[^\W\d_]+")
_FENCE = re.compile(r"^(```|~~~)")
_COUNTED = re.compile(
    r"^(?:join \d+ readers of our newsletter|rejoignez \d+ abonnés|schon \d+ abonnenten|únase a \d+ suscriptores|\d+ shares|\d+[- ]mal geteilt|\d+ partages|compartido \d+ veces"
    r"|save for later - \d+ saves|merken - \d+.*|.{4,30} - \d+ (?:saves|mal|fois|veces))$"
)
_TALKED = re.compile(r"^(?:reader opinions \(\d+\)|\d+ (?:comments|kommentare|commentaires|comentarios)|(?:leserstimmen|lesermeinungen|avis des lecteurs|opiniones(?: de lectores)?|opinions?|comments|kommentare|commentaires|comentarios) \(\d+\))$")
_SAYS = re.compile(r"^[^\s:]{2,40} ?(?:says|said|writes|wrote|schreibt|schrieb|sagt|meint|a écrit|écrit|dit|a dit|dice|escribe|escribió|opina) ?: ?$")
_DATED = re.compile(
    r"^(?:(?:published|last reviewed|updated|veröffentlicht|zuletzt|geprüft|stand|publié|mis à jour|dernière|publicado|revisado|actualizado|última)\b.*\d|\d+ (?:min read|minuten lesezeit|min de lecture|min de lectura)$)",
    re.I,
)
_BYLINE = re.compile(r"^(?:[Bb]y|[Vv]on|[Pp]ar|[Pp]or|BY|VON|PAR|POR) [A-ZÀ-Þ][^.!?:;]{1,60}$")
_WRITTEN = re.compile(r"^(?:written by|geschrieben von|écrit par|escrito por) \S[^.!?:;]{1,60}$", re.I)
_COPY = re.compile(r"^(?:©|\(c\)|copyright)\s*©?\s*\d{4}\b", re.I)
_CRUMB = re.compile(r"^\S[^>»›/|→]{0,28}(?:\s+(?:>|»|›|/|→)\s+)[^>»›/|→]{1,28}(?:\s+(?:>|»|›|/|→)\s+)\S")
_CRUMB_HOME = re.compile(r"^(?:home|startseite|accueil|inicio)\s+(?:>|»|›|/|→|\||·|:)\s+\S", re.I)
_TURN = re.compile(r"^(?:(?:←|→|«|»|<<|>>|‹|›)\s*\S.*|.*\S\s*(?:←|→|»|>>|›)|(?:previous|next|zurück|weiter|vorheriger|nächster|précédent|suivant|anterior|siguiente)(?: [^\W\d_]+)?\s*:\s*\S.*)$", re.I)
_PRICE = re.compile(r"(?:\d+[.,]\d{2}|[$€£] ?\d+)\s*(?:[$€£]|eur|usd)?$", re.I)
_SPLIT = re.compile(r"\s+(?:·|\||•|–|/|»|›)\s+|\s{3,}")
_TEASER = re.compile(r"\[\s?(?:\.\.\.|…)\s?\]$|\((?:more|mehr|suite|más)\)$", re.I)
_BOLD = re.compile(r"^(?:\*\*|__)[^*_]+(?:\*\*|__)$")
_TURNING = frozenset("←→«»<>‹›:")
_ASIDE = re.compile(r"\s*\([^()]*\)\.?$")
_RESIDUE = re.compile(r"[{}%@#$<>_\[\]]{1,2} ?[\w.: -]{2,40} ?[}%@>\]_]{1,2}|^(?:undefined|null|nan|none|\(empty string\)|\[object object\])(?:\s|$)|^ID \d+$", re.I)

_ERROR = re.compile(
    r"^(?:error )?\d{3}(?: [a-z ]{0,40})?$|^(?:bad gateway|access denied|application error|page not found|too many requests|checking your browser|internal server error|your session has expired|service (?:temporarily )?unavailable"
    r"|seite nicht gefunden|zugriff verweigert|wartungsarbeiten|interner (?:server)?fehler|page introuvable|accès refusé|erreur interne|service indisponible|página no encontrada|acceso denegado|servicio no disponible|error interno)\.?$",
    re.I,
)

#: Capacities of the graph's edges.
NEAR, LIST, BLANK, HEAD, HANG = 12, 30, 2, 6, 60
#: Evidence for the body of a line that is a sentence.
SENTENCE = 40
#: Documents of its site on which a line is repeated, and the evidence for furniture that this is.
DOCUMENTS, REPEATED = 5, 80


@dataclass
class Line:
    """A non-blank line (or a code block or table from its first to its last line)."""

    first: int
    last: int
    text: str
    kind: str  # prose, item, short, heading, code, table
    body: int  # evidence for the main body
    furniture: int
    role: str = ""  # what sort of furniture, if known
    gap: bool = False  # a blank line stands before it


def letters(text: str) -> str:
    return " ".join(_LETTERS.findall(text.lower()))


def _key(low: str) -> str:
    """Letters of a line; of a long one those of its start, if that alone has more letters and words than any rule asks for."""
    key = letters(low[:HEAD_CHARS])
    return key if len(low) <= HEAD_CHARS or (len(key) > LONGEST and key.count(" ") > 12) else letters(low)


def _judged(first: int, raw: str, gap: bool) -> Line:
    text, kind, body, evidence, role = _seen(raw)
    return Line(first, first, text, kind, body, evidence, role, gap)


@functools.lru_cache(maxsize=1 << 16)
def _seen(raw: str) -> tuple[str, str, int, int, str]:
    """The classifier's view of one line that is neither code nor table: its text, kind, evidence for body and furniture, role."""
    text = _LINK.sub(r"\1", raw) if "](" in raw else raw
    mark = _MARK.match(text)
    plain = text[mark.end() :] if mark else text
    heading = bool(mark) and text[0] == "#"
    plain = plain.strip().strip("*_").strip()
    low = " ".join(plain.lower().split())
    key = _key(low)
    words = key.count(" ") + 1 if key else 0

    def as_(kind: str, body: int, furniture: int, role: str = "") -> tuple[str, str, int, int, str]:
        return plain, kind, body, furniture, role

    kind = "heading" if heading else "item" if mark else "short" if words <= 3 else "prose"
    if low.startswith(CONSENT):
        return as_(kind, 0, 120, "consent")
    if key in NOTICE or (low.endswith((")", ").")) and letters(_ASIDE.sub("", low)) in NOTICE) or _DATED.match(plain) or (words <= 8 and _BYLINE.match(plain)):
        return as_(kind, 90, 0, "date")
    if key in SERVICE or _COUNTED.match(low):
        return as_(kind, 0, 120, "service")
    if key in FOOTER or _COPY.match(plain):
        return as_(kind, 0, 120, "footer")
    if key in REPLY:
        return as_(kind, 0, 120, "reply")
    if key in TALK or _TALKED.match(low):
        return as_(kind, 0, 120, "talk")
    if key in ADVERT:
        return as_(kind, 0, 120, "advert")
    if key in AUTHOR or _WRITTEN.match(low):
        return as_(kind, 0, 120, "author")
    if _SAYS.match(low):
        return as_(kind, 0, 120, "says")
    if words <= 12 and RELATED.fullmatch(low.rstrip(":")):
        return as_(kind, 0, 120, "related")
    if not plain.endswith((".", "?", "!")) and (_CRUMB_HOME.match(plain) or _CRUMB.match(plain)):
        return as_(kind, 0, 120, "crumb")
    if key in MENU:
        return as_(kind, 0, 50, "menu")
    if not _TURNING.isdisjoint(plain) and _TURN.match(plain) and not ("«" in plain and "»" in plain):
        return as_(kind, 0, 80, "turn")
    if plain.endswith(("]", ")")) and _TEASER.search(plain):
        return as_("prose", 0, 90, "teaser")
    if words <= 8 and (_RESIDUE.search(plain) or (not mark or heading) and _ERROR.match(plain)):
        return as_(kind, 60, 0, "residue")
    if not plain.endswith((".", "?", "!", ":")):
        parts = [letters(x) for x in _SPLIT.split(plain) if x.strip()]
        known = sum(x in MENU or x in SERVICE for x in parts) if len(parts) > 1 and max(x.count(" ") for x in parts) <= 2 else 0
        if known:
            return as_("item", 0, 40 + 20 * known, "menu")
    if _BOLD.match(raw.strip()):
        return as_("item", 8, 10, "bold")
    if heading:
        return as_(kind, 60 if text.startswith("# ") else 40, 0)
    if plain.endswith((".", "?", "!", ":", ";", "。")) and words >= 4:
        return as_(kind, SENTENCE, 0)
    if kind == "short":
        return as_(kind, 0, 12)
    if kind == "item":
        return as_(kind, 10 if words > 3 else 6, 0) if words > 2 else as_(kind, 0, 2 if words == 2 else 12)
    return as_(kind, 6, 0)


def read_lines(markdown: str) -> list[Line]:
    """The nodes of a page in reading order."""
    out: list[Line] = []
    gap, fence, start, block = False, "", 0, []
    for no, raw in enumerate(markdown.split("\n"), 1):
        text = raw.strip()
        if fence:
            if text:
                block.append(no)
            if text.startswith(fence):
                out.append(Line(start, no, "", "code", 200, 0, gap=gap))
                fence, gap = "", False
            continue
        if not text:
            gap = True
            continue
        if m := _FENCE.match(text):
            fence, start = m[1], no
            continue
        if text[0] == "|" and text[-1] == "|" and len(text) > 1:
            if out and out[-1].kind == "table" and out[-1].last == no - 1:
                out[-1].last = no
            else:
                out.append(Line(no, no, "", "table", 200, 0, gap=gap))
        else:
            out.append(_judged(no, text, gap))
        gap = False
    if fence:
        out.append(Line(start, max(block, default=start), "", "code", 200, 0, gap=gap))
    return out


def site_heads(lines: list[Line], repeated: frozenset[int]) -> frozenset[int]:
    """Nodes that head a list of titles in words that their site repeats, as those over related pages do, whatever the words.

    A head is no sentence, and what follows it is neither a sentence nor repeated: the same heading over prose stays as it is.
    """
    out = []
    for i in range(len(lines) - 1):
        x, y = lines[i], lines[i + 1]
        if x.first not in repeated or x.role or x.kind in ("code", "table") or x.body >= (SENTENCE + 1 if x.kind == "heading" else SENTENCE):
            continue
        if y.first not in repeated and y.role in ("", "bold", "teaser") and y.kind in ("prose", "item", "short") and (y.role or y.body < SENTENCE):
            out.append(i)
    return frozenset(out)


def edges(lines: list[Line], heads: frozenset[int] = frozenset()) -> list[tuple[int, int, int]]:
    """(node, node, capacity): neighbours, lists, and the lines that hang on a section's head; heads: those that the site tells."""
    out: list[tuple[int, int, int]] = []
    for i in range(len(lines) - 1):
        a, b = lines[i], lines[i + 1]
        if b.gap:
            price = BLANK
        elif a.kind == b.kind and a.kind in ("item", "short"):
            price = LIST if (a.body >= SENTENCE) == (b.body >= SENTENCE) else HEAD
        elif "heading" in (a.kind, b.kind):
            price = HEAD
        elif "code" in (a.kind, b.kind) or "table" in (a.kind, b.kind) or a.kind != b.kind:
            price = HEAD
        else:
            price = NEAR
        out.append((i, i + 1, price))
    n = len(lines)
    for i, head in enumerate(lines):
        j = i + 1
        if head.role == "related" or i in heads:
            seen = 0
            while j < n and not (lines[j].role and lines[j].role not in ("bold", "teaser", "turn")) and lines[j].kind not in ("heading", "code", "table"):
                x = lines[j]
                if seen and x.gap and not (lines[j - 1].role in ("bold", "teaser") and x.role in ("bold", "teaser")):
                    break
                after_bold = lines[j - 1].role == "bold"
                if not x.role and not after_bold and x.body >= SENTENCE:
                    break
                out.append((i, j, HANG))
                seen += 1
                j += 1
        elif head.role == "author":
            if j < n and lines[j].kind == "prose" and not lines[j].role:
                out.append((i, j, 2 * HANG))
        elif head.role == "advert":
            if j < n and not lines[j].gap and lines[j].kind in ("prose", "short") and not lines[j].role and _PRICE.search(lines[j].text.rstrip(". ")):
                out.append((i, j, 2 * HANG))
        elif head.role == "says":
            while j < n and lines[j].role not in ("reply", "says", "talk") and lines[j].kind not in ("heading",) and not lines[j].role:
                out.append((i, j, 2 * HANG))
                j += 1
                if j < n and lines[j].gap and lines[j].role != "reply" and not any(x.role == "reply" for x in lines[j : j + 3]):
                    break
        elif head.role == "bold":
            if j < n and lines[j].role == "teaser":
                out.append((i, j, HANG))
    return out


def source_side(n: int, supply: list[int], links: list[tuple[int, int, int]]) -> list[bool]:
    """Nodes on the source's side of a minimum cut; supply: capacity from the source, negative to the sink."""
    near: list[list[int]] = [[] for _ in range(n)]
    to: list[int] = []
    room: list[int] = []
    for a, b, c in links:
        near[a].append(len(to))
        near[b].append(len(to) + 1)
        to += (b, a)
        room += (c, c)
    left = list(supply)
    # Neighbours first: most of the flow runs over one edge.
    for e in range(0, len(to), 2):
        b, a = to[e], to[e + 1]
        if left[a] < 0 < left[b]:
            a, b, f = b, a, e + 1
        elif left[b] < 0 < left[a]:
            f = e
        else:
            continue
        x = min(left[a], -left[b], room[f])
        left[a] -= x
        left[b] += x
        room[f] -= x
        room[f ^ 1] += x
    while True:
        came = [-1] * n
        found = -1
        queue = deque(i for i in range(n) if left[i] > 0)
        for i in queue:
            came[i] = -2
        while queue and found < 0:
            i = queue.popleft()
            for e in near[i]:
                j = to[e]
                if room[e] and came[j] == -1:
                    came[j] = e
                    if left[j] < 0:
                        found = j
                        break
                    queue.append(j)
        if found < 0:
            return [x != -1 for x in came]
        x, i = -left[found], found
        while came[i] != -2:
            x = min(x, room[came[i]])
            i = to[came[i] ^ 1]
        x = min(x, left[i])
        left[i] -= x
        left[found] += x
        i = found
        while came[i] != -2:
            e = came[i]
            room[e] -= x
            room[e ^ 1] += x
            i = to[e ^ 1]


def furniture(markdown: str | None, repeated: frozenset[int] = frozenset()) -> list[int]:
    """Numbers, from 1, of the non-blank lines of a page that are not main body; repeated: numbers of those that its site repeats."""
    return [no for x, body in labelled(markdown, repeated) if not body for no in range(x.first, x.last + 1)]


def labelled(markdown: str | None, repeated: frozenset[int] = frozenset()) -> list[tuple[Line, bool]]:
    """Each node of a page and whether it is main body."""
    lines = read_lines(markdown or "")
    if not lines:
        return []
    supply = [x.body - x.furniture for x in lines]
    heads = site_heads(lines, repeated)
    told = lambda i, x: i in heads or (x.first in repeated and not x.role and x.kind not in ("heading", "code", "table"))
    with_site = [s - REPEATED if told(i, x) else s for i, (x, s) in enumerate(zip(lines, supply))]
    found = _cut(lines, with_site, heads)
    return found if with_site == supply or any(body for x, body in found if x.kind != "heading") else _cut(lines, supply)


def _cut(lines: list[Line], supply: list[int], heads: frozenset[int] = frozenset()) -> list[tuple[Line, bool]]:
    if all(x >= 0 for x in supply):
        return [(x, True) for x in lines]
    links, supply = edges(lines, heads), list(supply)
    for i, _, price in links:
        if lines[i].role == "says" and price > HANG:
            supply[i] -= SENTENCE  # however long the comment is, its head outweighs it
    keep = source_side(len(lines), supply, links)
    return [(x, k or (s == 0 and x.kind in ("code", "table"))) for x, k, s in zip(lines, keep, supply)]


def _marked(pages: DataFrame) -> tuple[DataFrame, np.ndarray | None]:
    """pages (page_id, markdown) with what tells the lines that their site repeats: the hash of the site (site) and the sorted
    hashes of these lines in their sites, while they are few; otherwise an array of line numbers (lines), and no hashes."""
    read = R.written(R.read_lines(pages))
    docs = R._small(R.numbered(read))
    lines = R.numbered_lines(read, docs)
    held = R.cut_lineage(R.repeated(R.bitmaps(lines), DOCUMENTS))
    keys = R.cut_lineage(held.select("site", "key").distinct())
    if keys.count() <= R.FEW_ROWS:
        table = keys.toArrow()
        both = R.mix(np.asarray(table["site"]).view(np.uint64) ^ R.mix(np.asarray(table["key"]).view(np.uint64)))
        return pages.select("page_id", "markdown", F.xxhash64(site_of(F.col("source_url"))).alias("site")), np.sort(both)
    marks = R.found_in(lines, held).groupBy("page_id").agg(F.collect_set("line_no").alias("lines"))
    return pages.select("page_id", "markdown").join(marks, "page_id", "left"), None


def _repeated_in(batch: pa.RecordBatch, known: np.ndarray | None) -> list[frozenset[int]]:
    """Numbers of the repeated lines of each page of a batch."""
    if "lines" in batch.schema.names:
        return [frozenset(x or ()) for x in batch["lines"].to_pylist()]
    if known is None or not len(known):
        return [frozenset()] * batch.num_rows
    counts, _, key = R.line_hashes(batch["markdown"].to_pylist())
    both = R.mix(np.repeat(np.asarray(batch["site"]).view(np.uint64), counts) ^ R.mix(key))
    hit = (key != 0) & (known[np.minimum(np.searchsorted(known, both), len(known) - 1)] == both)
    page = np.repeat(np.arange(len(counts)), counts)
    no = np.arange(len(key)) - np.repeat(np.cumsum(counts) - counts, counts) + 1
    out: list[set[int]] = [set() for _ in range(batch.num_rows)]
    for p, x in zip(page[hit].tolist(), no[hit].tolist()):
        out[p].add(x)
    return [frozenset(x) for x in out]


def _prepared(pages: DataFrame) -> tuple[DataFrame, object]:
    """Pages with their evidence of repetition, if they have addresses, and the broadcast hashes of repeated lines."""
    marked, known = _marked(pages) if "source_url" in pages.columns else (pages.select("page_id", "markdown"), None)
    return marked, pages.sparkSession.sparkContext.broadcast(known)


def furniture_lines(pages: DataFrame) -> DataFrame:
    """(page_id, line_no) of the non-blank lines of (page_id, markdown, source_url) that are not main body.

    Lines are split at line feeds and counted from 1. Null, empty and blank markdown has no lines; repeated rows are
    treated alike; extra columns are ignored. Without the column source_url, and for pages without a site, lines are
    judged by themselves. A page_id that several pages have shares their repeated lines.
    """
    marked, known = _prepared(pages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [furniture(x, r) for x, r in zip(batch["markdown"].to_pylist(), _repeated_in(batch, known.value))]
            at = pa.array([i for i, some in enumerate(found) for _ in some], pa.int64())
            yield pa.RecordBatch.from_arrays([batch["page_id"].take(at), pa.array([x for some in found for x in some], pa.int32())], names=["page_id", "line_no"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return marked.mapInArrow(run, f"page_id {kind}, line_no int")


def main_body(pages: DataFrame) -> DataFrame:
    """(page_id, markdown): the text of (page_id, markdown, source_url) without the lines that are not main body; null stays null."""
    marked, known = _prepared(pages)

    def clean(text: str | None, repeated: frozenset[int]) -> str | None:
        drop = set(furniture(text, repeated))
        return text if not drop else "\n".join(x for no, x in enumerate(text.split("\n"), 1) if no not in drop).strip("\n")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([clean(x, r) for x, r in zip(batch["markdown"].to_pylist(), _repeated_in(batch, known.value))], pa.string())
            yield pa.RecordBatch.from_arrays([batch["page_id"], texts], names=["page_id", "markdown"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return marked.mapInArrow(run, f"page_id {kind}, markdown string")
