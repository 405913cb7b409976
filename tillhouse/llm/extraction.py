"""Main text of web pages by a linear-chain conditional random field over DOM leaf blocks.

A page is read into leaf blocks: runs of inline text between the borders of block elements, each with
its path of ancestors. A block is described by the tags and the class, id and role words of its
ancestors, by its own tag, and by its text (length, link share, sentence ends, tell-tale words,
place on the page). A chain over the blocks with two labels, article or not, scores each block and each
pair of neighbours; it is trained by maximum likelihood (forward-backward) and decoded by Viterbi.

Training pages (`training_pages`): a bounded sample of the given pages (`PAGES` rows of smallest digest,
those above `PAGE_CHARS` characters left out) whose markup names one article gives labelled pages as they
are, and, dressed anew, labelled pages of other layouts: the same article blocks in other containers, among
menus, headers, footers, sidebars, notices, adverts, forms and reader comments of many class names, whose
texts come from the sample too, so that words alone do not decide. A few sentences of four languages are
always among the texts. The model is a dictionary of weights and goes to the tasks as one broadcast.

Every page is read whole, in a task of its own batch; blocks, weights and decoding are linear in its length.

Defined results: a null or empty html gives an empty text, and so does a page without article blocks.
Character references are decoded once. White space of any kind is one space inside a block; `br` counts
as white space. Scripts, styles, templates, comments and the head have no blocks. A tag that is cut off at
the end is dropped. Repeated rows are extracted each. An empty table gives an empty result. Only page_id,
url and html are read.
"""

from __future__ import annotations

import html as entities
import math
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.llm.common import ROW, packed

PAGES, PAGE_CHARS, LAYOUTS = 200, 100_000, 4

# Elements of HTML, by what they mean for blocks.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style template title textarea iframe noembed noframes xmp svg math".split())
# Raw elements whose text a reader sees.
SHOWN_RAW = {"textarea"}
BLOCK = set(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript ol optgroup option p pre search section "
    "select summary table tbody td tfoot th thead tr ul".split()
)
# A start tag closes an open element of these, up to the element that bounds them.
CLOSES = {
    **dict.fromkeys(BLOCK - {"body", "html", "head", "button", "option", "optgroup"}, {"p"}),
    "li": {"p", "li"}, "dt": {"p", "dt", "dd"}, "dd": {"p", "dt", "dd"}, "tr": {"p", "tr", "td", "th"}, "td": {"p", "td", "th"},
    "th": {"p", "td", "th"}, "option": {"option"}, "optgroup": {"option", "optgroup"}, "body": {"head"},
    **dict.fromkeys(("tbody", "thead", "tfoot"), {"p", "tr", "td", "th", "tbody", "thead", "tfoot", "caption"}),
}
BOUNDS = {
    "p": set("table td th button caption".split()), "li": set("ul ol menu dir table".split()), "dt": {"dl"}, "dd": {"dl"},
    "td": {"table"}, "th": {"table"}, "tr": {"table"}, "option": {"select"}, "optgroup": {"select"}, "head": {"html"},
    "tbody": {"table"}, "thead": {"table"}, "tfoot": {"table"}, "caption": {"table"},
}

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([A-Za-z][^\s/>]*+)([^>]*+)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"""(?<![\w-])(class|id|role|hidden|style|aria-hidden)\b\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])|[^A-Za-z]+")

# Words of class names, by what they usually mark.
MARKS = {
    "menu": "nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager tabs toc skip topbar",
    "header": "header masthead banner logo branding hero head top site title tagline",
    "footer": "footer foot bottom copyright legal colophon imprint credits",
    "sidebar": "sidebar aside side rail widget widgets related recommended recommendations more trending popular tags teaser teasers secondary",
    "notice": "notice notices cookie cookies consent gdpr alert popup modal overlay newsletter subscribe subscription paywall message warning toast announcement",
    "advert": "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion promoted banner adsense dfp outbrain taboola",
    "form": "form search login signin signup register contact input field poll survey",
    "comment": "comment comments commentlist reply replies respond discussion disqus discuss thread reader readers feedback reviews responses",
    "share": "share sharing social follow like print toolbar buttons byline meta author date",
    "article": "article content post entry story body main text page maincontent prose copy read",
}
MARK_OF = {word: tuple(kind for kind, words in MARKS.items() if word in words.split()) for words in MARKS.values() for word in words.split()}

# Words of texts that are no article, in the four languages of the tables.
TELLS = {
    "rights": "copyright © rights reserved droits réservés derechos reservados rechte vorbehalten impressum imprint mentions légales aviso datenschutz privacy",
    "consent": "cookie cookies consent accept akzeptieren accepter aceptar zustimmen",
    "talk": "reply replied commented comment comments répondre commentaire commentaires responder comentario comentarios antworten kommentar kommentare says",
    "act": "subscribe newsletter login register share search abonnieren anmelden suchen teilen partager chercher connexion inscription compartir buscar suscribirse entrar",
    "sold": "advertisement sponsored anzeige werbung publicité publicidad anuncio patrocinado sponsorisé",
}
TELL_OF = {word: kind for kind, words in TELLS.items() for word in words.split()}
_WORD = re.compile(r"[^\W\d_]+|©")


@lru_cache(maxsize=4096)
def _marks(tag: str, attributes: str) -> tuple[str, ...]:
    """The features an element gives to every block inside it."""
    found = {f"in={tag}"}
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), entities.unescape(value.strip("\"'"))
        if name in ("hidden", "aria-hidden", "style"):
            hides = {"hidden": value.lower() != "false", "aria-hidden": value.lower() == "true"}.get(name, bool(re.search(r"display\s*:\s*none", value)))
            if hides:
                found.add("hidden")
            continue
        for word in _CAMEL.split(value):
            word = word.lower()
            if word:
                found.add(f"word={word}")
                found.update(f"mark={kind}" for kind in MARK_OF.get(word, ()))
    return tuple(sorted(found))


@dataclass
class Block:
    tag: str
    marks: frozenset[str]
    nearest: str
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""


@dataclass
class _Open:
    tag: str
    marks: frozenset[str]
    nearest: str


def _nearest(marks: tuple[str, ...], tag: str, before: str) -> str:
    """The innermost element that says what it is, by its tag or its class words."""
    if tag in ("nav", "header", "footer", "aside", "form", "article", "main"):
        return tag
    kinds = [m[5:] for m in marks if m.startswith("mark=")]
    others = [k for k in kinds if k != "article"]
    return (others or kinds or [before])[0]


def blocks(html: str | None) -> list[Block]:
    """The leaf blocks of a page that have text, in order."""
    html = html or ""
    found: list[Block] = []
    stack = [_Open("", frozenset(), "")]
    block: Block | None = None
    linked = 0
    at = 0

    def text(piece: str) -> None:
        nonlocal block
        if not piece:
            return
        if block is None:
            if piece.isspace():
                return
            top = next((o for o in reversed(stack) if o.tag in BLOCK), stack[0])
            block = Block(top.tag, stack[-1].marks, stack[-1].nearest)
        piece = entities.unescape(piece) if "&" in piece else piece
        block.parts.append(piece)
        if linked:
            block.linked += len(piece)

    def border() -> None:
        nonlocal block
        if block is not None:
            block.text = " ".join("".join(block.parts).split())
            if block.text:
                found.append(block)
            block = None

    def leave(index: int) -> None:
        nonlocal linked
        for closed in stack[index:]:
            linked -= closed.tag == "a"
        if any(closed.tag in BLOCK for closed in stack[index:]):
            border()
        del stack[index:]

    def close(tags: set[str]) -> None:
        for tag in tags:
            for index in range(len(stack) - 1, 0, -1):
                if stack[index].tag == tag:
                    leave(index)
                    break
                if stack[index].tag in BOUNDS.get(tag, ()):
                    break
                if tag != "p" and tag != "head" and stack[index].tag in ("div", "section", "article", "form"):
                    break

    while found_tag := _TAG.search(html, at):
        text(html[at:found_tag.start()])
        at = found_tag.end()
        slash, name, attributes = found_tag.group(1), found_tag.group(2), found_tag.group(3)
        if name is None:
            slash, name, attributes = found_tag.group(4), found_tag.group(5), found_tag.group(6)
            if name is None or not found_tag.group().endswith(">"):
                continue
        tag = name.lower()
        if slash:
            if tag == "p" and not any(o.tag == "p" for o in stack):
                border()
            for index in range(len(stack) - 1, 0, -1):
                if stack[index].tag == tag:
                    leave(index)
                    break
            continue
        if tag == "br":
            text(" ")
            continue
        if tag in BLOCK:
            border()
            close(CLOSES.get(tag, set()))
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*+(?:>|\Z)|\Z", re.I).search(html, at)
            if tag in SHOWN_RAW:
                text(html[at:end.start()])
            at = end.end()
            continue
        if tag in VOID or attributes.endswith("/") and tag not in BLOCK:
            continue
        own = _marks(tag, attributes)
        top = stack[-1]
        marks = top.marks if top.marks.issuperset(own) else top.marks.union(own)
        stack.append(_Open(tag, marks, _nearest(own, tag, top.nearest)))
        linked += tag == "a"
    text(html[at:])
    border()
    return [b for b in found if "in=head" not in b.marks]


def features(page: list[Block]) -> list[list[str]]:
    """What the field knows of each block; first, what its nearest telling ancestor is."""
    out = []
    for i, block in enumerate(page):
        words = _WORD.findall(block.text.lower())
        n = len(words)
        named = {TELL_OF[w] for w in words if w in TELL_OF} if n < 40 else set()
        share = block.linked / max(1, sum(map(len, block.parts)))
        ends = sum(block.text.count(c) for c in ".!?")
        out.append([
            f"near={block.nearest}", *block.marks, f"tag={block.tag}",
            f"words={min(7, int(math.log2(n + 1)))}", f"links={int(share * 3.999)}", f"ends={min(3, ends)}",
            f"last={'stop' if block.text[-1] in '.!?…' else 'none'}",
            f"from={min(i, 3)}", f"left={min(len(page) - 1 - i, 3)}", *[f"tells={kind}" for kind in named], "any",
        ])
    return out


class Field:
    """A chain with the labels 0 and 1.

    It has a weight for each feature of label 1, and weights for each pair of labels of neighbours: one set
    where their nearest telling ancestors differ (`pairs[0]`), one where they are alike (`pairs[1]`).
    """

    def __init__(self, weights: dict[str, float], pairs: np.ndarray, first: np.ndarray):
        self.weights, self.pairs, self.first = weights, pairs, first

    def scores(self, page: list[list[str]]) -> list[float]:
        get = self.weights.get
        return [sum(get(name, 0.0) for name in names) for names in page]

    def decode(self, page: list[list[str]]) -> list[int]:
        """The best labels (Viterbi); of equally good ones, 0 first from the end."""
        scores = self.scores(page)
        if not scores:
            return []
        pairs = self.pairs.tolist()
        low, high = self.first[0], self.first[1] + scores[0]
        back = []
        for score, alike in zip(scores[1:], neighbours(page)):
            (p00, p01), (p10, p11) = pairs[alike]
            back.append((low + p00 < high + p10, low + p01 < high + p11))
            low, high = max(low + p00, high + p10), max(low + p01, high + p11) + score
        label = int(high > low)
        labels = [label]
        for step in reversed(back):
            label = int(step[label])
            labels.append(label)
        return labels[::-1]


def neighbours(page: list[list[str]]) -> list[int]:
    """For each block but the first, whether its nearest telling ancestor is what the one before has."""
    return [int(a[0] == b[0]) for a, b in zip(page, page[1:])]


def fit(pages: list[tuple[list[list[str]], list[int]]], rounds: int = 120, ridge: float = 0.1, rate: float = 0.15) -> Field:
    """Maximum likelihood with an L2 penalty, by Adam over all pages at once."""
    pages = sorted((p for p in pages if p[1]), key=lambda p: -len(p[1]))
    names = {name: i for i, name in enumerate(sorted({n for page, _ in pages for block in page for n in block}))}
    longest = max((len(labels) for _, labels in pages), default=1)
    b = len(pages)
    index = np.array([names[n] for page, _ in pages for block in page for n in block], np.int64)
    row = np.array([r * longest + t for r, (page, _) in enumerate(pages) for t, block in enumerate(page) for _ in block], np.int64)
    gold = np.zeros((b, longest), np.int64)
    here = np.zeros((b, longest), bool)
    for r, (_, labels) in enumerate(pages):
        gold[r, :len(labels)], here[r, :len(labels)] = labels, True
    # Pages are in order of length, so the first `reach[t]` of them have a block t.
    reach = here.sum(0)
    last = here.sum(1) - 1
    alike = np.zeros((b, max(0, longest - 1)), np.int64)
    for r, (page, _) in enumerate(pages):
        alike[r, :len(page) - 1] = neighbours(page)
    both = here[:, 1:]
    seen = np.zeros((2, 2, 2))
    np.add.at(seen, (alike[both], gold[:, :-1][both], gold[:, 1:][both]), 1)
    starts = np.bincount(gold[:, 0], minlength=2).astype(float)
    size = len(names)
    theta = np.zeros(size + 10)
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, rounds + 1):
        w, pairs, first = theta[:size], theta[size:size + 8].reshape(2, 2, 2), theta[size + 8:]
        emit = np.zeros((b, longest, 2))
        emit[..., 1] = np.bincount(row, w[index], b * longest).reshape(b, longest)
        ahead = np.zeros((b, longest, 2))
        ahead[:, 0] = first + emit[:, 0]
        for t in range(1, longest):
            n = reach[t]
            ways = ahead[:n, t - 1, :, None] + pairs[alike[:n, t - 1]]
            ahead[:n, t] = np.logaddexp(ways[:, 0], ways[:, 1]) + emit[:n, t]
        ends = ahead[np.arange(b), last]
        total = np.logaddexp(ends[:, 0], ends[:, 1])
        behind = np.zeros((b, longest, 2))
        expected = np.zeros((2, 2, 2))
        for t in range(longest - 2, -1, -1):
            n = reach[t + 1]
            ways = pairs[alike[:n, t]] + (emit[:n, t + 1] + behind[:n, t + 1])[:, None, :]
            behind[:n, t] = np.logaddexp(ways[..., 0], ways[..., 1])
            joint = np.exp(ahead[:n, t, :, None] + ways - total[:n, None, None])
            for kind in (0, 1):
                expected[kind] += joint[alike[:n, t] == kind].sum(0)
        belief = np.exp(ahead + behind - total[:, None, None])
        off = np.where(here, gold - belief[..., 1], 0.0).ravel()
        grad = np.concatenate([
            np.bincount(index, off[row], size), (seen - expected).ravel(), starts - belief[:, 0].sum(0)
        ]) - ridge * theta
        mean, square = 0.9 * mean + 0.1 * grad, 0.99 * square + 0.01 * grad * grad
        theta = theta + rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return Field(dict(zip(names, theta[:size].tolist())), theta[size:size + 8].reshape(2, 2, 2).copy(), theta[size + 8:].copy())


# Labelled pages -----------------------------------------------------------------------------

# Texts that are always among those of training pages.
SENTENCES = (
    "The council met on Tuesday and agreed to rebuild the old bridge before winter.",
    "Nobody had expected the river to rise so fast, and the town was not prepared.",
    "Der Rat beschloss am Dienstag, die alte Brücke noch vor dem Winter zu erneuern.",
    "Niemand hatte erwartet, dass der Fluss so schnell steigen würde.",
    "Le conseil a décidé mardi de reconstruire le vieux pont avant l'hiver.",
    "Personne ne s'attendait à ce que la rivière monte aussi vite.",
    "El consejo acordó el martes reconstruir el viejo puente antes del invierno.",
    "Nadie esperaba que el río creciera tan rápido.",
)
LABELS = ("Home", "News", "Sport", "Contact", "About us", "Startseite", "Kontakt", "Accueil", "Actualités", "Inicio", "Noticias", "Culture")
SAYINGS = {
    "footer": ("© 2024 All rights reserved.", "Impressum Datenschutz", "Mentions légales", "Aviso legal", "Copyright {}"),
    "notice": ("We use cookies. Accept", "Wir verwenden Cookies. Akzeptieren", "Nous utilisons des cookies. Accepter", "Usamos cookies. Aceptar", "Subscribe to our newsletter", "{}"),
    "form": ("Search", "E-mail", "Password", "Suchen", "Anmelden", "Connexion", "Buscar", "Your name", "Send"),
    "share": ("Share", "Teilen", "Partager", "Compartir", "By {}", "12 May 2023", "Print"),
    "comment": ("{}", "{}", "{}", "Reply", "Antworten", "Répondre", "Responder", "3 comments", "{} says:"),
    "advert": ("{}", "{}", "Advertisement", "Anzeige", "Publicité", "Publicidad"),
    "header": ("{}", "Daily News", "The Gazette"),
    "sidebar": ("{}", "Most read", "Related", "Meistgelesen", "À lire aussi", "Más leídas"),
    "menu": ("{}",),
}
# Class words are hidden from training this often, so that what they have in common is learnt.
WORDS_SEEN = 0.4
OWN_TAG = {"menu": "nav", "header": "header", "footer": "footer", "sidebar": "aside", "form": "form", "notice": "dialog", "comment": "section", "advert": "aside", "share": "aside"}


def _escaped(text: str) -> str:
    return entities.escape(text, quote=False)


def _module(kind: str, rng: random.Random, texts: list[str]) -> str:
    """A part of a page that is no article."""
    word = rng.choice([w for w in MARKS[kind].split() if w not in MARKS["article"].split()])
    name = rng.choice((word, f"{word}-{rng.choice(('box', 'wrap', 'area', 'inner', 'list'))}", f"site-{word}", f"{word}Block"))
    tag = OWN_TAG[kind] if rng.random() < 0.4 and kind != "comment" else rng.choice(("div", "div", "section", "ul" if kind == "menu" else "div"))
    named = tag in ("nav", "header", "footer", "form") and rng.random() < 0.6
    head = f"<{tag}>" if named else f'<{tag} {rng.choice(("class", "class", "id"))}="{name}">'
    inner = []
    for _ in range(rng.randrange(1, 5)):
        text = rng.choice(SAYINGS[kind])
        if text == "{}" and kind == "menu":
            text = rng.choice((*LABELS, " ".join(rng.choice(texts).split()[:2])))
        words = rng.choice(texts).split()
        cut = len(words) if kind in ("comment", "advert", "notice") else rng.randrange(1, 9)
        text = _escaped(text.replace("{}", " ".join(words[:cut]) or "news"))
        if kind in ("menu", "sidebar") and rng.random() < 0.7 or kind == "share":
            text = f'<a href="/x">{text}</a>'
        inner.append(f"<li>{text}</li>" if tag == "ul" or kind == "menu" and rng.random() < 0.7 else rng.choice(("<p>{}</p>", "<div>{}</div>", "<span>{}</span> ")).format(text))
    if kind in ("comment", "sidebar") and rng.random() < 0.4:
        inner.insert(0, f"<h3>{rng.choice(('Comments', 'Kommentare', 'Commentaires', 'Comentarios') if kind == 'comment' else SAYINGS['sidebar'][1:])}</h3>")
    return f"{head}{''.join(inner)}</{tag}>"


def dress(texts: list[str], others: list[str], rng: random.Random) -> str:
    """A page of a layout of its own around the article blocks `texts`; article blocks carry the attribute data-gold."""
    body = []
    for i, text in enumerate(texts):
        tag = rng.choice(("h1", "h2")) if i == 0 else rng.choices(("p", "div", "h2", "li", "blockquote", "td"), (70, 8, 6, 8, 4, 2))[0]
        wrap = {"li": "<ul>{}</ul>", "td": "<table><tr>{}</tr></table>"}.get(tag, "{}")
        text = _escaped(text)
        if rng.random() < 0.15 and " " in text:
            first, rest = text.split(" ", 1)
            text = f'<a href="/y">{first}</a> {rest}'
        body.append(wrap.format(f"<{tag} data-gold>{text}</{tag}>"))
    for kind in rng.sample(("advert", "share", "sidebar", "notice", "form"), rng.randrange(0, 4)):
        body.insert(rng.randrange(len(body) + 1), _module(kind, rng, others))
    if rng.random() < 0.4:
        body.append(_module("comment", rng, others))
    word = rng.choice(MARKS["article"].split())
    open_, shut = rng.choice((
        ("<article>", "</article>"), ("<main>", "</main>"), ("<main><article>", "</article></main>"), (f'<article class="{word}">', "</article>"),
        (f'<div class="{word}">', "</div>"), (f'<div id="{word}">', "</div>"), (f'<section class="{word}-area">', "</section>"), ("<div>", "</div>"), ("", ""),
    ))
    before = [_module(k, rng, others) for k in rng.sample(("menu", "header", "notice", "advert", "form", "sidebar"), rng.randrange(0, 4))]
    after = [_module(k, rng, others) for k in rng.sample(("comment", "sidebar", "footer", "advert", "form", "menu"), rng.randrange(0, 4))]
    if rng.random() < 0.5:
        after.append(_module("footer", rng, others))
    return f"<html><head><title>{_escaped(texts[0])}</title></head><body>{''.join(before)}{open_}{''.join(body)}{shut}{''.join(after)}</body></html>"


_APART = re.compile(r"in=(nav|header|footer|aside|form|dialog|noscript|button)$|mark=(?!article)|hidden$")


def labelled(page: list[Block]) -> list[int] | None:
    """Labels of a page whose markup names its article; None where it does not."""
    for tag in ("in=article", "in=main"):
        if any(tag in b.marks for b in page):
            return [int(tag in b.marks and not any(_APART.match(m) for m in b.marks)) for b in page]
    return None


def training_pages(htmls: list[str], layouts: int = LAYOUTS, seed: int = 13) -> list[tuple[list[list[str]], list[int]]]:
    """(features, labels) of the pages as they are, where labelled, and of their articles in other layouts."""
    rng = random.Random(seed)
    found, articles, others = [], [], list(SENTENCES)
    for html in htmls:
        page = blocks(html)
        labels = labelled(page)
        if labels is None or 1 not in labels:
            continue
        found.append((features(page), labels))
        articles.append([b.text for b, label in zip(page, labels) if label])
        others += [b.text for b, label in zip(page, labels) if not label] + articles[-1][1:3]
    articles += [rng.sample(SENTENCES, 5) for _ in range(60)]
    for article in articles:
        for _ in range(layouts):
            page, labels = _golden(dress(article[:40], others, rng))
            found.append(([[n for n in block if not n.startswith("word=") or rng.random() < WORDS_SEEN] for block in page], labels))
    return found


def _golden(html: str) -> tuple[list[list[str]], list[int]]:
    marked = html.replace(" data-gold", ' class="datagold"')
    labels = [int("word=datagold" in b.marks) for b in blocks(marked)]
    return features(blocks(html)), labels


def train(pages: DataFrame, sample: int = PAGES, page_chars: int = PAGE_CHARS, layouts: int = LAYOUTS) -> Field:
    """A field fitted on at most `sample` pages of `pages` (html) with at most `page_chars` characters."""
    fit_for = pages.select("html").where((F.length("html") > 0) & (F.length("html") <= page_chars))
    # The smallest digests, equal pages once: the same sample on every run.
    digest = F.sha2("html", 256)
    chosen = [r[0] for r in fit_for.select(digest.alias("digest")).distinct().orderBy("digest").limit(sample).collect()]
    some = fit_for.where(digest.isin(chosen)).dropDuplicates(["html"]).collect() if chosen else []
    return fit(training_pages(sorted(r.html for r in some), layouts))


# Extraction ---------------------------------------------------------------------------------


def main_text(html: str | None, model: Field) -> str:
    page = blocks(html)
    return "\n".join(b.text for b, label in zip(page, model.decode(features(page))) if label)


def extract(pages: DataFrame, model: Field) -> DataFrame:
    """The rows of `pages` (html) inside `ROW`, with their main `text` and `n_chars`, its code points."""
    shared = pages.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("string")
    def text_of(htmls: Iterator[pd.Series]) -> Iterator[pd.Series]:
        field_ = shared.value
        for series in htmls:
            yield pd.Series([main_text(h, field_) for h in series], dtype=object)

    rows = packed(pages).withColumn("text", text_of(F.col(f"{ROW}.html")))
    return rows.withColumn("n_chars", F.length("text").cast("long"))
