"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level tags (and double line breaks). The first pass decides blocks by length,
stop-word density, link density and the element that holds them; the second lets undecided short
blocks inherit the label of their nearest decided neighbours.

Element rules: scripts, styles and other markup never give text. Blocks inside navigation, footers, sidebars,
notices, adverts, forms and reader comments (by element, role, or a class or id whose words all say so) are boilerplate.
Where the page marks an article, blocks outside it are boilerplate as soon as it holds any text, and its
own blocks pass with lower demands; elsewhere the text features decide alone. An article that is boilerplate only by the class
or id of itself or of what holds it is doubtful: the longest of them is the article of the page if it is longer than
what is found without it (for reader comments: if nothing else is found).

Defined results: null or empty html gives the empty text. Broken markup (tags left open, stray ends, quotes
left open) is read to its end; elements that give no text but have no end are left at once, unless they are raw text. Repeated rows give repeated results; an empty table gives an empty result.
"""

from __future__ import annotations

import html as _html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Thresholds of the published two-pass rules (characters, shares).
LENGTH_LOW, LENGTH_HIGH = 70, 200
STOP_LOW, STOP_HIGH = 0.30, 0.32
MAX_LINK_DENSITY = 0.2
#: Inside a marked article a block goes only if it is mostly links.
ARTICLE_LINK_DENSITY = 0.6

# Frequent function words of English, German, French and Spanish.
STOP_WORDS = frozenset("""
the of and to in a is that for it as with by on be are this was at from or an not but have has he she they we you his her
der die das und ist nicht ein eine einer den dem des von zu mit für auf im auch sich als an bei nach aus wie es sie wir
le la les et des du un une est en que qui dans pour pas sur au aux avec ce se il elle nous vous ou par plus son sa
el los las y de del una por con para su al lo como más o pero sus le ya entre cuando muy sin sobre
""".split())

# HTML elements by their part in a page.
BLOCK_TAGS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre search section summary table tbody
td tfoot th thead tr ul""".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset("script style template textarea title svg math iframe object select button canvas audio video noscript datalist".split())
MAIN_TAGS = frozenset(["article", "main"])
#: Of these, what has no end takes the rest of the page.
OPEN_TAGS = frozenset("script style textarea title template".split())
NESTED_TAGS = frozenset("svg math".split())
# kind of boilerplate by element, by role and by a word of class or id
TAG_KINDS = {"nav": "menu", "menu": "menu", "footer": "footer", "aside": "side", "form": "form", "fieldset": "form", "dialog": "notice",
             "search": "form", "header": "header", "head": "head"}
ROLE_KINDS = {"navigation": "menu", "menu": "menu", "menubar": "menu", "banner": "header", "contentinfo": "footer",
              "complementary": "side", "search": "form", "form": "form", "dialog": "notice", "alertdialog": "notice", "alert": "notice"}
WORD_KINDS = {word: kind for kind, words in {
    "menu": "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager toc tabs toolbar skip",
    "header": "header masthead topbar",
    "footer": "footer copyright colophon bottombar legal",
    "side": "sidebar aside widget widgets related recommended recommendations teaser teasers trending popular rail",
    "notice": "cookie cookies consent gdpr notice banner alert popup modal overlay paywall disclaimer toast",
    "ad": "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion promoted outbrain taboola",
    "form": "form login signup signin subscribe subscription newsletter search",
    "comment": "comment comments commentlist reply replies disqus respond discussion guestbook",
    "share": "share sharing social",
}.items() for word in words.split()}
#: Words that may stand beside these in a class or id: footer-links is a footer, has-footer is not.
NEUTRAL_WORDS = frozenset("""site page main global primary secondary top bottom left right box bar block container wrapper wrap inner outer area
list item items section row col column link links body text title button panel content unit slot zone group holder the""".split())
#: Kinds that a marked article inside them overrides (they enclose it by accident or habit).
OVERRIDDEN = frozenset(["form", "ad", "notice", "header", "share"])

WORD = "~"

_TOKEN = re.compile(r"""<!--(?s:.*?)(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
                    r"""|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*(?:>|\Z)""")
_ATTR = re.compile(r"""([a-zA-Z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_WORDS = re.compile(r"[^\W\d_]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


@dataclass
class Block:
    text: str
    linked: int
    kind: str | None
    article: int
    heading: bool
    parent: int
    doubt: str | None = None
    label: str = field(default="")


def _word_kinds(value: str) -> list[str]:
    """Kinds that a class or id names. Each of its parts between spaces counts as a whole."""
    out = []
    for token in value.split():
        words = _WORDS.findall(_CAMEL.sub(" ", token).lower())
        if all(w in WORD_KINDS or w in NEUTRAL_WORDS for w in words):
            out += [WORD_KINDS[w] for w in words if w in WORD_KINDS]
    return out


def _kind(tag: str, attrs: str, in_article: bool) -> str | None:
    """Kind of boilerplate that an element marks, if any; with WORD before it if only class or id say so."""
    kind = TAG_KINDS.get(tag)
    if in_article and kind == "header":
        kind = None
    if kind or not attrs or "=" not in attrs and "hidden" not in attrs:
        return kind
    by_word = None
    for name, a, b, c in _ATTR.findall(attrs):
        value = a or b or c
        name = name.lower()
        if name == "role":
            kind = ROLE_KINDS.get(value.lower())
        elif name in ("class", "id") and tag not in ("body", "html"):
            by_word = by_word or next((WORD + k for k in _word_kinds(value) if not (in_article and k == "header")), None)
        elif name == "aria-hidden" and value.lower() == "true" or name == "style" and re.search(r"display\s*:\s*none", value):
            kind = "hidden"
        if kind:
            return kind
    return by_word


def blocks(page: str) -> list[Block]:
    """Text blocks of a page in order, with what the rules need to know of each."""
    out: list[Block] = []
    stack: list[tuple[str, str | None, int, int, str | None]] = []  # element, kind, article number, element number, doubt
    ends: dict[str, tuple[int, int]] = {}  # next end of a raw element
    pieces: list[str] = []
    linked = articles = number = breaks = 0

    def state() -> tuple[str | None, int, int]:
        return (stack[-1][1], stack[-1][2], next((n for t, _, _, n, _ in reversed(stack) if t in BLOCK_TAGS), 0)) if stack else (None, 0, 0)

    def close_block() -> None:
        nonlocal linked, breaks
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                kind, article, parent = state()
                heading = any(t in ("h1", "h2", "h3", "h4", "h5", "h6") for t, *_ in stack[-4:])
                out.append(Block(text, linked, kind, article, heading, parent, stack[-1][4] if stack else None))
            pieces.clear()
        linked = breaks = 0

    def add(text: str) -> None:
        nonlocal linked, breaks
        if "&" in text:
            text = _html.unescape(text)
        pieces.append(text)
        if not text.isspace():
            breaks = 0
            if any(t == "a" for t, *_ in stack):
                linked += len("".join(text.split()))

    at, n = 0, len(page)
    while at < n:
        m = _TOKEN.search(page, at)
        if m is None:
            add(page[at:])
            break
        if m.start() > at:
            add(page[at:m.start()])
        at = m.end()
        end, tag, attrs = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag:
            continue
        tag = tag.lower()
        if end:
            if tag in BLOCK_TAGS:
                close_block()
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    del stack[i:]
                    break
                if tag not in BLOCK_TAGS and stack[i][0] in BLOCK_TAGS:
                    break  # an inline end does not close blocks
            continue
        if tag in RAW_TAGS:
            if attrs.endswith("/"):
                continue
            if ends.get(tag, (-1, -1))[0] < at:
                stop = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
                ends[tag] = stop.span() if stop else (n + 1, n)
            begin, stop_at = ends[tag]
            if tag not in OPEN_TAGS and (begin > n or tag not in NESTED_TAGS and re.compile(rf"<{tag}\b", re.I).search(page, at, begin)):
                continue  # it has no end of its own
            at = stop_at
            continue
        if tag == "br":
            breaks += 1
            pieces.append(" ")
            if breaks >= 2:
                close_block()
            continue
        if tag in BLOCK_TAGS:
            close_block()
            same = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}.get(tag, ())
            for i in range(len(stack) - 1, -1, -1):
                t = stack[i][0]
                if t == "p" or t in same:
                    del stack[i:]
                    break
                if t in BLOCK_TAGS:
                    break
            if tag == "body":  # a head left open ends here
                stack[:] = [s for s in stack if s[0] != "head"]
        if tag in VOID_TAGS or attrs.endswith("/") and tag not in BLOCK_TAGS:
            continue
        if tag == "a":
            stack[:] = [s for s in stack if s[0] != "a"]
        kind, article, _ = state()
        if kind == "head" and tag in BLOCK_TAGS and tag != "head":
            kind = None
        number += 1
        own = _kind(tag, attrs, article > 0)
        doubt = stack[-1][4] if stack else None
        if tag in MAIN_TAGS:
            if kind and kind.removeprefix(WORD) in OVERRIDDEN:
                kind = None
            by_word = kind or own
            if not by_word or by_word[0] == WORD and (not own or own[0] == WORD):
                if by_word or not article:
                    articles += 1
                    article = articles
                doubt, kind, own = doubt or by_word, None, None
        if kind and kind[0] == WORD and own and own[0] != WORD:
            kind = own
        stack.append((tag, kind or own, article, number, doubt))
    close_block()
    return out


def _first_pass(b: Block) -> str:
    """good, bad, near (good if a neighbour is) or short (undecided)."""
    size = len(b.text)
    links = b.linked / max(1, len(b.text.replace(" ", "")))
    if b.kind or "\xa9" in b.text and not b.article or links > (ARTICLE_LINK_DENSITY if b.article else MAX_LINK_DENSITY):
        return "bad"
    if b.heading:
        return "short"
    if b.article and size >= LENGTH_LOW:
        return "good"
    if size < LENGTH_LOW:
        return "bad" if b.linked and not b.article else "short"
    words = [w.strip(".,;:!?\"'()").lower() for w in b.text.split()]
    stop = sum(w in STOP_WORDS for w in words) / len(words)
    if stop >= STOP_HIGH:
        return "good" if size > LENGTH_HIGH else "near"
    return "near" if stop >= STOP_LOW else "bad"


def classify(found: list[Block]) -> list[Block]:
    """Sets the labels (good or bad) by both passes, after settling what doubtful articles are."""
    sizes: dict[int, int] = {}
    for b in found:
        if b.doubt:
            sizes[b.article] = sizes.get(b.article, 0) + (len(b.text) if _first_pass(b) != "bad" else 0)
    _labels(found, 0)
    if any(sizes.values()):
        have = sum(len(b.text) for b in found if b.label == "good")
        comments = {b.article for b in found if b.doubt == WORD + "comment"}
        able = [a for a in sizes if sizes[a] > have and not (have and a in comments)]
        if able:
            _labels(found, max(able, key=lambda a: (a not in comments, sizes[a], -a)))
    return found


def _labels(found: list[Block], taken: int) -> None:
    """Labels where the doubtful article ``taken`` is the article, other doubtful ones are boilerplate; 0: all of these are."""
    for b in found:
        b.label = "bad" if (b.doubt or taken) and b.article != taken else _first_pass(b)
    marked = any(b.article and b.label in ("good", "near", "short") for b in found)
    if marked:
        for b in found:
            if not b.article:
                b.label = "bad"
    decided = [b.label for b in found]

    def neighbour(i: int, step: int, near_counts: bool) -> tuple[str, int]:
        """Label and distance of the nearest decided block; undecided ones and other regions are passed over."""
        j = i + step
        while 0 <= j < len(found):
            if found[j].article == found[i].article and not (found[i].article and found[j].label == "bad"):
                if found[j].label in ("good", "bad") or near_counts and found[j].label == "near":
                    return ("good" if found[j].label == "near" else found[j].label), abs(j - i)
            j += step
        return ("good" if found[i].article else "bad"), len(found)

    for i, b in enumerate(found):
        if b.label == "short":
            (before, near_b), (after, near_a) = neighbour(i, -1, True), neighbour(i, 1, True)
            if before == after:
                decided[i] = before
            elif b.heading:
                decided[i] = after  # a heading goes with what follows
            else:
                decided[i] = before if near_b < near_a else after if near_a < near_b else "bad"
        elif b.label == "near":
            decided[i] = "good" if "good" in (neighbour(i, -1, False)[0], neighbour(i, 1, False)[0]) else "bad"
    if not marked and "good" not in decided:  # no long prose anywhere: the middling blocks are the text
        decided = ["good" if b.label == "near" else d for b, d in zip(found, decided)]
    for b, d in zip(found, decided):
        b.label = d


def main_text(page: str | None) -> str:
    return "\n\n".join(b.text for b in classify(blocks(page)) if b.label == "good") if page else ""


def _texts(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(x.as_py()) for x in b.column(width)]
            yield pa.RecordBatch.from_arrays([*b.columns[:width], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                                             names=[*b.schema.names[:width], "text", "n_chars"])
    return run


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every row."""
    src = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("__html"))
    schema = src.drop("__html").schema.add("text", "string").add("n_chars", "long")
    return src.mapInArrow(_texts(2), schema)
