"""Main text of HTML pages by line-block distribution."""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

#: Lines of a window; a region surges where a window's sum reaches the lesser of that share of the page's
#: greatest sum and so many characters.
WINDOW, SURGE, SURGE_CHARS = 3, 0.2, 80
#: An element that marks or a form tag leave out is text after all if it has at least so many characters
#: and those left without it are less than that share of them.
WRAPPER_CHARS, WRAPPER_REST = 200, 0.1

#: Elements without text of their own, elements that are never article text, elements
#: that hold an article, and elements that begin and end a block.
RAW = ("script", "style", "noscript", "template", "textarea", "select", "iframe", "svg", "math", "object", "title", "head")
SKIPPED = ("nav", "aside", "footer", "form", "button", "dialog", "menu", "header")
EDGES = ("nav", "footer", "dialog", "menu", "header")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
MAIN = ("article", "main")
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Words in a class, id or role that mark what is not article text.
MARKS = (
    "ad ads adv advert advertisement advertising adsense banner sponsor sponsored promo promotion popup modal overlay cookie cookies consent gdpr notice notices alert "
    "nav navbar navigation menu breadcrumb breadcrumbs pagination pager sidebar aside footer masthead topbar toolbar comment comments commentlist disqus respond reply "
    "replies related recommended share sharing social newsletter subscribe subscription signup login search widget widgets contentinfo complementary"
).split()

#: Words that mark an article or main element too, elements whose id may mark them, and
#: words that a marking class or id may have besides (comments-open and notice-of-death mark nothing).
COMMENT = frozenset("comment comments commentlist".split())
HOLDERS = frozenset("div section ul ol dl table fieldset details figure center nav aside header footer".split())
PLACES = frozenset(
    "area article bar block blog body bottom box button buttons center col column container div element entry footer form global google group header holder inner item items js left "
    "link links list main mobile desktop outer page panel post posts primary right row section secondary site slot thread top unit wp wrapper wrap zone".split()
)
#: An opening tag ends an open element of the first kind unless one of the second is nearer.
IMPLIED = {
    "li": (("li",), ("ul", "ol", "menu", "dir")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")), "option": (("option",), ()),
}

_MARKS = frozenset(MARKS)
_RAW = "|".join(RAW)
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(?P<raw>{_RAW})\b(?:\"[^\"]*\"|'[^']*'|[^'\">])*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<more>(?:\"[^\"]*\"|'[^']*'|[^'\">])*)>|<[/!?a-zA-Z][^<>]*\Z",
    re.S | re.I,
)
_ATTR = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_SPLIT = re.compile(r"[_-]+")
_NONE = re.compile(r"display\s*:\s*none", re.I)
_SPACE = re.compile(r"\s+")
#: In an a tag: a place to link to, not a link; such tags are often left open.
_TARGET = re.compile(r"(?!.*\bhref\b).*\b(?:name|id)\s*=", re.S | re.I)
_WORD = re.compile(r"\w")


def _says(name: str, words: list[str], tag: str) -> bool:
    """Whether the words of one class, id or role say that an element of that tag is no article text."""
    if name == "role" and tag not in MAIN:
        return any(w in _MARKS for w in words)
    if tag in MAIN:
        return any(w in COMMENT for w in words) and not any(w in ("has", "no", "with", "without") for w in words)
    if name == "id" and tag not in HOLDERS:
        return False
    # a mark among words of other kinds tells of a layout, a state or a subject
    return any(w in _MARKS for w in words) and all(w in _MARKS or w in PLACES or w.isdigit() for w in words)


def _marked(tag: str, more: str) -> int:
    """0, 1 for an element whose class, id or role marks it as no article text, 2 for a hidden one."""
    if not more or more.isspace():
        return 0
    for name, a, b, c in _ATTR.findall(more):
        name, value = name.lower(), a or b or c
        if name == "hidden" or (name == "aria-hidden" and value.strip().lower() == "true") or (name == "style" and _NONE.search(value)):
            return 2
        if name in ("class", "id", "role"):
            for own in value.lower().split():
                if name == "class" and own == "hidden":
                    return 2
                if _says(name, [w for w in _SPLIT.split(own) if w], tag):
                    return 1
    return 0


class _Blocks:
    """The blocks of a page with where they stand: which left-out elements hold them, and whether an
    article does. Tags that are never closed end as their successors imply."""

    def __init__(self, page: str):
        #: text, characters outside links (0 for links and signs alone), article (0 none, 1 inside a left-out element, 2 else), holders
        self.blocks: list[tuple[str, int, int, tuple[int, ...]]] = []
        self.parts: list[str] = []
        self.plain, self.links, self.words, self.linked = 0, False, False, False
        self.stack: list[tuple[str, int, bool]] = []  # tag, holder or -1, article
        self.wrappers: list[bool] = []  # of each holder: may it turn out to be text
        self.dropped = 0  # open inline elements whose text goes
        self.article, self.holders = 0, ()
        at = 0
        for m in _TOKEN.finditer(page):
            if m.start() > at:
                self.add(page[at : m.start()])
            at = m.end()
            tag = (m["tag"] or "").lower()
            if not tag:
                if m["raw"]:
                    self.parts.append(" ")
            elif m["end"]:
                self.ends(tag)
            else:
                self.starts(tag, m["more"])
        self.add(page[at:])
        self.close()

    def add(self, own: str) -> None:
        if self.dropped or not own:
            return
        self.parts.append(own)
        if self.linked:
            self.links = True
        else:
            self.plain += len(own.strip())
            self.words = self.words or bool(_WORD.search(html.unescape(own)))

    def close(self) -> None:
        if self.parts:
            text = _SPACE.sub(" ", html.unescape("".join(self.parts))).strip()
            if text:
                self.blocks.append((text, 0 if self.links and not self.words else self.plain, self.article, self.holders))
            self.parts = []
        self.plain, self.links, self.words = 0, False, False

    def stands(self) -> None:
        """Article and holders from the open elements: an article counts anew, whatever holds it."""
        own = [(h, art) for _, h, art in self.stack if h >= 0 or art]
        last = max((i for i, (_, art) in enumerate(own) if art), default=-1)
        self.article = 0 if last < 0 else 1 if any(h >= 0 for h, _ in own[:last]) else 2
        self.holders = tuple(h for h, _ in own[last + 1 :] if h >= 0)

    def pop(self, n: int) -> None:
        gone = self.stack[n:]
        del self.stack[n:]
        self.dropped -= sum(h == -2 for _, h, _ in gone)
        if any(h >= 0 or art for _, h, art in gone):
            self.stands()

    def nearest(self, tags, stop) -> int:
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] in tags:
                return i
            if self.stack[i][0] in stop or self.stack[i][2]:
                return -1
        return -1

    def starts(self, tag: str, more: str) -> None:
        if tag == "br":
            self.add(" ")
            return
        block = tag in BLOCKS
        if block:
            self.close()
            i = self.nearest(("p",), BLOCKS - {"p"})
            if i >= 0:
                self.pop(i)
            if tag in IMPLIED:
                i = self.nearest(*IMPLIED[tag])
                if i >= 0:
                    self.pop(i)
        elif tag == "a":
            self.linked = not _TARGET.match(more)
        if tag in VOID or more.rstrip().endswith("/") or tag in ("body", "html"):
            return
        mark = _marked(tag, more)
        if not block:
            if mark or tag == "button":
                self.stack.append((tag, -2, False))
                self.dropped += 1
            return
        apart = tag in SKIPPED and not (tag == "header" and self.article)
        holder = -1
        if apart or mark:
            holder = len(self.wrappers)
            self.wrappers.append(tag not in EDGES and tag != "aside" and mark < 2 and not any(w in COMMENT for w in _SPLIT.split(re.sub(r"\W+", "-", more.lower()))))
            if tag in EDGES and not self.article:
                self.blocks.append(("", 0, 0, ()))
        self.stack.append((tag, holder, tag in MAIN and not mark))
        if holder >= 0 or tag in MAIN:
            self.stands()

    def ends(self, tag: str) -> None:
        if tag == "a":
            self.linked = False
        if tag in BLOCKS:
            self.close()
            i = self.nearest((tag,), ()) if tag not in MAIN else max((i for i, e in enumerate(self.stack) if e[0] == tag), default=-1)
        elif self.dropped:
            i = self.nearest((tag,), BLOCKS)
        else:
            return
        if i >= 0:
            self.pop(i)


def lines_of(page: str) -> list[tuple[str, int]]:
    """(text, weight) of the blocks that may be main text, in order; WINDOW empty lines stand where the
    page's navigation, headers and footers stood.

    Menus, forms, adverts, hidden and otherwise marked elements are left out, but for a marked wrapper
    or form that holds nearly all text. Where an article holds words outside links, what stands outside
    articles is left out too. The weight is the characters outside links, inside an article all."""
    own = _Blocks(page)
    held = [0] * len(own.wrappers)
    rest = 0
    for _, plain, _, holders in own.blocks:
        rest += 0 if holders else plain
        for h in holders:
            held[h] += plain
    text = {h for h, n in enumerate(held) if own.wrappers[h] and n >= WRAPPER_CHARS and rest < WRAPPER_REST * n}
    free = [b for b in own.blocks if all(h in text for h in b[3])]
    found = {art for _, plain, art, _ in free if art and plain}
    if found:
        free = [b for b in free if b[2] == max(found)]
    lines: list[tuple[str, int]] = []
    for t, plain, art, _ in free:
        if t:
            lines.append((t, len(t) if art else plain))
        elif lines and lines[-1][0]:
            lines += [("", 0)] * WINDOW
    return lines


def main_text(page: str, window: int = WINDOW, surge: float = SURGE, surge_chars: int = SURGE_CHARS) -> str:
    """The blocks of the page's main text, joined by line ends.

    Each line's sum runs over its window of lines. A region of sums above zero is a surge if its
    greatest reaches the lesser of surge times the page's greatest and surge_chars; it dives where the
    sums fall to nothing. Every line between the first surge's and the last dive's is main text, however
    short and links or not; lines of weaker regions and of links before and behind are not.
    """
    lines = lines_of(page)
    weights = [w for _, w in lines]
    sums = [sum(weights[i : i + window]) for i in range(len(lines))]
    least = min(surge * max(sums, default=0), surge_chars)
    first = last = None
    start = peak = 0
    for i, s in enumerate([*sums, 0]):
        if s:
            peak = max(peak, s)
            continue
        if peak and peak >= least:
            first = start if first is None else first
            last = i
        start, peak = i + 1, 0
    if first is None:
        return ""
    text = [i for i in range(first, last) if weights[i]]
    return "\n".join(t for t, _ in lines[text[0] : text[-1] + 1] if t)


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """The main text of every page: page_id, url, text, n_chars (code points).

    Null and empty pages, and pages without such text, give an empty text. Rows are independent:
    repeated rows, null ids and urls, and other columns (ignored) need no rule. No shuffle.
    """

    def run(batches):
        for part in slices(batches, "html"):
            text = [main_text(h) if h else "" for h in part.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())], ["page_id", "url", "text", "n_chars"]
            )

    own = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return own.mapInArrow(run, "page_id long, url string, text string, n_chars long")
