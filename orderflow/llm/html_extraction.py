"""Main text of web pages by tree scoring.

A page is read into a tree of elements. Scripts, styles, hidden parts and elements that are by tag or
role a menu, header, footer or sidebar are left out with all they hold. Forms, and elements whose
class or id speaks of notices, adverts or reader comments, are only suspects: they are left out too,
unless the article itself lies in them. Each remaining paragraph has points for its length
and commas; its parent gets all of them, the next ancestor half, the one above a quarter
and so on. An element's points are lessened by the share of its text that stands in links. The
element with the most points is the article; of its siblings, headings and those with a fair share
of its points stay too.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .workers import map_batches

# Names of elements and of classes with a known part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
DROPPED = frozenset(
    "aside audio button canvas dialog footer head header iframe menu nav noscript object "
    "script select style svg template textarea title video".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre "
    "section summary table tbody td tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PARAGRAPHS = HEADINGS | frozenset("blockquote dd dt figcaption li p pre td th".split())
ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split()
)
NEVER_TEXT = frozenset(
    "ad ads advert advertisement advertising adverts comment comments consent cookie cookies disqus "
    "login modal newsletter outbrain paywall popup promo promoted promotion recommendations "
    "recommended related respond share sharing shoutbox signup social sponsor sponsored subscribe "
    "subscription taboola toolbar".split()
)
SELDOM_TEXT = frozenset(
    "alert aside banner breadcrumb breadcrumbs footer header masthead menu nav navbar navigation "
    "notice notification pager pagination rail sidebar sidenav skip topbar widget".split()
)
LIKELY_TEXT = frozenset("article body column content entry main post story text".split())
#: What closes an open element of the same row, list or paragraph when it begins.
SIBLINGS = {"li": "li", "td": "td th", "th": "td th", "tr": "tr td th", "dt": "dt dd", "dd": "dt dd", "option": "option"}

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*'|["'])*+)>""", re.DOTALL
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


@dataclass
class Element:
    tag: str
    parent: int
    dropped: bool
    suspect: bool = False
    named: bool = False
    points: float = 0.0
    chars: int = 0
    linked: int = 0
    children: list[int] = field(default_factory=list)


def _attributes(written: str) -> dict[str, str]:
    return {
        m[1].lower(): m[2] if m[2] is not None else m[3] if m[3] is not None else m[4] or ""
        for m in _ATTRIBUTE.finditer(written)
    }


def _out(tag: str, attributes: dict[str, str], inside_article: bool) -> bool:
    """Whether an element is no part of an article, by its tag, its role or since it is hidden."""
    if tag in DROPPED and not (tag == "header" and inside_article):
        return True
    if not attributes or tag in ("html", "body", "article", "main"):
        return False
    if "hidden" in attributes or attributes.get("aria-hidden") == "true" or attributes.get("role", "").lower() in ROLES:
        return True
    return bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attributes.get("style", "")))


def _suspect(tag: str, attributes: dict[str, str]) -> tuple[bool, bool]:
    """Whether an element may be no part of an article, and whether a whole name of it says so."""
    if tag == "form":
        return True, False
    if tag in ("html", "body", "article", "main"):
        return False, False
    named = f"{attributes.get('class', '')} {attributes.get('id', '')}"
    words = {w.lower() for w in _NAME.findall(named)}
    suspect = bool(words & NEVER_TEXT) or bool(words & SELDOM_TEXT) and not words & LIKELY_TEXT
    return suspect, suspect and any(n.lower() in NEVER_TEXT | SELDOM_TEXT for n in named.split())


class Page:
    """Elements of a page and its blocks of text, in order."""

    def __init__(self, source: str):
        self.elements = [Element("", -1, False)]
        self.blocks: list[tuple[int, str, int]] = []
        self.open = [0]
        self.open_tags = Counter([""])
        self.buffer: list[str] = []
        self.links = self.in_link = 0
        self._read(source)
        self._flush()
        self._leave_suspects_out()
        self._score()

    def _read(self, source: str) -> None:
        at, last = 0, source.rfind(">")
        while at <= last and (tag := _TAG.search(source, at)) is not None:
            self._text(source[at : tag.start()])
            at = tag.end()
            name = (tag[2] or "").lower()
            if not name:
                continue
            if tag[1]:
                self._close(name)
                continue
            self._begin(name, tag[3])
            if name in RAW:
                end = re.compile(rf"</{re.escape(name)}[^>]*>", re.IGNORECASE).search(source, at)
                at = end.end() if end else len(source)
                self._close(name)
        self._text(source[at:].partition("<!--")[0])

    def _text(self, text: str) -> None:
        if text and not self.elements[self.open[-1]].dropped:
            text = html.unescape(text) if "&" in text else text
            self.buffer.append(text)
            if self.in_link:
                self.links += len(text)

    def _begin(self, name: str, written: str) -> None:
        if name in BLOCKS:
            self._flush()
            self._close_open_paragraph()
        elif name == "br":
            self._text(" ")
        if name in SIBLINGS:
            self._close_sibling(SIBLINGS[name].split())
        if name in VOID:
            return
        above = self.open[-1]
        up = self.elements[above]
        inside = bool(self.open_tags["article"] or self.open_tags["main"])
        attributes = _attributes(written) if written.strip() else {}
        dropped = up.dropped or _out(name, attributes, inside)
        self.elements.append(Element(name, above, dropped, *_suspect(name, attributes)))
        here = len(self.elements) - 1
        up.children.append(here)
        self.open.append(here)
        self.open_tags[name] += 1
        self.in_link += name == "a"

    def _close_open_paragraph(self) -> None:
        for k in reversed(self.open):
            tag = self.elements[k].tag
            if tag == "p":
                self._close("p")
                return
            if tag in BLOCKS:
                return

    def _close_sibling(self, names: list[str]) -> None:
        for k in reversed(self.open):
            tag = self.elements[k].tag
            if tag in names:
                self._close(tag)
                return
            if tag in ("ul", "ol", "dl", "table", "select", "menu"):
                return

    def _close(self, name: str) -> None:
        if not self.open_tags[name]:
            return
        if name in BLOCKS:
            self._flush()
        while True:
            tag = self.elements[self.open.pop()].tag
            self.open_tags[tag] -= 1
            self.in_link -= tag == "a"
            if tag == name:
                return

    def _flush(self) -> None:
        """End the block of text read so far."""
        text = " ".join("".join(self.buffer).split())
        linked, self.links = min(self.links, len(text)), 0
        self.buffer = []
        if text:
            at = next((k for k in reversed(self.open) if self.elements[k].tag in BLOCKS), 0)
            self.blocks.append((at, text, linked))

    def _leave_suspects_out(self) -> None:
        """Drop suspects, but for those in which the article itself lies.

        One that holds most of the page's text and the first heading or element named an article is a
        wrapper of the page. So is one that holds nearly all text, if only a part of a name is suspect.
        """
        chars = [0] * len(self.elements)
        for at, text, _ in self.blocks:
            chars[at] += len(text)
        total = sum(chars)
        for k in range(len(self.elements) - 1, 0, -1):  # children come after their parents
            chars[self.elements[k].parent] += chars[k]
        shown = (k for k, one in enumerate(self.elements) if not one.dropped and one.tag in ("h1", "article", "main"))
        around, up = set(), next(shown, -1)
        while up >= 0:
            around.add(up)
            up = self.elements[up].parent
        for k, one in enumerate(self.elements):
            wrapper = k in around and 2 * chars[k] > total or not one.named and 5 * chars[k] > 4 * total
            one.dropped = one.dropped or one.suspect and not wrapper
            one.dropped = one.dropped or k > 0 and self.elements[one.parent].dropped
        self.blocks = [block for block in self.blocks if not self.elements[block[0]].dropped]

    def _score(self) -> None:
        """Give the points of each block to what holds it, and halves of them further up."""
        for at, text, linked in self.blocks:
            here = self.elements[at]
            here.chars += len(text)
            here.linked += linked
            if here.tag not in HEADINGS:
                up = here.parent if here.tag in PARAGRAPHS else at
                self.elements[up].points += 1 + text.count(",") + min(len(text) / 100, 3)
        for k in range(len(self.elements) - 1, 0, -1):  # children come after their parents
            one = self.elements[k]
            up = self.elements[one.parent]
            up.chars += one.chars
            up.linked += one.linked
            up.points += one.points / 2

    def worth(self, k: int) -> float:
        one = self.elements[k]
        return one.points * (1 - one.linked / one.chars) if one.chars else 0.0

    def article(self) -> set[int]:
        """The elements whose text is the article's, with all below them."""
        best = max(range(len(self.elements)), key=lambda k: (self.worth(k), -k))
        up = best
        while up >= 0:  # an element that is named an article holds all of it
            if self.elements[up].tag in ("article", "main"):
                best = up
                if self.elements[up].tag == "article":
                    break
            up = self.elements[up].parent
        parent, least = self.elements[best].parent, 0.2 * self.worth(best)
        chosen = {best}
        for k in self.elements[parent].children if parent >= 0 else ():
            one = self.elements[k]
            plain = one.chars and one.linked / one.chars < 0.25
            if self.elements[best].tag in ("article", "main"):
                fair = one.tag == self.elements[best].tag and self.worth(k) >= least
            else:
                fair = self.worth(k) >= least or one.tag == "p" and one.chars > 80
            if plain and (fair or one.tag in HEADINGS):
                chosen.add(k)
        return chosen

    def text(self) -> str:
        if not self.blocks:
            return ""
        inside: dict[int, bool] = {-1: False}
        chosen = self.article()
        for k, one in enumerate(self.elements):  # parents come before children
            inside[k] = k in chosen or inside[one.parent]
        return " ".join(text for k, text, _ in self.blocks if inside[k])


def main_text(source: str | None) -> str:
    """The main text of one page; empty for a null, empty or text-less page."""
    return Page(source).text() if source else ""


def extract(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per row: page_id, url, text, from the whole page.

    Cases: null and empty html give the empty text; pages may be broken anywhere and of any
    length; of elements with equal points the first in the page is taken; repeated rows are each
    answered; null ids and urls stay null. Other columns are not looked at.
    """

    def run(batches):
        for batch in batches:
            for low in range(0, len(batch), 500):
                part = batch.slice(low, 500)
                texts = [main_text(source) for source in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string())],
                    names=["page_id", "url", "text"],
                )

    given = pages.select(
        F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html")
    )
    return map_batches(given, run, "page_id bigint, url string, text string")
