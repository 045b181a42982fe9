"""Main text of web pages by tree scoring.

Each page is read into a tree in which broken nesting is closed as browsers do.
Navigation, notices, adverts, forms and the like go by their tags, roles and
names. Every paragraph then passes points for its length and its commas to its
ancestors, fewer with each level; a container's sum is discounted by the share of its
text that is link text. The best container is kept, and those of its siblings that
score well or read like paragraphs. A page is one row of one task: no shuffle.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import map_arrow

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z_:-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|(\bhidden\b)")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

# Kinds of elements and the names by which page furniture goes.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript iframe template xmp noembed noframes".split())
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure"
    " footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary"
    " table tbody td tfoot th thead tr ul".split()
)
DROPPED = RAW | set(
    "head nav header footer aside form button select option input svg canvas object audio video dialog menu".split()
)
ROLES = set("navigation banner contentinfo complementary search dialog alert menu menubar form".split())
FURNITURE = set(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs consent cookie cookies footer"
    " gdpr header menu modal nav navbar navigation newsletter notice notices notification overlay pagination pager"
    " popup promo promoted promotion related recommended share sharing sidebar signup social sponsor sponsored"
    " subscribe subscription toolbar widget".split()
)
TALK = set("comment comments commentlist disqus discussion respond replies".split())
CLOSED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
HOLDS = {
    "li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table", "tbody", "thead", "tfoot"},
    "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"},
}
WEIGHTS = {"article": 25, "main": 25, "section": 5, "div": 5, "pre": 3, "td": 3, "blockquote": 3, "body": 0}


class _Tree:
    """Elements by number, parents before children, and the text in page order."""

    def __init__(self) -> None:
        self.tags, self.parents, self.attributes = ["#page"], [-1], [""]
        self.texts: list[tuple[int, str | None]] = []  # None where a block begins or ends

    def read(self, page: str) -> None:
        stack, at, find, closing = [0], 0, _TOKEN.search, {}
        while token := find(page, at):
            if token.start() > at:
                self.texts.append((stack[-1], html.unescape(page[at : token.start()])))
            at = token.end()
            if not token[2]:
                continue
            tag = token[2].lower()
            if token[1]:
                self._close(stack, tag)
                continue
            if tag in BLOCKS:
                self._close_open(stack, {"p"}, {"button", "td", "th", "table", "article", "section", "div"})
            if tag in CLOSED_BY:
                self._close_open(stack, CLOSED_BY[tag], HOLDS[tag])
            if tag in BLOCKS or tag == "br":
                self.texts.append((stack[-1], None))
            if tag in VOID:
                continue
            self.tags.append(tag)
            self.parents.append(stack[-1])
            self.attributes.append(token[3])
            if tag in RAW:
                if tag not in closing:
                    closing[tag] = re.compile(rf"</{tag}[^>]*(?:>|\Z)", re.I)
                end = closing[tag].search(page, at)
                at = end.end() if end else len(page)
            else:
                stack.append(len(self.tags) - 1)
        if at < len(page):
            self.texts.append((stack[-1], html.unescape(page[at:])))

    def _close(self, stack: list[int], tag: str) -> None:
        for depth in range(len(stack) - 1, 0, -1):
            if self.tags[stack[depth]] == tag:
                if tag in BLOCKS:
                    self.texts.append((stack[depth], None))
                del stack[depth:]
                return
            if self.tags[stack[depth]] in ("article", "body") and tag not in BLOCKS:
                return

    def _close_open(self, stack: list[int], closed: set[str], stop: set[str]) -> None:
        for depth in range(len(stack) - 1, 0, -1):
            if self.tags[stack[depth]] in closed:
                del stack[depth:]
                return
            if self.tags[stack[depth]] in stop:
                return


def _furniture(tree: _Tree) -> list[bool]:
    """Which elements go, themselves or with one that they stand in."""
    n = len(tree.tags)
    holds_main = [tag in ("article", "main", "h1", "body") for tag in tree.tags]
    for i in range(n - 1, 0, -1):
        if holds_main[i]:
            holds_main[tree.parents[i]] = True
    gone = [False] * n
    for i in range(1, n):
        if gone[tree.parents[i]] or tree.tags[i] in DROPPED:
            gone[i] = True
        elif tree.attributes[i] and not tree.attributes[i].isspace():
            told: dict[str, str] = {}
            for name, *values in _ATTRIBUTE.findall(tree.attributes[i]):
                told.setdefault((name or "hidden").lower(), "".join(values))
            names = {w.lower() for k in ("class", "id") for w in _NAME.findall(told.get(k, ""))}
            gone[i] = (
                bool(names & TALK and tree.tags[i] not in ("body", "html"))
                or "hidden" in told
                or told.get("aria-hidden") == "true"
                or re.search(r"display\s*:\s*none", told.get("style", "")) is not None
                or not holds_main[i]
                and (bool(names & FURNITURE) or told.get("role", "").lower() in ROLES)
            )
    return gone


def _article(tree: _Tree, best: int, density: list[float]) -> int:
    """The outermost article around ``best``, else the outermost main, that is not mostly links."""
    found = {"article": best, "main": best}
    at = best
    while at > 0:
        if tree.tags[at] in found and density[at] <= 0.5:
            found[tree.tags[at]] = at
        at = tree.parents[at]
    return found["article"] if found["article"] != best or tree.tags[best] == "article" else found["main"]


def main_text(page: str | None) -> str:
    """The main text of one page, blocks joined by single spaces; empty if there is none."""
    tree = _Tree()
    tree.read(page or "")
    n, parents, tags = len(tree.tags), tree.parents, tree.tags
    gone = _furniture(tree)
    linked = [False] * n
    block = [0] * n
    for i in range(1, n):
        linked[i] = linked[parents[i]] or tags[i] == "a"
        block[i] = i if tags[i] in BLOCKS else block[parents[i]]
    own, commas, length, links = [0] * n, [0] * n, [0] * n, [0] * n
    for i, text in tree.texts:
        if text and not gone[i]:
            size = len(" ".join(text.split()))
            own[block[i]] += size
            commas[block[i]] += text.count(",")
            length[i] += size
            links[i] += size * linked[i]
    score = [0.0] * n
    for i in range(n):
        if own[i]:
            points = 1 + commas[i] + min(own[i] / 100, 3)
            # A block that holds its text itself is a container, too.
            at, level = (i if tags[i] in WEIGHTS or i == 0 else parents[i]), 0
            while at >= 0 and level < 6:
                score[at] += points / (1, 2, 6, 9, 12, 15)[level]
                at, level = parents[at], level + 1
    for i in range(n - 1, 0, -1):
        length[parents[i]] += length[i]
        links[parents[i]] += links[i]
    density = [links[i] / length[i] if length[i] else 0.0 for i in range(n)]
    for i in range(n):
        if score[i]:
            score[i] = (score[i] + WEIGHTS.get(tags[i], 0)) * (1 - density[i])
    candidates = [i for i in range(n) if score[i] > 0 and not gone[i]]
    if not candidates:
        return ""
    best = max(candidates, key=lambda i: (score[i], -i))
    kept = [False] * n
    top = _article(tree, best, density)
    kept[top] = True
    around, at = {best}, best  # and what stands between it and the article
    while at != top:
        at = parents[at]
        around.add(at)
    for i in range(1, n):
        if parents[i] == parents[top] and not gone[i]:
            reads = tags[i] == "p" and density[i] < 0.25 and length[i] > 80
            kept[i] = kept[i] or score[i] >= max(10, 0.2 * score[best]) or reads
        # Lists of links inside the container are menus.
        menu = tags[i] in ("ul", "ol", "div", "section") and links[i] > 0 and density[i] > 0.5
        gone[i] = gone[i] or gone[parents[i]] or menu and i not in around
        kept[i] = (kept[i] or kept[parents[i]]) and not gone[i]
    parts = []
    for i, text in tree.texts:
        if text is None:
            parts.append(" ")
        elif kept[i]:
            parts.append(text)
    return " ".join("".join(parts).split())


def extract(pages: DataFrame, *, html_column: str = "html", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (all of ``page_id, url``) with the page's main ``text``, one row per row of ``pages``.

    A null or empty page has an empty text. Repeated rows each give theirs; further
    columns are passed over, whatever their names.
    """
    keep = ["page_id", "url"] if keep is None else keep
    rows = pages.select(*keep, F.col(html_column).alias("_html"))
    schema = rows.drop("_html").schema.add("text", "string")

    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(page.as_py()) for page in batch.column("_html")]
        columns = [batch.column(name) for name in keep]
        return pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], [*keep, "text"])

    return map_arrow(rows, of, schema)
