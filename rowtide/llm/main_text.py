"""The main text of a web page by scoring its tree.

Every paragraph earns points for its length and its commas and passes them to its ancestors,
fewer the farther they are; an ancestor's points are discounted by the share of its text
that is links. The best container is taken, widened to the article it lies in, with
those of its siblings that score well themselves; without an article, with all siblings that are plain text. Menus, headers, footers, sidebars,
notices, adverts, forms, scripts, styles and reader comments are left out of it.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rowtide.llm.common import without

# Elements by what HTML says of them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td "
    "tfoot th thead title tr ul".split()
)
# A start tag of these closes an open paragraph.
CLOSES_P = BLOCKS - frozenset("br caption body head html legend option tbody td tfoot th thead title tr".split())
# A start tag closes an open element of its group, within the nearest element of the scope.
IMPLIED = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu", "dir"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr", "td", "th"]), frozenset(["table", "tbody", "thead", "tfoot"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "option": (frozenset(["option"]), frozenset(["select", "datalist"])),
}

# Elements that are never main text.
DROPPED = frozenset(
    "script style noscript template head title nav header footer aside form button input select option textarea iframe object embed "
    "svg canvas audio video map menu dialog noembed noframes".split()
)
# Words of a class, id or role that say the same.
DROPPED_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsense sponsor sponsored sponsors promo promoted promotion "
    "banner cookie cookies consent gdpr notice notices alert popup modal overlay dialog nav navbar navigation menu submenu "
    "breadcrumb breadcrumbs sidebar complementary footer contentinfo header masthead share sharing social related recommended "
    "recommendations newsletter subscribe subscription signup login search widget pagination pager toolbar".split()
)
COMMENT_WORDS = frozenset("comment comments commentlist disqus respond replies reply".split())
# Words that turn the others into a remark on layout.
LAYOUT_WORDS = frozenset("has with no without".split())
KEPT = frozenset("html body main article".split())

# Parts of tables, lists and text; a container is what holds them.
PARTS = frozenset("tr tbody thead tfoot td th table ul ol li dl dt dd p blockquote pre".split())
PARAGRAPHS = frozenset("p pre blockquote td li dd figcaption div section article main body".split())
LEAST_PARAGRAPH = 25

_QUOTE_OR_END = re.compile(r"[\"'>]")
_TAG = re.compile(r"[a-zA-Z][^\s/>\x00]*")
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


def _tag_end(page: str, at: int) -> int:
    """The place of the `>` that ends the tag; quoted values may hold others. -1: the tag is cut off."""
    while True:
        m = _QUOTE_OR_END.search(page, at)
        if not m:
            return -1
        if m[0] == ">":
            return m.start()
        at = m.end()
        if page[max(0, m.start() - 40) : m.start()].rstrip()[-1:] == "=":
            at = page.find(m[0], at) + 1
            if not at:
                return -1


class _Tree:
    """Elements in page order; each knows its parent. Texts are (element, text) in page order."""

    def __init__(self, page: str):
        self.tags, self.parents, self.attributes = ["html"], [-1], [""]
        self.texts: list[tuple[int, str]] = []
        self.open = [0]
        self.counts = {"html": 1}
        self._read(page)

    def _start(self, tag: str, attributes: str) -> None:
        if tag in ("html", "body") and self.counts.get(tag):
            return
        if tag in CLOSES_P and self.counts.get("p"):
            self._end("p")
        if tag in IMPLIED:
            group, scope = IMPLIED[tag]
            if any(self.counts.get(g) for g in group):
                for depth in range(len(self.open) - 1, 0, -1):
                    name = self.tags[self.open[depth]]
                    if name in scope:
                        break
                    if name in group:
                        self._close_from(depth)
                        if tag != "tr":
                            break
        self.tags.append(tag)
        self.parents.append(self.open[-1])
        self.attributes.append(attributes)
        node = len(self.tags) - 1
        if tag in BLOCKS:
            self.texts.append((node, " "))
        if tag not in VOID:
            self.open.append(node)
            self.counts[tag] = self.counts.get(tag, 0) + 1

    def _close_from(self, depth: int) -> None:
        for node in self.open[depth:]:
            self.counts[self.tags[node]] -= 1
        del self.open[depth:]

    def _end(self, tag: str) -> None:
        if tag == "html" or not self.counts.get(tag):
            return
        depth = len(self.open) - 1
        while self.tags[self.open[depth]] != tag:
            depth -= 1
        self._close_from(depth)
        if tag in BLOCKS:
            self.texts.append((self.open[-1], " "))

    def _text(self, text: str) -> None:
        if text:
            self.texts.append((self.open[-1], entities.unescape(text) if "&" in text else text))

    def _read(self, page: str) -> None:
        at, size = 0, len(page)
        while at < size:
            lt = page.find("<", at)
            if lt < 0:
                self._text(page[at:])
                return
            nxt = page[lt + 1 : lt + 2]
            if page.startswith("<!--", lt):
                self._text(page[at:lt])
                end = page.find("-->", lt + 4)
                at = size if end < 0 else end + 3
                if page.startswith(("<!-->", "<!--->"), lt):
                    at = page.index(">", lt) + 1
            elif nxt in ("!", "?"):
                self._text(page[at:lt])
                end = page.find(">", lt)
                at = size if end < 0 else end + 1
            elif nxt == "/" or nxt.isascii() and nxt.isalpha():
                self._text(page[at:lt])
                begin = lt + 1 + (nxt == "/")
                end = _tag_end(page, begin)
                if end < 0:  # cut off within a tag
                    return
                at = end + 1
                m = _TAG.match(page, begin, end)
                if not m:
                    continue
                tag = m[0].lower()
                if nxt == "/":
                    self._end(tag)
                    continue
                self._start(tag, page[m.end() : end])
                if tag in RAW:
                    stop = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(page, at)
                    if tag == "textarea" or tag == "title":
                        self._text(page[at : stop.start() if stop else size])
                    at = stop.start() if stop else size
            else:
                self._text(page[at : lt + 1])
                at = lt + 1


def _words(attributes: str) -> tuple[set[str], bool]:
    """The words of class, id and role, and whether the element is hidden."""
    words, hidden = set(), False
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name in ("class", "id", "role"):
            words.update(w.lower() for w in _WORD.findall(value))
        elif name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            hidden = True
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            hidden = True
    return words, hidden


def _is_dropped(tag: str, attributes: str, holds_article: bool) -> bool:
    if tag in DROPPED:
        return True
    if not attributes or tag in ("html", "body"):
        return False
    words, hidden = _words(attributes)
    if hidden or words & COMMENT_WORDS and not holds_article:
        return True
    return tag not in KEPT and not holds_article and bool(words & DROPPED_WORDS) and not words & LAYOUT_WORDS


def main_text(page: str) -> str:
    """The page's main text: blocks in page order, single spaces; empty if there is none."""
    tree = _Tree(page)
    tags, parents, n = tree.tags, tree.parents, len(tree.tags)
    holds_article = [False] * n
    for i in range(n - 1, 0, -1):
        if tags[i] in ("article", "main") and not _words(tree.attributes[i])[0] & COMMENT_WORDS or holds_article[i]:
            holds_article[parents[i]] = True
    dropped = [False] * n
    for i in range(1, n):
        dropped[i] = dropped[parents[i]] or _is_dropped(tags[i], tree.attributes[i], holds_article[i])

    in_link = [False] * n
    own = [0] * n  # characters of the text whose nearest paragraph this is
    commas, total, linked = [0] * n, [0] * n, [0] * n
    nearest = list(range(n))
    for i in range(1, n):
        in_link[i] = in_link[parents[i]] or tags[i] == "a"
        nearest[i] = i if tags[i] in PARAGRAPHS else nearest[parents[i]]
    for node, text in tree.texts:
        if not dropped[node] and not text.isspace():
            size = len(text.strip())
            total[node] += size
            linked[node] += size * in_link[node]
            if not in_link[node]:
                own[nearest[node]] += size
                commas[nearest[node]] += text.count(",")
    for i in range(n - 1, 0, -1):
        total[parents[i]] += total[i]
        linked[parents[i]] += linked[i]

    # Link lists without a name are menus, too.
    links = [0] * n
    for i in range(n - 1, 0, -1):
        links[i] += tags[i] == "a"
        links[parents[i]] += links[i]
    for i in range(1, n):
        menu = tags[i] in ("ul", "ol", "div", "p", "section", "table") and links[i] >= 3 and linked[i] >= 0.9 * total[i]
        dropped[i] = dropped[i] or dropped[parents[i]] or menu and total[i] < 0.5 * total[0]

    score = [0.0] * n
    for i in range(n):
        if own[i] >= LEAST_PARAGRAPH and not dropped[i]:
            points, up, level = 1 + commas[i] + min(own[i] / 100, 3), parents[i], 1
            while up >= 0 and level <= 5:
                score[up] += points / level
                up, level = parents[up], level * 2 if level < 2 else level + 1
    for i in range(n):
        if score[i]:
            score[i] *= 1 - linked[i] / max(total[i], 1)

    best = max(range(n), key=lambda i: (score[i], -i))
    if not score[best]:  # no paragraph of any length: the article, or all
        best = next((i for i in range(n) if tags[i] in ("article", "main") and not dropped[i]), 0)
    while tags[best] in PARTS and best:
        best = parents[best]
    up = best
    while up > 0:
        if tags[up] in ("article", "main"):
            best = up
            break
        up = parents[up]
    chosen = {best}
    if best:
        enough = max(3.0, 0.2 * score[best])
        marked = tags[best] in ("article", "main")
        for i in range(1, n):
            if parents[i] == parents[best] and not dropped[i]:
                dense = linked[i] / max(total[i], 1)
                # Beside a marked article only what reads like one; else all plain text: titles, leads, short sections.
                if score[i] >= enough or marked and tags[i] == "p" and own[i] > 80 and dense < 0.25 or not marked and total[i] and dense < 0.5:
                    chosen.add(i)
    inside = [False] * n
    for i in range(n):
        inside[i] = i in chosen or i > 0 and inside[parents[i]]
    parts = [text for node, text in tree.texts if inside[node] and not dropped[node] or text == " "]
    return " ".join("".join(parts).split())


def extract_text(pages: DataFrame) -> DataFrame:
    """`pages` (`html` and any other columns) with `text` and `n_chars`, its number of code points.

    White space of any kind inside a block becomes one space, character references are
    decoded; null and empty pages give an empty text. Broken markup is read as far as it
    goes: open elements end with the page, a tag that is cut off is left out. Columns named
    `text` and `n_chars` are replaced. Repeated rows give repeated rows, no rows none.
    """

    def extract(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([main_text(page.as_py() or "") for page in batch], pa.string())

    text = F.arrow_udf(extract, "string")
    return without(pages, "text", "n_chars").withColumn("text", text("html")).selectExpr("*", "CAST(length(text) AS BIGINT) AS n_chars")
