"""Main text of web pages by tag-path ratios."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrow import slices

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:\"[^\"]*\"|'[^']*'|[^'\">])*+)>",
    re.S,
)
_NAMES = re.compile(r"""(?<![\w-])(class|id|role|style|hidden|aria-hidden)(?![\w-])(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_PUNCTUATION = re.compile(r"[.,;:!?…。，；：！？、؟،]")

# Elements whose content is never text of the page, read as raw characters up to their end tag.
_RAW = {"script", "style", "noscript", "template", "iframe", "textarea", "title", "svg", "math", "object", "noembed", "xmp"}
_VOID = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr",
}
_BLOCK = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "div", "dl",
    "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header",
    "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "option", "p", "pre", "section", "select",
    "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
_FOREIGN = {"svg", "math"}  # those that a slash at the end of the tag closes
_EMPTY = re.compile(r"(?:^|[\s\"']|(?<![^\s])[^\s=\"']+)/$")
_SECTION = {"article", "body", "div", "main", "section", "td", "center", "html"}
_CELLS = {"tr", "td", "th"}  # told apart by their place, since cells beside each other hold different things
_HEADING = {"h1", "h2", "h3", "h4", "h5", "h6"}
# Start tags that end an open element of these kinds, which HTML lets authors leave unclosed.
_CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "tbody": {"thead", "tbody", "tr", "td", "th"},
    "tfoot": {"tbody", "tr", "td", "th"}, "body": {"head"},
}
_LIMITS = {"ul", "ol", "dl", "table", "select", "article", "section", "div", "main", "body", "html"}
_ASIDE = {"head", "nav", "footer", "aside", "form", "menu", "button", "select", "dialog", "fieldset", "label"}
_ASIDE_NAMES = {
    "ad", "adbox", "ads", "adsbygoogle", "adsense", "adslot", "advert", "advertisement", "advertising", "adverts",
    "alert", "author", "banner", "breadcrumb", "breadcrumbs", "byline", "comment", "commentform", "commentlist",
    "comments", "consent", "cookie", "cookiebanner", "cookiebar", "cookies", "disqus", "footer", "gdpr", "header",
    "masthead", "menu", "meta", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "pager",
    "pagination", "popup", "promo", "promotion", "recommended", "related", "replies", "reply", "respond", "share",
    "sharing", "sidebar", "sidenav", "signup", "sitefooter", "siteheader", "skip", "social", "sponsor", "sponsored",
    "subscribe", "tags", "teaser", "toolbar", "topbar", "topnav", "widget", "widgets",
}
_IN_ARTICLE = {"header"}  # what heads an article belongs to it
_OF_PARAGRAPHS = {"author", "banner", "byline", "header", "masthead", "meta", "teaser"}  # a paragraph so called may be a lead
_QUALIFIERS = {"has", "with", "no", "without", "free"}  # of a class that tells what a page has, and not what it is
_READERS = {"comment", "commentform", "commentlist", "comments", "disqus", "replies", "reply", "respond"}
_WRAPPERS = {"fieldset", "form", "label"}  # elements that may as well hold a whole page
_ASIDE_ROLES = {
    "alert", "alertdialog", "banner", "complementary", "contentinfo", "dialog", "form", "menu", "menubar",
    "navigation", "note", "search", "status", "toolbar",
}
_PAGE = {"", "html", "body"}
_GRID = {"table", "thead", "tbody", "tfoot", "tr"}
_SENTENCE = re.compile(r"[.!?…。！？؟][\"'”’»)]*(?:\s|$)")
SHARE = 0.2
LITTLE = 0.05
PROSE = 200
_HINT, _SIGN = 1, 2


class _Aside:
    """Elements of one path that are set aside within the same others, and the text right inside them."""

    __slots__ = ("outer", "weight", "in_article", "holds", "prose", "text")

    def __init__(self, outer: _Aside | None, weight: int, in_article: bool):
        self.outer, self.in_article = outer, in_article
        self.weight = max(weight, outer.weight) if outer else weight
        self.holds, self.prose, self.text = "", 0, 0


class _Open:
    """An element on the way from the root: its name, its path, what sets its text aside, the article it lies in."""

    __slots__ = ("name", "path", "aside", "section", "in_article", "holds", "parent", "depth", "linked", "cells")

    def __init__(self, name: str, path: str, aside: _Aside | None, section: str, in_article: bool, holds: str, parent: _Open | None = None):
        self.name, self.path, self.aside, self.section, self.in_article, self.holds = name, path, aside, section, in_article, holds
        self.parent, self.depth = parent, parent.depth + 1 if parent else 0
        self.linked = name == "a" or bool(parent and parent.linked)
        self.cells = 0


def _weight(name: str, value: str, names: set[str]) -> int:
    """How far a class or id tells that an element is not the article: a whole name is a sign, a part of one a hint."""
    weight = 0
    for one in value.split():
        parts = {one.lower()} if name == "article" else {part.lower() for part in _PART.findall(one)}
        found = parts & names
        if found and not parts & _QUALIFIERS:
            weight = max(weight, _SIGN if one.lower() in names or found & _READERS else _HINT)
    return weight


def _set_aside(name: str, attributes: str, parent: _Open) -> tuple[int, str]:
    """How far an element tells that its text is not the article's, and its class for the path."""
    aside, label = (_HINT if name in _WRAPPERS else _SIGN) if name in _ASIDE else 0, ""
    if name == "header" and not parent.in_article:
        aside = _SIGN
    if "=" in attributes or "hidden" in attributes:
        for key, value in _NAMES.findall(attributes):
            key, value = key.lower(), value.strip("\"'")
            if key in ("class", "id"):
                if name not in ("html", "body", "main"):
                    names = _ASIDE_NAMES - _OF_PARAGRAPHS if name == "p" else _ASIDE_NAMES
                    aside = max(aside, _weight(name, value, names - _IN_ARTICLE if parent.in_article else names))
                if key == "class":
                    label = "." + value.split()[0] if value.split() else ""
            elif key == "role":
                if value.lower() in _ASIDE_ROLES:
                    aside = max(aside, _HINT if value.lower() == "form" else _SIGN)
            elif key == "style":
                aside = _SIGN if _HIDDEN.search(value) else aside
            elif key == "hidden":
                aside = _SIGN if value.lower() != "until-found" else aside
            else:
                aside = _SIGN if value.lower() == "true" else aside
    return aside, label


def _released(groups: list[_Aside], blocks: list[tuple[list[tuple[str, _Open]], bool]]) -> set[_Aside]:
    """The groups that are not set aside after all, since they hold the page's text.

    Text counts as prose where its block has a punctuation mark. A hint gives way where its
    group holds more prose than all that is not set aside, a sign only where next to nothing
    else is left; the largest go first. Where an article or main element with prose stands
    outside, only hints within it give way; where none does, a hint never outweighs main,
    and an article only if that is small.
    """
    if not groups:
        return set()
    left, article = 0, False
    for text, element in (piece for pieces, _ in blocks for piece in pieces):
        group, prose = element.aside, bool(_PUNCTUATION.search(text))
        if group is None:
            left += len(text) * prose
            article |= prose and element.in_article
        else:
            group.prose += len(text) * prose
            group.text += len(text)
            if element.holds == "main" or not group.holds:
                group.holds = element.holds

    def outweighs(group: _Aside) -> bool:
        if group.weight == _SIGN:
            return not article and group.prose >= PROSE and LITTLE * group.prose > left
        if article:
            return group.prose * (SHARE / (1 - SHARE) if group.in_article else LITTLE) > left
        if group.holds == "main":
            return group.text > 0
        if group.prose == 0:
            return left == 0 and group.text > 0
        return group.prose > left * (SHARE if group.holds else 1)

    released: set[_Aside] = set()
    waiting = sorted((group for group in groups if group.text), key=lambda group: (-group.prose, -group.text))
    while chosen := next((group for group in waiting if group not in released and outweighs(group)), None):
        article |= bool(chosen.holds) and chosen.prose > 0
        while chosen and chosen not in released:
            released.add(chosen)
            left += chosen.prose or chosen.text * (left == 0)
            chosen = chosen.outer
    return released


def _container(elements: list[_Open]) -> _Open:
    """The innermost element that holds all of these."""
    common = elements[0]
    for other in elements[1:]:
        while other.depth > common.depth:
            other = other.parent
        while common is not other:
            if common.depth > other.depth:
                common = common.parent
            elif other.depth > common.depth:
                other = other.parent
            else:
                common, other = common.parent, other.parent
    return common


def _widened(section: _Open, blocks: list[tuple[str, _Open, bool, bool]]) -> _Open:
    """The closest element around a section with other text, if that holds sentences; or else the section.

    The page itself does not count, nor does a row of cells: what stands beside the text there is the page's frame.
    """
    around: dict[_Open, list[bool]] = {}
    for text, element, _, linked in blocks:
        way = element
        while way is not None and way is not section:
            way = way.parent
        if way is None:
            sentence = not linked and bool(_SENTENCE.search(text))
            while element is not None:
                around.setdefault(element, []).append(sentence)
                element = element.parent
    parent = section.parent
    while parent is not None and parent not in around:
        parent = parent.parent
    if parent is None or parent.name in _PAGE or parent.name in _GRID or not any(around[parent]):
        return section
    return parent


def _flow(blocks: list[tuple[str, _Open, bool, bool]], marked: list[bool]) -> list[bool]:
    """Which blocks of a page without an article element belong to its text: those of the content container.

    The container is the innermost section that holds all marked blocks. Where that is one
    section alone, it widens to the element around it if that has sentences beside it (a lead,
    a tail). All blocks of the container are kept but links without a punctuation mark in
    sections of nothing else (menus). Where the container is the page itself, only what lies
    between its first and last marked blocks is.
    """
    menus: dict[str, bool] = {}
    for text, element, _, linked in blocks:
        menus[element.section] = menus.get(element.section, True) and linked and not _PUNCTUATION.search(text)
    owners = []
    for keep, (_, element, _, _) in zip(marked, blocks, strict=True):
        while keep and element.path != element.section:
            element = element.parent
        owners.append(element if keep else None)
    sections = list(dict.fromkeys(one for one in owners if one is not None))
    container = _container(sections) if len(sections) > 1 else _widened(sections[0], blocks)
    first, last = marked.index(True), len(marked) - 1 - marked[::-1].index(True)
    within, out = {container: True}, []
    for at, (_, element, _, _) in enumerate(blocks):
        way = []
        while element is not None and element not in within and element.depth > container.depth:
            way.append(element)
            element = element.parent
        inside = within.get(element, False)
        within.update(dict.fromkeys(way, inside))
        if container.name in _PAGE:
            inside &= first <= at <= last
        out.append(marked[at] or inside and not menus[blocks[at][1].section])
    return out


def _blocks(html: str) -> list[tuple[str, _Open, bool, bool]]:
    """Text blocks outside what is set aside: text, element, whether it is a heading, whether all is links."""
    top = _Open("", "", None, "", False, "")
    stack, blocks, pieces = [top], [], []
    groups: dict[tuple[_Aside | None, str], _Aside] = {}
    at = 0

    def end_block() -> None:
        if any(not text.isspace() for text, _ in pieces):
            heading = any(one.name in _HEADING for one in stack)
            blocks.append((pieces.copy(), heading))
        pieces.clear()

    while at < len(html):
        token = _TOKEN.search(html, at)
        stop = token.start() if token else len(html)
        if stop > at:
            pieces.append((unescape(html[at:stop]), stack[-1]))
        if not token:
            break
        at = token.end()
        name = token[2]
        if name is None:
            continue
        name = name.lower()
        if token[1]:
            if name in _BLOCK:
                end_block()
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].name == name:
                    if name not in _BLOCK and any(one.name in _BLOCK for one in stack[depth + 1 :]):
                        break
                    del stack[depth:]
                    break
                if stack[depth].name in _LIMITS and name not in _BLOCK:
                    break
            continue
        if name in _RAW:
            if name in _FOREIGN and _EMPTY.search(token[3]):
                continue
            closing = re.compile(rf"</{name}\b[^>]*>", re.I).search(html, at)
            at = closing.end() if closing else len(html)
            continue
        if name in _VOID:
            if name == "hr":
                end_block()
            elif name == "br" and pieces:
                pieces.append((" ", stack[-1]))
            continue
        if name in _BLOCK:
            end_block()
            closes = _CLOSES.get(name, set()) | {"p"}
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].name in closes:
                    del stack[depth:]
                elif stack[depth].name in _LIMITS:
                    break
        parent = stack[-1]
        weight, label = _set_aside(name, token[3], parent)
        path = f"{parent.path}/{name}{label}"
        if name in _CELLS and not parent.in_article:
            parent.cells += 1
            path += f"[{parent.cells}]"
        aside, holds = parent.aside, parent.holds
        if weight:
            kind = (aside, f"{path} {weight}")
            if kind not in groups:
                groups[kind] = _Aside(aside, weight, parent.in_article)
            aside, holds = groups[kind], ""
        if name in ("article", "main"):
            holds = "main" if "main" in (name, holds) else name
        article = parent.in_article or name in ("article", "main")
        section = parent.section if parent.in_article else path if name in _SECTION else parent.section
        stack.append(_Open(name, path, aside, section, article, holds, parent))
    end_block()
    released = _released(list(groups.values()), blocks)
    left = []
    for pieces, heading in blocks:
        own = [piece for piece in pieces if piece[1].aside is None or piece[1].aside in released]
        text = " ".join("".join(text for text, _ in own).split())
        if text:
            left.append((text, own[0][1], heading, all(element.linked for text, element in own if not text.isspace())))
    return left


def main_text(html: str) -> str:
    """The article of a page: its blocks in page order, one to a line.

    Menus, footers, side bars, notices, adverts, forms, hidden parts and reader comments
    are set aside by element, role, class and id, unless they hold the page's text (see
    ``_released``). What is left is judged by its tag paths:
    text length and punctuation marks are added up per path and divided by the path's
    blocks, smoothed along the sections of the page, and multiplied; sections whose best
    path reaches ``SHARE`` of the page's best are content. All blocks of a content section
    are kept, whatever their length, and so are headings that lead into one. Where no
    article or main element has text, length and punctuation marks per character are held
    against the best section's apart, and all blocks of the content container are kept
    (see ``_flow``).
    """
    blocks = _blocks(html)
    if not blocks:
        return ""
    per_path: dict[str, list[float]] = {}
    order: dict[str, int] = {}
    for text, element, _, _ in blocks:
        sums = per_path.setdefault(element.path, [0, 0, 0, order.setdefault(element.section, len(order))])
        sums[0] += len(text)
        sums[1] += len(_PUNCTUATION.findall(text))
        sums[2] += 1
    lengths, marks = np.zeros(len(order)), np.zeros(len(order))
    for length, mark, count, section in per_path.values():
        lengths[section] = max(lengths[section], length / count)
        marks[section] = max(marks[section], mark / count)
    fused = _smooth(lengths) * (1 + _smooth(marks))
    content = fused >= SHARE * fused.max()
    whole = not any(element.in_article for _, element, _, _ in blocks)
    if whole:
        best = int(fused.argmax())
        content |= (lengths >= SHARE * lengths[best]) & (marks * lengths[best] >= SHARE * marks[best] * lengths)
    belongs = [bool(content[order[element.section]]) for _, element, _, _ in blocks]
    if whole:
        belongs = _flow(blocks, belongs)
    kept, wanted = [], False
    for (text, element, heading, _), keep in zip(reversed(blocks), reversed(belongs), strict=True):
        section = element.section
        if keep:
            wanted = True
            leads = section
            kept.append(text)
        elif heading and wanted and leads.startswith(section):
            kept.append(text)
    return "\n".join(reversed(kept))


def _smooth(values: np.ndarray) -> np.ndarray:
    """A tenth of each neighbour and the rest of the value; the ends lean on themselves."""
    padded = np.concatenate([values[:1], values, values[-1:]])
    return 0.1 * padded[:-2] + 0.8 * padded[1:-1] + 0.1 * padded[2:]


def extracted(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``page_id``, ``url``, the main ``text`` of the whole html and its code points ``n_chars``.

    Character references are decoded, white space inside a block becomes one space, and
    blocks are joined by one line feed; see ``main_text``. A page without text, an empty
    or a null one gives an empty string. Rows are handled one by one, in the order and
    number in which they come; null keys and urls pass through, other columns are left
    out, and an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            texts = [main_text(page) for page in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    batch.column("url"),
                    pa.array(texts, pa.string()),
                    pa.array([len(text) for text in texts], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(
        F.col(key).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(html), F.lit("")).alias("html")
    )
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
