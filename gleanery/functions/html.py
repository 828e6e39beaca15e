"""Structure out of HTML: the one place where rows need Python.

Spark has no HTML expression, and pages are not well-formed XML. A small tree builder runs
inside Arrow UDFs that take only the HTML column and return raw pieces; every choice, clean-up
and filter on those pieces is left to Spark expressions.
"""

from __future__ import annotations

import gc
import re
from html import unescape
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from .. import fixed_values as fv
from .text import as_col

# A comment, a declaration, a tag, or markup that never ends. Quotes count only after an equals
# sign. Nothing backtracks and markup without end is taken in one go, so broken pages cost
# linear time.
_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)
    |<[!?][^>]*+>
    |<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')|=)*+)>
    |(?P<endless><(?=[a-zA-Z!?]|/[a-zA-Z]).*+)""",
    re.DOTALL | re.VERBOSE,
)
_ATTRIBUTE = re.compile(r"""([^\s/>=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*)))?""")
_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
# Elements that end an open paragraph.
_ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
# The content of these is text up to their own end tag, whatever it looks like.
_RAW = ("script", "style")
_RAW_END = {name: re.compile(rf"</{name}[\s/>]", re.IGNORECASE) for name in _RAW}


class Node:
    """An element with its parent and children (elements and texts)."""

    __slots__ = ("tag", "source", "parent", "children", "_attrs")

    def __init__(self, tag, source, parent):
        self.tag, self.source, self.parent = tag, source, parent
        self.children, self._attrs = [], None

    @property
    def attrs(self):
        """Attributes, read when first asked for: most elements never are."""
        if self._attrs is None:
            self._attrs = {
                name.lower(): unescape(a or b or c) for name, a, b, c in _ATTRIBUTE.findall(self.source)
            }
        return self._attrs

    def classes(self):
        return self.attrs.get("class", "").split()

    def has_class(self, cls):
        """Whether it bears a class; most elements tell by their source alone that they do not."""
        return (cls in self.source or "&" in self.source) and cls in self.classes()

    def walk(self, skip=()):
        """Descendant elements in document order, without those in ``skip`` and what they hold
        (no recursion: pages can be deep)."""
        stack = [c for c in reversed(self.children) if c.__class__ is Node]
        while stack:
            node = stack.pop()
            if node.tag not in skip:
                yield node
                stack.extend([c for c in reversed(node.children) if c.__class__ is Node])

    def strings(self, skip=_RAW):
        stack = self.children[::-1]
        while stack:
            item = stack.pop()
            if item.__class__ is str:
                yield item
            elif item.tag not in skip:
                stack.extend(reversed(item.children))

    def text(self, sep=None):
        """All text; with ``sep``, pieces are trimmed, empty ones dropped, then joined."""
        if sep is None:
            return "".join(self.strings())
        return sep.join([s for s in [p.strip() for p in self.strings()] if s])

    def first(self, tag, cls=None):
        for node in self.walk():
            if node.tag == tag and (cls is None or node.has_class(cls)):
                return node
        return None

    def by_tag(self):
        """Descendant elements by tag, in document order: for many looks into one element."""
        found = {}
        for node in self.walk():
            found.setdefault(node.tag, []).append(node)
        return found

    def inside(self, tags, cls=None):
        node = self.parent
        while node is not None:
            if node.tag in tags and (cls is None or node.has_class(cls)):
                return True
            node = node.parent
        return False


def parse_html(page: str) -> Node:
    """Element tree of a page. An end tag closes the nearest open element of its name, or
    nothing; a block element closes an open paragraph."""
    root = here = Node("", "", None)
    opened: dict[str, int] = {}
    at = 0

    def close(tag, node):
        while node.tag != tag:
            opened[node.tag] -= 1
            node = node.parent
        opened[tag] -= 1
        return node.parent

    search = _TAG.search
    while found := search(page, at):
        end, tag, source, endless = found.groups()
        if endless:
            break
        start, stop = found.span()
        if start > at:
            data = page[at:start]
            here.children.append(unescape(data) if "&" in data else data)
        at = stop
        if tag is None:
            continue
        tag = tag.lower()
        if end:
            if here.tag == tag:  # as in most pages
                opened[tag] -= 1
                here = here.parent
            elif opened.get(tag):
                here = close(tag, here)
            continue
        if tag in _ENDS_PARAGRAPH and opened.get("p"):
            here = close("p", here)
        node = Node(tag, source, here)
        here.children.append(node)
        if tag in _VOID or source.endswith("/"):
            continue
        if tag in _RAW:
            stop = _RAW_END[tag].search(page, at)
            limit = stop.start() if stop else len(page)
            node.children.append(page[at:limit])
            at = limit
        here = node
        opened[tag] = opened.get(tag, 0) + 1
    if at < len(page):
        data = page[at:]
        here.children.append(unescape(data) if "&" in data else data)
    return root


def _paragraphs(page: str):
    out = []
    for node in parse_html(page).walk(skip=fv.DROPPED_BLOCKS):
        if node.tag == "p":
            parts = [p.strip() for p in node.strings(skip=fv.DROPPED_BLOCKS)]
            out.append(" ".join([p for p in parts if p]))
    return out


def _cards(page: str, base_url: str):
    out = []
    for a in parse_html(page).walk():
        if a.tag != "a" or a.attrs.get("target") != "_blank" or "href" not in a.attrs:
            continue
        if not a.inside(("main",)):
            continue
        parts = list(a.walk())
        heading = next((n for n in parts if n.tag == "h3"), None)
        summary = next((n for n in parts if n.tag == "p"), None)
        spans = [n for n in parts if n.tag == "span"]
        badge = next((n for n in spans if n.inside(("div",), "flex")), None)
        logo = next(
            (n for n in parts if n.tag == "img" and "alt" in n.attrs and n.inside(("div",), "flex")), None
        )
        out.append(
            {
                "url": urljoin(base_url + "/", a.attrs["href"]),
                "title": heading.text("") if heading else "",
                "summary": summary.text(" ") if summary else "",
                "badge": badge.text() if badge else None,
                "logo": logo.attrs["alt"] if logo else None,
                "spans": [n.text() for n in spans],
                "strings": [s for s in a.strings() if s.strip()],
            }
        )
    return out


def _with_class(nodes: list[Node], cls: str) -> Node | None:
    return next((n for n in nodes if n.has_class(cls)), None)


def _label(counts: Node | None, item_class: str):
    item = counts and counts.first("li", item_class)
    button = item and item.first("button")
    return button.attrs.get("aria-label") if button else None


def _posts(page: str):
    out = []
    for card in parse_html(page).walk():
        if card.tag != "div" or not card.has_class(fv.POST_CARD_CLASS):
            continue
        parts = card.by_tag()
        divs = parts.get("div", ())
        link = _with_class(parts.get("a", ()), fv.POST_LINK_CLASS)
        actor = _with_class(divs, fv.POST_ACTOR_CLASS)
        own = actor.by_tag() if actor else {}
        spans = own.get("span", ())
        title = _with_class(spans, fv.POST_ACTOR_TITLE_CLASS)
        name = title and next(
            (n for n in title.walk() if n.tag == "span" and n.attrs.get("dir") == "ltr"), None
        )
        profile = _with_class(own.get("a", ()), fv.POST_ACTOR_LINK_CLASS)
        job = _with_class(spans, fv.POST_ACTOR_JOB_CLASS)
        when = _with_class(spans, fv.POST_ACTOR_TIME_CLASS)
        content = _with_class(divs, fv.POST_TEXT_CLASS)
        counts = _with_class(divs, fv.POST_COUNTS_CLASS)
        seen = _with_class(parts.get("span", ()), fv.POST_IMPRESSIONS_CLASS)
        out.append(
            {
                "link": link.attrs.get("href") if link else None,
                "data_urn": card.attrs.get("data-urn"),
                "author_name": name.text("") if name else None,
                "author_profile": profile.attrs.get("href") if profile else None,
                "author_job": job.text("") if job else None,
                "post_time": when.text("") if when else None,
                "content": content.text("\n") if content else None,
                "reactions_label": _label(counts, fv.POST_REACTIONS_CLASS),
                "comments_label": _label(counts, fv.POST_COMMENTS_CLASS),
                "impressions_text": seen.text("") if seen else None,
            }
        )
    return out


def _stripped(page: str) -> str:
    """Source of a page without dropped blocks; everything else is copied as it stands."""
    out, inside, kept_from, at = [], [], 0, 0
    while tag := _TAG.search(page, at):
        at = tag.end()
        name = (tag["name"] or "").lower()
        if name not in fv.DROPPED_BLOCKS:
            continue
        if not inside:
            out.append(page[kept_from : tag.start()])
            kept_from = at
        if not tag["end"]:
            if not tag[0].endswith("/>"):
                inside.append(name)
            if name in _RAW:
                # The content of these is text up to their own end tag, whatever it looks like.
                end = _RAW_END[name].search(page, at)
                at = end.start() if end else len(page)
        elif name in inside:
            while inside.pop() != name:
                pass
            kept_from = at
    if not inside:
        out.append(page[kept_from:])
    return "".join(out)


def _struct(*texts: str, lists: tuple[str, ...] = ()) -> ArrayType:
    fields = [StructField(n, StringType()) for n in texts]
    fields += [StructField(n, ArrayType(StringType())) for n in lists]
    return ArrayType(StructType(fields))


CARD_TYPE = _struct("url", "title", "summary", "badge", "logo", lists=("spans", "strings"))
POST_TYPE = _struct(
    "link",
    "data_urn",
    "author_name",
    "author_profile",
    "author_job",
    "post_time",
    "content",
    "reactions_label",
    "comments_label",
    "impressions_text",
)


def uncollected(read, page: str):
    """``read(page)`` while the garbage collector rests: it would walk the growing tree again and again. A tree is garbage as
    soon as its page is read, and is collected then."""
    on = gc.isenabled()
    gc.disable()
    try:
        return read(page)
    finally:
        if on:
            gc.enable()


def _per_page(html: Column | str, read, spark_type) -> Column:
    """Apply ``read`` to every page of an Arrow batch; missing pages stay missing."""
    arrow_type = to_arrow_type(spark_type)

    def run(pages: pa.Array) -> pa.Array:
        return pa.array([None if p is None else uncollected(read, p) for p in pages.to_pylist()], arrow_type)

    return F.arrow_udf(run, spark_type)(as_col(html))


def paragraphs(html: Column | str) -> Column:
    """Texts of all paragraphs outside dropped blocks, in page order."""
    return _per_page(html, _paragraphs, ArrayType(StringType()))


def strip_blocks(html: Column | str) -> Column:
    """The page without script, style, noscript, pre, code, samp and kbd blocks."""
    return _per_page(html, _stripped, StringType())


def listing_cards(html: Column | str, base_url: str = fv.BLOG_BASE_URL) -> Column:
    """Raw pieces of every article card of a listing page."""
    base = base_url.rstrip("/")
    return _per_page(html, lambda page: _cards(page, base), CARD_TYPE)


def post_cards(html: Column | str) -> Column:
    """Raw pieces of every post card of a snapshot."""
    return _per_page(html, _posts, POST_TYPE)
