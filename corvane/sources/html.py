"""HTML pages to rows: a small document tree, a selector subset and declarative page layouts, run in Arrow batches."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that end an open element of the same kind.
SELF_CLOSING = {"li": ("li",), "p": ("p",), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "dt": ("dt", "dd"), "dd": ("dt", "dd")}


@dataclass
class Node:
    """An element; texts and elements are its children in order."""

    tag: str
    attrs: dict[str, str] = field(default_factory=dict)
    parent: Node | None = None
    children: list[Node | str] = field(default_factory=list)

    @property
    def classes(self) -> set[str]:
        return set(self.attrs.get("class", "").split())

    def walk(self) -> Iterator[Node]:
        for child in self.children:
            if isinstance(child, Node):
                yield child
                yield from child.walk()

    def texts(self, skip: frozenset[str] = frozenset()) -> Iterator[str]:
        for child in self.children:
            if isinstance(child, str):
                yield child
            elif child.tag not in skip:
                yield from child.texts(skip)

    def text(self, joint: str = "", skip: frozenset[str] = frozenset({"script", "style"})) -> str:
        """Stripped texts joined by ``joint``."""
        return joint.join(t for t in (x.strip() for x in self.texts(skip)) if t)

    def select(self, selector: str) -> list[Node]:
        """Descendants that match one of the comma-separated selectors, in document order."""
        wanted = _compiled(selector)
        return [n for n in self.walk() if any(_matches(n, path, self) for path in wanted)]

    def first(self, selector: str) -> Node | None:
        wanted = _compiled(selector)
        return next((n for n in self.walk() if any(_matches(n, path, self) for path in wanted)), None)

    def up(self, tag: str) -> Node | None:
        n = self.parent
        while n is not None and n.tag != tag:
            n = n.parent
        return n


PART = re.compile(r"([a-zA-Z][\w-]*|\*)?((?:[.#][\w-]+|\[[^\]]+\])*)$")
PIECE = re.compile(r"([.#])([\w-]+)|\[([\w-]+)(?:(\^?\$?\*?=)['\"]?([^'\"\]]*)['\"]?)?\]")


@lru_cache(maxsize=500)
def _compiled(selector: str) -> list[list[tuple]]:
    out = []
    for one in selector.split(","):
        path = []
        for part in one.split():
            tag, rest = PART.match(part).groups()
            path.append((None if tag in (None, "*") else tag.lower(), tuple(PIECE.findall(rest or ""))))
        out.append(path)
    return out


def _is(n: Node, part: tuple) -> bool:
    tag, pieces = part
    if tag and n.tag != tag:
        return False
    for kind, name, attr, op, value in pieces:
        if kind == "." and name not in n.classes or kind == "#" and n.attrs.get("id") != name:
            return False
        if attr:
            has = n.attrs.get(attr)
            if has is None or (op == "=" and has != value) or (op == "^=" and not has.startswith(value)) or (op == "$=" and not has.endswith(value)) or (op == "*=" and value not in has):
                return False
    return True


def _matches(n: Node, path: list[tuple], root: Node) -> bool:
    if not _is(n, path[-1]):
        return False
    left, at = len(path) - 2, n.parent
    while left >= 0:
        while at is not None and at is not root and not _is(at, path[left]):
            at = at.parent
        if at is None or (at is root and not _is(at, path[left])):
            return False
        left, at = left - 1, at.parent
    return True


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("#document")

    def handle_starttag(self, tag, attrs):
        ends = SELF_CLOSING.get(tag)
        if ends:
            n = self.at
            while n.tag not in ("ul", "ol", "table", "div", "#document", "section", "article", "dl", "select") and n.parent is not None:
                if n.tag in ends:
                    self.at = n.parent
                    break
                n = n.parent
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.at.children.append(Node(tag, {k: v or "" for k, v in attrs}, self.at))

    def handle_endtag(self, tag):
        n = self.at
        while n is not None and n.tag != tag:
            n = n.parent
        if n is not None and n.parent is not None:
            self.at = n.parent

    def handle_data(self, data):
        self.at.children.append(data)


def parse(html: str | None) -> Node:
    """The tree of a page; broken mark-up gives the tree of what can be read."""
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    return builder.root


Take = Callable[[Node], str | None]


def text_of(selector: str, joint: str = "") -> Take:
    """Text of the first match, NULL if it is missing or empty."""

    def take(n: Node) -> str | None:
        found = n.first(selector)
        return (found.text(joint) or None) if found is not None else None

    return take


def attr_of(selector: str | None, name: str) -> Take:
    """Attribute of the first match, or of the row itself; NULL if it is missing or empty."""

    def take(n: Node) -> str | None:
        found = n.first(selector) if selector else n
        return (found.attrs.get(name, "").strip() or None) if found is not None else None

    return take


@dataclass
class Layout:
    """A kind of page: which elements are rows, what each column takes from a row, and which rows count."""

    rows: Callable[[Node], list[Node]]
    columns: dict[str, Take]
    required: tuple[str, ...] = ("name",)


def scan_pages(pages: DataFrame, layout: Layout, page_id: str = "page_id", html: str = "html") -> DataFrame:
    """(page_id, seq, columns of the layout): one row for each row element, in page order. Rows without a required column
    are left out; NULL and empty pages give none."""
    kind = pages.schema[page_id].dataType.simpleString()
    schema = ", ".join([f"{page_id} {kind}", "seq int", *[f"{c} string" for c in layout.columns]])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, source in zip(batch[page_id], batch[html]):
                if not isinstance(source, str) or not source:
                    continue
                for i, n in enumerate(layout.rows(parse(source))):
                    values = [take(n) for take in layout.columns.values()]
                    if all(values[list(layout.columns).index(c)] for c in layout.required):
                        rows.append((key, i, *values))
            yield pd.DataFrame(rows, columns=[page_id, "seq", *layout.columns])

    return pages.select(page_id, html).mapInPandas(run, schema)


def page_text(pages: DataFrame, page_id: str = "page_id", html: str = "html", most: int | None = None) -> DataFrame:
    """(page_id, text): the text of a page without scripts, styles and navigation, cut at ``most`` characters if given."""
    kind = pages.schema[page_id].dataType.simpleString()
    skip = frozenset({"script", "style", "nav", "footer", "head"})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [re.sub(r"\s+", " ", parse(h).text(" ", skip)).strip()[:most] if isinstance(h, str) else None for h in batch[html]]
            yield pd.DataFrame({page_id: batch[page_id], "text": texts})

    return pages.select(page_id, html).mapInPandas(run, f"{page_id} {kind}, text string")
