"""One page of HTML to its sections; the per-row helper of ``documents``."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from html import unescape
from html.parser import HTMLParser
from operator import attrgetter

_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_UNREAD = ("script", "style", "template")
_NOT_BODY = {"eyebrow", "section-label", "lead", "meta"}
_AT = attrgetter("at")


class _Node:
    """An element: what it is, and which elements and pieces of text lie below it."""

    __slots__ = ("classes", "at", "end", "first_piece", "last_piece", "tag")

    def __init__(self, tag: str, classes: list[str], at: int, piece: int) -> None:
        self.tag, self.classes, self.at, self.end = tag, classes, at, at + 1
        self.first_piece = self.last_piece = piece


class _Page(HTMLParser):
    """Elements in the order they start; an end tag closes what is open inside it.

    The text below an element is a run of the page's pieces, and elements are found
    by tag or class in lists that are in page order, so that neither deep nor long
    markup is gone through again for each element.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.pieces: list[str] = []
        self.root = _Node("", [], 0, 0)
        self.open = [self.root]
        self.count = 1
        self.tags: dict[str, list[_Node]] = {}
        self.classes: dict[str, list[_Node]] = {}

    def handle_starttag(self, tag: str, attrs: list) -> None:
        classes: list[str] = []
        for name, value in attrs:
            if name == "class":  # the last one counts
                classes = (value or "").split()
        node = _Node(tag, classes, self.count, len(self.pieces))
        self.count += 1
        self.tags.setdefault(tag, []).append(node)
        for name in set(classes) if len(classes) > 1 else classes:
            self.classes.setdefault(name, []).append(node)
        if tag not in _VOID:
            self.open.append(node)

    def _end(self, depth: int) -> None:
        for node in self.open[depth:]:
            node.end, node.last_piece = self.count, len(self.pieces)
        del self.open[depth:]

    def handle_endtag(self, tag: str) -> None:
        for depth in range(len(self.open) - 1, 0, -1):
            if self.open[depth].tag == tag:
                self._end(depth)
                return

    def handle_data(self, data: str) -> None:
        piece = data.strip()
        if piece and self.open[-1].tag not in _UNREAD:
            self.pieces.append(piece)

    def finish(self) -> None:
        self.close()
        self._end(0)

    def text(self, node: _Node | None) -> str:
        if node is None:
            return ""
        return " ".join(unescape(" ".join(self.pieces[node.first_piece : node.last_piece])).split())

    def below(self, node: _Node, index: dict[str, list[_Node]], *names: str) -> list[_Node]:
        """Elements below ``node`` of one of the tags or classes, in page order."""
        found: list[_Node] = []
        for name in names:
            nodes = index.get(name)
            if nodes:
                found += nodes[bisect_right(nodes, node.at, key=_AT) : bisect_left(nodes, node.end, key=_AT)]
        if len(names) > 1:
            found.sort(key=_AT)
        return found

    def first(self, node: _Node, index: dict[str, list[_Node]], *names: str) -> _Node | None:
        return next(iter(self.below(node, index, *names)), None)


def _section(page: _Page, top: _Node, number: int) -> tuple:
    text, tags, classes = page.text, page.tags, page.classes
    cards = [
        {
            "badge": text(page.first(card, classes, "badge")),
            "title": text(page.first(card, tags, "h3")),
            "body": text(page.first(card, tags, "p")),
        }
        for card in page.below(top, classes, "card")
    ]
    tables = []
    for table in page.below(top, tags, "table"):
        rows = [[text(cell) for cell in page.below(row, tags, "th", "td")] for row in page.below(table, tags, "tr")]
        rows = [row for row in rows if row]
        if rows:
            tables.append(rows)
    body = (text(p) for p in page.below(top, tags, "p") if _NOT_BODY.isdisjoint(p.classes))
    return (
        number,
        text(page.first(top, tags, "h1", "h2")),
        text(page.first(top, classes, "eyebrow") or page.first(top, classes, "section-label")),
        text(page.first(top, classes, "lead")),
        text(page.first(top, classes, "meta")),
        [text(li) for li in page.below(top, tags, "li")],
        cards,
        tables,
        [paragraph for paragraph in body if paragraph],
    )


def sections_of(html: str | None, section: tuple[str, str] | None) -> Iterator[tuple]:
    """The sections of a page, numbered from 1."""
    page = _Page()
    page.feed(html or "")
    page.finish()
    if section is None:
        tops = [page.root]
    else:
        tag, name = section
        tops = [n for n in page.below(page.root, page.tags, tag) if name in n.classes]
    for number, top in enumerate(tops, start=1):
        yield _section(page, top, number)
