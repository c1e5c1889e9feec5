"""A forgiving HTML reader and a small selector, used inside tasks."""

from __future__ import annotations

from dataclasses import dataclass
from html.parser import HTMLParser
from xml.etree import ElementTree

_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_CLOSED_BY_SAME = frozenset("p li tr td th option".split())


@dataclass(frozen=True)
class Field:
    """Where a value lies.

    ``path`` is an ElementTree path below the element in scope, or below the
    page when ``page`` is set. ``beside`` then moves to later siblings of the
    hits, by path, or to the text after them when it is ``"text"``. ``element``
    keeps one hit. ``take`` is ``text`` (each piece of the element's own text),
    ``string`` (all text within) or ``@name``. ``nth`` picks one of all values;
    0 keeps them all.
    """

    path: str
    take: str = "text"
    nth: int = 1
    element: int | None = None
    beside: str | None = None
    page: bool = False
    containing: str | None = None
    css_class: str | None = None


class _Reader(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.builder = ElementTree.TreeBuilder()
        self.builder.start("page", {})
        self.open = ["page"]

    def handle_starttag(self, tag, attrs):
        if tag in _CLOSED_BY_SAME and self.open[-1] == tag:
            self.handle_endtag(tag)
        self.builder.start(tag, {name: value or "" for name, value in attrs})
        if tag in _VOID:
            self.builder.end(tag)
        else:
            self.open.append(tag)

    def handle_startendtag(self, tag, attrs):
        self.builder.start(tag, {name: value or "" for name, value in attrs})
        self.builder.end(tag)

    def handle_endtag(self, tag):
        if tag in self.open[1:]:
            while self.open[-1] != tag:
                self.builder.end(self.open.pop())
            self.builder.end(self.open.pop())

    def handle_data(self, data):
        self.builder.data(data)

    def finish(self) -> ElementTree.Element:
        self.close()
        while self.open:
            self.builder.end(self.open.pop())
        return self.builder.close()


def parse_page(html: str) -> ElementTree.Element:
    reader = _Reader()
    reader.feed(html)
    return reader.finish()


def _own_texts(element: ElementTree.Element) -> list[str]:
    return [t for t in [element.text, *(child.tail for child in element)] if t]


def _later_siblings(page: ElementTree.Element, hits: list) -> list:
    """For every hit, the hit itself and the siblings after it."""
    parent_of = {child: parent for parent in page.iter() for child in parent}
    runs = []
    for hit in hits:
        siblings = list(parent_of[hit]) if hit in parent_of else [hit]
        runs.append(siblings[siblings.index(hit):])
    return runs


def select_texts(page: ElementTree.Element, element: ElementTree.Element, field: Field) -> list[str]:
    """All values of a field, in page order."""
    root = page if field.page else element
    hits = root.findall(field.path) if field.path != "." else [root]
    if field.containing is not None:
        hits = [h for h in hits if field.containing in next(iter(_own_texts(h)), "")]
    if field.css_class is not None:
        hits = [h for h in hits if field.css_class in h.get("class", "").split()]
    if field.beside == "text":
        followers = {id(e): e for run in _later_siblings(page, hits) for e in run}
        values = [e.tail for e in followers.values() if e.tail]
        return _nth(values, field.nth)
    if field.beside is not None:
        tag, _, below = field.beside.partition("/")
        later = {id(e): e for run in _later_siblings(page, hits) for e in run[1:] if e.tag == tag}
        hits = [h for e in later.values() for h in (e.findall(below) if below else [e])]
    if field.element is not None:
        hits = hits[field.element - 1 : field.element]
    if field.take == "text":
        values = [t for h in hits for t in _own_texts(h)]
    elif field.take == "string":
        values = ["".join(h.itertext()) for h in hits]
    else:
        values = [h.get(field.take[1:]) for h in hits if h.get(field.take[1:]) is not None]
    return _nth(values, field.nth)


def _nth(values: list[str], n: int) -> list[str]:
    return values if n == 0 else values[n - 1 : n]
