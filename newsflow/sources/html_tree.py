"""The element tree of a page in one pass, and the elements of wanted classes by their intervals.

A page is split in front of every ``<`` into pieces, each a tag and the text after it.  One pass with a stack for every tag
name gives each element the interval of pieces from its opening tag to the piece of its closing tag (or to the end of the
page); elements are numbered in page order, and their depth is how many intervals hold them.  Blocks to leave out are
intervals too: pieces inside go, the text behind a block's closing tag stays.  Linear in the page, however many elements
it has and however deep they are nested.  Pages travel in Arrow batches; null pages have null elements.
"""

from __future__ import annotations

import re
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from newsflow.session import ship_package

_NAME = re.compile(r"</?([A-Za-z][A-Za-z0-9]*)")
_ALONE = re.compile(r"<[^>]*/>")
_TAG = re.compile(r"<[^>]*>")
_CLASS = re.compile(r"""<[^>]*\sclass\s*=\s*["']([^"'>]*)["']""", re.A)
_SPACE = re.compile(r"\s+", re.A)
# Elements without an end tag.
VOID = frozenset(["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"])


class Element(NamedTuple):
    """Pieces [start, end) from the opening tag up to, without, the closing one; depth 0 is outermost."""

    start: int
    end: int
    depth: int
    name: str
    classes: frozenset


def split_pieces(html: str) -> list[str]:
    head, *rest = html.split("<")
    return [head, *["<" + r for r in rest]]


def element_tree(pieces: list[str]) -> list[Element]:
    """All elements in page order."""
    opened: dict[str, list[int]] = {}
    found: list[list] = []
    depth = 0
    for k, piece in enumerate(pieces):
        m = _NAME.match(piece)
        name = m[1].lower() if m else ""
        if not name or name in VOID or _ALONE.match(piece):
            continue
        stack = opened.setdefault(name, [])
        if not piece.startswith("</"):
            c = _CLASS.match(piece)
            stack.append(len(found))
            found.append([k, len(pieces), name, frozenset(filter(None, _SPACE.split(c[1]))) if c else frozenset()])
        elif stack:
            found[stack.pop()][1] = k
    # depth by one sweep over the interval ends
    out, ends = [], [0] * (len(pieces) + 1)
    for _, end, _, _ in found:
        ends[end] += 1
    at = 0
    for start, end, name, classes in found:
        while at < start:
            at += 1
            depth -= ends[at]
        out.append(Element(start, end, depth, name, classes))
        depth += 1
    return out


def without(pieces: list[str], blocks: list[Element]) -> list[str]:
    """The pieces outside the blocks; of a block's closing piece the text behind the tag."""
    out, hidden, closing = [], 0, {}
    starts: dict[int, int] = {}
    for b in blocks:
        starts[b.start] = starts.get(b.start, 0) + 1
        closing[b.end] = closing.get(b.end, 0) + 1
    for k, piece in enumerate(pieces):
        hidden += starts.get(k, 0) - closing.get(k, 0)
        if hidden <= 0:
            out.append(_escaped_rest(piece) if k in closing else piece)
    return out


def _escaped_rest(piece: str) -> str:
    """A piece without its tag, so that it opens and closes nothing."""
    return _TAG.sub("", piece, count=1) if _TAG.match(piece) else piece


def inner_html(pieces: list[str], e: Element) -> str:
    run = "".join(pieces[e.start : e.end])
    return _TAG.sub("", run, count=1) if _TAG.match(run) else run


def class_elements(html: str, classes: list[str], drop_class: str | None = None) -> list[list[str]]:
    """For every class the inner HTML of its elements, in page order."""
    pieces = split_pieces(html)
    tree = element_tree(pieces)
    if drop_class:
        blocks = [e for e in tree if drop_class in e.classes]
        if blocks:
            pieces = without(pieces, blocks)
            tree = element_tree(pieces)
    return [[inner_html(pieces, e) for e in tree if c in e.classes] for c in classes]


def elements_of(spark: SparkSession, html: Column, classes: list[str], drop_class: str | None = None) -> Column:
    """struct<c0: array<string>, c1: …>: the inner HTML of the elements of each class."""
    ship_package(spark)
    fields = ", ".join(f"c{k} array<string>" for k in range(len(classes)))

    @F.arrow_udf(returnType=f"struct<{fields}>")
    def find(pages: pa.Array) -> pa.Array:
        found = [None if p is None else class_elements(p, classes, drop_class) for p in pages.to_pylist()]
        columns = [pa.array([None if f is None else f[k] for f in found], pa.list_(pa.string())) for k in range(len(classes))]
        return pa.StructArray.from_arrays(columns, names=[f"c{k}" for k in range(len(classes))])

    return find(html)
