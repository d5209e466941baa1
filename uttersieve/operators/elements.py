"""Pages as tables of elements, so that selectors are column expressions.

A page's elements are numbered in document order from 1 (``pre``), and each knows the last
number in its subtree (``last``).  With these two numbers the relations of a tree are
comparisons: ``e`` is inside ``c`` if ``c.pre < e.pre <= c.last``, and what follows a subtree,
number ``last + 1``, is the next sibling if it has the same parent.

A page's text is kept once.  An element has its place in it, so elements inside each
other do not repeat it.  Python parses, in Arrow batches; everything else runs in Spark.
"""

from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from uttersieve.functions.memory import hand_back
from uttersieve.functions.text import _c, strip
from uttersieve.operators.pages import HIDDEN, VOID

ELEMENT = (
    "struct<pre: int, last: int, parent: int, tag: string, classes: array<string>, "
    "attrs: map<string, string>, at: int, stop: int>"
)
PAGE = f"struct<text: string, elements: array<{ELEMENT}>>"


PART_BYTES = 1 << 20  # of pages parsed at once


class _Outline(HTMLParser):
    """Numbers the elements of one page and places them in its text.

    Tolerant: an end tag closes up to its open element, or is ignored; what is
    never closed ends with the page.  Scripts and styles have no text.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.text, self.length = [], 0
        self.last, self.parent, self.tag, self.attrs = [], [], [], []
        self.at, self.stop = [], []
        self._open = []

    def handle_starttag(self, tag, attrs):
        self.parent.append(self._open[-1] if self._open else 0)
        self.tag.append(tag)
        self.attrs.append({k: v or "" for k, v in attrs})
        self.at.append(self.length)
        for column in (self.last, self.stop):
            column.append(None)
        self._open.append(len(self.tag))
        if tag in VOID:
            self._close(len(self._open) - 1)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self._close(len(self._open) - 1)

    def handle_endtag(self, tag):
        for i in range(len(self._open) - 1, -1, -1):
            if self.tag[self._open[i] - 1] == tag:
                self._close(i)
                break

    def handle_data(self, data):
        if self._open and self.tag[self._open[-1] - 1] not in HIDDEN:
            self.text.append(data)
            self.length += len(data)

    def _close(self, i):
        for pre in self._open[i:]:
            self.last[pre - 1], self.stop[pre - 1] = len(self.tag), self.length
        del self._open[i:]

    def close(self):
        super().close()
        self._close(0)


def _parts(pages: pa.Array):
    """Runs of whole pages of about ``PART_BYTES``.  A page's elements take many times its
    room while it is parsed, and only one run's are there at a time."""
    size = pc.fill_null(pc.binary_length(pages), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(size.astype(np.int64) + 1)  # empty pages count, too
    at = 0
    while at < len(pages):
        before = ends[at - 1] if at else 0
        end = max(int(np.searchsorted(ends, before + PART_BYTES, side="right")), at + 1)
        yield pages.slice(at, end - at)
        at = end


def _parsed(pages: pa.Array) -> pa.Array:
    texts, bounds, outlines = [], [0], []
    for page in pages.to_pylist():
        if page is None:
            texts.append(None)
        else:
            outline = _Outline()
            outline.feed(page)
            outline.close()
            outlines.append(outline)
            texts.append("".join(outline.text))
        bounds.append(bounds[-1] + (len(outlines[-1].tag) if page is not None else 0))

    def flat(name):
        return [x for o in outlines for x in getattr(o, name)]

    number, word = pa.int32(), pa.string()
    attrs = flat("attrs")
    fields = {
        "pre": pa.array([i + 1 for o in outlines for i in range(len(o.tag))], number),
        "last": pa.array(flat("last"), number),
        "parent": pa.array(flat("parent"), number),
        "tag": pa.array(flat("tag"), word),
        "classes": pa.array([a.get("class", "").split() for a in attrs], pa.list_(word)),
        "attrs": pa.array([list(a.items()) for a in attrs], pa.map_(word, word)),
        "at": pa.array(flat("at"), number),
        "stop": pa.array(flat("stop"), number),
    }
    elements = pa.StructArray.from_arrays(list(fields.values()), names=list(fields))
    lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), elements)
    missing = pa.array([t is None for t in texts])
    return pa.StructArray.from_arrays(
        [pa.array(texts, word), lists], names=["text", "elements"], mask=missing
    )


def page_elements(html) -> Column:
    """The page as a struct of its text and its elements; null for a null page."""

    def parsed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        try:
            for pages in batches:
                for part in _parts(pages):
                    yield _parsed(part)
        finally:
            hand_back()

    return F.arrow_udf(parsed, PAGE)(_c(html))


def _fits(e, tag, classes):
    fits = F.lit(True) if tag is None else e["tag"] == tag
    for name in classes:
        fits = fits & F.array_contains(e["classes"], name)
    return fits


def _classes(classes):
    return [classes] if isinstance(classes, str) else list(classes or ())


def element_text(page, element) -> Column:
    """Stripped text of an element, with that of all inside it."""
    return strip(F.substr(_c(page)["text"], element["at"] + 1, element["stop"] - element["at"]))


def select(page, tag=None, classes=(), inside=None, text=None) -> Column:
    """The page's elements, in document order, that have this tag, all of these classes, and this
    stripped text; ``inside=(tag, classes)`` wants them below such an element."""
    page, classes = _c(page), _classes(classes)
    found = F.filter(page["elements"], lambda e: _fits(e, tag, classes))
    if text is not None:
        found = F.filter(found, lambda e: element_text(page, e) == text)
    if inside is not None:
        around = F.filter(page["elements"], lambda c: _fits(c, inside[0], _classes(inside[1])))
        found = F.filter(
            found,
            lambda e: F.exists(
                around, lambda c: (c["pre"] < e["pre"]) & (e["pre"] <= c["last"])
            ),
        )
    return found


def next_siblings(page, elements) -> Column:
    """For each element the one that follows it under the same parent; the last ones
    have none and are left out."""
    everything = _c(page)["elements"]
    after = F.transform(
        elements,
        lambda e: F.struct(e["parent"].alias("of"), F.get(everything, e["last"]).alias("next")),
    )
    siblings = F.filter(after, lambda s: s["next"]["parent"] == s["of"])
    return F.transform(siblings, lambda s: s["next"])


def texts(page, elements) -> Column:
    """Stripped texts of the elements."""
    return F.transform(elements, lambda e: element_text(page, e))


def attributes(elements, name) -> Column:
    """The attribute's values, of the elements that have it."""
    return F.filter(F.transform(elements, lambda e: e["attrs"][name]), lambda v: v.isNotNull())
