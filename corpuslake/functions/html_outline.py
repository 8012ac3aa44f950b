"""Per-page helper: the text nodes of an HTML page and the spans its elements cover.

Only tokenising happens here. Which span is the article is decided by column expressions in
``operators.extract``.
"""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

MAIN, ARTICLE, CONTAINER, BLOCK = 0, 1, 2, 6
#: Characters of HTML whose outlines a task holds before it hands them on; what a page counts besides its own.
SLICE, PAGE = 4 << 20, 1 << 10
# Elements without article text, and container classes in order of preference.
REMOVED = frozenset(["script", "style", "nav", "footer", "header", "aside"])
CONTAINER_CLASSES = ["article", "content", "body", "main"]

_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
_CLOSES_P = frozenset(
    "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav "
    "ol p pre section table ul".split()
)
_SIBLINGS = {"li": {"li"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}}
# An end tag does not reach past an open element of higher rank.
_RANK = {
    "div": 2, "article": 2, "main": 2, "section": 2, "li": 2, "td": 3, "th": 3, "tr": 4,
    "ul": 5, "ol": 5, "dl": 5, "table": 5, "body": 6, "html": 7,
}


class Outline(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.title: str | None = None
        self.texts: list[str] = []
        self.spans: list[list[int]] = []  # kind, first text, end text
        self._open: list[tuple[str, list[int]]] = []
        self._hidden = 0
        self._pending: list[str] = []
        self._seen: set[int] = set()

    def handle_data(self, data: str) -> None:
        self._pending.append(data)

    def handle_comment(self, data: str) -> None:
        self._flush()

    def _flush(self) -> None:
        if not self._pending:
            return
        text = "".join(self._pending).strip()
        self._pending.clear()
        if self._open and self._open[-1][0] == "title" and self.title is None:
            self.title = text
        if text and not self._hidden:
            self.texts.append(text)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self._flush()
        if tag in _CLOSES_P:
            self._close_nearest({"p"}, 2)
        elif tag in _SIBLINGS:
            self._close_nearest(_SIBLINGS[tag], 5)
        if tag in _VOID:
            return
        self._open.append((tag, [] if self._hidden else self._begin(tag, attrs)))
        self._hidden += tag in REMOVED

    def _begin(self, tag: str, attrs: list[tuple[str, str | None]]) -> list[int]:
        kinds = []
        if tag == "main":
            kinds = [MAIN]
        elif tag == "article":
            kinds = [ARTICLE]
        elif tag in ("p", "div"):
            kinds = [BLOCK]
            if tag == "div":
                names = (dict(attrs).get("class") or "").split()
                kinds += [CONTAINER + i for i, c in enumerate(CONTAINER_CLASSES) if c in names]
        begun = []
        for kind in kinds:
            # Of <main> and <article> only the first one counts.
            if kind in (MAIN, ARTICLE):
                if kind in self._seen:
                    continue
                self._seen.add(kind)
            begun.append(len(self.spans))
            self.spans.append([kind, len(self.texts), -1])
        return begun

    def handle_endtag(self, tag: str) -> None:
        self._flush()
        rank = _RANK.get(tag, 1)
        for depth in range(len(self._open) - 1, -1, -1):
            name = self._open[depth][0]
            if name == tag:
                self._close_to(depth)
                return
            if _RANK.get(name, 1) > rank:
                return

    def _close_nearest(self, tags: set[str], boundary: int) -> None:
        for depth in range(len(self._open) - 1, -1, -1):
            name = self._open[depth][0]
            if name in tags:
                self._close_to(depth)
                return
            if _RANK.get(name, 1) >= boundary:
                return

    def _close_to(self, depth: int) -> None:
        while len(self._open) > depth:
            tag, begun = self._open.pop()
            self._hidden -= tag in REMOVED
            for i in begun:
                self.spans[i][2] = len(self.texts)

    def finish(self) -> Outline:
        self.close()
        self._flush()
        self._close_to(0)
        return self


def outline(page: str | bytes | None) -> tuple[str, list[str], list[int], list[int], list[int], list[int]]:
    """Title, text nodes, and per element: kind, first text, number of texts, length when joined."""
    if isinstance(page, (bytes, bytearray)):
        page = bytes(page).decode("utf-8", errors="ignore")
    parser = Outline()
    parser.feed(page or "")
    parser.finish()
    ends = [0]
    for t in parser.texts:
        ends.append(ends[-1] + len(t))
    kinds, starts, sizes, chars = [], [], [], []
    for kind, a, b in parser.spans:
        if b > a:
            kinds.append(kind)
            starts.append(a)
            sizes.append(b - a)
            chars.append(ends[b] - ends[a] + (b - a - 1))
    return parser.title or "", parser.texts, kinds, starts, sizes, chars


OUTLINE_TYPE = StructType(
    [StructField("title", StringType()), StructField("texts", ArrayType(StringType()))]
    + [StructField(c, ArrayType(IntegerType())) for c in ("kinds", "starts", "sizes", "chars")]
)


_ARROW = [pa.string(), pa.list_(pa.string()), *[pa.list_(pa.int32())] * 4]


def outlines(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """The outlines of pages, handed on whenever they come to SLICE characters of HTML, however many pages a batch has."""

    def packed(rows: list[tuple]) -> pa.Array:
        columns = zip(*rows, strict=True)
        return pa.StructArray.from_arrays([pa.array(c, kind) for c, kind in zip(columns, _ARROW, strict=True)], names=OUTLINE_TYPE.names)

    for batch in batches:
        rows, size = [], 0
        for page in batch:
            html = page.as_py()
            rows.append(outline(html))
            size += len(html or "") + PAGE
            if size >= SLICE:
                yield packed(rows)
                rows, size = [], 0
        if rows:
            yield packed(rows)


@arrow_udf(OUTLINE_TYPE)
def _html_outline(pages: Iterator[pa.Array]) -> Iterator[pa.Array]:
    yield from outlines(pages)


# Declared non-deterministic so that a later filter is not pushed below it, which would parse every page twice.
html_outline = _html_outline.asNondeterministic()
