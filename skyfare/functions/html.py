"""A tokeniser for HTML as browsers write it: one pass over a page, no tree.

A state machine over the page: text, tags with quoted, unquoted and valueless
attributes, comments, declarations, and elements whose content is not markup.
What the page's end cuts off (a tag, a comment) gives no token.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape as decode_text
from html.entities import html5

# Elements whose content is no markup (shown or not).
HIDDEN_ELEMENTS = ["script", "style", "iframe", "noembed", "noframes", "xmp"]
SHOWN_ELEMENTS = ["textarea", "title"]

_SPACE = r"[\t\n\f\r ]"
_NAME = re.compile(r"[A-Za-z][^\t\n\f\r />]*+")
_GAP = re.compile(r"[\t\n\f\r /]*+")
_ATTRIBUTE = re.compile(
    r"([^\t\n\f\r />][^\t\n\f\r />=]*+)"
    rf"(?:{_SPACE}*+={_SPACE}*+(?:\"([^\"]*)\"|'([^']*)'|(?=>)|([^\t\n\f\r >\"'][^\t\n\f\r >]*+)|([\"'])))?+")
_COMMENT_END = re.compile(r"--!?>")
_RAW_END = {n: re.compile(rf"</{n}(?=[\t\n\f\r />])", re.I) for n in HIDDEN_ELEMENTS + SHOWN_ELEMENTS}
_REFERENCE = re.compile(r"&(?:#[xX][0-9a-fA-F]+;?|#[0-9]+;?|([A-Za-z][A-Za-z0-9]*+)(?:(;)|(?!=)))")

Token = tuple[str, str, object]


def decode_attribute(value: str) -> str:
    """Character references of an attribute: a name without ``;`` counts only when nothing of a name or ``=`` follows."""
    def one(m):
        name = m.group(1)
        if name and name + (m.group(2) or "") not in html5:
            return m.group()
        return decode_text(m.group())
    return _REFERENCE.sub(one, value) if "&" in value else value


def _tag_end(page: str, at: int) -> tuple[int, list[tuple[str, str | None]]] | None:
    """(place after the tag, its attributes) from the place after the tag's name; None if the page ends first."""
    found = []
    while True:
        at = _GAP.match(page, at).end()
        if at >= len(page):
            return None
        if page[at] == ">":
            return at + 1, found
        m = _ATTRIBUTE.match(page, at)
        if m.group(5):  # a quote that nothing closes
            return None
        value = next((v for v in m.group(2, 3, 4) if v is not None), None)
        found.append((m.group(1).lower(), value))
        at = m.end()


def tokens(page: str) -> Iterator[Token]:
    """("text", raw text, None), ("start", name, [(attribute, raw value or None)]) and ("end", name, None)."""
    at, size = 0, len(page)
    while at < size:
        lt = page.find("<", at)
        if lt < 0:
            yield "text", page[at:], None
            return
        if lt > at:
            yield "text", page[at:lt], None
        closing = page.startswith("/", lt + 1)
        name = _NAME.match(page, lt + 1 + closing)
        if not name:
            follows = page[lt + 1:lt + 2]
            if follows not in ("!", "?") and not closing:
                yield "text", "<", None
                at = lt + 1
            elif page.startswith("<!--", lt) and not page.startswith(("<!-->", "<!--->"), lt):
                end = _COMMENT_END.search(page, lt + 4)
                at = end.end() if end else size
            elif closing and lt + 2 >= size:
                yield "text", "</", None
                return
            else:
                end = page.find(">", lt)
                at = end + 1 if end >= 0 else size
            continue
        end = _tag_end(page, name.end())
        if end is None:
            return
        at, attributes = end
        tag = name.group().lower()
        yield ("end", tag, None) if closing else ("start", tag, attributes)
        if not closing and tag in _RAW_END:
            stop = _RAW_END[tag].search(page, at)
            until = stop.start() if stop else size
            if tag in SHOWN_ELEMENTS and until > at:
                yield "text", page[at:until], None
            at = until


def anchors(page: str) -> Iterator[str | None]:
    """The first ``href`` of each ``<a>``, decoded; None where it has none or no value."""
    for kind, name, attributes in tokens(page):
        if kind == "start" and name == "a":
            value = next((v for n, v in attributes if n == "href"), None)
            yield None if value is None else decode_attribute(value)


class _Table:
    """One open table: its open row and the place of its open cell's first text."""

    def __init__(self):
        self.row: list[str] | None = None
        self.cell: int | None = None


def table_rows(page: str, row_tag: str = "tr", cell_tag: str = "td") -> list[list[str]]:
    """The cells' texts of each row, rows in the order of their starts.

    End tags of rows and cells may be missing: the next row, cell or section
    and the end of the table end them.  A table inside a cell has rows of its
    own, and its text is part of the outer cell's.  For other tags than ``tr``
    each ``row_tag`` element is a table of one row (a list and its items).
    Text is decoded, ``<br>`` is a line break, and white space at the ends goes.
    """
    table_tag = "table" if row_tag == "tr" else row_tag
    sections = {"tbody", "thead", "tfoot", "caption"} if row_tag == "tr" else set()
    others = {"th"} if cell_tag == "td" else {"td"} if cell_tag == "th" else set()
    rows: list[list[str]] = []
    text: list[str] = []
    open_tables = [_Table()]  # rows may stand outside any table

    def end_cell(t):
        if t.cell is not None:
            t.row.append("".join(text[t.cell:]).strip("\t\n\f\r "))
            t.cell = None

    def end_row(t):
        end_cell(t)
        t.row = None

    def start_row(t):
        end_row(t)
        t.row = []
        rows.append(t.row)

    for kind, name, _ in tokens(page):
        t = open_tables[-1]
        if kind == "text":
            if any(o.cell is not None for o in open_tables):
                text.append(decode_text(name))
        elif kind == "start":
            if name == table_tag:
                open_tables.append(t := _Table())
            if name == row_tag:
                start_row(t)
            elif name == cell_tag and (t.row is not None or len(open_tables) > 1):
                end_cell(t)
                if t.row is None:  # a cell straight in a table is in a row of its own
                    start_row(t)
                t.cell = len(text)
            elif name in others:
                end_cell(t)
            elif name in sections:
                end_row(t)
            elif name == "br":
                text.append("\n")
        elif name == table_tag:
            end_row(t)
            if len(open_tables) > 1:
                open_tables.pop()
        elif name == row_tag or name in sections:
            end_row(t)
        elif name == cell_tag:
            end_cell(t)
        if len(open_tables) == 1 and t.cell is None and t is open_tables[0]:
            text.clear()
    while open_tables:
        end_row(open_tables.pop())
    return rows
