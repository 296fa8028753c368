"""The tokeniser against the standard library's parser, and the tables it finds against a plain tree walk."""

from html.parser import HTMLParser

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from skyfare.functions.html import anchors, decode_attribute, table_rows, tokens
from skyfare.sources import web


class Plain(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=False)
        self.seen = []

    def handle_starttag(self, tag, attrs):
        self.seen.append(("start", tag, [n for n, _ in attrs]))

    def handle_endtag(self, tag):
        self.seen.append(("end", tag))


PIECES = ["<a href=x>", "<a title=\"a>b\" href='y'>", "<A HREF = z disabled>", "</a>", "<br/>", "<td>", "</td >", "text",
          "<!-- <a href=c> -->", "<!DOCTYPE html>", "<script>if (a<b) '<a href=s>'</script>", "<style>a<b{}</style>",
          "<input checked value=\"\">", "a < b", " & ", "<p class=a/b>", "\n", "<!---->"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=12).map("".join))
def test_tags_are_those_of_the_standard_parser(page):
    plain = Plain()
    plain.feed(page)
    plain.close()
    got = [(k, n, [a for a, _ in v]) if k == "start" else (k, n) for k, n, v in tokens(page) if k != "text"]
    assert got == [t if t[:2] != ("end", "br") else t for t in plain.seen if t != ("end", "br")]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="<>/!-=\"' ab\n&;", max_size=40))
def test_any_text_ends_and_keeps_plain_text(page):
    got = list(tokens(page))
    assert len(got) <= len(page) + 1
    if "<" not in page:
        assert "".join(t for _, t, _ in got) == page


@pytest.mark.parametrize("page, links", [
    ('<a title="a>b" href="u">', ["u"]),
    ("<!-- <a href=no> --><a href=yes>", ["yes"]),
    ("<a href>x</a><a name=n><a href=''>", [None, None, ""]),
    ("<a href=1 href=2>", ["1"]),
    ("<a href = 'x y'class=k><a/href=q>", ["x y", "q"]),
    ("<script>'<a href=s>'</script><style><a href=t></style><a href=u>", ["u"]),
    ("<textarea><a href=no></textarea><a href=u>", ["u"]),
    ("<a href='never closed><a href=x>", []),
    ("<!-- never closed <a href=x>", []),
    ("<!--><a href=u><!---><a href=v>", ["u", "v"]),
    ("<abbr href=x><a\nhref=y>", ["y"]),
    ("a < b <a href=u", []),
    ("</", []), ("<", []), ("", []),
])
def test_anchors(page, links):
    assert list(anchors(page)) == links


def test_references_in_attributes():
    assert decode_attribute("?a=1&amp;b=2&copy=3&lt;&#65;&#x42;&notit;&amp;=") == "?a=1&b=2&copy=3<AB&notit;&="


@pytest.mark.parametrize("page, rows", [
    ("<table><tr><td>a<td>b<tr><td>c</table>", [["a", "b"], ["c"]]),
    ("<tr><td>1<table><tr><td>x</td></tr></table></td><td>2</td></tr>", [["1x", "2"], ["x"]]),
    ("<table><td>a</td><td>b</td></table><td>lost</td>", [["a", "b"]]),
    ("<table><thead><tr><th>h<td>a<tbody><tr><td>b<!-- <td>c --> d</table>", [["a"], ["b d"]]),
    ("<tr><td><b>4</b>0<br>&lt;x&gt;&nbsp;</td><td><script>'<td>'</script></td></tr>", [["40\n<x>\xa0", ""]]),
    ("<tr></tr><tr><td>", [[], [""]]),
    ("<td>no row</td>", []),
])
def test_table_rows(page, rows):
    assert table_rows(page) == rows


def test_lists_and_items():
    page = "<ul><li>a<ul><li>b</ul><li>c</ul><li>outside</li>"
    assert table_rows(page, "ul", "li") == [["ab", "c"], ["b"]]


@settings(max_examples=60, deadline=None)
@given(st.recursive(st.text(alphabet="ab", max_size=2), lambda c: st.lists(st.lists(c, max_size=3), max_size=3),
                    max_leaves=12), st.booleans())
def test_tables_written_out_are_read_back(tree, implied):
    """Nested tables, with and without the end tags that may be left out."""
    end = ("", "") if implied else ("</td>", "</tr>")

    def write(node):
        if isinstance(node, str):
            return node
        return "<table>" + "".join("<tr>" + "".join(f"<td>{write(c)}{end[0]}" for c in row) + end[1]
                                   for row in node) + "</table>"

    def flat(node):
        return node if isinstance(node, str) else "".join(flat(c) for row in node for c in row)

    def walk(node, out):
        if not isinstance(node, str):
            for row in node:
                out.append([flat(c) for c in row])
                for c in row:
                    walk(c, out)
        return out

    assert table_rows(write(tree)) == walk(tree, [])


def test_pages_in_spark(spark, monkeypatch):
    monkeypatch.setattr(web, "GROUP_BYTES", 64)
    pages = [(1, "<a title='>' href=/1.csv><table><tr><td>x<td>y<tr><td>z</table>".encode(), "k"),
             (2, None, "k"), (3, b"", None), (4, b"no tags", "k"),
             (5, b"<a href='/\xff.csv'><tr><td>\xff b</td></tr>", None),
             (6, b"<a href=/6.csv>" * 3000, "long")]
    df = spark.createDataFrame(pages, "page_id INT, html BINARY, extra STRING").repartition(3)
    links = web.extract_links(df, include=[".csv"], exclude=["fhv"], keep=["page_id", "extra"])
    got = sorted((r.page_id, r.extra or "", r.link_pos, r.link) for r in links.collect())
    assert got[:2] == [(1, "k", 0, "/1.csv"), (5, "", 0, "/�.csv")]
    assert got[2:] == [(6, "long", i, "/6.csv") for i in range(3000)]
    rows = web.html_rows(df, columns=["c0", "c1"]).orderBy("page_id", "row_pos").collect()
    assert [tuple(r) for r in rows] == [(1, 0, "x", "y"), (1, 1, "z", None), (5, 0, "� b", None)]
    assert web.html_rows(df.where("page_id > 9")).count() == 0
