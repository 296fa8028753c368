"""Links and table rows from stored web pages, as Spark jobs over an html column.

Pages go through a tokeniser (``functions.html``) in Arrow batches, cut to a few
MB of text each; every page is read by itself, so nothing is shuffled.  The html
column is text or binary; bytes that are no UTF-8 read as U+FFFD.  Null and
empty pages have neither links nor rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from skyfare.functions.html import anchors, table_rows
from skyfare.session import ship_package
from skyfare.sources.weather import WEATHER_FIELDS

#: Pages of an Arrow batch are turned into rows in groups of about so many bytes.
GROUP_BYTES = 2 << 20
# The reference's link filter terms.
TRIP_LINK_INCLUDE = [".csv", "trip+data"]
TRIP_LINK_EXCLUDE = ["fhv"]


def _each_page(pages: DataFrame, html_col: str, keep: Sequence[str], new: str,
               read: Callable[[str], Iterable[tuple]]) -> DataFrame:
    """(keep..., new columns): the tuples that ``read`` gives for each page."""
    ship_package(pages.sparkSession)
    own = StructType.fromDDL(new)
    out = StructType([pages.schema[c] for c in keep] + own.fields)
    kinds = {f.name: {"string": pa.string(), "int": pa.int32()}[f.dataType.simpleString()] for f in own.fields}
    n = len(keep)

    def rows(group):
        at, found = [], []
        for i, page in enumerate(group.column(n).to_pylist()):
            if page:
                for row in read(page.decode("utf-8", "replace")):
                    at.append(i)
                    found.append(row)
        if not found:
            return None
        old = [group.column(i).take(pa.array(at)) for i in range(n)]
        return pa.RecordBatch.from_arrays(
            old + [pa.array(c, t) for c, t in zip(zip(*found, strict=True), kinds.values(), strict=True)],
            names=[*keep, *kinds])

    def task(batches):
        for batch in batches:
            size = pc.fill_null(pc.binary_length(batch.column(n)), 0).to_numpy(zero_copy_only=False).cumsum()
            at = 0
            while at < batch.num_rows:
                base = size[at - 1] if at else 0
                end = max(at + 1, int(size.searchsorted(base + GROUP_BYTES, side="right")))
                if (done := rows(batch.slice(at, end - at))) is not None:
                    yield done
                at = end

    html = F.col(html_col).cast("binary").alias("_html")
    return pages.select(*keep, html).where("octet_length(_html) > 0").mapInArrow(task, out)


def extract_links(pages: DataFrame, html_col: str = "html", keep: Sequence[str] = ("page_id",),
                  include: Iterable[str] = TRIP_LINK_INCLUDE,
                  exclude: Iterable[str] = TRIP_LINK_EXCLUDE) -> DataFrame:
    """One row per kept ``<a href>``: (keep..., link_pos, link).

    ``link_pos`` numbers the page's anchors from 0.  The first href of each
    anchor, entity-decoded; kept when non-empty, holding every ``include`` term
    and no ``exclude`` term.  Anchors without a value are skipped, and so is
    what stands in comments, scripts and styles.
    """
    def read(page):
        return ((i, link) for i, link in enumerate(anchors(page)) if link)

    out = _each_page(pages, html_col, keep, "link_pos INT, link STRING", read)
    cond = F.lit(True)
    for term in include:
        cond = cond & F.col("link").contains(term)
    for term in exclude:
        cond = cond & ~F.col("link").contains(term)
    return out.where(cond)


def link_metadata(links: DataFrame, link_col: str = "link") -> DataFrame:
    """file_name = text after the last '/'; month, year = the 2 and 4 characters
    that end 0 and 3 characters before the first '.csv'.  Null when there is no
    '.csv' or too little text before it."""
    link = F.col(link_col)
    p = F.locate(".csv", link)
    ok = p > 7
    return links.select(
        "*",
        F.substring_index(link, "/", -1).alias("file_name"),
        F.when(ok, F.substring(link, p - 2, 2)).alias("month"),
        F.when(ok, F.substring(link, p - 7, 4)).alias("year"),
    )


def html_rows(pages: DataFrame, html_col: str = "html", keep: Sequence[str] = ("page_id",),
              row_tag: str = "tr", cell_tag: str = "td",
              columns: Sequence[str] = WEATHER_FIELDS) -> DataFrame:
    """Rows of tables: (keep..., row_pos, columns...), cell i -> column i of ``columns``; the text of each cell.

    ``row_pos`` numbers the page's rows from 0 (``functions.html.table_rows``).
    Missing cells are null, extra cells are ignored.
    """
    width = len(columns)

    def read(page):
        for i, cells in enumerate(table_rows(page, row_tag, cell_tag)):
            yield (i, *cells[:width], *[None] * (width - len(cells)))

    new = ", ".join(["row_pos INT", *[f"`{c}` STRING" for c in columns]])
    return _each_page(pages, html_col, keep, new, read)
