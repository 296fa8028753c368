from hypothesis import given, settings
from hypothesis import strategies as st

from skyfare.sources import web

HTML = """<html><body>
<a href="https://x.org/trip+data/green_tripdata_2020-01.csv">g</a>
<A HREF='https://x.org/trip+data/yellow_tripdata_2020-02.csv'>y</A>
<a class="k" href="https://x.org/trip+data/fhv_tripdata_2020-01.csv">f</a>
<a id=1 href=https://x.org/trip+data/green_tripdata_2019-12.csv?a=1&amp;b=2>u</a>
<a href>no value</a><a name="n">no href</a>
<a href="https://x.org/misc/file.csv">other</a>
<table><tbody><tr><td>2020-01-01</td><td><b>40</b></td><td> 30 </td></tr>
<tr><td>2020-01-02</td><td>M</td></tr></tbody></table>
</body></html>"""


def test_extract_links(spark):
    pages = spark.createDataFrame([(1, HTML)], "page_id BIGINT, html STRING")
    links = [r.link for r in web.extract_links(pages).orderBy("link_pos").collect()]
    assert links == ["https://x.org/trip+data/green_tripdata_2020-01.csv",
                     "https://x.org/trip+data/yellow_tripdata_2020-02.csv",
                     "https://x.org/trip+data/green_tripdata_2019-12.csv?a=1&b=2"]


def test_link_metadata(spark):
    df = spark.createDataFrame([("https://x.org/trip+data/green_tripdata_2020-01.csv",),
                                ("https://x.org/a_2019-03.csv/b_2020-04.csv",), ("no-csv",)], "link STRING")
    got = [(r.file_name, r.month, r.year) for r in web.link_metadata(df).collect()]
    assert got == [("green_tripdata_2020-01.csv", "01", "2020"), ("b_2020-04.csv", "03", "2019"),
                   ("no-csv", None, None)]


def test_html_rows(spark):
    pages = spark.createDataFrame([(1, HTML)], "page_id BIGINT, html STRING")
    rows = web.html_rows(pages).orderBy("row_pos").collect()
    assert [(r.date, r.tempMax, r.tempMin, r.tempAvg) for r in rows] == [
        ("2020-01-01", "40", "30", None), ("2020-01-02", "M", None, None)]


def _metadata_rule(link):
    # file name after the last '/'; month and year end 0 and 3 characters before the first '.csv'
    i = link.find(".csv")
    ok = i >= 7
    return (link.rsplit("/", 1)[-1], link[i - 2:i] if ok else None, link[i - 7:i - 3] if ok else None)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["/", ".csv", "2020", "-", "01", "x", "trip+data", "_", "."]),
                         max_size=10).map("".join), min_size=1, max_size=20))
def test_link_metadata_follows_the_rule(spark, links):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(links)], "i INT, link STRING")
    got = [(r.file_name, r.month, r.year) for r in web.link_metadata(df).orderBy("i").collect()]
    assert got == [_metadata_rule(s) for s in links]
