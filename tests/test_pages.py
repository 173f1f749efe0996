"""Elements of pages: nested tables, unclosed tags, links below headings, cells by the ends of their ids."""

from vitrine.sources.pages import below_headings, elements, rows_by_name, table_records

PAGE = """<a href="/0">Above</a><h2>Ana <b>Pop</b></h2><ul><li><a href="/1?a=1&amp;b=2">One</a><li><a href=/2>Two <i>x</i></ul>
<h3>Part</h3><a name=no>none</a><a href='/3'>Three<script>var a = "<a href=no>";</script></a><h2>Ion</h2><a href="/4">Four<p>still</p>
<table><tr><th>Name<th>Value</tr><tr><td id=r1_lblName>A <a href="/5">five</a></td><td id=r1_lblVal>1</td></tr>
<tr><td id=r2_lblName>B<table><tr><td>inner</td></tr></table></td><td id=r2_lblVal>2<br>3</tr></table><!-- <a href="/no"> -->"""


def frame(spark, *pages):
    return elements(spark.createDataFrame(list(enumerate(pages)), "page long, html string"))


def test_links_take_the_nearest_heading(spark):
    rows = below_headings(frame(spark, PAGE), "page").orderBy("pos").collect()
    assert [(r["target"], r["heading"], r["heading_no"]) for r in rows] == [
        ("/0", None, 0), ("/1?a=1&b=2", "Ana Pop", 1), ("/2", "Ana Pop", 1), ("/3", "Part", 2), ("/4", "Ion", 3), ("/5", "Ion", 3),
    ]
    assert rows[2]["text"] == "Two x" and rows[3]["text"] == "Three"
    upper = below_headings(frame(spark, PAGE), "page", least_level=2).orderBy("pos").collect()
    assert [r["heading"] for r in upper] == [None, "Ana Pop", "Ana Pop", "Ana Pop", "Ion", "Ion"]


def test_cells_by_suffix_and_by_header(spark):
    rows = rows_by_name(frame(spark, PAGE), ["page"], {"name": "lblName", "value": "lblVal"}).orderBy("row_no").collect()
    assert [(r["name"], r["value"]) for r in rows] == [("A five", "1"), ("Binner", "2 3")]
    rows = table_records(frame(spark, PAGE), ["page"], {"n": ["name"], "v": ["value", "valoare"], "none": ["other"]}).orderBy("row_no").collect()
    assert [(r["n"], r["v"], r["none"]) for r in rows] == [("A five", "1", None), ("Binner", "2 3", None)]


def test_odd_pages(spark):
    assert frame(spark, None, "", "no tags", "<a href=", "</table></td><td>lost", "<a>no target</a>").count() == 0
    assert [(r["page"], r["text"]) for r in frame(spark, None, "<h1>open").collect()] == [(1, "open")]
