import pytest

from tidewire.functions.html import after_heading
from tidewire.operators.sections import sections

PAGES = [
    "<h1>A</h1><p>one <b>two</b> three</p><ul><li>x</li><li>y <i>z</i></li></ul><a href='/u'>u</a>",
    "<body><h1>A &amp; B</h1><div>outer <div>inner</div> rest</div><p>later</p><ul><li>a<ul><li>nested</li></ul></li><li>b</ul></body>",
    "<h2>No</h2><p>skip</p><h1>B</h1><p>unclosed<p>second<ul><li>i</ul>",
    "<h1>C</h1><script>var t='<p>no</p>';</script><style>p{}</style><!-- <p>no</p> --><span>Jane Doe</span><strong>tel 12</strong><p>John Smith</p>",
    "<p>nothing</p>", "", "<h1>D</h1>", "<h1>E</h1><p></p><div>x@y.z</div><p>Ann Lee</p>",
    "<div><h1>F</h1><p>inside</p></div><p>outside</p><a>no link</a><a href=\"/v\">v</a>",
]


@pytest.mark.parametrize("heading, lenient", [(None, False), ("A & B", False), ("b", True)])
def test_sections_equal_the_parser(spark, heading, lenient):
    pages = [*PAGES, "<h1>G</h1>" + "<p>word</p>" * 2000 + "<ul>" + "".join(f"<li>{i}</li>" for i in range(500)) + "</ul>"]
    df = spark.createDataFrame([(i, p, "x") for i, p in enumerate(pages)] + [(99, None, "x")], "page_id long, html string, name string")
    got = {r["page_id"]: (r["text"], r["items"], r["link"], r["name"]) for r in sections(df, tag="h1", heading=heading, lenient=lenient).collect()}
    for i, page in enumerate(pages):
        want = after_heading(page, "h1", heading, lenient, 1)
        assert got[i] == (want["text"], want["items"], want["link"], want["name"]), page[:80]
    assert got[99] == (None, [], None, None)


def test_second_list_and_no_pages(spark):
    df = spark.createDataFrame([(1, "<h2>T</h2><ul><li>a</li></ul><ul><li>b</li><li>c</li></ul>")], "page_id long, html string")
    assert sections(df, nth_list=2).first()["items"] == ["b", "c"]
    assert sections(df, nth_list=3).first()["items"] == []
    assert sections(df.limit(0)).count() == 0
