"""Paths count whole, however many segments they have."""

from lumenlog.llm import urls


def test_paths_that_differ_behind_a_thousand_segments(spark):
    long = "http://h.org" + "/a" * 1100
    pages = [(k, f"{long}/{'good' if k < 10 else 'bad'}") for k in range(20)]
    labels = [(k, int(k < 10)) for k in range(20)]
    got = {r.page_id: r for r in urls.judge(spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(labels, "page_id long, good int"), rules=()).collect()}
    assert {got[k].verdict for k in range(10)} == {"allow"} and {got[k].verdict for k in range(10, 20)} == {"block"}
    assert got[0].template.endswith("/good") and got[10].template.endswith("/bad")
