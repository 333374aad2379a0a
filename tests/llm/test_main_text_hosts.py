"""Copies of a page do not make its text template; blocks of different outlines meet."""

import pytest

from lumenlog.llm import html


def texts(spark, pages):
    rows = [(k, "http://h.org/x", h) for k, h in pages]
    return {r.page_id: r.text for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}


@pytest.mark.parametrize("others", [0, 2])
def test_copies_of_an_article_stay(spark, others):
    article = "<article><h1>The head</h1><p>first part</p><p>second part</p></article>"
    pages = [(k, article) for k in range(20)] + [(100 + k, f"<article><h1>Other {k}</h1><p>its text {k}</p></article>") for k in range(others)]
    got = texts(spark, pages)
    assert all(got[k] == "The head\nfirst part\nsecond part" for k in range(20))
    assert all(got[100 + k] == f"Other {k}\nits text {k}" for k in range(others))


def test_page_keeps_a_slot_that_varies(spark):
    # p holds the same text on 16 of 20 different pages, beside a block that some lack
    pages = [(k, f"<div><h1>Head {k}</h1><p>same words</p></div>") for k in range(15)]
    pages += [(50, "<div><p>same words</p></div>")] + [(60 + k, f"<div><h1>Top {k}</h1><p>own words {k}</p></div>") for k in range(3)]
    got = texts(spark, pages)
    assert got[0] == "Head 0" and got[50] == "same words" and got[60] == "Top 0\nown words 0"


def test_first_page_does_not_decide(spark):
    kinds = ["{}<section><h6>Follow us</h6></section>", "<table><tr><td>t{}</td></tr></table>{}<section><h6>Follow us</h6></section>",
             "<dl><dt>a{}</dt></dl><ul><li>b{}</li></ul>{}<section><h6>Follow us</h6></section>"]
    pages = [(-1, None)]
    for k in range(12):
        story = f"<p>story {k}</p>"
        pages.append((k, kinds[k % 3].replace("{}<section", story + "<section").replace("{}", str(k))))
    got = texts(spark, pages)
    assert got[-1] == "" and all("Follow us" not in t for t in got.values())
    assert all(f"story {k}" in got[k].split("\n") for k in range(12))


def test_nodes_that_the_wrapper_lacks_meet(spark):
    # most pages have no section; the others have it at different places
    pages = [(k, f"<p>plain {k}</p>") for k in range(30)]
    pages += [(100 + k, f"<p>story {k}</p><section><h6>Follow us</h6></section>") for k in range(5)]
    pages += [(200 + k, f"<p>story {k}x</p><ul><li>i{k}</li></ul><section><h6>Follow us</h6></section>") for k in range(5)]
    got = texts(spark, pages)
    assert [got[100 + k] for k in range(5)] == [f"story {k}" for k in range(5)]
    assert [got[200 + k] for k in range(5)] == [f"story {k}x\ni{k}" for k in range(5)]
    assert [got[k] for k in range(30)] == [f"plain {k}" for k in range(30)]
