"""Trees of any depth and width, names that only look like marks."""

import random
import time

from lumenlog.llm import html


def plain_weight(a, b):
    """The size of a largest mapping, by the definition."""
    ta, ka = html.tree_of(a)
    tb, kb = html.tree_of(b)

    def w(x, y):
        if ta[x] != tb[y]:
            return 0
        p, q = ka[x], kb[y]
        best = [[0] * (len(q) + 1) for _ in range(len(p) + 1)]
        for i in range(1, len(p) + 1):
            for j in range(1, len(q) + 1):
                best[i][j] = max(best[i - 1][j], best[i][j - 1], best[i - 1][j - 1] + w(p[i - 1], q[j - 1]))
        return best[-1][-1] + 1

    return w(0, 0)


def random_outline(r, depth=0):
    kids = [random_outline(r, depth + 1) for _ in range(r.randrange(4 if depth < 4 else 1))]
    return r.choice(["div", "p", "ul"]) + (f"({' '.join(kids)} )" if kids else "")


def test_mappings_are_largest_and_valid():
    r = random.Random(9)
    for _ in range(300):
        a, b = (f"({random_outline(r)} {random_outline(r)} )" for _ in range(2))
        partner = html.matched(a, b)
        ta, ka = html.tree_of(a)
        tb, kb = html.tree_of(b)
        assert sum(x >= 0 for x in partner) == plain_weight(a, b)
        for x, kids in enumerate(ka):
            mine = [partner[c] for c in kids if partner[c] >= 0]
            assert mine == sorted(mine) and set(mine) <= set(kb[partner[x]] if partner[x] >= 0 else [])
            assert all(ta[c] == tb[partner[c]] for c in kids if partner[c] >= 0)


def test_deep_and_wide_pages():
    n = 100_000
    deep = "<div>" * n + "text" + "</div>" * n
    outline, blocks = html.parse(deep)
    assert [t for _, t in blocks] == ["text"] and outline.count("div") == n
    t = time.time()
    assert all(x >= 0 for x in html.matched(outline, outline))
    wide = "(" + "div(p ) ul " * 20_000 + ")"
    assert sum(x < 0 for x in html.matched(wide, wide[:-1] + "table )")) == 0
    assert time.time() - t < 30


def test_one_deep_page_is_a_row(spark):
    page = "<article>" + "<div>" * 3000 + "<p>main text</p>" + "</div>" * 3000 + "</article>"
    rows = [(k, f"http://h.example/{k}", page) for k in range(3)] + [(9, "http://h.example/9", None)]
    got = {r.page_id: r.text for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {0: "main text", 1: "main text", 2: "main text", 9: ""}


def test_names():
    page = '<article><p>one</p><div class="related-work">two</div><div id="search-methods">three</div><div class="ad-box top">four</div><p class="story comments-are-closed">five</p></article>'
    assert [t for _, t in html.parse(page)[1]] == ["one", "two", "three", "five"]
    assert [t for _, t in html.parse('<div class="widget"><p>main</p></div>')[1]] == ["main"]
    assert [t for _, t in html.parse('<div class="site-header">a</div><p>b</p><nav>c</nav>')[1]] == ["b"]
    assert html.parse('<nav>c</nav>')[1] == []
