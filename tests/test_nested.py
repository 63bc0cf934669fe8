"""Elements by the nesting of their tags, against the standard library's parser."""

from __future__ import annotations

import random
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from shelfline.operators import nested as N
from shelfline.operators import pages as G


class Plain(HTMLParser):
    """Markup inside the elements of one tag with a class, in page order."""

    def __init__(self, html: str, tag: str, name: str | None):
        super().__init__(convert_charrefs=False)
        self.tag, self.name, self.html = tag, name, html
        self.lines = [0]
        for line in html.split("\n"):
            self.lines.append(self.lines[-1] + len(line) + 1)
        self.open, self.spans = [], []
        self.feed(html)
        self.spans += [(s, len(html)) for s, hit in self.open if hit]

    def place(self) -> int:
        line, column = self.getpos()
        return self.lines[line - 1] + column

    def handle_starttag(self, tag, attrs):
        if tag == self.tag:
            classes = (dict(attrs).get("class") or "").split()
            self.open.append((self.place() + len(self.get_starttag_text()), self.name is None or self.name in classes))

    handle_startendtag = handle_starttag

    def handle_endtag(self, tag):
        if tag == self.tag and self.open:
            start, hit = self.open.pop()
            if hit:
                self.spans.append((start, self.place()))

    def items(self):
        return [self.html[a:b] for a, b in sorted(self.spans)]


def _elements(spark, pages, tag, where=None):
    rows = spark.createDataFrame([(i, h) for i, h in enumerate(pages)], "i int, html string")
    return [r.x for r in rows.select("i", N.elements(F.col("html"), tag, where).alias("x")).orderBy("i").collect()]


def _random_page(rng):
    parts = ["<div>", "<div class='card'>", '<DIV class="big card">', "</div>", "</DIV >", "<divan>", "<p class=card>", "</p>", "text", "\n", "&lt;div&gt;", "<br/>", '<a title="<div> > </div>">'.replace("<div>", "").replace("</div>", "")]
    return "".join(rng.choice(parts) for _ in range(rng.randint(0, 60)))


def test_elements_equal_a_parser(spark):
    rng = random.Random(3)
    pages = [_random_page(rng) for _ in range(400)]
    assert sum(p.count("card") > 2 for p in pages) > 100
    for where, name in ((None, None), ("""class=["'][^"']*card""", "card")):
        assert _elements(spark, pages, "div", where) == [Plain(p, "div", name).items() for p in pages]


def test_lists_and_tables_without_end_tags(spark):
    page = "<ul><li>a<li>b<ul><li>c<li>d</ul>e</li><li>f</ul>g<li>h"
    assert _elements(spark, [page], "li") == [["a", "b<ul><li>c<li>d</ul>e", "c", "d", "f", "h"]]
    table = "<table><tr><td>1<td>2<table><tr><td>x</table><tr><th>3</table>"
    assert _elements(spark, [table], "tr") == [["<td>1<td>2<table><tr><td>x</table>", "<td>x", "<th>3"]]


def test_odd_pages(spark):
    pages = [None, "", "no tags", "</div></div>", "<div", "<div>", "<div><!-- </div> -->x<script>'</div>'</script></div>y", "\u0001<div>\u0001a</div>"]
    assert _elements(spark, pages, "div") == [None, [], [], [], [""], [""], ["x"], ["a"]]


def test_deep_and_wide_pages(spark):
    deep, wide = "<div>" * 800 + "x" + "</div>" * 800, "<div class=c>y</div>" * 2000
    got = _elements(spark, [deep, wide], "div")
    assert len(got[0]) == 800 and got[0][0] == deep[5:-6] and got[0][-1] == "x" and got[1] == ["y"] * 2000


@pytest.mark.parametrize("limit", [None, 1])
def test_selectors_in_order_and_fields(spark, limit):
    html = '<section class=x><div class="n"><div>A</div>&amp;</div><a class=y href=q>q</a><a href="/p">p</a></section><section>B</section>'
    pages = spark.createDataFrame([(1, "http://h/l/i", html), (2, "http://h/", "<div>only</div>"), (3, None, None)], "page_id int, url string, html string")
    items = N.split_elements(pages, [("nav", None), ("section", None), ("div", None)], limit)
    assert [(r.page_id, r.position) for r in items.orderBy("page_id", "position").collect()] == ([(1, 0), (1, 1), (2, 0)] if limit is None else [(1, 0), (2, 0)])
    fields = {"name": N.first_text("div", "class=.n"), "link": N.attribute("a", "href"), "image": N.attribute("a", "class")}
    got = G.extract_fields(items, fields).collect()
    assert [(r.page_id, r.name, r.link, r.image) for r in got] == [(1, "A&", "http://h/l/q", "http://h/l/y")]


def test_nothing_is_shuffled(spark):
    pages = spark.createDataFrame([(1, "u", "<div></div>")], "page_id int, url string, html string")
    plan = N.split_elements(pages, [("div", None)])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
