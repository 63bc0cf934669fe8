"""Records from pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfline.functions.text import preview
from shelfline.operators import nested as N
from shelfline.operators import pages as G
from shelfline.queries.registry import query, rounded
from shelfline.sources import adapters as A

ITEM = r"(?s)<li>(.*?)</li>"
PARAGRAPH = r"(?s)<p>(.*?)</p>"
HOST = "lower(regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1))"


def _pieces(pattern: str, name: str) -> str:
    return f"""{name} AS (SELECT page_id, url, unnest(regexp_extract_all(html, '{pattern}', 1)) AS item,
  generate_subscripts(regexp_extract_all(html, '{pattern}', 1), 1)::INT - 1 AS position FROM pages)"""


@query(f"WITH {_pieces(PARAGRAPH, 'p')} SELECT page_id, url, position, item FROM p")
def x1_split_containers(spark, folder):
    """The first pattern occurs on no page, so the second decides."""
    return G.split_containers(A.pages(spark, folder), [r"(?s)<section>(.*?)</section>", PARAGRAPH])


@query(f"WITH {_pieces(PARAGRAPH, 'p')} SELECT page_id, position FROM p WHERE position < 25")
def w8_records_per_page_limit(spark, folder):
    rows = G.split_containers(A.pages(spark, folder), [PARAGRAPH], limit=G.PAGE_LIMIT)
    return rows.select("page_id", "position")


@query(f"""WITH {_pieces(ITEM, 'i')} SELECT page_id, position, trim(regexp_extract(item, '<a[^>]*>(.*?)</a>', 1)) AS name,
CASE WHEN regexp_extract(item, '([0-9]+)', 1) <> '' THEN regexp_extract(item, '([0-9]+)', 1)::DOUBLE END AS price,
regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || regexp_extract(item, 'href="([^"]*)"', 1) AS link,
NULL::VARCHAR AS image, NULL::VARCHAR AS availability FROM i""")
def x2_field_extraction(spark, folder):
    fields = {"name": r"<a[^>]*>(.*?)</a>", "price": r"([0-9]+)", "link": r'href="([^"]*)"'}
    return G.extract_fields(G.split_containers(A.pages(spark, folder), [ITEM]), fields)


@query(f"""WITH {_pieces(ITEM, 'i')}, r AS (SELECT page_id, position, trim(regexp_extract(item, '<a[^>]*>([^<]*)<', 1)) AS name,
regexp_extract(item, 'href="([^"]*)"', 1) AS h FROM i)
SELECT page_id, position, name, NULL::DOUBLE AS price, 'http://shop.example.com' || h AS link, 'laptop' AS search_term,
'In Stock' AS availability, NULL::VARCHAR AS rating, 'Pages' AS source FROM r WHERE name <> ''""")
def x3_search_results(spark, folder):
    items = G.split_containers(A.pages(spark, folder), [ITEM])
    return G.extract_results(
        items, "laptop",
        titles=[r"<h2[^>]*>([^<]*)<", r"<a[^>]*>([^<]*)<"],
        links=[r'data-link="([^"]*)"', r'href="([^"]*)"'],
        host="http://shop.example.com", source="Pages",
    )


@query(f"""WITH {_pieces(ITEM, 'i')} SELECT page_id AS page, position, trim(regexp_extract(item, '<a[^>]*>(.*?)</a>', 1)) AS name,
NULL::VARCHAR AS price, regexp_extract(item, '<a href="([^"]*)"', 1) AS link, 'Unknown' AS availability
FROM i WHERE trim(regexp_extract(item, '<a[^>]*>(.*?)</a>', 1)) NOT IN ('The', 'and', '')""")
def x4_auction_results(spark, folder):
    items = G.split_containers(A.pages(spark, folder), [ITEM])
    return G.extract_auctions(
        items, titles=[r'<span role="heading">(.*?)</span>', r"<a[^>]*>(.*?)</a>"],
        link=r'<a href="([^"]*)"', placeholders=["The", "and"],
    )


@query(f"""WITH c AS (SELECT {HOST} AS host, regexp_matches(lower(html),
'captcha|robot|automated|blocked|unusual traffic|request blocked|access denied|temporarily blocked') AS blocked,
NOT contains(html, '<li><a href=') AS loaded_empty FROM pages)
SELECT host, count(*) AS pages, count(*) FILTER (WHERE blocked) AS blocked, count(*) FILTER (WHERE loaded_empty) AS loaded_empty,
round(avg(blocked::INT::DOUBLE), 6) AS blocked_rate FROM c GROUP BY 1""")
def x5_block_rates(spark, folder):
    return rounded(G.block_rates(G.classify_pages(A.pages(spark, folder), mark="<li><a href=")))


@query(f"""SELECT page_id, url, {HOST} AS host, regexp_matches(lower(html), 'mit license|all rights|cookie') AS blocked,
contains(html, '<br>') AS has_results, NOT contains(html, '<br>') AS loaded_empty FROM pages""")
def x5_page_classes(spark, folder):
    return G.classify_pages(A.pages(spark, folder), ["mit license", "all rights", "cookie"], "<br>")


@query(f"""WITH r AS (SELECT {HOST} AS host, len(regexp_extract_all(html, '{PARAGRAPH}', 1)) AS n FROM pages)
SELECT host, count(*) AS pages, sum(n)::BIGINT AS records, count(*) FILTER (WHERE n = 0) AS empty_pages FROM r GROUP BY 1""")
def x6_records_per_host(spark, folder):
    return G.records_per_host(A.pages(spark, folder), [PARAGRAPH])


@query(f"""WITH {_pieces(PARAGRAPH, 'p')}, t AS (SELECT page_id, position, regexp_replace(item, '<[^>]*>', '', 'g') AS t FROM p),
u AS (SELECT page_id, position, replace(replace(replace(replace(t, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&') AS t FROM t)
SELECT page_id, position, CASE WHEN length(t) > 50 THEN substring(t, 1, 50) || '...' ELSE t END AS preview FROM u""")
def x7_paragraph_previews(spark, folder):
    """Text of every paragraph, tags and character references resolved, as a list shows it."""
    rows = G.split_containers(A.pages(spark, folder), [PARAGRAPH])
    return rows.select("page_id", "position", preview(G.text_of(F.col("item"))).alias("preview"))


# Parts as pages of records whose fields are all there: five kinds of a part on a page.
FILLED = """q AS (SELECT p_partkey AS k, p_partkey // 40 AS page_id, p_name AS n, p_brand AS b, p_size AS z,
  (row_number() OVER (PARTITION BY p_partkey // 40 ORDER BY p_partkey) - 1)::INT AS position,
  printf('%.2f', p_retailprice) AS r FROM part)"""


def _filled(spark, folder, record: str):
    """Pages with one record per part; ``record`` is a format with the part's fields."""
    part = A.table(spark, folder, "part")
    key = F.col("p_partkey")
    markup = F.format_string(
        record, key, "p_name", F.format_string("%.2f", "p_retailprice"), "p_brand", "p_size"
    )
    rows = part.select(F.floor(key / 40).cast("long").alias("page_id"), F.struct(key, markup.alias("m")).alias("r"))
    pages = rows.groupBy("page_id").agg(F.array_sort(F.collect_list("r")).alias("r"))
    body = F.concat(F.lit("<html><body>"), F.array_join(F.col("r.m"), "\n"), F.lit("</body></html>"))
    return pages.select("page_id", F.lit("http://shop.example.com/list/all.html").alias("url"), body.alias("html"))


@query(f"""WITH {FILLED} SELECT page_id, position, n AS name, r::DOUBLE AS price, 'http://shop.example.com/list/p/' || k AS link,
'http://shop.example.com/img/' || k || '.jpg' AS image, CASE WHEN z > 25 THEN 'In stock' ELSE 'Size ' || z END AS availability FROM q""")
def x2_filled_fields(spark, folder):
    """Cards with price, image and availability."""
    card = (
        '<article class="card product_pod"><h3><a href="p/%1$d" title="%2$s">%2$s</a></h3><img src="/img/%1$d.jpg">'
        '<p class="price_color">£%3$s</p><p class="instock availability"> Size\n  %5$d </p></article>'
    )
    pages = _filled(spark, folder, card)
    # Large sizes say that they are in stock.
    large = F.regexp_replace("html", r"Size\s+(2[6-9]|[3-9][0-9])\s", "In  stock ")
    items = G.split_containers(pages.withColumn("html", large), G.CATALOGUE_CONTAINERS)
    return G.extract_fields(items, G.CATALOGUE_FIELDS)


@query(f"""WITH {FILLED} SELECT page_id, position, n AS name, r::DOUBLE AS price, 'https://www.amazon.com/dp/' || k AS link,
'parts' AS search_term, 'In Stock' AS availability, CASE WHEN z <= 25 THEN z || ' out of 50' END AS rating, 'Amazon' AS source FROM q""")
def x3_filled_results(spark, folder):
    """Search results with prices and, for the smaller sizes, a rating; up to forty on a page."""
    result = (
        '<div class="s-result-item" data-component-type="s-search-result"><div data-cy="title-recipe">'
        '<a class="a-link-normal" href="/dp/%1$d"><h2><span>%2$s</span></h2></a></div><i class="a-icon-alt">%5$d out of 50</i>'
        '<span class="a-price"><span class="a-offscreen">$%3$s</span></span></div>'
    )
    unrated = F.regexp_replace(F.col("html"), r'<i class="a-icon-alt">(2[6-9]|[3-9][0-9]) out of 50</i>', "")
    pages = _filled(spark, folder, result).withColumn("html", unrated)
    return G.extract_results(G.split_containers(pages, G.RESULT_CONTAINERS), "parts")


@query(f"""WITH {FILLED} SELECT page_id AS page, position, n AS name, '$' || r || ' to $' || r AS price,
'http://shop.example.com/' || k AS link, CASE WHEN z <= 25 THEN 'Brand ' || b ELSE 'Unknown' END AS availability FROM q""")
def x4_filled_auctions(spark, folder):
    """Auctions with a price range and, for the smaller sizes, a note on availability."""
    auction = (
        '<li class="s-item s-item__pl"><a class="s-item__link" href="http://shop.example.com/%1$d">'
        '<div class="s-item__title"><span role="heading">%2$s</span></div></a><span class="s-item__price">$%3$s to $%3$s</span>'
        '<span class="SECONDARY_INFO">Brand %4$s<!-- %5$d --></span></li>'
    )
    bare = F.regexp_replace("html", r'<span class="SECONDARY_INFO">Brand [^<]*<!-- (2[6-9]|[3-9][0-9]) --></span>', "")
    pages = _filled(spark, folder, auction).withColumn("html", bare)
    return G.extract_auctions(G.split_containers(pages, G.AUCTION_CONTAINERS))


@query(rf"""WITH h AS (SELECT page_id, url, regexp_replace(html, '{N.NO_MARKUP}', '', 'g') AS html FROM pages)
SELECT page_id, url, 0 AS position, '<div>' || html || '</div><div class="card">' || url || '</div>' AS item FROM h
UNION ALL SELECT page_id, url, 1, url FROM h UNION ALL SELECT page_id, url, 2, page_id::VARCHAR FROM h""")
def x8_nested_containers(spark, folder):
    """Cards that hold whole pages, other boxes and cards; the last one has no end tag."""
    card = [F.lit('<!-- <div class="card"> --><div id=a class="big card"><div>'), "html", F.lit("</div><div class=\"card\">"), "url",
            F.lit('</div></div><div class="card">'), F.col("page_id").cast("string")]
    pages = A.pages(spark, folder).withColumn("html", F.concat(*card))
    return N.split_elements(pages, [("section", None), ("div", 'class="[^"]*card')])


@query(f"WITH {_pieces(ITEM, 'i')} SELECT page_id, url, position, item FROM i")
def x9_items_without_end_tags(spark, folder):
    """Items of a list end where the next begins, and with their list."""
    pages = A.pages(spark, folder).withColumn("html", F.replace("html", F.lit("</li>"), F.lit("")))
    return N.split_elements(pages, [("li", None)])


@query(f"""WITH {FILLED} SELECT page_id, position, n AS name, r::DOUBLE AS price, 'http://shop.example.com/list/p/' || k AS link,
'http://shop.example.com/img/' || k || '.jpg' AS image, 'In stock' AS availability FROM q""")
def x10_nested_fields(spark, folder):
    """Cards whose parts are boxes within boxes, and an offer of the same kind inside."""
    card = (
        '<div class="card"><div class="top"><div class="name"><a title="a > b" href="p/%1$d">%2$s</a></div></div>'
        '<div class="body"><div class="money"><div>£</div>%3$s<div class="cents"></div></div>'
        '<img alt=">" src=/img/%1$d.jpg><div class="stock"> In <b>stock</b></div></div></div>'
    )
    fields = {
        "name": N.first_text("div", 'class="name"'), "price": N.first_text("div", 'class="money"'),
        "link": N.attribute("a", "href"), "image": N.attribute("img", "src"), "availability": N.first_text("div", 'class="stock"'),
    }
    items = N.split_elements(_filled(spark, folder, card), [("div", 'class="card"')])
    return G.extract_fields(items, fields)
