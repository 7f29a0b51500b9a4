"""Pages to rows (SC5, HX1-HX8, WN7, WN8, PJ13-PJ17)."""

from __future__ import annotations

from pyspark.sql import functions as F

from hylle import fixed_values as V
from hylle.fixtures import as_sql, relation
from hylle.functions import text as X
from hylle.functions import urls as U
from hylle.operators import listing as L
from hylle.profiles import STORE1
from hylle.sources import extract as E
from hylle.suite import dictionary_sql as D
from hylle.suite import query

BASE = "https://shop.example"


@query("sc5_scan_pages", "SELECT page_id, url, md5(html) AS digest, length(html) AS n_chars FROM pages")
def scan_pages(spark, sf):
    return relation(spark, sf, "pages").select(
        "page_id", "url", F.md5("html").alias("digest"),
        F.length("html").cast("bigint").alias("n_chars"),
    )


LINKS = r"""(SELECT page_id, unnest(range(len(m))) AS pos, regexp_extract(unnest(m), 'href="([^"]*)"', 1) AS link,
 regexp_extract(unnest(m), '>(.*)<', 1) AS text
 FROM (SELECT page_id, regexp_extract_all(html, '<a href="[^"]*">[^<]*</a>') AS m FROM pages) AS t)"""


@query(
    "hx1_plain_links",
    f"SELECT page_id, pos, replace(link, '&amp;', '&') AS link, trim(replace(text, '&amp;', '&')) AS text FROM {LINKS} AS l",
)
def plain_links(spark, sf):
    return E.plain_links(relation(spark, sf, "pages").select("page_id", "html")).withColumn(
        "pos", F.col("pos").cast("bigint")
    )


@query(
    "hx1_links_by_word",
    "SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY pos) AS nth, lower(text) AS name, "
    f"'https://shop.example' || link AS link FROM {LINKS} AS l "
    f"WHERE {D.any_term('lower(text)', V.SUBCATEGORY_LINK_WORDS)}",
)
def links_by_word(spark, sf):
    """Real pages have no sections, so the last strategy applies to them."""
    from pyspark.sql import Window

    links = E.subcategory_links(relation(spark, sf, "pages").select("page_id", "html"))
    nth = F.row_number().over(Window.partitionBy("page_id").orderBy("pos"))
    return links.select("page_id", nth.cast("bigint").alias("nth"), "name", "link")


G = "cast(p_partkey - p_partkey % 4 AS VARCHAR)"
SECTION_LINKS = f"""(
 SELECT p_partkey AS page_id, 1 AS nth, p_name AS name, 'https://shop.example/no/categories/' || {G} || '-melk/' AS link FROM part WHERE p_partkey % 12 < 8
 UNION ALL SELECT p_partkey, 2, 'Dobbel', 'https://shop.example/no/categories/' || {G} || '-melk/?x=1' FROM part WHERE p_partkey % 12 < 8
 UNION ALL SELECT p_partkey, 3, 'Alle i Drikke', 'https://shop.example/no/categories/999-drikke/' FROM part WHERE p_partkey % 12 < 8)"""
OTHER_LINKS = """(
 SELECT p_partkey AS page_id, 1 AS nth, p_name AS name, 'https://shop.example/tema/' || p_partkey || '/' AS link FROM part WHERE p_partkey % 12 IN (8, 9)
 UNION ALL SELECT p_partkey, 1, lower('ost & ' || p_name), 'https://shop.example/ost/' || p_partkey FROM part WHERE p_partkey % 12 > 9)"""


@query(
    "hx1_subcategory_links",
    f"SELECT page_id, name, link FROM {SECTION_LINKS} AS a UNION ALL SELECT page_id, name, link FROM {OTHER_LINKS} AS b",
)
def subcategory_links(spark, sf):
    pages = relation(spark, sf, "category_pages").select("page_id", "html")
    return E.subcategory_links(pages).select("page_id", "name", "link")


@query(
    "wn7_first_strategy",
    "SELECT page_id, CASE WHEN page_id % 12 < 8 THEN 'section' WHEN page_id % 12 < 10 THEN 'main' ELSE 'word' END AS strategy, "
    f"count(*) AS n FROM (SELECT page_id FROM {SECTION_LINKS} AS a UNION ALL SELECT page_id FROM {OTHER_LINKS} AS b) AS t GROUP BY page_id",
)
def first_strategy(spark, sf):
    pages = relation(spark, sf, "category_pages").select("page_id", "html")
    strategy = (
        F.when(F.max(F.col("link").contains(V.CATEGORY_MARKER)), "section")
        .when(F.max(F.col("link").contains("/tema/")), "main")
        .otherwise("word")
    )
    return E.subcategory_links(pages).groupBy("page_id").agg(
        strategy.alias("strategy"), F.count("*").alias("n")
    )


@query(
    "pj13_subcategory_link_predicate",
    f"SELECT page_id, link FROM (SELECT page_id, unnest(regexp_extract_all(html, 'href=\"?([^\" >]+)', 1)) AS link "
    f"FROM {as_sql('category_pages')} AS c) AS t WHERE contains(link, '/categories/')",
)
def subcategory_link_predicate(spark, sf):
    links = E.plain_links(relation(spark, sf, "category_pages").select("page_id", "html"))
    return links.where(U.is_subcategory_link("text", "link")).select("page_id", "link")


@query(
    "pj14_link_word_predicate",
    f"SELECT page_id, link, lower(text) AS text FROM {LINKS} AS l WHERE {D.any_term('lower(text)', V.SUBCATEGORY_LINK_WORDS)}",
)
def link_word_predicate(spark, sf):
    links = E.plain_links(relation(spark, sf, "pages").select("page_id", "html"))
    lower = links.select("page_id", "link", F.lower("text").alias("text"))
    return lower.where(X.contains_any("text", V.SUBCATEGORY_LINK_WORDS))


def product_url(n):
    return f"'https://shop.example/no/products/' || ({n}) || '-x/'"


LISTED = f"""(SELECT p_partkey AS page_id, 'https://shop.example/no/categories/' || {G} || '-melk/' AS listing_url,
  p_partkey % 4 + 1 AS page_no, u.pos, CASE u.pos WHEN 0 THEN {product_url('p_partkey')} ELSE {product_url('p_partkey + 1')} END AS link
 FROM part, (VALUES (0), (1)) AS u(pos) WHERE NOT (p_partkey % 4 = 2 AND p_partkey % 12 < 4))"""


@query("hx2_product_links", f"SELECT page_id, pos, link FROM {LISTED} AS l")
def product_links(spark, sf):
    pages = relation(spark, sf, "listing_pages").select("page_id", "html")
    return E.product_links(pages)


@query(
    "pj15_product_card_store1",
    f"SELECT page_id, count(*) AS n FROM {LISTED} AS l GROUP BY page_id",
)
def product_card_store1(spark, sf):
    pages = relation(spark, sf, "listing_pages").select("page_id", "html")
    return E.product_links(pages).groupBy("page_id").agg(F.count("*").alias("n"))


PRICE_SHOWN = "CASE WHEN regexp_matches(price_text, 'kr|[0-9]') THEN price_text WHEN unit_price LIKE '%kr%' THEN unit_price END"
EXTRACTED = f"""(SELECT *, {D.PRICE1.format('shown_price')} AS price FROM (
 SELECT product_id AS source_id, url, category AS category_name, name, coalesce(info, '') AS info, {PRICE_SHOWN} AS shown_price,
  CASE WHEN contains(unit_price, '/') AND contains(unit_price, 'kr') THEN unit_price END AS shown_unit,
  'https://shop.example/img/' || product_id || '.png?a=1&b=2' AS image
 FROM {as_sql('products')} AS p) AS e WHERE shown_price IS NOT NULL)"""


@query(
    "hx3_product_record_store1",
    "SELECT source_id, md5(url) AS product_id, name, info, price, shown_price AS price_text, shown_unit AS unit_price, url "
    f"FROM {EXTRACTED} AS x",
)
def product_record_store1(spark, sf):
    pages = relation(spark, sf, "product_pages").withColumnRenamed("product_id", "source_id")
    return E.store1_products(pages).select(
        "source_id", "product_id", "name", "info", "price", "price_text", "unit_price", "url"
    )


@query("hx4_product_image_store1", f"SELECT source_id, image AS image_url FROM {EXTRACTED} AS x")
def product_image_store1(spark, sf):
    pages = relation(spark, sf, "product_pages").withColumnRenamed("product_id", "source_id")
    return E.store1_products(pages).select("source_id", "image_url")


@query(
    "pj17_complete_records",
    f"SELECT source_id IS NOT NULL AS found, count(*) AS n FROM {EXTRACTED} AS x GROUP BY 1",
)
def complete_records(spark, sf):
    pages = relation(spark, sf, "product_pages").withColumnRenamed("product_id", "source_id")
    kept = E.store1_products(pages).select(F.col("source_id").isNotNull().alias("found"))
    return kept.groupBy("found").agg(F.count("*").alias("n"))


@query("hx5_product_cards_store2", "SELECT p_partkey AS page_id, 1 AS n_cards FROM part")
def product_cards_store2(spark, sf):
    pages = relation(spark, sf, "card_pages").select("page_id", "html")
    return E.cards(pages).select("page_id", F.size("_cards").alias("n_cards"))


CARDS = """(SELECT p_partkey AS page_id, 'meieri/' || p_partkey AS product_id, p_name AS name, p_brand AS brand,
 p_size || ' g ' || p_brand AS info, CAST(p_size || '.90' AS DOUBLE) AS price, 'kr ' || p_size || ',90' AS price_text,
 'kr ' || p_size || ',17 /kg' AS unit_price, 'https://shop.example/i/' || p_partkey || '.jpg' AS image_url,
 'https://shop.example/varer/meieri/' || p_partkey || '/' AS url FROM part)"""


@query("hx6_card_record_store2", f"SELECT * FROM {CARDS} AS c")
def card_record_store2(spark, sf):
    pages = relation(spark, sf, "card_pages").select("page_id", "html")
    return E.card_products(E.cards(pages)).drop("pos")


@query(
    "pj16_product_card_store2",
    "SELECT page_id, name, price_text FROM " + CARDS + " AS c",
)
def product_card_store2(spark, sf):
    """Cards without the list item and box classes: the price and image tests decide."""
    pages = relation(spark, sf, "card_pages").select(
        "page_id",
        F.regexp_replace(
            F.regexp_replace("html", "ws-product-list-vertical(__item)?\"", 'x"'),
            '<div class="ws-product-vertical">',
            '</li><li><b>kr</b></li><li><img src="/y.png"></li><li><div class="Product-x">',
        ).alias("html"),
    )
    loose = pages.withColumn("html", F.replace("html", F.lit('<li class="x">'), F.lit("<li>")))
    return E.card_products(E.cards(loose)).select("page_id", "name", "price_text")


PAGE2 = f"""(SELECT *, {D.PRICE.format('price_text')} AS price FROM {as_sql('products')} AS p WHERE seq % 3 <> 2)"""


@query(
    "hx7_product_record_store2",
    "SELECT product_id AS source_id, 'meieri/' || product_id AS product_id, name, coalesce(info, '') AS info, price, price_text, "
    "'/i/' || product_id || '.jpg' AS image_url, CASE WHEN seq % 2 = 1 THEN coalesce(brand, 'Ukjent') END AS brand, "
    f"coalesce(category, '') AS category FROM {PAGE2} AS p",
)
def product_record_store2(spark, sf):
    return E.store2_products(relation(spark, sf, "store2_pages")).select(
        "source_id", "product_id", "name", "info", "price", "price_text", "image_url", "brand",
        "category",
    )


@query(
    "hx8_pagination",
    "SELECT p_partkey AS page_id, CAST(p_partkey % 4 + 1 AS INTEGER) AS data_page, 3 AS data_total_pages, "
    "p_partkey % 4 < 2 AS has_more, p_partkey % 4 >= 2 AS is_last FROM part",
)
def pagination(spark, sf):
    pages = relation(spark, sf, "card_pages").select("page_id", "html")
    return E.with_pagination(pages)


@query(
    "wn8_last_page",
    "SELECT p_partkey AS page_id, p_partkey - p_partkey % 4 AS listing FROM part WHERE p_partkey % 4 < 3 "
    "AND p_partkey - p_partkey % 4 IN (SELECT p_partkey FROM part)",
)
def last_page(spark, sf):
    pages = relation(spark, sf, "card_pages").select(
        "page_id", (F.col("page_id") - F.col("page_id") % 4).alias("listing"),
        (F.col("page_id") % 4 + 1).alias("page_no"), "html",
    )
    facts = E.with_pagination(pages)
    return L.read_pages(facts, "listing", is_last=F.col("is_last")).select("page_id", "listing")
