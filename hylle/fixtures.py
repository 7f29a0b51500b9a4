"""Input relations derived from the test tables.

Each statement is plain SQL that means the same to Spark and to the SQL engine
used for checking; ``{table}`` stands for a test table or another statement.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession


TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# Relations with long texts: few rows per byte, much work per row. The tables are one
# small file, one split, each; their rows are dealt out to all cores. Of a derived one
# the rows it is made of are dealt out, so that its texts are made on all cores too and
# never cross an exchange.
LONG_TEXTS = (
    "documents", "pages", "product_pages", "category_pages", "listing_pages", "store2_pages", "card_pages",
)

STATEMENTS = {
    # product rows with sixteen name / info shapes
    "products": """
SELECT p_partkey AS seq, concat('p', cast(p_partkey AS string)) AS product_id,
 CASE p_partkey % 16
  WHEN 0 THEN 'Lettmelk' WHEN 1 THEN 'Helmelk økologisk' WHEN 2 THEN 'Norvegia Skivet'
  WHEN 3 THEN 'Egg Frittgående' WHEN 4 THEN 'Yoghurt Jordbær' WHEN 5 THEN 'Havredrikk'
  WHEN 6 THEN 'Ekte Rømme' WHEN 7 THEN 'Smør "Usaltet"' WHEN 8 THEN 'Kefir'
  WHEN 9 THEN 'Biola' WHEN 10 THEN concat('Go', chr(39), 'morgen Skyr') WHEN 11 THEN 'Blåbær Kvarg'
  WHEN 12 THEN 'Pudding Sjokolade' WHEN 13 THEN 'Cheddar Revet' WHEN 14 THEN 'Brus'
  ELSE 'Servietter' END AS name,
 CASE p_partkey % 16
  WHEN 0 THEN concat(cast(p_size AS string), '% fett, 1,75 l, TINE')
  WHEN 1 THEN '3,5% fett; 1 l,  økologisk, Kulturgård'
  WHEN 2 THEN concat('27% fett, ', cast(p_size * 10 AS string), ' g, hvit, ', CASE WHEN p_size % 2 = 0 THEN 'skiver' ELSE 'hel' END, ', 12 mnd')
  WHEN 3 THEN concat('STØRRELSE L, ', cast(p_size AS string), ' stk, ', CASE p_size % 3 WHEN 0 THEN 'friland' WHEN 1 THEN 'frittgående' ELSE 'økologisk' END, ', Prior')
  WHEN 4 THEN concat(cast(p_size % 6 + 2 AS string), 'x125g, laktosefri, Yoplait')
  WHEN 5 THEN '1 l, vegansk, glutenfri, Oatly'
  WHEN 6 THEN '35 % fett, 3 dl, RØROS'
  WHEN 7 THEN '500 g, Bondens'
  WHEN 8 THEN NULL
  WHEN 9 THEN ''
  WHEN 10 THEN concat('190 g, Go', chr(39), 'morgen')
  WHEN 11 THEN 'uten laktose, 6 pk, Q-Meieriene'
  WHEN 12 THEN '4 x 125 ML, kakao'
  WHEN 13 THEN '200 g, revet, cheddar, lagret 6 måneder, Synnøve Finden'
  WHEN 14 THEN '0,5 l flaske'
  ELSE 'hvit' END AS info,
 CASE p_partkey % 11 WHEN 0 THEN 'Hopp til hovedinnhold' WHEN 1 THEN 'gratis'
  WHEN 2 THEN 'kr 1 234,50' WHEN 3 THEN '' WHEN 4 THEN concat(cast(p_size AS string), ' kr')
  ELSE concat('kr ', cast(p_partkey % 400 + 5 AS string), ',', lpad(cast(p_partkey * 7 % 100 AS string), 2, '0')) END AS price_text,
 CASE p_partkey % 4 WHEN 0 THEN NULL WHEN 1 THEN concat('kr ', cast(p_size AS string), ',17 /l')
  WHEN 2 THEN concat(cast(p_size AS string), '/kg') ELSE 'per stk' END AS unit_price,
 CASE WHEN p_partkey % 5 = 0 THEN p_brand END AS brand,
 concat('https://shop.example/img/p', cast(p_partkey AS string), '.png') AS image_url,
 CASE WHEN p_partkey % 7 = 0 THEN 'egg' WHEN p_partkey % 7 = 1 THEN 'ost' END AS subcategory,
 CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE lower(p_type) END AS category,
 concat('https://shop.example/no/products/', cast(p_partkey AS string), '-x/') AS url,
 concat('2024-01-0', cast(p_partkey % 3 + 1 AS string), 'T12:00:0', cast(p_partkey % 10 AS string)) AS scraped_at,
 concat('2024010', cast(p_partkey % 3 + 1 AS string), '_', substr(md5(cast(p_partkey % 3 AS string)), 1, 12), '_', lower(p_type)) AS run_id
FROM {part}""",
    # a second batch: every id twice, two thirds of the ids already stored
    "batch": """
SELECT seq,
 concat('p', cast(3 * ((seq - seq % 2) / 2) AS bigint)) AS product_id,
 concat(name, ' ny') AS name, info, price_text, unit_price, brand, image_url, subcategory, category, url,
 scraped_at, concat('20240201_', substr(run_id, 10)) AS run_id
FROM ({products}) AS q""",
    # run history
    "runs": """
SELECT o_orderkey AS seq,
 concat('202401', lpad(cast(o_custkey % 28 + 1 AS string), 2, '0'), '_', substr(md5(cast(o_orderkey AS string)), 1, 12), '_cat', cast(o_orderkey % 5 AS string)) AS run_id,
 CASE WHEN o_orderkey % 2 = 0 THEN 'store1' ELSE 'store2' END AS scraper_type,
 concat('https://shop.example/no/categories/', cast(o_orderkey % 5 AS string), '-c/') AS category_url,
 CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'running' ELSE 'failed' END AS status,
 o_orderdate AS start_time
FROM {orders}""",
    # ids to resolve against the run history: exact, same day, suffix only, no hit, wildcards
    "run_requests": """
SELECT seq, CASE seq % 6
  WHEN 0 THEN run_id
  WHEN 1 THEN concat(substr(run_id, 1, 8), '_zzz')
  WHEN 2 THEN substr(run_id, 10)
  WHEN 3 THEN concat('19990101_', substr(run_id, 10))
  WHEN 4 THEN concat(substr(run_id, 3, 6), '_', substr(run_id, 10))
  ELSE CASE WHEN seq % 12 = 5 THEN substr(md5(run_id), 1, 7) WHEN seq % 60 = 11 THEN concat('%', substr(run_id, 8, 4), '%_cat', cast(seq % 6 AS string))
   WHEN seq % 60 = 23 THEN '_%' ELSE concat('0%', substr(run_id, 13)) END END AS run_id,
 CASE WHEN seq % 3 = 0 THEN 'failed' ELSE 'completed' END AS status,
 CASE WHEN seq % 3 = 0 THEN 0 ELSE seq % 40 END AS num_products,
 CASE WHEN seq % 3 = 0 THEN concat('error ', cast(seq % 4 AS string)) END AS error_message
FROM ({runs}) AS r""",
    # links seen on listing pages; some categories have no page 4
    "listing": """
SELECT concat('cat', cast(l_orderkey % 500 AS string)) AS category, l_linenumber AS page_no,
 l_partkey AS pos_key, concat('/no/products/', cast(l_partkey AS string), '-x/', CASE WHEN l_suppkey % 3 = 0 THEN '?ref=a' ELSE '' END) AS url
FROM {lineitem} WHERE NOT (l_linenumber = 4 AND l_orderkey % 5 = 0)""",
    # URL shapes
    "urls": """
SELECT p_partkey AS url_id,
 CASE p_partkey % 18
  WHEN 0 THEN concat('/no/products/', cast(p_partkey AS string), '-melk/')
  WHEN 1 THEN '/no/products/' WHEN 2 THEN '/no/products/news/1/'
  WHEN 3 THEN '/no/products/search?q=7' WHEN 4 THEN '/no/products/melk'
  WHEN 5 THEN '/no/products/melk/lett' WHEN 6 THEN '/no/products/discounts/2'
  WHEN 7 THEN concat('/varer/meieri/', cast(p_partkey AS string)) WHEN 8 THEN '/varer/tilbud/x'
  WHEN 9 THEN '/varer/' WHEN 10 THEN 'https://shop.example/no/categories/1283-meieri-ost-og-egg/'
  WHEN 11 THEN '/no/categories/60-drikke/?filters=&cursor=3'
  WHEN 12 THEN NULL
  WHEN 13 THEN concat('/varer/meieri/?sort=pris%20opp&page=', cast(p_size AS string), '&tom=&q=a+b')
  WHEN 14 THEN concat('//cdn.example/i/', cast(p_partkey AS string), '.png')
  WHEN 15 THEN concat('varer/ost/', cast(p_partkey AS string), '/')
  WHEN 16 THEN concat('/no/products/', cast(p_partkey AS string), '-x/?filters=') ELSE '' END AS url
FROM {part}""",
    # configured categories, one per product type
    "categories": """
SELECT DISTINCT lower(replace(p_type, ' ', '-')) AS name,
 CASE WHEN p_type LIKE 'PROMO%' THEN concat('https://shop.example/no/categories/9-', lower(replace(p_type, ' ', '-')), '/')
  WHEN p_type LIKE 'SMALL%' THEN '' WHEN p_type LIKE 'LARGE%' THEN NULL
  ELSE concat('/no/categories/7-', lower(replace(p_type, ' ', '-')), '/') END AS url
FROM {part}""",
    # product pages of the first store
    "product_pages": """
SELECT product_id, url, category,
 concat('<!DOCTYPE html><html><body><main><article><div><img src="/img/', product_id, '.png?a=1&amp;b=2" alt="x"></div><h2>',
  replace(name, '"', '&quot;'), '</h2><p class="k-text-style--body-s">', coalesce(info, ''),
  '</p><span class="k-text-style--label-m k-text--weight-bold">', price_text,
  '</span><p class="k-text-style--label-s k-text-color--subdued">', coalesce(unit_price, ''),
  '</p></article></main></body></html>') AS html
FROM ({products}) AS p""",
    # category pages of the first store: links in sections, in the main part, or by word
    "category_pages": """
SELECT p_partkey AS page_id, concat('https://shop.example/no/categories/', cast(p_partkey AS string), '-melk/') AS url,
 CASE WHEN p_partkey % 12 < 8 THEN concat('<html><body><nav><a href="/no/categories/5-nei/">Egg</a></nav><main><div><section><a href="/no/categories/', cast(p_partkey - p_partkey % 4 AS string), '-melk/"><span><span>✓</span>', p_name, ' (', cast(p_size AS string),
  ')</span></a><a href="/om/">Om</a><a href="/no/categories/', cast(p_partkey - p_partkey % 4 AS string), '-melk/?x=1">Dobbel</a></section><section><a href=/no/categories/999-drikke/><span>Alle i Drikke</span></a></section></div></main></body></html>')
 WHEN p_partkey % 12 < 10 THEN concat('<html><body><main><div><div><section><a href="/tema/', cast(p_partkey AS string), '/"><h3>', p_name, '</h3>x</a><a href="">y</a></section></div></div></main></body></html>')
 ELSE concat('<html><body><ul><li><a href="ost/', cast(p_partkey AS string), '">OST &amp; ', p_name, '</a><li><a href="/brus/">Brus</a></ul></body></html>') END AS html
FROM {part}""",
    # listing pages of the first store; some listings have an empty third page
    "listing_pages": """
SELECT p_partkey AS page_id, concat('https://shop.example/no/categories/', cast(p_partkey - p_partkey % 4 AS string), '-melk/') AS listing_url,
 p_partkey % 4 + 1 AS page_no,
 CASE WHEN p_partkey % 4 = 2 AND p_partkey % 12 < 4 THEN '<html><body><article><p>kr 10</p></article><a href="/no/products/">Alle</a></body></html>'
 WHEN p_partkey % 4 = 3 THEN concat('<html><body><article><a href="/no/products/', cast(p_partkey AS string), '-x/">uten pris</a></article><a href="/no/products/news/1/">N</a><a href="/no/products/', cast(p_partkey + 1 AS string), '-x/">m</a></body></html>')
 ELSE concat('<html><body><article><img src="/a.png"><a href="/no/products/search?q=1">s</a><a href="/no/products/', cast(p_partkey AS string), '-x/">a</a><a href="/no/products/7-y/">b</a><span>kr ', cast(p_size AS string),
  '</span></article><article><a href="/no/products/', cast(p_partkey + 1 AS string), '-x/"><b>c</b></a><div>kr 5<article><a href="/no/products/', cast(p_partkey + 1 AS string), '-x/">d</a><i>kr</i></article></div></article><article>no price <a href="/no/products/8-z/">e</a></article></body></html>') END AS html
FROM {part}""",
    # product pages of the second store
    "store2_pages": """
SELECT product_id AS source_id, concat('https://shop.example/varer/meieri/', product_id, '/') AS url,
 concat('<html><body><ol class="x breadcrumbs"><li><a href="/">Hjem</a><li><a href="/varer/">', coalesce(category, ''), '</a></ol><h1> ', replace(name, '"', '&quot;'), ' </h1>',
  CASE WHEN seq % 3 = 0 THEN concat('<span itemprop="price" content="1">', price_text, '</span>') WHEN seq % 3 = 1 THEN concat('<div class="a ws-product-price-regular"><b>', price_text, '</b></div>') ELSE '' END,
  CASE WHEN seq % 2 = 0 THEN concat('<p itemprop="description">', coalesce(info, ''), '</p>') ELSE concat('<p class="ws-product-description">', coalesce(info, ''), '</p><div itemprop="brand">', coalesce(brand, 'Ukjent'), '</div>') END,
  '<div class="ws-product-image"><span><img src="/i/', product_id, '.jpg"></span></div></body></html>') AS html
FROM ({products}) AS p""",
    # listing pages of the second store, one card each
    "card_pages": """
SELECT p_partkey AS page_id, concat('/varer/meieri/', cast(p_partkey AS string), '/') AS href,
 concat('<html><body><!-- <i data-page="9" data-total-pages="99"></i> --><div ', CASE p_partkey % 3
  WHEN 0 THEN concat('data-page="', cast(p_partkey % 4 + 1 AS string), '" data-total-pages="3"')
  WHEN 1 THEN concat('data-page=', chr(39), cast(p_partkey % 4 + 1 AS string), chr(39), ' data-total-pages=', chr(39), '3', chr(39))
  ELSE concat('data-total-pages=3 data-page=', cast(p_partkey % 4 + 1 AS string)) END, '></div><ul class="ws-product-list-vertical"><li class="ws-product-list-vertical__item"><div class="ws-product-vertical"><img src="/i/',
  cast(p_partkey AS string), '.jpg"><a class="ws-product-vertical__link" href="/varer/meieri/', cast(p_partkey AS string),
  '/"><h3 class="ws-product-vertical__title">', p_name, '</h3></a><p class="ws-product-vertical__subtitle">', cast(p_size AS string), ' g ', p_brand,
  '</p><div class="ws-product-vertical__price">kr ', cast(p_size AS string), ',90</div><p class="ws-product-vertical__price-unit">kr ', cast(p_size AS string), ',17 /kg</p></div></li></ul>',
  CASE WHEN p_partkey % 4 = 0 THEN '<button class="ngr-button">Vis flere</button>' WHEN p_partkey % 4 = 1 THEN '<button class=ngr-button><b>Vis flere</b></button>' ELSE '' END, '</body></html>') AS html
FROM {part}""",
}


def render(name: str, table_ref) -> str:
    """The statement with every ``{x}`` replaced by a table or a nested statement."""

    def put(match: re.Match) -> str:
        ref = match.group(1)
        return render(ref, table_ref) if ref in STATEMENTS else table_ref(ref)

    return re.sub(r"\{(\w+)\}", put, STATEMENTS[name])


def relation(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table or a derived relation as a DataFrame."""
    cores = spark.sparkContext.defaultParallelism
    if name in TABLES:
        table = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        return table.repartition(cores) if name in LONG_TEXTS else table
    dealt = f"/*+ REPARTITION({cores}) */ " if name in LONG_TEXTS else ""
    return spark.sql(render(name, lambda t: f"(SELECT {dealt}* FROM parquet.`{sf_dir}/{t}.parquet`)"))


def as_sql(name: str) -> str:
    """The same relation as SQL over registered views."""
    return f"({render(name, lambda t: t)})"
