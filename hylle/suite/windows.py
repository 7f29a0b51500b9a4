"""Listing operators (WN1-WN4, WN6, LM1-LM3, ST1, JN7, PJ10, AG4, AG5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from hylle.fixtures import as_sql, relation
from hylle.functions import urls as U
from hylle.operators import filters as P
from hylle.operators import listing as L
from hylle.operators import ranking as R
from hylle.operators import summary as A
from hylle.suite import query

LISTING = as_sql("listing")
ORDER = ["page_no", "pos_key", "url"]


def listing(spark, sf):
    return relation(spark, sf, "listing")


UNCAPPED = f"""(SELECT category, page_no, pos_key, url FROM (
 SELECT *, dense_rank() OVER (PARTITION BY category ORDER BY page_no) AS dr FROM {LISTING} AS l) AS t
 WHERE page_no = dr)"""
READ = f"""(SELECT category, page_no, pos_key, url FROM (
 SELECT *, dense_rank() OVER (PARTITION BY category ORDER BY page_no) AS dr FROM {LISTING} AS l WHERE page_no <= 20) AS t
 WHERE page_no = dr)"""


@query("wn1_contiguous_pages", f"SELECT * FROM {UNCAPPED} AS r")
def contiguous_pages(spark, sf):
    return L.read_pages(listing(spark, sf), "category")


# thirty unbroken pages per part, but for those without page 25
MANY_PAGES = "(SELECT p_partkey AS part, CAST(n AS INTEGER) AS page_no FROM part, {numbers} WHERE NOT (n = 25 AND p_partkey % 3 = 0))"


@query(
    "wn1_many_pages",
    "SELECT part, page_no FROM " + MANY_PAGES.format(numbers="(SELECT unnest(range(1, 31)) AS n) AS u")
    + " AS m WHERE page_no < 25 OR part % 3 <> 0",
)
def many_pages(spark, sf):
    pages = relation(spark, sf, "part").select(
        F.col("p_partkey").alias("part"), F.explode(F.sequence(F.lit(1), F.lit(30))).alias("page_no")
    )
    return L.read_pages(pages.where("NOT (page_no = 25 AND part % 3 = 0)"), "part")


@query("wn2_page_cap", f"SELECT * FROM {READ} AS r WHERE page_no <= 3")
def page_cap(spark, sf):
    return L.read_pages(listing(spark, sf), "category", page_cap=3)


@query(
    "wn3_products_per_category",
    "SELECT category, page_no, pos_key, url FROM (SELECT *, row_number() OVER "
    f"(PARTITION BY category ORDER BY page_no, pos_key, url) AS rn FROM {READ} AS r) AS t WHERE rn <= 10",
)
def products_per_category(spark, sf):
    return L.capped(L.read_pages(listing(spark, sf), "category", page_cap=20), ["category"], ORDER, 10)


@query(
    "wn3_large_cap",
    "SELECT category, page_no, pos_key, url FROM (SELECT *, row_number() OVER "
    f"(PARTITION BY category ORDER BY page_no, pos_key, url) AS rn FROM {LISTING} AS r) AS t WHERE rn <= 2000",
)
def large_cap(spark, sf):
    return L.capped(listing(spark, sf), ["category"], ORDER, 2000)


@query(
    "wn3_cap_by_ranges",
    "SELECT category, page_no, pos_key, url FROM (SELECT *, row_number() OVER "
    f"(PARTITION BY page_no ORDER BY pos_key, category, url) AS rn FROM {LISTING} AS r) AS t WHERE rn <= 5000",
)
def cap_by_ranges(spark, sf):
    return R.top_per_group(listing(spark, sf), ["page_no"], ["pos_key", "category", "url"], 5000)


@query(
    "wn4_first_occurrence",
    "SELECT category, page_no, pos_key, url FROM (SELECT *, row_number() OVER "
    "(PARTITION BY split_part(url, '?', 1) ORDER BY category, page_no, pos_key, url) AS rn "
    f"FROM {LISTING} AS l) AS t WHERE rn = 1",
)
def first_occurrence(spark, sf):
    return L.first_occurrences(listing(spark, sf), [], ["category", *ORDER])


@query(
    "wn4_first_occurrence_per_page",
    "SELECT category, page_no, pos_key, url FROM (SELECT *, row_number() OVER "
    "(PARTITION BY category, page_no, split_part(url, '?', 1) ORDER BY pos_key, url) AS rn "
    f"FROM {LISTING} AS l) AS t WHERE rn = 1",
)
def first_occurrence_per_page(spark, sf):
    return L.first_occurrences(listing(spark, sf), ["category", "page_no"], ["pos_key", "url"])


BATCH = as_sql("batch")


@query(
    "wn6_last_record_per_id",
    "SELECT product_id, seq, name, price_text FROM (SELECT *, row_number() OVER "
    f"(PARTITION BY product_id ORDER BY seq DESC) AS rn FROM {BATCH} AS b) AS t WHERE rn = 1",
)
def last_record_per_id(spark, sf):
    batch = relation(spark, sf, "batch").select("product_id", "seq", "name", "price_text")
    return R.last_per_key(batch, ["product_id"], "seq")


PRODUCTS = as_sql("products")


@query(
    "lm1_limit_rows",
    f"SELECT product_id, name, price_text FROM {PRODUCTS} AS p ORDER BY product_id LIMIT 40",
)
def limit_rows(spark, sf):
    rows = relation(spark, sf, "products").select("product_id", "name", "price_text")
    return P.first_rows(rows, 40, "product_id")


@query(
    "lm2_first_match",
    f"SELECT run_id, status FROM {as_sql('runs')} AS r WHERE starts_with(run_id, '20240105') ORDER BY run_id LIMIT 1",
)
def first_match(spark, sf):
    runs = relation(spark, sf, "runs").where(F.col("run_id").startswith("20240105"))
    return P.first_rows(runs.select("run_id", "status"), 1, "run_id")


@query(
    "lm3_head_of_list",
    "SELECT category, page_no, pos_key, url FROM (SELECT *, row_number() OVER "
    f"(PARTITION BY category, page_no ORDER BY pos_key, url) AS rn FROM {LISTING} AS l) AS t WHERE rn <= 3",
)
def head_of_list(spark, sf):
    return L.capped(listing(spark, sf), ["category", "page_no"], ["pos_key", "url"], 3)


@query(
    "st1_union_all",
    f"SELECT 'listing' AS source, url FROM {LISTING} AS l UNION ALL "
    f"SELECT 'urls' AS source, url FROM {as_sql('urls')} AS u",
)
def union_all(spark, sf):
    return A.all_links(listing=listing(spark, sf), urls=relation(spark, sf, "urls"))


MAIN = f"""(SELECT DISTINCT category, '/no/products/' || CAST(7 * CAST(substr(category, 4) AS BIGINT) AS VARCHAR) || '-x/' AS url FROM {LISTING} AS l)"""


@query(
    "jn7_add_main_category",
    f"""SELECT category, 'link' AS name, url FROM {LISTING} AS l
 UNION ALL SELECT category, 'Alle i ' || upper(category[1]) || category[2:] AS name, url FROM {MAIN} AS m
 WHERE NOT EXISTS (SELECT 1 FROM {LISTING} AS l2 WHERE l2.category = m.category AND l2.url = m.url)""",
)
def add_main_category(spark, sf):
    links = listing(spark, sf).select("category", F.lit("link").alias("name"), "url")
    number = F.substring("category", 4, 20).cast("bigint") * 7
    main = (
        listing(spark, sf)
        .select("category")
        .distinct()
        .select(
            "category",
            U.main_category_name(F.col("category")).alias("name"),
            F.concat(F.lit("/no/products/"), number.cast("string"), F.lit("-x/")).alias("url"),
        )
    )
    return L.with_main_category(links, main, ["category", "url"])


@query(
    "pj10_skip_list",
    f"SELECT category, page_no, pos_key, url FROM {LISTING} AS l WHERE category NOT IN ('cat3', 'cat77')",
)
def skip_list(spark, sf):
    named = listing(spark, sf).withColumn("name", F.col("category"))
    return P.without_skipped(named, ("cat3", "cat77")).drop("name")


@query(
    "ag4_links_per_page",
    f"SELECT category, page_no, count(*) AS n_links, count(DISTINCT split_part(url, '?', 1)) AS n_products FROM {LISTING} AS l "
    "GROUP BY ROLLUP (category, page_no)",
)
def links_per_page(spark, sf):
    return A.per_page(listing(spark, sf))


@query("ag5_distinct_urls", f"SELECT DISTINCT split_part(url, '?', 1) AS url FROM {LISTING} AS l")
def distinct_urls(spark, sf):
    return A.distinct_urls(listing(spark, sf))
