"""URL predicates and rewrites (PJ5, PJ6, PJ8-PJ13, SF22-SF30, SF34, SC6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from hylle.fixtures import as_sql, relation
from hylle.functions import urls as U
from hylle.operators import filters as P
from hylle.profiles import STORE1, STORE2
from hylle.sources.categories import categories_of_urls, category_relation
from hylle.suite import query

URLS = as_sql("urls")
CATEGORIES = as_sql("categories")
BASE = "https://shop.example"


def urls(spark, sf):
    return relation(spark, sf, "urls")


HAS_BASE = "CASE WHEN coalesce(url, '') <> '' AND NOT starts_with(url, 'http://') AND NOT starts_with(url, 'https://') THEN 'https://shop.example' || url ELSE url END"


@query(
    "sc6_categories",
    f"SELECT name, {HAS_BASE} AS url FROM {CATEGORIES} AS c",
)
def categories(spark, sf):
    return category_relation(relation(spark, sf, "categories"), BASE)


@query(
    "sc6_categories_of_given_urls",
    f"SELECT string_split(rtrim(url, '/'), '/')[-1] AS name, url FROM {CATEGORIES} AS c WHERE coalesce(url, '') <> ''",
)
def categories_of_given_urls(spark, sf):
    given = relation(spark, sf, "categories").where(F.coalesce("url", F.lit("")) != "")
    return categories_of_urls(given)


@query(
    "sf28_category_from_given_url",
    "SELECT url_id, string_split(rtrim(url, '/'), '/')[-1] AS name, url "
    f"FROM {URLS} AS u WHERE coalesce(url, '') <> ''",
)
def category_from_url(spark, sf):
    given = urls(spark, sf).where(F.coalesce("url", F.lit("")) != "")
    return given.select("url_id", U.last_segment("url").alias("name"), "url")


@query(
    "pj5_category_name_filter",
    f"SELECT name, url FROM {CATEGORIES} AS c WHERE contains(lower(name), 'i')",
)
def category_name_filter(spark, sf):
    cats = relation(spark, sf, "categories")
    return P.named_like(cats, "I")


@query(
    "pj6_categories_with_url",
    f"SELECT name, url FROM {CATEGORIES} AS c WHERE coalesce(url, '') <> '' "
    f"UNION ALL SELECT cast(url_id AS VARCHAR), url FROM {URLS} AS u WHERE coalesce(url, '') <> ''",
)
def categories_with_url(spark, sf):
    both = relation(spark, sf, "categories").unionByName(
        urls(spark, sf).select(F.col("url_id").cast("string").alias("name"), "url")
    )
    return P.with_url(both)


@query(
    "pj8_category_run_id",
    f"SELECT seq, run_id || '_' || scraper_type AS run_id FROM {as_sql('runs')} AS r",
)
def category_run_id(spark, sf):
    return relation(spark, sf, "runs").select(
        "seq", P.category_run_id("run_id", "scraper_type").alias("run_id")
    )


@query("pj9_base_url", f"SELECT url_id, {HAS_BASE} AS url FROM {URLS} AS u")
def base_url(spark, sf):
    return urls(spark, sf).select("url_id", U.with_base("url", BASE).alias("url"))


@query(
    "pj11_product_url_store1",
    "SELECT url_id, url, coalesce(contains(url, '/products/') AND NOT ends_with(url, '/products/') "
    "AND NOT regexp_matches(url, '/products/(news/|discounts/|favourites/|search)') "
    "AND string_split(url, '/products/')[2] <> '' "
    f"AND regexp_matches(string_split(url, '/products/')[2], '[0-9/]'), false) AS ok FROM {URLS} AS u",
)
def product_url_store1(spark, sf):
    return urls(spark, sf).select("url_id", "url", U.is_product_url("url", STORE1).alias("ok"))


@query(
    "pj12_product_url_store2",
    "SELECT url_id, url, coalesce(contains(url, '/varer/') "
    "AND NOT regexp_matches(url, '/varer/(tilbud|nyheter|oppskrifter)/') "
    f"AND string_split(url, '/varer/')[2] <> '', false) AS ok FROM {URLS} AS u",
)
def product_url_store2(spark, sf):
    return urls(spark, sf).select("url_id", "url", U.is_product_url("url", STORE2).alias("ok"))


@query(
    "sf22_url_without_query",
    "SELECT url_id, split_part(url, '?', 1) AS url, "
    "regexp_replace(rtrim(split_part(url, '?', 1), '/'), 'filters=$', '') AS listing_base "
    f"FROM {URLS} AS u",
)
def url_without_query(spark, sf):
    return urls(spark, sf).select(
        "url_id",
        U.without_query("url").alias("url"),
        U.listing_base("url").alias("listing_base"),
    )


@query(
    "sf23_cursor_url",
    "SELECT url_id, CASE WHEN NOT contains(url, '?') THEN url || '?filters=&cursor=' || n "
    "WHEN contains(url, 'cursor=') THEN regexp_replace(url, 'cursor=[0-9]+', 'cursor=' || n, 'g') "
    f"ELSE url || '&cursor=' || n END AS url FROM (SELECT *, url_id % 20 + 1 AS n FROM {URLS} AS u) AS t",
)
def cursor_url(spark, sf):
    return urls(spark, sf).select(
        "url_id", U.with_cursor("url", F.col("url_id") % 20 + 1).alias("url")
    )


RESOLVED = (
    "CASE WHEN url = '' THEN 'https://shop.example' WHEN regexp_matches(url, '^[a-z]+:') THEN url "
    "WHEN starts_with(url, '//') THEN 'https:' || url WHEN starts_with(url, '/') THEN 'https://shop.example' || url "
    "WHEN starts_with(url, '?') THEN 'https://shop.example' || url ELSE 'https://shop.example/' || url END"
)
QUERY_PARTS = (
    "list_filter(string_split(CASE WHEN contains(url, '?') THEN url[strpos(url, '?') + 1:] ELSE '' END, '&'), "
    "lambda x: regexp_matches(x, '=.'))"
)


@query(
    "sf24_next_page_url",
    f"""SELECT url_id, {RESOLVED} AS url FROM (
 SELECT url_id, path || '?' || array_to_string(
  list_transform(CASE WHEN list_contains(list_transform(parts, lambda x: split_part(x, '=', 1)), 'page') THEN parts ELSE list_append(parts, 'page=0') END,
   lambda x: CASE WHEN split_part(x, '=', 1) = 'page' THEN 'page=' || n
    ELSE split_part(x, '=', 1) || '=' || replace(url_encode(url_decode(replace(split_part(x, '=', 2), '+', ' '))), '%20', '+') END), '&') AS url
 FROM (SELECT url_id, url_id % 20 + 1 AS n, {QUERY_PARTS} AS parts,
   regexp_replace(split_part(url, '?', 1), '^([a-z]+:)?//[^/]*', '') AS path FROM {URLS} AS u) AS s) AS t""",
)
def next_page_url(spark, sf):
    return urls(spark, sf).select(
        "url_id", U.with_page("url", F.col("url_id") % 20 + 1, BASE).alias("url")
    )


@query("sf25_resolve_url", f"SELECT url_id, {RESOLVED} AS url FROM {URLS} AS u")
def resolve_url(spark, sf):
    return urls(spark, sf).select("url_id", U.resolve("url", BASE).alias("url"))


# Links with steps, and where each leads from the base page.
STEPS = (
    ("../{0}/", "https://shop.example/{0}/"),
    ("./{0}", "https://shop.example/no/{0}"),
    ("a/../../{0}", "https://shop.example/{0}"),
    ("/x/./{0}/../y?q=../z", "https://shop.example/x/y?q=../z"),
    ("../../../{0}/..", "https://shop.example/"),
    ("a//{0}", "https://shop.example/no/a/{0}"),
    ("https://cdn.example/../{0}", "https://cdn.example/../{0}"),
    ("{0}?", "https://shop.example/no/{0}"),
)


def stepped(part):
    """SQL of the case's link or target for each row's key."""
    cases = " ".join(
        f"WHEN {i} THEN replace('{case[part]}', '{{0}}', 'p' || cast(p_partkey AS string))" for i, case in enumerate(STEPS)
    )
    return f"CASE p_partkey % {len(STEPS)} {cases} END"


@query("sf25_links_with_steps", f"SELECT p_partkey, {stepped(1)} AS url FROM part")
def links_with_steps(spark, sf):
    return relation(spark, sf, "part").select(
        "p_partkey", U.resolve(F.expr(stepped(0)), "https://shop.example/no/side").alias("url")
    )


SLUG = "coalesce(nullif(regexp_extract(url, '/categories/[0-9]+-([^/]+)/', 1), ''), 'unknown')"


@query("sf26_category_slug", f"SELECT url_id, {SLUG} AS slug FROM {URLS} AS u")
def category_slug(spark, sf):
    return urls(spark, sf).select("url_id", U.category_slug("url").alias("slug"))


def title_sql(text: str) -> str:
    return (
        f"array_to_string(list_transform(string_split({text}, ' '), "
        "lambda w: upper(w[1]) || lower(w[2:])), ' ')"
    )


@query(
    "sf27_slug_title",
    f"SELECT url_id, {title_sql('t')} AS title, 'Alle i ' || {title_sql('t')} AS main_title "
    f"FROM (SELECT url_id, replace({SLUG}, '-', ' ') AS t FROM {URLS} AS u) AS s",
)
def slug_title(spark, sf):
    slugs = urls(spark, sf).select("url_id", U.category_slug("url").alias("slug"))
    return slugs.select(
        "url_id",
        U.slug_title("slug").alias("title"),
        U.main_category_name("slug").alias("main_title"),
    )


@query(
    "sf29_product_id_from_url",
    "SELECT url_id, CASE WHEN contains(url, '/varer/') AND string_split(url, '/varer/')[-1] <> '' "
    "THEN rtrim(string_split(url, '/varer/')[-1], '/') WHEN url <> '' THEN md5(url) END AS product_id "
    f"FROM {URLS} AS u",
)
def product_id_from_url(spark, sf):
    return urls(spark, sf).select("url_id", U.product_id_from_url("url").alias("product_id"))


@query(
    "sf30_link_label",
    "SELECT p_partkey, trim(regexp_extract(p_name, '^([^(]+)', 1)) AS label, "
    "'(' || p_size || ')' AS bare FROM part",
)
def link_label(spark, sf):
    part = relation(spark, sf, "part")
    count = F.concat(F.lit("("), F.col("p_size").cast("string"), F.lit(")"))
    marked = F.concat(F.lit(" ✓"), F.col("p_name"), F.lit(" "), count)
    return part.select(
        "p_partkey", U.link_label(marked).alias("label"), U.link_label(count).alias("bare")
    )


@query(
    "sf34_entity_unescape",
    "SELECT page_id, md5(replace(replace(replace(replace(replace(replace(replace(replace(replace(html, '&copy;', '©'), '&middot;', '·'), '&lt;', '<'), '&gt;', '>'), "
    "'&quot;', '\"'), '&apos;', chr(39)), '&#39;', chr(39)), '&#x27;', chr(39)), '&amp;', '&')) AS digest FROM pages",
)
def entity_unescape(spark, sf):
    return relation(spark, sf, "pages").select(
        "page_id", F.md5(U.unescaped("html")).alias("digest")
    )


@query(
    "sf34_numeric_references",
    "SELECT p_partkey, chr(CAST(p_partkey + 160 AS INTEGER)) || p_name || chr(CAST(p_partkey + 160 AS INTEGER)) || ' & ' "
    "|| CASE p_partkey % 3 WHEN 0 THEN 'ø' WHEN 1 THEN '¬it' ELSE '&amp' END AS text FROM part",
)
def numeric_references(spark, sf):
    code = F.col("p_partkey") + 160
    named = F.when(F.col("p_partkey") % 3 == 0, "&oslash;").when(F.col("p_partkey") % 3 == 1, "&notit").otherwise("&amp;amp")
    escaped = F.concat(
        F.lit("&#"), code.cast("string"), F.lit(";"), F.col("p_name"), F.lit("&#x"), F.hex(code), F.lit("; &amp; "), named
    )
    return relation(spark, sf, "part").select("p_partkey", U.unescaped(escaped).alias("text"))
