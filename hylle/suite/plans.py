"""Whole jobs (PL1-PL7) and the column rules that belong to them."""

from __future__ import annotations

from pyspark.sql import functions as F

from hylle.fixtures import as_sql, relation
from hylle.plans.crawl import crawl_store1, crawl_store2, store1_source, store2_source
from hylle.plans.enrich import enrich, enrich_frame, flat_attributes
from hylle.plans.ingest import ingest
from hylle.profiles import STORE1, STORE2
from hylle.schema import ATTRIBUTE_FIELDS
from hylle.sources.extract import store1_products
from hylle.suite import dictionary_sql as D
from hylle.suite import query
from hylle.suite.tables import table_target
from hylle.suite.webpages import CARDS, EXTRACTED, LISTED

PRODUCTS = as_sql("products")
KEPT = "product_id, name, info, category"


def products(spark, sf):
    return relation(spark, sf, "products")


def flat(df):
    return flat_attributes(
        df.select(*KEPT.split(", "), "brand", "subcategory", "attributes")
    )


@query("pl1_enrich_store1", f"SELECT * FROM {D.enriched(PRODUCTS, 1, KEPT)} AS e")
def enrich_store1(spark, sf):
    return flat(enrich(products(spark, sf), STORE1))


@query("pl2_enrich_store2", f"SELECT * FROM {D.enriched(PRODUCTS, 2, KEPT)} AS e")
def enrich_store2(spark, sf):
    return flat(enrich(products(spark, sf), STORE2))


@query(
    "pl3_enrich_frame",
    f"SELECT product_id, name, info, CAST(0.0 AS DOUBLE) AS price, '' AS price_text, unit_price, brand, "
    f"CAST(NULL AS VARCHAR) AS image_url, category, subcategory, url, scraped_at, run_id, "
    f"{', '.join(D.ATTRIBUTES)} "
    f"FROM {D.enriched(PRODUCTS, 1, 'product_id, name, info, unit_price, category, url, scraped_at, run_id')} AS e",
)
def enrich_any_frame(spark, sf):
    frame = products(spark, sf).drop("price_text", "image_url")
    result = flat_attributes(enrich_frame(frame, STORE1))
    return result.withColumn(
        "scraped_at", F.date_format("scraped_at", "yyyy-MM-dd'T'HH:mm:ss")
    )


@query(
    "sc7_any_frame_as_source",
    f"SELECT product_id, name, info, brand, subcategory, {', '.join(D.ATTRIBUTES)} "
    f"FROM {D.enriched('(SELECT CAST(o_orderkey AS VARCHAR) AS product_id, o_orderpriority AS name, ' + chr(39) + chr(39) + ' || o_orderkey % 7 || ' + chr(39) + ' x 2,5 dl, ' + chr(39) + ' || o_orderstatus || ' + chr(39) + 'X' + chr(39) + ' AS info, CAST(NULL AS VARCHAR) AS brand, CAST(NULL AS VARCHAR) AS subcategory FROM orders)', 1, 'product_id, name, info')} AS e",
)
def any_frame(spark, sf):
    frame = relation(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("product_id"),
        F.col("o_orderpriority").alias("name"),
        F.concat(
            (F.col("o_orderkey") % 7).cast("string"),
            F.lit(" x 2,5 dl, "),
            F.col("o_orderstatus"),
            F.lit("X"),
        ).alias("info"),
    )
    return flat_attributes(enrich_frame(frame, STORE1)).select(
        "product_id", "name", "info", "brand", "subcategory", *D.ATTRIBUTES
    )


@query(
    "pj18_required_columns",
    f"SELECT product_id, name, price_text FROM {PRODUCTS} AS p",
)
def required_columns(spark, sf):
    return enrich_frame(products(spark, sf).select("product_id", "name", "price_text"), STORE1)


@query(
    "sf36_merge_attribute_groups",
    "SELECT product_id, size_quantity, size_unit, fat_content, flavor, egg_type, cheese_type FROM "
    "(SELECT e.product_id, size_quantity, size_unit, coalesce(fat_content, CASE WHEN ok THEN old_fat ELSE old_fat END) AS fat_content, "
    "coalesce(flavor, old_flavor) AS flavor, "
    "CASE WHEN ok AND subcategory = 'egg' THEN egg_type ELSE old_egg END AS egg_type, cheese_type FROM "
    f"{D.enriched('(SELECT *, CAST(seq AS DOUBLE) AS old_fat, name AS old_flavor, category AS old_egg FROM ' + PRODUCTS + ' AS p0)', 1, 'product_id, ok, old_fat, old_flavor, old_egg')} AS e) AS m",
)
def merge_attribute_groups(spark, sf):
    """Enrichment on top of attributes that rows already carry."""
    before = {"fat_content": F.col("seq").cast("double"), "flavor": F.col("name"),
              "egg_type": F.col("category")}
    struct = F.struct(
        *[before.get(n, F.lit(None)).cast(t).alias(n) for n, t in ATTRIBUTE_FIELDS]
    )
    done = enrich(products(spark, sf).withColumn("attributes", struct), STORE1)
    return flat_attributes(done).select(
        "product_id", "size_quantity", "size_unit", "fat_content", "flavor", "egg_type",
        "cheese_type",
    )


# --- crawl and ingest ----------------------------------------------------------

COMPLETE = f"""(SELECT url, name, price, shown_price AS price_text FROM {EXTRACTED} AS x)"""
READ_LISTED = f"""(SELECT listing_url, page_no, pos, link, row_number() OVER (PARTITION BY listing_url ORDER BY page_no, pos) AS rn
 FROM {LISTED} AS l WHERE page_no < 3 OR page_id % 12 >= 4)"""
WANTED = """(SELECT p_partkey, 'https://shop.example/no/categories/' || p_partkey || '-melk/' AS category_url,
 'https://shop.example/no/categories/' || (p_partkey - p_partkey % 4) || '-melk/' AS listing_url, p_name AS subcategory FROM part WHERE p_partkey % 12 < 8
 UNION ALL SELECT p_partkey, 'https://shop.example/no/categories/' || p_partkey || '-melk/',
 'https://shop.example/no/categories/' || p_partkey || '-melk/', 'Alle i Melk' FROM part
 WHERE NOT (p_partkey % 12 < 8 AND p_partkey % 4 = 0))"""


@query(
    "pl4_crawl_store1",
    "SELECT w.category_url, w.subcategory, 'melk' AS category, l.page_no, l.pos, md5(c.url) AS product_id, c.url, c.name, c.price, c.price_text "
    f"FROM {WANTED} AS w JOIN {READ_LISTED} AS l ON l.listing_url = w.listing_url AND l.rn <= 5 JOIN {COMPLETE} AS c ON c.url = l.link",
)
def crawl_first_store(spark, sf):
    products = crawl_store1(
        spark,
        relation(spark, sf, "category_pages").select("url", "html"),
        relation(spark, sf, "listing_pages"),
        relation(spark, sf, "product_pages").select("url", "html"),
        max_products=5,
    )
    return products.select(
        "category_url", "subcategory", "category", "page_no", "pos", "product_id", "url",
        "name", "price", "price_text",
    )


@query(
    "pl5_crawl_store2",
    "SELECT 'https://shop.example/varer/meieri-' || (page_id - page_id % 4) || '/' AS listing_url, page_id % 4 + 1 AS page_no, "
    "product_id, name, brand, info, price, price_text, unit_price, image_url, url, 'Meieri ' || (page_id - page_id % 4) AS category "
    f"FROM {CARDS} AS c WHERE page_id % 4 < 2 AND page_id - page_id % 4 IN (SELECT p_partkey FROM part)",
)
def crawl_second_store(spark, sf):
    key = (F.col("page_id") - F.col("page_id") % 4).cast("string")
    pages = relation(spark, sf, "card_pages").select(
        F.concat(F.lit("https://shop.example/varer/meieri-"), key, F.lit("/")).alias("listing_url"),
        (F.col("page_id") % 4 + 1).alias("page_no"),
        "html",
    )
    return crawl_store2(spark, pages, max_products=2).drop("pos", "subcategory")


INGESTED = "(SELECT * FROM " + EXTRACTED + " AS x WHERE category_name IN ('promo', 'economy', 'medium', 'standard'))"
INGEST_SOURCE = f"""(SELECT md5(url) AS product_id, name, info, price, shown_price AS price_text, shown_unit AS unit_price, image AS image_url,
 category_name AS category, 'r1_' || category_name AS run_id, url, CAST(NULL AS VARCHAR) AS brand, CAST(NULL AS VARCHAR) AS subcategory FROM {INGESTED} AS i)"""
INGEST_KEPT = "product_id, name, info, price, price_text, unit_price, image_url, category, run_id, url"


def run_ingest(spark, sf, unreadable=None):
    """One ingest of the configured categories into new tables; one may fail to be read."""
    pages = relation(spark, sf, "product_pages").withColumnRenamed("category", "category_name")

    def crawl(categories, max_products):
        wanted = categories.select(F.col("name").alias("category_name"))
        listed = pages.join(wanted, "category_name", "left_semi")
        found = store1_products(listed.select("product_id", "url", "html", "category_name"))
        bad = F.raise_error(F.lit("page is broken")).cast("string")
        name = F.when(F.col("category_name").eqNullSafe(F.lit(unreadable)), bad).otherwise(F.col("name"))
        return found.withColumns({"seq": F.col("url"), "category": F.lit(None).cast("string"), "name": name})

    products, runs = table_target(spark), table_target(spark, "runs")
    ingest(
        spark, relation(spark, sf, "categories"), crawl, STORE1, "r1", products, runs,
        replace_existing=True, now=F.lit("2024-03-01T08:00:00Z").cast("timestamp"),
    )
    return products, runs


@query(
    "pl6_ingest_products",
    f"SELECT * FROM {D.enriched(INGEST_SOURCE, 1, INGEST_KEPT)} AS e",
)
def ingest_products(spark, sf):
    products, _ = run_ingest(spark, sf)
    stored = spark.table(products.location)
    return flat_attributes(
        stored.select(*INGEST_KEPT.split(", "), "brand", "subcategory", "attributes")
    )


@query(
    "pl6_ingest_runs",
    "SELECT 'r1_' || name AS run_id, 'store1' AS scraper_type, "
    "CASE WHEN starts_with(url, '/') THEN 'https://shop.example' || url ELSE url END AS category_url, "
    "CASE WHEN n IS NULL THEN 'running' ELSE 'completed' END AS status, n AS num_products, "
    "CASE WHEN n IS NOT NULL THEN 0::BIGINT END AS duration_seconds "
    f"FROM {as_sql('categories')} AS c LEFT JOIN (SELECT category_name, count(*) AS n FROM {INGESTED} AS i GROUP BY category_name) AS t "
    "ON t.category_name = c.name WHERE coalesce(url, '') <> ''",
)
def ingest_runs(spark, sf):
    _, runs = run_ingest(spark, sf)
    return spark.table(runs.location).select(
        "run_id", "scraper_type", "category_url", "status", "num_products", "duration_seconds"
    )


FAILING = INGESTED.replace("'economy', ", "")


@query(
    "pl6_ingest_failed_category",
    "SELECT 'r1_' || name AS run_id, CASE WHEN name = 'economy' THEN 'failed' WHEN n IS NULL THEN 'running' ELSE 'completed' END AS status, "
    "CASE WHEN name = 'economy' THEN 0 ELSE n END AS num_products, name = 'economy' AS has_error "
    f"FROM {as_sql('categories')} AS c LEFT JOIN (SELECT category_name, count(*) AS n FROM {FAILING} AS i GROUP BY category_name) AS t "
    "ON t.category_name = c.name WHERE coalesce(url, '') <> ''",
)
def ingest_failed_category(spark, sf):
    """One category cannot be read: it fails alone, the others are stored."""
    _, runs = run_ingest(spark, sf, unreadable="economy")
    return spark.table(runs.location).select(
        "run_id", "status", "num_products", F.col("error_message").isNotNull().alias("has_error")
    )


CRAWLED1 = f"""(SELECT *, row_number() OVER (PARTITION BY url ORDER BY category_name DESC, own DESC, page_no DESC, pos DESC) AS rn FROM (
 SELECT 'cat' || w.p_partkey AS category_name, w.subcategory = 'Alle i Melk' AS own, l.page_no, l.pos, c.url, c.name, c.price
 FROM {WANTED} AS w JOIN {READ_LISTED} AS l ON l.listing_url = w.listing_url AND l.rn <= 5 JOIN {COMPLETE} AS c ON c.url = l.link) AS x)"""


def ingested(spark, configured, crawl, profile, run_id):
    products, runs = table_target(spark), table_target(spark, "runs")
    ingest(
        spark, configured, crawl, profile, run_id, products, runs, max_products=5, replace_existing=True,
        now=F.lit("2024-03-01T08:00:00Z").cast("timestamp"), request_delay=0.5, max_retries=3, clear="before",
    )
    return products, runs


@query(
    "pl6_ingest_store1",
    "SELECT md5(url) AS product_id, name, price, url, 'melk' AS category, 'r1_' || category_name AS run_id "
    f"FROM {CRAWLED1} AS c WHERE rn = 1",
)
def ingest_first_store(spark, sf):
    """From category, listing and product pages to stored products in one call."""
    configured = relation(spark, sf, "part").select(
        F.concat(F.lit("cat"), F.col("p_partkey").cast("string")).alias("name"),
        F.concat(F.lit("/no/categories/"), F.col("p_partkey").cast("string"), F.lit("-melk/")).alias("url"),
    )
    crawl = store1_source(
        spark,
        relation(spark, sf, "category_pages").select("url", "html"),
        relation(spark, sf, "listing_pages"),
        relation(spark, sf, "product_pages").select("url", "html"),
    )
    products, _ = ingested(spark, configured, crawl, STORE1, "r1")
    return spark.table(products.location).select("product_id", "name", "price", "url", "category", "run_id")


@query(
    "pl6_ingest_store2",
    "SELECT product_id, name, price, url, 'Meieri ' || (page_id - page_id % 4) AS category, "
    "'r2_m' || (page_id - page_id % 4) AS run_id, 5 AS max_products, 0.5::DOUBLE AS request_delay, 3 AS max_retries "
    f"FROM {CARDS} AS c WHERE page_id % 4 < 3 AND page_id - page_id % 4 IN (SELECT p_partkey FROM part)",
)
def ingest_second_store(spark, sf):
    """From listing pages to stored products; the settings stand in the run's row."""
    key = (F.col("page_id") - F.col("page_id") % 4).cast("string")
    url = F.concat(F.lit("https://shop.example/varer/meieri-"), key, F.lit("/"))
    pages = relation(spark, sf, "card_pages")
    configured = pages.where("page_id % 4 = 0").select(F.concat(F.lit("m"), key).alias("name"), url.alias("url"))
    listing = pages.select(url.alias("listing_url"), (F.col("page_id") % 4 + 1).alias("page_no"), "html")
    products, runs = ingested(spark, configured, store2_source(spark, listing), STORE2, "r2")
    config = F.from_json("config_snapshot", "scraper struct<request_delay: double, max_retries: int>")["scraper"]
    settings = spark.table(runs.location).select(
        "run_id", "max_products", config["request_delay"].alias("request_delay"), config["max_retries"].alias("max_retries")
    )
    stored = spark.table(products.location).select("product_id", "name", "price", "url", "category", "run_id")
    return stored.join(settings, "run_id")
