"""From page snapshots to products (PL4, PL5).

The snapshots take the place of fetching: which pages would be read, and in which
order, follows from the links on them. A page that nothing links to is not parsed: the
wanted URLs make a bit array that is probed where pages are scanned. The others are
parsed once, there, and only the narrow rows that this gives are shuffled and joined:
markup never crosses an exchange.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hylle.functions import urls as U
from hylle.operators import listing as L
from hylle.operators.filters import without_skipped
from hylle.operators.membership import may_be_among
from hylle.profiles import STORE1, STORE2, StoreProfile
from hylle.session import materialised
from hylle.sources import extract as E


def subcategories(category_pages: DataFrame, profile: StoreProfile = STORE1) -> DataFrame:
    """(category_url, pos, name, listing_url) of each category page (url, html).

    The category's own listing comes last unless it is among the links; skipped
    labels go first and then repeated URLs, so a skipped link hides nothing.
    """
    pages = category_pages.select(F.col("url").alias("category_url"), "html")
    found = E.subcategory_links(pages, profile).withColumnRenamed("link", "url")
    links = materialised(category_pages.sparkSession, found, "category-links")
    own = (
        links.select("category_url")
        .distinct()
        .select(
            "category_url",
            F.lit(2**31 - 1).alias("pos"),
            U.main_category_name(U.category_slug("category_url")).alias("name"),
            F.col("category_url").alias("url"),
        )
    )
    every = L.with_main_category(links, own, ["category_url", "url"])
    unique = L.first_occurrences(without_skipped(every), ["category_url"], ["pos", "name", "url"])
    return unique.withColumnRenamed("url", "listing_url")


def store1_listing_links(
    spark: SparkSession,
    listing_pages: DataFrame,
    wanted: DataFrame,
    profile: StoreProfile = STORE1,
    max_products: int | None = None,
) -> DataFrame:
    """(listing_url, page_no, pos, url): product URLs that reading the listings gives."""
    pages = may_be_among(listing_pages, "listing_url", wanted, "listing_url")
    pages = pages.where(F.col("page_no") <= profile.page_cap).select("listing_url", "page_no", "html")
    found = E.product_links(pages, profile).withColumnRenamed("link", "url")
    parsed = materialised(spark, found, "listing-links")
    asked = parsed.join(wanted.select("listing_url").distinct(), "listing_url", "left_semi")
    read = L.read_pages(asked, "listing_url", profile.page_cap)
    return L.capped(read, ["listing_url"], ["page_no", "pos", "url"], max_products)


def crawl_store1(
    spark: SparkSession,
    category_pages: DataFrame,
    listing_pages: DataFrame,
    product_pages: DataFrame,
    profile: StoreProfile = STORE1,
    max_products: int | None = None,
) -> DataFrame:
    """Products of every subcategory of every category page.

    Inputs: category_pages(url, html), listing_pages(listing_url, page_no, html),
    product_pages(url, html). The cap holds per subcategory and counts URLs. A
    product listed twice gives two rows with one id; link_pos, page_no and pos are
    its place in reading order.
    """
    subs = materialised(spark, subcategories(category_pages, profile), "subcategories")
    links = store1_listing_links(spark, listing_pages, subs, profile, max_products)
    placed = links.join(
        subs.select("listing_url", "category_url", F.col("name").alias("subcategory"),
                    F.col("pos").alias("link_pos")),
        "listing_url",
    )
    placed = materialised(spark, placed, "product-links")
    linked = may_be_among(product_pages.select("url", "html"), "url", placed, "url")
    records = E.store1_products(linked, profile)
    return placed.join(records, "url").withColumn("category", U.category_slug("category_url"))


def crawl_store2(
    spark: SparkSession,
    listing_pages: DataFrame,
    profile: StoreProfile = STORE2,
    max_products: int | None = None,
    wanted: DataFrame | None = None,
) -> DataFrame:
    """Products of every listing, from listing_pages(listing_url, page_no, html).

    Reading stops at the page cap, before a page without cards and after a last
    page; the cap counts extracted products. ``wanted`` (listing_url) keeps other
    listings from being parsed; the few that may slip through are for the caller's
    join to drop.
    """
    if wanted is not None:
        listing_pages = may_be_among(listing_pages, "listing_url", wanted, "listing_url")
    pages = listing_pages.where(F.col("page_no") <= profile.page_cap).select(
        "listing_url", "page_no", "html"
    )
    carded = E.cards(pages, paged=True)
    parsed = materialised(
        spark,
        carded.select("listing_url", "page_no", "is_last", "_cards", "_boxes"),
        "cards",
    )
    read = L.read_pages(
        parsed, "listing_url", profile.page_cap,
        has_rows=F.size("_cards") > 0, is_last=F.col("is_last"),
    )
    found = E.card_products(read.drop("is_last"), profile)
    kept = L.capped(found, ["listing_url"], ["page_no", "pos", "product_id"], max_products)
    return kept.withColumns(
        {
            "category": U.slug_title(U.last_segment("listing_url")),
            "subcategory": F.lit(None).cast("string"),
        }
    )


Crawl = Callable[[DataFrame, int | None], DataFrame]


def store1_source(
    spark: SparkSession,
    category_pages: DataFrame,
    listing_pages: DataFrame,
    product_pages: DataFrame,
    profile: StoreProfile = STORE1,
) -> Crawl:
    """A crawl of the first store for ``ingest``: categories (name, url) and a cap to products.

    ``seq`` is the reading order: categories by name, then links, pages and positions.
    """

    def crawl(categories: DataFrame, max_products: int | None) -> DataFrame:
        named = categories.select(F.col("name").alias("category_name"), F.col("url").alias("category_url"))
        asked = may_be_among(category_pages, "url", named, "category_url")
        found = crawl_store1(spark, asked, listing_pages, product_pages, profile, max_products)
        order = F.struct("category_name", "link_pos", "page_no", "pos", "listing_url")
        return found.join(named, "category_url").withColumn("seq", order)

    return crawl


def store2_source(
    spark: SparkSession, listing_pages: DataFrame, profile: StoreProfile = STORE2
) -> Crawl:
    """A crawl of the second store for ``ingest``; a category's URL is its listing."""

    def crawl(categories: DataFrame, max_products: int | None) -> DataFrame:
        named = categories.select(F.col("name").alias("category_name"), F.col("url").alias("listing_url"))
        found = crawl_store2(spark, listing_pages, profile, max_products, named)
        return found.join(named, "listing_url").withColumn("seq", F.struct("category_name", "page_no", "pos"))

    return crawl
