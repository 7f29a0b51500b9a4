"""Scopes to product rows and links: which element wins, per store (HX1-HX8)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hylle import fixed_values as V
from hylle.functions import text as X
from hylle.functions import urls as U
from hylle.operators.filters import complete_records
from hylle.profiles import STORE1, STORE2, StoreProfile
from hylle.sources.markup import scopes


def hit(hits: Column, rule: str, test=None) -> Column:
    """The first element of a rule (that passes the test), in document order."""
    return F.try_element_at(
        F.filter(
            hits, lambda h: (h["rule"] == rule) if test is None else (h["rule"] == rule) & test(h)
        ),
        F.lit(1),
    )


def first_of(hits: Column, rules: list[str], test=None) -> Column:
    """The winner of the first rule that has one."""
    return F.coalesce(*[hit(hits, rule, test) for rule in rules])


def read_scopes(pages: DataFrame, job: str) -> DataFrame:
    """The pages' scopes beside the page's columns, without the markup."""
    return pages.withColumn("_scopes", scopes("html", job)).drop("html")


def page_hits(pages: DataFrame, job: str) -> DataFrame:
    """The page scope's elements beside the page's columns."""
    read = read_scopes(pages, job)
    return read.withColumn("_hits", F.try_element_at("_scopes", F.lit(1))["hits"]).drop("_scopes")


# --- first store ---------------------------------------------------------------


def subcategory_links(pages: DataFrame, profile: StoreProfile = STORE1) -> DataFrame:
    """(page columns, pos, name, link): links to subcategories in page order.

    Category links inside sections count; without any, links in sections of the main
    part; without those, links whose text has a category word. Links are taken from
    one array per page, so choosing the strategy needs no shuffle.
    """
    links = F.filter("_scopes", lambda s: s["kind"] == "link")

    def listed(test, name):
        return F.transform(
            F.filter(links, test),
            lambda s: F.struct(
                s["pos"].alias("pos"),
                name(s).alias("name"),
                s["link"].alias("link"),
            ),
        )

    def span_label(s):
        span = hit(s["hits"], "span")
        return F.when(span.isNotNull(), U.link_label(span["text"])).otherwise(s["text"])

    def block_label(s):
        block = F.try_element_at(s["hits"], F.lit(1))
        return F.coalesce(block["text"], s["text"])

    def category_word(s):
        return X.contains_any(F.lower(s["text"]), V.SUBCATEGORY_LINK_WORDS)

    by_section = listed(
        lambda s: s["in_section"] & U.is_subcategory_link(span_label(s), s["link"]), span_label
    )
    by_main = listed(
        lambda s: s["in_main"] & X.has_text(s["link"]) & X.has_text(block_label(s)),
        block_label,
    )
    by_word = listed(
        lambda s: X.has_text(s["link"]) & category_word(s), lambda s: F.lower(s["text"])
    )
    read = read_scopes(pages, "subcategories")
    # a strategy is worked out where the ones before it gave nothing
    for strategy in (by_section, by_main, by_word):
        if "_links" in read.columns:
            strategy = F.when(F.size("_links") > 0, F.col("_links")).otherwise(strategy)
        read = read.withColumn("_links", strategy)
    kept = [c for c in pages.columns if c != "html"]
    found = read.select(*kept, F.explode("_links").alias("_link"))
    return found.select(*kept, "_link.pos", "_link.name", U.resolve("_link.link", profile.base_url).alias("link"))


def product_links(pages: DataFrame, profile: StoreProfile = STORE1) -> DataFrame:
    """(page columns, pos, link): product URLs of listing pages, each once per page.

    A card is an article with a price and an image or product link; it gives its
    first valid link. Pages without such links give all valid links.
    """
    marker = profile.product_marker

    def valid(h):
        return U.is_product_url(h["link"], profile)

    def is_card(s):
        links_on = F.exists(
            s["hits"], lambda h: h["link"].contains(marker) & ~h["link"].endswith(marker)
        )
        return (s["kind"] == "article") & s["has_kr"] & (s["has_img"] | F.coalesce(links_on, F.lit(False)))

    def absolute(links):
        return F.array_distinct(F.transform(links, lambda u: U.resolve(u, profile.base_url)))

    from_cards = F.filter(
        F.transform(
            F.filter("_scopes", is_card),
            lambda s: F.try_element_at(F.filter(s["hits"], valid), F.lit(1))["link"],
        ),
        lambda u: u.isNotNull(),
    )
    from_page = F.transform(
        F.filter(F.try_element_at("_scopes", F.lit(1))["hits"], valid), lambda h: h["link"]
    )
    read = read_scopes(pages, "product_links")
    found = read.withColumn("_cards", from_cards)
    chosen = absolute(F.when(F.size("_cards") > 0, F.col("_cards")).otherwise(from_page))
    kept = [c for c in pages.columns if c != "html"]
    return found.select(*kept, F.posexplode(chosen).alias("pos", "link"))


PRICE_RULES = ["price.1", "price.2", "price.3", "price.4", "price.5"]
UNIT_RULES = ["unit.1", "unit.2", "unit.3", "unit.4"]
IMAGE_RULES = ["image.1", "image.2", "image.3", "image.4", "image.5", "image.6", "image.7"]


def store1_products(pages: DataFrame, profile: StoreProfile = STORE1) -> DataFrame:
    """One product per product page with a name and a price; other columns stay.

    The id is a hash of the URL, so that reading a page again gives the same id.
    """
    hits = F.col("_hits")
    price = F.coalesce(
        first_of(hits, PRICE_RULES, lambda h: h["text"].rlike("kr|[0-9]")),
        hit(hits, "price.any"),
    )
    unit = first_of(
        hits, UNIT_RULES, lambda h: h["text"].contains("/") & h["text"].contains("kr")
    )
    # Pages without the name's tag give nothing and need not be parsed. Their markup is
    # left out rather than the rows: a filter would be moved to where markup is made.
    titled = F.when(F.col("html").rlike("(?i)<h2"), F.col("html"))
    named = page_hits(pages.withColumn("html", titled), "store1_product").withColumns(
        {
            "name": hit(hits, "name")["text"],
            "info": F.coalesce(hit(hits, "info")["text"], F.lit("")),
            "price_text": price["text"],
            "unit_price": unit["text"],
        }
    )
    image = F.coalesce(
        hit(hits, "image.lead"),
        hit(hits, "image.div"),
        F.when(
            F.col("name") != "",
            hit(
                hits,
                "image.any",
                lambda h: F.lower(F.coalesce(h["alt"], F.lit(""))).contains(F.lower("name")),
            ),
        ),
        first_of(hits, IMAGE_RULES),
    )
    records = complete_records(named)
    return records.withColumns(
        {
            "product_id": F.md5("url"),
            "price": X.parse_price("price_text", profile.header_text),
            "image_url": U.absolute_or_null(U.unescaped(image["link"]), profile.base_url),
        }
    ).drop("_hits")


# --- second store --------------------------------------------------------------


def cards(pages: DataFrame, paged: bool = False) -> DataFrame:
    """Pages with their product cards as an array of scopes, by the first strategy
    that applies: marked list items, product boxes, items of the product list, or
    any list item that looks like a product. ``paged`` adds what pagination says,
    from the same reading of the page."""
    read = read_scopes(pages, "cards")
    page = F.try_element_at("_scopes", F.lit(1))
    if paged:
        read = read.withColumns(pagination(page["hits"]))

    def of_kind(kind, test=None):
        return F.filter(
            "_scopes", lambda s: (s["kind"] == kind) if test is None else (s["kind"] == kind) & test(s)
        )

    found = read.withColumns(
        {
            "_items": of_kind("item"),
            "_boxes": of_kind("box"),
            "_listed": of_kind("listed", lambda s: s["has_kr"] & s["has_img"]),
            "_other": of_kind("li", lambda s: s["has_kr"] & s["has_img"] & s["has_box"]),
            "_has_list": hit(page["hits"], "list").isNotNull(),
        }
    )
    chosen = (
        F.when(F.size("_items") > 0, F.col("_items"))
        .when(F.size("_boxes") > 0, F.col("_boxes"))
        .when(F.col("_has_list"), F.col("_listed"))
        .otherwise(F.col("_other"))
    )
    return found.withColumn("_cards", F.coalesce(chosen, F.array().cast(found.schema["_items"].dataType))).drop(
        "_scopes", "_items", "_listed", "_other", "_has_list"
    )


def card_products(carded: DataFrame, profile: StoreProfile = STORE2) -> DataFrame:
    """One row per card with a link and a price, in page order.

    Fields come from the card's first product box if it has one, else from the card.
    A card without a URL gets an id from its place (the page's columns and the
    position there), name and info, so no two of them share one.
    """
    kept = [c for c in carded.columns if c not in ("_cards", "_boxes")]
    card = carded.select(*kept, "_boxes", F.posexplode("_cards").alias("pos", "_card"))
    inner = hit(F.col("_card.hits"), "box")["pos"]
    box = F.try_element_at(F.filter("_boxes", lambda s: s["pos"] == inner), F.lit(1))
    body = card.withColumn("_hits", F.coalesce(box["hits"], F.col("_card.hits")))
    hits = F.col("_hits")
    link = first_of(hits, ["link.1", "link.2"])
    picked = body.select(
        *kept,
        "pos",
        link.alias("_link"),
        F.coalesce(hit(hits, "title"), link)["text"].alias("name"),
        F.coalesce(hit(hits, "subtitle")["text"], F.lit("")).alias("info"),
        hit(hits, "price")["text"].alias("price_text"),
        hit(hits, "unit")["text"].alias("unit_price"),
        hit(hits, "image")["link"].alias("_image"),
    )
    href = F.coalesce("_link.link", F.lit(""))
    place = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (*kept, "pos", "name", "info")]
    return complete_records(picked.where(F.col("_link").isNotNull())).select(
        *kept,
        "pos",
        F.when(href == "", F.sha2(F.concat_ws("\x1f", *place), 256))
        .otherwise(U.product_id_from_url(href))
        .alias("product_id"),
        "name",
        X.subtitle_brand("info").alias("brand"),
        "info",
        X.parse_price("price_text", profile.header_text).alias("price"),
        "price_text",
        "unit_price",
        U.absolute_or_null("_image", profile.base_url).alias("image_url"),
        F.when(href == "", href).otherwise(U.absolute_or_null(href, profile.base_url)).alias("url"),
    )


def store2_products(pages: DataFrame, profile: StoreProfile = STORE2) -> DataFrame:
    """One product per product page of the second store; other columns stay."""
    hits = F.col("_hits")
    crumbs = F.filter("_hits", lambda h: h["rule"] == "crumb")
    valid = pages.where(U.is_product_url("url", profile) & F.col("html").rlike("(?i)<h1"))
    picked = page_hits(valid, "store2_product").withColumns(
        {
            "product_id": U.product_id_from_url("url"),
            "name": hit(hits, "name")["text"],
            "info": F.coalesce(first_of(hits, ["info.1", "info.2"])["text"], F.lit("")),
            "price_text": first_of(hits, ["price.1", "price.2"])["text"],
            "unit_price": F.lit(None).cast("string"),
            "image_url": first_of(hits, ["image.1", "image.2"])["link"],
            "brand": first_of(hits, ["brand.1", "brand.2"])["text"],
            "category": F.coalesce(F.try_element_at(crumbs, F.lit(2))["text"], F.lit("unknown")),
        }
    )
    priced = complete_records(picked).withColumn(
        "price", X.parse_price("price_text", profile.header_text)
    )
    return priced.drop("_hits")


# --- facts read straight off the markup ----------------------------------------

def pagination(hits: Column) -> dict[str, Column]:
    """data_page, data_total_pages, has_more and is_last from a page's elements.

    A page is the last if no button offers more and the pager, if any, does not say
    that pages are left.
    """
    pager, more = hit(hits, "pager"), hit(hits, "more")["text"]
    number, total = pager["link"].try_cast("int"), pager["alt"].try_cast("int")
    has_more = F.coalesce(more.contains(V.MORE_BUTTON_TEXT), F.lit(False))
    left = F.coalesce(number < total, F.lit(False))
    return {
        "data_page": number,
        "data_total_pages": total,
        "has_more": has_more,
        "is_last": ~has_more & ~left,
    }


def with_pagination(pages: DataFrame) -> DataFrame:
    """Adds what pagination says to each listing page, without the markup."""
    read = page_hits(pages, "pagination")
    return read.withColumns(pagination(F.col("_hits"))).drop("_hits")


COMMENT = "(?s)<!--.*?-->"
LINK = r"""(?is)<a\s(?:[^>]*?\s)?href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))[^>]*>(.*?)</a>"""


def plain_links(pages: DataFrame) -> DataFrame:
    """(page columns, pos, link, text): all simple links, without leaving the JVM."""
    whole = F.regexp_extract_all(F.regexp_replace("html", COMMENT, ""), F.lit(LINK), F.lit(0))
    kept = [c for c in pages.columns if c != "html"]
    found = pages.select(*kept, F.posexplode(whole).alias("pos", "_a"))
    link = F.concat(*(F.regexp_extract("_a", LINK, i) for i in (1, 2, 3)))
    return found.select(
        *kept,
        "pos",
        U.unescaped(link).alias("link"),
        U.unescaped(
            X.strip(F.regexp_replace(F.regexp_extract("_a", LINK, 4), "<[^>]*>", ""))
        ).alias("text"),
    )
