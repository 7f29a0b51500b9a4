"""Only pages that something links to reach the page reader."""

import pytest
from pyspark.sql import functions as F

from hylle.operators import membership as B
from hylle.plans import crawl as C
from hylle.sources import markup


@pytest.mark.parametrize("words", [1, 64, B.WORDS])
def test_no_key_is_lost(spark, words):
    keys = spark.range(500).select(F.concat(F.lit("https://x/é/"), F.col("id")).alias("k"))
    rows = spark.range(-2_000, 2_000).select(F.concat(F.lit("https://x/é/"), F.col("id")).alias("u"), "id")
    rows = rows.unionByName(spark.createDataFrame([(None, 9_999)], "u string, id long"))
    kept = [r.id for r in B.may_be_among(rows, "u", keys, "k", words).collect()]
    assert set(range(500)) <= set(kept) and 9_999 not in kept
    if words == B.WORDS:
        assert len(kept) < 510
    none = keys.limit(0).unionByName(spark.createDataFrame([(None,)], "k string"))
    assert B.may_be_among(rows, "u", none, "k", words).count() == 0


def page(links, extra=""):
    return "<main><section>" + "".join(f'<a href="{u}"><span>L{i}</span></a>' for i, u in enumerate(links)) + f"</section></main>{extra}"


@pytest.fixture
def only_linked(monkeypatch):
    """The reader fails on a page that nothing links to."""
    read = markup.read_page

    def strict(html, job):
        if html and "UNLINKED" in html:
            raise ValueError("an unlinked page was read")
        return read(html, job)

    monkeypatch.setattr(markup, "read_page", strict)


def test_store1_reads_linked_pages_alone(spark, only_linked):
    base = "https://shop.example"
    cat = f"{base}/no/categories/1-melk/"
    listing = "/no/categories/5-ost/"
    product = "<main><article><h2>Ost</h2><p class='x'>kr 5</p></article></main>"
    bad = "<p>UNLINKED</p>"
    categories = spark.createDataFrame([(cat, page([listing])), (f"{base}/no/categories/2-nei/", bad)], "url string, html string")
    listings = spark.createDataFrame(
        [(base + listing, 1, '<article><img><a href="/no/products/7-x/">a</a>kr 5</article>'), (f"{base}/no/categories/6-nei/", 1, bad)]
        + [(f"{base}/no/categories/{i}-nei/", 1, bad) for i in range(100, 300)],
        "listing_url string, page_no int, html string",
    )
    products = spark.createDataFrame(
        [(f"{base}/no/products/7-x/", product)] + [(f"{base}/no/products/{i}-nei/", bad) for i in range(100, 300)],
        "url string, html string",
    )
    crawl = C.store1_source(spark, categories, listings, products)
    named = spark.createDataFrame([("melk", cat)], "name string, url string")
    rows = crawl(named, None).collect()
    assert [r.url for r in rows] == [f"{base}/no/products/7-x/"]


def test_store2_reads_wanted_listings_alone(spark, only_linked, sf_dir):
    from hylle.fixtures import relation

    cards = relation(spark, sf_dir, "card_pages").where("page_id in (1, 2)")
    wanted, other = "https://shop.example/varer/a/", "https://shop.example/varer/b/"
    pages = cards.select(
        F.when(F.col("page_id") == 1, wanted).otherwise(other).alias("listing_url"),
        F.lit(1).alias("page_no"),
        F.when(F.col("page_id") == 1, F.col("html")).otherwise(F.lit("<p>UNLINKED</p>")).alias("html"),
    )
    crawl = C.store2_source(spark, pages)
    rows = crawl(spark.createDataFrame([("a", wanted)], "name string, url string"), None).collect()
    assert [r.listing_url for r in rows] == [wanted]


def test_the_test_stands_before_the_reader(spark, sf_dir):
    from hylle.fixtures import relation

    pages = relation(spark, sf_dir, "product_pages").select("url", "html")
    links = pages.select("url").limit(3)
    plan = C.E.store1_products(B.may_be_among(pages, "url", links, "url"))._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    reader = next(i for i, x in enumerate(lines) if "EvalPython" in x)
    assert any("Filter" in x and "Subquery" in x for x in lines[reader + 1 :])


def test_the_array_grows_with_the_keys(spark):
    keys = spark.range(3_000_000).select(F.col("id").cast("string").alias("k"))
    rows = spark.range(3_000_000, 3_020_000).select(F.col("id").cast("string").alias("u"))
    assert B.words_for(keys, "k") > B.WORDS == B.words_for(keys.limit(10), "k")
    assert B.may_be_among(rows, "u", keys, "k").count() < 0.05 * 20_000
    assert B.may_be_among(keys.limit(500), "k", keys, "k").count() == 500
