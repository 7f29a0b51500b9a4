"""Plans and hot groups: nothing may need a whole group in one task."""

import random

import pytest
from pyspark.sql import functions as F

from hylle import suite
from hylle.operators import listing as L
from hylle.operators import ranking as R
from hylle.plans import crawl as C
from hylle.sources import extract as E

suite.load()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


WRITES = {n for n in suite.QUERIES if n.startswith(("sk", "sc1_", "sc2_", "sc3_", "sc4_", "pj2_", "pl4_", "pl5_", "pl6_", "pl7_"))}


@pytest.mark.parametrize("name", sorted(set(suite.QUERIES) - WRITES))
def test_no_cross_joins_and_python_only_for_pages(name, spark, sf_dir):
    text = plan(suite.QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    python_steps = text.count("EvalPython")
    reads_markup = name.startswith(("hx", "pj15", "pj16", "pj17", "wn7", "wn8"))
    assert python_steps == (1 if reads_markup and name != "hx1_plain_links" else 0)


def hot_listing(spark):
    rng = random.Random(7)
    rows = [("hot" if rng.random() < 0.4 else f"g{rng.randrange(40)}", rng.randrange(1, 9), rng.randrange(500)) for _ in range(6000)]
    df = spark.createDataFrame(rows, "g string, page_no int, pos int").repartition(8)
    return rows, df


@pytest.mark.parametrize("n", [1, 5, 1500])
def test_top_per_group_with_a_hot_group(spark, n):
    rows, df = hot_listing(spark)
    got = sorted(map(tuple, R.top_per_group(df, ["g"], ["page_no", "pos"], n).collect()))
    want = []
    for g in {r[0] for r in rows}:
        want += sorted(r for r in rows if r[0] == g)[:n]
    assert got == sorted(want)


@pytest.mark.parametrize("n", [1, 700, 2000, 10**6])
def test_top_per_group_with_a_hot_group_and_ties(spark, n):
    rows, _ = hot_listing(spark)
    rows = rows + [("hot", 3, 250)] * 900 + [(None, 1, i % 3) for i in range(1500)]
    df = spark.createDataFrame(rows, "g string, page_no int, pos int").repartition(8)
    got = R.top_per_group(df, ["g"], ["page_no", "pos"], n).collect()
    want = []
    for g in {r[0] for r in rows}:
        want += sorted(r for r in rows if r[0] == g)[:n]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_first_and_last_per_key_with_a_hot_key(spark):
    rows, df = hot_listing(spark)
    want = sorted(min(r for r in rows if r[0] == g) for g in {r[0] for r in rows})
    assert sorted(map(tuple, R.first_per_key(df, ["g"], ["page_no", "pos"]).collect())) == want
    numbered = df.withColumn("seq", F.col("page_no") * 1000 + F.col("pos")).drop("page_no", "pos")
    last = {r.g: r.seq for r in R.last_per_key(numbered, ["g"], "seq").collect()}
    assert last == {g: max(r[1] * 1000 + r[2] for r in rows if r[0] == g) for g in {r[0] for r in rows}}


def test_ranks_are_limited_before_the_shuffle(spark):
    _, df = hot_listing(spark)
    for ranked in (
        R.first_per_key(df, ["g"], ["page_no", "pos"]),
        R.top_per_group(df, ["g"], ["page_no", "pos"], 10),
    ):
        text = plan(ranked)
        assert "WindowGroupLimit" in text and "Partial" in text


def test_pages_are_counted_before_the_shuffle(spark):
    _, df = hot_listing(spark)
    text = plan(L.read_pages(df, "g"))
    assert "partial_min" in text and "Window " not in text and "collect_set" not in text


def test_listings_that_look_small_are_not_broadcast(spark):
    """Rows made by an explode look small beforehand; no side may go through the driver."""
    parts = spark.range(50).select("id", F.explode(F.sequence(F.lit(1), F.lit(30))).alias("page_no"))
    kept = L.read_pages(parts.where("NOT (page_no = 25 AND id % 3 = 0)"), "id")
    assert "BroadcastExchange" not in plan(kept)
    assert kept.columns == ["id", "page_no"]
    assert kept.count() == 17 * 24 + 33 * 30


def test_no_page_cap_unless_given(spark):
    df = spark.range(1, 41).select(F.lit("g").alias("g"), F.col("id").cast("int").alias("page_no"))
    assert L.read_pages(df, "g").count() == 40
    assert L.read_pages(df, "g", 20).count() == 20
    assert L.read_pages(df.where("page_no <> 1"), "g").count() == 0


def test_markup_crosses_no_exchange(spark, tmp_path):
    """Each page is read where it is scanned; joins only see what was read off it."""
    rows = [("https://shop.example/no/products/1-x/", "l", 1, '<h2>N</h2><p>kr 5</p><a href="/no/products/1-x/">x</a>')]
    pages = spark.createDataFrame(rows, "url string, listing_url string, page_no int, html string").repartition(2)
    pages.write.parquet(f"{tmp_path}/pages")
    pages = spark.read.parquet(f"{tmp_path}/pages")
    for read in (
        E.product_links(pages),
        E.store1_products(pages),
        E.subcategory_links(pages),
        E.card_products(E.cards(pages, paged=True)),
        E.with_pagination(pages),
    ):
        assert "Exchange" not in plan(read)
    subs = spark.createDataFrame([("l",)], "listing_url string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        crawled = C.store1_listing_links(spark, pages, subs)
        assert "html" not in plan(crawled)
        records = E.store1_products(pages.select("url", "html")).join(crawled.select("url"), "url")
        shuffled = [line for line in records._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in line]
        assert shuffled and "html" not in records.columns
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
