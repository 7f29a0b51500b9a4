"""Page extraction on small markup."""

from html.parser import HTMLParser
from random import Random

from pyspark.sql import functions as F

from hylle.fixtures import relation, render
from hylle.operators.listing import read_pages
from hylle.sources import extract as E
from hylle.sources import markup
from hylle.sources.markup import read_page


def pages(spark, *htmls, url="https://shop.example/varer/a/1/"):
    return spark.createDataFrame([(i, url, h) for i, h in enumerate(htmls)], "id int, url string, html string")


def test_text_is_stripped_per_piece_and_scripts_are_hidden():
    page = read_page("<div><h2> a <b> b</b>\n c </h2><script>kr 5</script></div>", "store1_product")[0]
    assert [h["text"] for h in page["hits"] if h["rule"] == "name"] == ["abc"]
    assert page["has_kr"] is True


def test_text_pieces_of_one_text_keep_their_blanks():
    page = read_page("<h2>a < b</h2><h2> c <!-- x --> d</h2>", "store1_product")[0]
    assert [h["text"] for h in page["hits"] if h["rule"] == "name"] == ["a < b"]


def test_bad_declarations_are_skipped():
    for bad in ("<![foo[ x ]]>", "<![", "<!foo>", "<![if x]>"):
        page = read_page(f"{bad}<h2>x</h2><p>kr 5</p>", "store1_product")[0]
        names = [h["text"] for h in page["hits"] if h["rule"] == "name"]
        assert names == (["x"] if bad != "<![" else names), bad


def test_unclosed_tags_cost_in_proportion():
    import time

    def took(n):
        start = time.process_time()
        rows = read_page('<span class="price">x' * n, "store1_product")
        return time.process_time() - start, sum(len(h["text"] or "") for h in rows[0]["hits"])

    took(1_000)
    (small, text_small), (large, text_large) = took(2_000), took(20_000)
    assert large < 40 * max(small, 0.005)
    assert text_large <= 40 * 20_000


def test_nested_blocks_ship_little_text():
    page = "<a href='/x/'>" + "<div>word " * 400 + "</a>" + "<div>word " * 400
    shipped = sum(len(h["text"] or "") for s in read_page(page, "subcategories") for h in s["hits"])
    assert shipped < 10 * len(page)


def test_links_in_any_quoting(spark):
    html = """<a href='/x'>x</a><a class=b href=/y>y</a><!-- <a href="/no">n</a> --><a href="/z?a=1&amp;b=2">z</a>"""
    assert [r.link for r in E.plain_links(pages(spark, html)).orderBy("pos").collect()] == ["/x", "/y", "/z?a=1&b=2"]


def test_cards_without_url_have_ids_of_their_own(spark):
    card = '<li class="ws-product-list-vertical__item"><a class="ws-product-vertical__link">{}</a><div class="ws-product-vertical__price">kr 5</div></li>'
    name = "Tine Lettmelk Laktosefri Ekstra Lang Holdbarhet "
    rows = E.card_products(E.cards(pages(spark, card.format(name + "1l") + card.format(name + "2l") + card.format(name + "2l")))).collect()
    assert len({r.product_id for r in rows}) == 3


def test_broken_and_missing_markup():
    assert read_page(None, "cards") is None
    assert read_page("", "cards")[0]["hits"] == []
    assert read_page("<p>a<p>b</div></section>", "cards")[0]["kind"] == "page"


def test_price_selector_order(spark):
    html = (
        '<h2>N</h2><span class="x price">kr 9</span><div class="price"><span>kr 8</span></div>'
        '<span class="k-text-color--default">tilbud</span>'
    )
    assert [r.price_text for r in E.store1_products(pages(spark, html)).collect()] == ["kr 8"]


def test_price_fallback_takes_the_outermost_block(spark):
    html = "<h2>N</h2><div>for <b>kr</b><p>12 stk</p></div><p>kr 5</p>"
    row = E.store1_products(pages(spark, html)).first()
    assert (row.price_text, row.price) == ("forkr12 stk", 12.0)


def test_page_without_name_or_price_gives_nothing(spark):
    assert E.store1_products(pages(spark, "<h2>N</h2><p>gratis</p>", "<p>kr 5</p>")).count() == 0


def test_image_strategies(spark):
    price = '<h2>Melk</h2><p>kr 5</p>'
    htmls = [
        f'<article><p></p><div>{price}</div><div><img src="/no.png"></div></article><img alt="tine MELK 1l" src="/alt.png">',
        f'{price}<img src="/0.png"><img class="k-image" src="/1.png">',
        f'{price}<main><div><article><section><div><img src="/2.png?a&amp;amp;b"></div></section></article></div></main>',
        f'{price}<div class="my-product"><i><img src="https://cdn.example/3.png"></i></div>',
        f'{price}<img src="/none.png">',
        f'<article><div>{price}<img></div></article><img class="k-image" src="/1.png">',
    ]
    rows = E.store1_products(pages(spark, *htmls)).orderBy("id").collect()
    base = "https://shop.example"
    assert [r.image_url for r in rows] == [
        base + "/alt.png", base + "/1.png", base + "/2.png?a&b", "https://cdn.example/3.png", None, None,
    ]


def test_nested_sections_list_a_link_once(spark):
    html = '<section><section><a href="/categories/1-a/"><span>A (3)</span></a></section></section>'
    rows = E.subcategory_links(pages(spark, html)).collect()
    assert [(r.name, r.link) for r in rows] == [("A", "https://shop.example/categories/1-a/")]


def test_product_links_once_per_page_and_card_first(spark):
    card = '<article>kr 5<a href="/products/1-a/">x</a><a href="/products/2-b/">y</a></article>'
    html = card + card + '<a href="/products/3-c/">z</a>'
    assert [r.link for r in E.product_links(pages(spark, html)).collect()] == [
        "https://shop.example/products/1-a/"
    ]


def test_card_strategies(spark):
    body = '<a class="ws-product-vertical__link" href="/varer/m/{0}/">n{0}</a><div class="ws-product-vertical__price">kr {0}</div>'
    boxes = "".join(f'<div class="ws-product-vertical">{body.format(i)}</div>' for i in (1, 2))
    listed = (
        '<ul class="ws-product-list-vertical"><li>' + body.format(3) + '<img src="/a"></li><li>x</li></ul>'
        '<li>' + body.format(4) + '<img src="/a"></li>'
    )
    other = '<ul><li><div class="Product">' + body.format(5) + '</div><img src="/a"></li><li>kr</li></ul>'
    empty_list = '<ul class="ws-product-list-vertical"></ul>' + other
    rows = E.card_products(E.cards(pages(spark, boxes, listed, other, empty_list))).orderBy("id", "pos")
    assert [(r.id, r.name) for r in rows.collect()] == [(0, "n1"), (0, "n2"), (1, "n3"), (2, "n5")]


def test_second_store_page_needs_a_product_url(spark):
    html = '<h1>N</h1><b itemprop="price">kr 5</b>'
    assert E.store2_products(pages(spark, html)).first().category == "unknown"
    assert E.store2_products(pages(spark, html, url="https://shop.example/varer/")).count() == 0


def test_last_page_rules(spark):
    pager = '<i data-page="{}" data-total-pages="3"></i>'
    more = '<button class="a ngr-button"><b>Vis flere</b></button>'
    single = "<i data-page='1' data-total-pages=3></i>"
    hidden = f"<!-- {pager.format(1)} --><script>{pager.format(1)}</script>"
    htmls = [pager.format(1), pager.format(3), pager.format(3) + more, "<p>x</p>", '<i data-page="1"></i>', single,
             "<button class='ngr-button x'>Vis flere</button>", hidden]
    rows = E.with_pagination(pages(spark, *htmls)).orderBy("id").collect()
    assert [r.is_last for r in rows] == [False, True, False, True, True, False, False, True]


def test_pages_are_parsed_once(spark):
    plan = E.card_products(E.cards(pages(spark, "<p>x</p>")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    plan = E.store1_products(pages(spark, "<p>x</p>"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_reading_stops_at_gaps_caps_and_last_pages(spark):
    rows = spark.createDataFrame(
        [("a", 1, False, 1), ("a", 2, False, 0), ("a", 3, False, 1), ("b", 2, False, 1),
         ("c", 1, False, 1), ("c", 2, True, 1), ("c", 3, False, 1), ("d", 1, False, 1), ("d", 2, False, 1)],
        "g string, page_no int, is_last boolean, n int",
    )
    kept = read_pages(rows, "g", 20, has_rows=F.col("n") > 0, is_last=F.col("is_last"))
    assert sorted((r.g, r.page_no) for r in kept.collect()) == [
        ("a", 1), ("c", 1), ("c", 2), ("d", 1), ("d", 2),
    ]
    assert sorted((r.g, r.page_no) for r in read_pages(rows, "g", 1).collect()) == [
        ("a", 1), ("c", 1), ("d", 1),
    ]


SOUP = (
    "<div>", "</div>", "<div class='x product price'>", '<h2 Class="a b">', "</h2>", "<a href=/x/>", '<a href="/y?a=1&amp;b=2">', "</a>",
    "<a href='/z' href=\"/w\">", "<p>", "</p >", "<script>if(a<b)</script>", "<script>", "</script >", "<style>x</style>", "<!-- kr -->", "<!--",
    "-->", "<!doctype html>", "<![CDATA[ kr 1]]>", "<?pi kr?>", "<?", "< b", "<", "&amp;", "&am", "kr 5", " æ\xa0ø ", "<br/>", "<img src=/a.png alt='x'/>",
    "<img\xa0src=a>", "</>", "</ a>", "<SPAN CLASS=price disabled>", "</SPAN>", "<article>", "<section>", "</section>", "<title>a<b>b</title>",
    '<a href="a>b">', '<a href="cut off>', "<a x = 'y'>", "<a x=='y'>", "<a b'c>", "<a href=x\"y>", "<p class=a&amp;b>", "<a/ href=x>", "<a href='q'class=z>",
    "<x:y z>", "<p class=\x85a>", "<p a=b\x1fc=d>", "<li>", "<td>", "<ul class=ws-product-list-vertical>", "<button class=ngr-button>Vis flere",
)


def base_reader():
    class BaseReader(markup.PageReader):
        goahead = HTMLParser.goahead

    return BaseReader


def test_plain_tags_are_read_as_the_base_class_reads_them(monkeypatch):
    random = Random(1)
    pages = ["".join(random.choices(SOUP, k=random.randint(0, 30))) for _ in range(1500)]
    found = [[read_page(page, job) for job in markup.JOBS] for page in pages]
    monkeypatch.setattr(markup, "PageReader", base_reader())
    assert found == [[read_page(page, job) for job in markup.JOBS] for page in pages]


def test_plain_tags_need_no_second_reading(monkeypatch):
    """The base class looks at every tag several times; plain ones are kept from it."""
    left = []
    for name in ("parse_starttag", "parse_endtag"):
        former = getattr(HTMLParser, name)
        monkeypatch.setattr(HTMLParser, name, lambda self, i, f=former: left.append(self.rawdata[i : i + 5]) or f(self, i))
    read_page('<!doctype html><h2 class="a b">x &amp; y</h2><img src=/a.png alt><script>a<b</script><p>kr 5</p ><p>z</p>', "store1_product")
    assert left == ["<scri", "</scr", "</p >"]


def test_links_by_later_strategies_where_earlier_ones_give_none(spark):
    part = '<main><div><section><a href="/tema/1/"><h3>T</h3></a></section></div></main>'
    rows = pages(
        spark, f'<section><a href="/no/categories/1-a/"><span>A</span></a></section>{part}', part, '<a href="ost/1">OST</a>', None, ""
    )
    found = E.subcategory_links(rows).orderBy("id").collect()
    assert [(r.id, r.name, r.link) for r in found] == [
        (0, "A", "https://shop.example/no/categories/1-a/"),
        (1, "T", "https://shop.example/tema/1/"),
        (2, "ost", "https://shop.example/ost/1"),
    ]


def test_texts_of_derived_pages_are_made_after_rows_are_dealt_out(spark, tmp_path):
    spark.sql("SELECT id AS p_partkey, 'n' AS p_name, 1 AS p_size FROM range(40)").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    listed = relation(spark, str(tmp_path), "listing_pages")
    plan = listed._jdf.queryExecution().optimizedPlan().toString()
    assert "Repartition" in plan and "html" not in plan[plan.index("Repartition") :]
    made = spark.sql(render("listing_pages", lambda t: f"parquet.`{tmp_path}/{t}.parquet`"))
    assert listed.exceptAll(made).isEmpty() and made.exceptAll(listed).isEmpty()
