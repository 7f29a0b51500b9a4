"""Hand-made rows for the text rules; expected values worked out by hand."""

import pytest
from pyspark.sql import functions as F

from hylle.functions import text as X
from hylle.functions import urls as U
from hylle.plans.enrich import enrich, enrich_frame, flat_attributes
from hylle.profiles import STORE1, STORE2
from hylle.schema import PRODUCT_COLUMNS
from hylle.sources import codec

NBSP = " "


def apply(spark, values, make):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.r for r in df.select("i", make(F.col("v")).alias("r")).orderBy("i").collect()]


def test_clean_text(spark):
    values = [None, "", f"  1,75{NBSP}l ;\tTINE\n", "Go'morgen \"x\"", "a\x1cb  c", f"{NBSP}{NBSP}x{NBSP}"]
    assert apply(spark, values, X.clean_text) == ["", "", "1,75 l , TINE", "Gomorgen x", "a b c", "x"]


@pytest.mark.parametrize(
    "text, price",
    [
        ("kr 35,30", 35.3), (f"kr{NBSP}35,30", 35.3), ("kr 1 234,50", 1.0), ("12.5,7", 12.5),
        ("gratis", 0.0), ("", 0.0), (None, 0.0), ("kr,5", 5.0),
    ],
)
def test_parse_price(spark, text, price):
    assert apply(spark, [text], X.parse_price) == [price]


def test_header_text_is_no_price_for_the_first_store(spark):
    text = "Hopp til hovedinnhold 12"
    assert apply(spark, [text], lambda c: X.parse_price(c, STORE1.header_text)) == [0.0]
    assert apply(spark, [text], lambda c: X.parse_price(c, STORE2.header_text)) == [12.0]


def test_unit_price(spark):
    got = apply(
        spark,
        ["kr 20,17 /l", f"kr 20,17{NBSP}/{NBSP}kg", "kr&nbsp;5/stk", "5 / størrelse", "per stk", "", None],
        X.parse_unit_price,
    )
    assert [tuple(r) for r in got] == [
        (20.17, "l"), (20.17, "kg"), (5.0, "stk"), (5.0, "størrelse"),
        (None, None), (None, None), (None, None),
    ]


def test_stable_product_id(spark):
    df = spark.createDataFrame([("Blåbær Kvarg!", "1 l, TINE"), ("x" * 40, None)], "n string, i string")
    got = [r[0] for r in df.select(X.stable_product_id("n", "i")).collect()]
    assert got == ["blåbærkvarg_1ltine", "x" * 32]


def test_sizes_and_packs(spark):
    df = spark.createDataFrame(
        [("4x125g, 6 pk",), ("6X1.5 L",), ("3 gulrøtter",), ("4 x 125 ml",), ("12 pakning",), ("",)], "t string"
    ).select(
        X.size_quantity("t"), X.size_unit("t"), X.pack_quantity("t"), X.unit_size("t"), X.unit_size_unit("t")
    )
    assert [tuple(r) for r in df.collect()] == [
        (125.0, "g", 4, 125.0, "g"),
        (1.5, "l", 6, 1.5, "l"),
        (3.0, "g", None, None, None),
        (125.0, "ml", None, None, None),
        (None, None, 12, None, None),
        (None, None, None, None, None),
    ]


def test_fat_needs_no_blank_before_the_sign(spark):
    assert apply(spark, ["3,5% fett", "35 % fett", "27%", None], X.fat_content) == [3.5, None, 27.0, None]


def test_eggs_and_cheese(spark):
    assert apply(spark, ["STØRRELSE L", "str. xl", "str.M", "18 egg", "stor"], X.egg_size) == [
        "L", "XL", "M", None, None,
    ]
    assert apply(spark, ["12 stk", "18 EGG", "6"], X.egg_quantity) == [12, 18, None]
    assert apply(spark, ["frittgående økologisk", "økologisk", "x"], X.egg_type) == [
        "Frittgående", "Økologisk", None,
    ]
    assert apply(spark, ["skiver, hel", "raspet", "helmelk", "x"], X.cheese_preparation) == [
        "Skivet", "Revet", "Hel", None,
    ]
    assert apply(spark, ["12 MND", "lagret 6 måneder", "6 uker"], X.cheese_aging) == [
        "12 måneder", "6 måneder", None,
    ]


def test_product_types_not_in_the_fixtures(spark):
    assert apply(spark, ["kefir", "skumma melk", "kulturmjølk", "extra lett"], X.product_type) == [
        "Kefir", "Skummet", "Kulturmelk", "Ekstra lett",
    ]


def test_brand_order_and_fallbacks(spark):
    df = spark.createDataFrame(
        [
            ("synnøve finden", ""), ("1,75 L", ""), ("hvit, Kulturgård", ""), ("hvit,", ""),
            ("hvit", ""), ("x, en veldig lang beskrivelse her", ""), ("a, FJELL, b", ""), ("", "tine"),
        ],
        "i string, n string",
    )
    got = [r[0] for r in df.select(X.brand("i", F.lower(F.concat_ws(" ", "i", "n")))).collect()]
    assert got == ["Synnøve", "75 L", "Kulturgård", "", None, None, "FJELL", "TINE"]


def test_info_parts(spark):
    got = apply(spark, ["1% fett, 1,75 l, TINE", "", "2 dl, 3 l, arla x, Ukjent", "10 % FETT"], X.info_parts)
    assert [tuple(r) for r in got] == [
        (75.0, "l", 1.0, "TINE"), (None, None, None, None), (3.0, "l", None, "arla x"),
        (None, None, 10.0, None),
    ]


def test_subtitle_brand(spark):
    assert apply(spark, ["500 g  Bondens ", "Bondens", "", None], X.subtitle_brand) == [
        "Bondens", None, None, None,
    ]


def test_shorter_terms_stand_for_longer_ones(spark):
    assert X.shortest_terms(["melk", "lettmelk", "skummet", "helmelk"]) == ["melk", "skummet"]


def test_titles_and_labels(spark):
    assert apply(spark, ["meieri-ost-og-egg", "o'boy 2go", "éa-ØB"], U.slug_title) == [
        "Meieri Ost Og Egg", "O'Boy 2Go", "Éa Øb",
    ]
    assert apply(spark, ["✓Melk (84)", "(5)", " Ost "], U.link_label) == ["Melk", "(5)", "Ost"]


def test_page_urls(spark):
    base = "https://shop.example"
    got = apply(
        spark,
        ["/v/a/?sort=x&page=1&b=", "/v/a/?x=1&y=2&x=3", "https://other.example/v/a/#top", "/v/?q=a+b%2F~*", ""],
        lambda c: U.with_page(c, F.lit(2), base),
    )
    assert got == [
        base + "/v/a/?sort=x&page=2", base + "/v/a/?x=1&x=3&y=2&page=2", base + "/v/a/?page=2",
        base + "/v/?q=a+b%2F~%2A&page=2", base + "?page=2",
    ]


def test_resolve(spark):
    got = apply(
        spark,
        ["/a", "b/c", "//cdn.example/i", "http://x.example/", "?q=1", "#t", "", "mailto:a@b", None],
        lambda c: U.resolve(c, "https://shop.example"),
    )
    base = "https://shop.example"
    assert got == [
        base + "/a", base + "/b/c", "https://cdn.example/i", "http://x.example/", base + "?q=1",
        base + "#t", base, "mailto:a@b", None,
    ]


def test_iso_times(spark):
    missing = F.lit("2000-01-01T00:00:00Z").cast("timestamp")
    got = apply(
        spark,
        ["2024-01-02T03:04:05Z", "2024-01-02T03:04:05+02:00", "2024-01-02T03:04:05.25", None, "", "no time"],
        lambda c: codec.iso_text(codec.iso_time(c, missing)),
    )
    assert got == [
        "2024-01-02T03:04:05", "2024-01-02T01:04:05", "2024-01-02T03:04:05.250000",
        "2000-01-01T00:00:00", "2000-01-01T00:00:00", "2000-01-01T00:00:00",
    ]


def test_attributes_of_json(spark):
    got = apply(
        spark, ['{"size_quantity":1.5,"other":1}', "{broken", None, "[1]", '"x"'], codec.attributes_of
    )
    assert got[0].size_quantity == 1.5
    assert all(r is not None and all(v is None for v in r) for r in got[1:])


PRODUCT = "product_id string, name string, info string, brand string, subcategory string"


def test_rows_without_info_pass_unchanged(spark):
    df = spark.createDataFrame([("a", "Tine egg", None, "", None), ("b", "Tine egg", "", None, "")], PRODUCT)
    rows = enrich(df, STORE1).orderBy("product_id").collect()
    assert [(r.brand, r.subcategory, r.attributes) for r in rows] == [("", None, None), (None, "", None)]


def test_subcategory_decides_the_group(spark):
    info = "str. L, 12 stk, hvit, skivet"
    df = spark.createDataFrame(
        [("a", "x", info, "B", "egg"), ("b", "x", info, "B", "ost"), ("c", "x", info, "B", "Egg")], PRODUCT
    )
    rows = flat_attributes(enrich(df, STORE1)).orderBy("product_id").collect()
    assert [(r.egg_size, r.cheese_type) for r in rows] == [("L", None), (None, "Hvit"), (None, None)]
    second = flat_attributes(enrich(df, STORE2)).orderBy("product_id").collect()
    assert [(r.egg_size, r.cheese_type, r.organic) for r in second] == [
        ("L", None, None), (None, None, None), (None, None, None),
    ]


def test_frame_needs_name_and_info(spark):
    df = spark.createDataFrame([("a",)], "name string")
    assert enrich_frame(df, STORE1) is df
    full = enrich_frame(spark.createDataFrame([("a", "1 l", 3)], "name string, info string, extra int"), STORE1)
    assert full.columns == PRODUCT_COLUMNS


def test_enrichment_runs_on_a_stream(spark, tmp_path):
    df = spark.createDataFrame([("a", "Tine melk", "1 l", None, None)], PRODUCT)
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    q = (
        enrich(stream, STORE1).writeStream.format("memory").queryName("enriched_stream")
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    q.awaitTermination(60)
    row = spark.table("enriched_stream").first()
    assert (row.brand, row.subcategory, row.attributes.size_quantity) == ("TINE", "melk", 1.0)
