"""Scalar text rules (SF1-SF21, SF31-SF37) and the predicates around them."""

from __future__ import annotations

from pyspark.sql import functions as F

from hylle import fixed_values as V
from hylle.fixtures import as_sql, relation
from hylle.functions import text as X
from hylle.operators import dictionary as B
from hylle.operators import filters as P
from hylle.profiles import STORE1
from hylle.suite import dictionary_sql as D
from hylle.suite import query

PRODUCTS = as_sql("products")
CLEANED = D.cleaned(PRODUCTS)


def products(spark, sf):
    return relation(spark, sf, "products")


def cleaned(spark, sf):
    """Products with clean and lower-case texts beside their columns."""
    return (
        products(spark, sf)
        .withColumns({"cn": X.clean_text("name"), "ci": X.clean_text("info")})
        .withColumns(
            {
                "li": F.lower("ci"),
                "both_": F.lower(F.concat_ws(" ", "cn", "ci")),
                "swap_": F.lower(F.concat_ws(" ", "ci", "cn")),
            }
        )
    )


@query(
    "sf1_clean_text",
    f"SELECT product_id, {D.clean('name')} AS name, {D.clean('info')} AS info FROM {PRODUCTS} AS p",
)
def clean_text(spark, sf):
    return products(spark, sf).select(
        "product_id", X.clean_text("name").alias("name"), X.clean_text("info").alias("info")
    )


DOC_CLEAN = (
    "replace(replace(replace(trim(regexp_replace(coalesce(text, ''), "
    r"'[\s\x{1c}-\x{1f}\x{0b}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+', ' ', 'g')), "
    "';', ','), '\"', ''), chr(39), '')"
)


@query(
    "sf1_clean_text_documents",
    f"SELECT doc_id, md5({DOC_CLEAN}) AS digest, length({DOC_CLEAN}) AS n_clean FROM documents",
)
def clean_text_documents(spark, sf):
    text = relation(spark, sf, "documents").select("doc_id", X.clean_text("text").alias("t"))
    return text.select(
        "doc_id", F.md5("t").alias("digest"), F.length("t").cast("bigint").alias("n_clean")
    )


@query(
    "sf2_parse_price",
    f"SELECT product_id, {D.PRICE1.format('price_text')} AS store1_price, "
    f"{D.PRICE.format('price_text')} AS store2_price FROM {PRODUCTS} AS p",
)
def parse_price(spark, sf):
    return products(spark, sf).select(
        "product_id",
        X.parse_price("price_text", V.HEADER_TEXT).alias("store1_price"),
        X.parse_price("price_text").alias("store2_price"),
    )


UNIT = r"regexp_extract(replace(replace(unit_price, 'kr', ''), '&nbsp;', ' '), '(\d+[,.]?\d*)\s*/\s*(\w+)', {0})"


@query(
    "sf3_parse_unit_price",
    f"SELECT product_id, try_cast(replace({UNIT.format(1)}, ',', '.') AS DOUBLE) AS price, "
    f"nullif({UNIT.format(2)}, '') AS unit FROM {PRODUCTS} AS p",
)
def parse_unit_price(spark, sf):
    return (
        products(spark, sf)
        .select("product_id", X.parse_unit_price("unit_price").alias("u"))
        .select("product_id", "u.price", "u.unit")
    )


@query(
    "sf4_stable_product_id",
    "SELECT seq, substr(lower(regexp_replace(name || '_' || coalesce(info, ''), "
    r"'[^\p{L}\p{N}_]', '', 'g')), 1, 32) AS stable_id "
    f"FROM {PRODUCTS} AS p",
)
def stable_product_id(spark, sf):
    return products(spark, sf).select(
        "seq", X.stable_product_id("name", "info").alias("stable_id")
    )


def _attribute_query(name, **exprs):
    columns = ", ".join(f"{D.ATTRIBUTES[a]} AS {a}" for a in exprs)

    @query(name, f"SELECT product_id, {columns} FROM {CLEANED} AS p")
    def run(spark, sf):
        return cleaned(spark, sf).select("product_id", *[e().alias(a) for a, e in exprs.items()])


_attribute_query(
    "sf5_extract_size",
    size_quantity=lambda: X.size_quantity("ci"),
    size_unit=lambda: X.size_unit("ci"),
)
_attribute_query("sf6_extract_fat_content", fat_content=lambda: X.fat_content("ci"))
_attribute_query(
    "sf7_extract_multipack",
    pack_quantity=lambda: X.pack_quantity("ci"),
    unit_size=lambda: X.unit_size("ci"),
    unit_size_unit=lambda: X.unit_size_unit("ci"),
)
_attribute_query("sf8_egg_size", egg_size=lambda: X.egg_size("ci"))
_attribute_query("sf9_egg_quantity", egg_quantity=lambda: X.egg_quantity("ci"))
_attribute_query("sf10_egg_type", egg_type=lambda: X.egg_type("li"))
_attribute_query(
    "sf11_cheese_info",
    cheese_type=lambda: X.cheese_type("li"),
    aging=lambda: X.cheese_aging("ci"),
    preparation=lambda: X.cheese_preparation("li"),
)
_attribute_query(
    "sf12_dietary_flags",
    lactose_free=lambda: X.dietary_flag("li", "lactose_free"),
    gluten_free=lambda: X.dietary_flag("li", "gluten_free"),
    organic=lambda: X.dietary_flag("li", "organic"),
    vegan=lambda: X.dietary_flag("li", "vegan"),
)
_attribute_query("sf20_flavour", flavor=lambda: X.flavour("both_"))
_attribute_query("sf21_product_type", product_type=lambda: X.product_type("both_"))


@query(
    "sf13_determine_subcategory",
    f"SELECT product_id, {D.subcategory('both_')} AS subcategory FROM {CLEANED} AS p",
)
def determine_subcategory(spark, sf):
    return cleaned(spark, sf).select("product_id", X.subcategory("both_").alias("subcategory"))


DOCS = f"(SELECT doc_id, {DOC_CLEAN} AS ct FROM documents)"


@query(
    "sf13_subcategory_documents",
    f"SELECT subcategory, count(*) AS n FROM (SELECT {D.subcategory('lower(ct)')} AS subcategory "
    f"FROM {DOCS} AS d) AS t GROUP BY subcategory",
)
def subcategory_documents(spark, sf):
    text = relation(spark, sf, "documents").select(F.lower(X.clean_text("text")).alias("t"))
    return text.select(X.subcategory("t").alias("subcategory")).groupBy("subcategory").agg(
        F.count("*").alias("n")
    )


@query(
    "sf14_extract_brand",
    f"SELECT product_id, {D.brand('ci', 'swap_')} AS brand FROM {CLEANED} AS p",
)
def extract_brand(spark, sf):
    return cleaned(spark, sf).select("product_id", X.brand("ci", "swap_").alias("brand"))


@query(
    "sf14_brand_documents",
    f"SELECT doc_id, {D.brand('ct', 'lower(ct)')} AS brand FROM {DOCS} AS d",
)
def brand_documents(spark, sf):
    text = relation(spark, sf, "documents").select("doc_id", X.clean_text("text").alias("t"))
    text = text.withColumn("low", F.lower("t"))
    return text.select("doc_id", X.brand("t", "low").alias("brand"))


@query(
    "sf15_extract_brand_store2",
    f"SELECT product_id, coalesce(nullif(brand, ''), {D.brand('ci', 'swap_')}) AS brand FROM {CLEANED} AS p",
)
def extract_brand_store2(spark, sf):
    return cleaned(spark, sf).select(
        "product_id", P.fill_missing("brand", X.brand("ci", "swap_")).alias("brand")
    )


@query(
    "sf16_subtitle_brand",
    "SELECT p_partkey, CASE WHEN len(w) > 1 THEN w[-1] END AS brand FROM (SELECT p_partkey, "
    r"string_split_regex(trim(p_name || '  ' || p_brand), '\s+') AS w FROM part) AS t "
    "UNION ALL SELECT p_partkey, NULL FROM part",
)
def subtitle_brand(spark, sf):
    part = relation(spark, sf, "part")
    two = part.select(
        "p_partkey", X.subtitle_brand(F.concat_ws("  ", "p_name", "p_brand")).alias("brand")
    )
    one = part.select(
        "p_partkey",
        X.subtitle_brand(F.concat(F.lit(" "), F.regexp_replace("p_name", " ", ""))).alias("brand"),
    )
    return two.unionByName(one)


VOL = r"(\d+[,.]?\d*)\s*(ml|l|dl|cl|g|kg)"
FAT = r"(\d+[,.]?\d*)\s*%\s*fett"


@query(
    "sf17_parse_product_info",
    f"""SELECT product_id,
 try_cast(replace(regexp_extract(v, '{VOL}', 1, 'i'), ',', '.') AS DOUBLE) AS volume,
 lower(nullif(regexp_extract(v, '{VOL}', 2, 'i'), '')) AS volume_unit,
 try_cast(replace(regexp_extract(f, '{FAT}', 1, 'i'), ',', '.') AS DOUBLE) AS fat_percentage,
 b AS brand
FROM (SELECT product_id,
  list_filter(parts, lambda x: regexp_matches(x, '{VOL}', 'i'))[-1] AS v,
  list_filter(parts, lambda x: NOT regexp_matches(x, '{VOL}', 'i') AND regexp_matches(x, '{FAT}', 'i'))[-1] AS f,
  list_filter(parts, lambda x: NOT regexp_matches(x, '{VOL}', 'i') AND NOT regexp_matches(x, '{FAT}', 'i')
   AND ((upper(x) = x AND lower(x) <> x) OR {D.any_term('upper(x)', V.KNOWN_BRAND_PARTS)}))[-1] AS b
 FROM (SELECT product_id, list_transform(string_split(coalesce(info, ''), ','), lambda x: trim(x)) AS parts
  FROM {PRODUCTS} AS p) AS q) AS r""",
)
def parse_product_info(spark, sf):
    return (
        products(spark, sf)
        .select("product_id", X.info_parts("info").alias("i"))
        .select("product_id", "i.*")
    )


@query(
    "jn6_dictionary_join",
    "SELECT product_id, priority, keyword, label FROM "
    f"{CLEANED} AS p, (VALUES "
    + ", ".join(f"({i}, {D.quoted(k)}, {D.quoted(v)})" for i, (k, v) in enumerate(V.BRANDS))
    + ") AS d(priority, keyword, label) WHERE contains(swap_, keyword)",
)
def dictionary_join(spark, sf):
    hits = cleaned(spark, sf).select(
        "product_id", F.explode(X.dictionary_hits("swap_", V.BRANDS)).alias("h")
    )
    return hits.select("product_id", "h.priority", "h.keyword", "h.label")


# Keywords of a large dictionary: all words of the conversations, and part names.
# The order is that of their hashes.
LARGE = """(SELECT md5(keyword) AS priority, keyword, left(md5(keyword), 4) AS label FROM (
 SELECT DISTINCT unnest(string_split(lower(text), ' ')) AS keyword FROM conversations
 UNION SELECT lower(p_name) FROM part) AS k WHERE keyword <> '')"""


def large_dictionary(spark, sf):
    words = relation(spark, sf, "conversations").select(
        F.explode(F.split(F.lower("text"), " ")).alias("keyword")
    )
    names = relation(spark, sf, "part").select(F.lower("p_name").alias("keyword"))
    return words.unionByName(names).where("keyword <> ''").distinct().select(
        F.md5("keyword").alias("priority"), "keyword", F.left(F.md5("keyword"), F.lit(4)).alias("label")
    )


def lower_documents(spark, sf):
    return relation(spark, sf, "documents").select("doc_id", F.lower("text").alias("text"))


@query(
    "jn6_large_dictionary",
    f"SELECT doc_id, keyword, label FROM documents JOIN {LARGE} AS d ON contains(lower(text), keyword)",
)
def large_dictionary_join(spark, sf):
    hits = B.keyword_hits(
        lower_documents(spark, sf), large_dictionary(spark, sf).select("keyword", "label"), key="doc_id", text="text"
    )
    return hits.select("doc_id", "keyword", "label")


@query(
    "wn5_first_of_large_dictionary",
    "SELECT doc_id, priority, keyword, label FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY priority) AS rn "
    f"FROM documents JOIN {LARGE} AS d ON contains(lower(text), keyword)) AS h WHERE rn = 1",
)
def first_of_large_dictionary(spark, sf):
    return B.first_keyword(
        lower_documents(spark, sf), large_dictionary(spark, sf), key="doc_id", text="text", priority="priority"
    )


@query(
    "wn5_first_keyword",
    "SELECT product_id, label FROM (SELECT product_id, label, row_number() OVER "
    f"(PARTITION BY product_id ORDER BY priority) AS rn FROM {CLEANED} AS p, (VALUES "
    + ", ".join(f"({i}, {D.quoted(k)}, {D.quoted(v)})" for i, (k, v) in enumerate(V.BRANDS))
    + ") AS d(priority, keyword, label) WHERE contains(swap_, keyword)) AS t WHERE rn = 1",
)
def first_keyword(spark, sf):
    brands = [(label, (key,)) for key, label in V.BRANDS]
    labelled = cleaned(spark, sf).select(
        "product_id", X.first_label("swap_", brands).alias("label")
    )
    return labelled.where(F.col("label").isNotNull())


@query(
    "pj3_info_guard",
    f"SELECT product_id, coalesce(info, '') <> '' AS has_info, CASE WHEN coalesce(info, '') <> '' "
    f"THEN {D.clean('info')} END AS info FROM {PRODUCTS} AS p",
)
def info_guard(spark, sf):
    guard = X.has_text("info")
    return products(spark, sf).select(
        "product_id", guard.alias("has_info"), F.when(guard, X.clean_text("info")).alias("info")
    )


@query(
    "pj4_fill_missing",
    f"SELECT product_id, coalesce(nullif(brand, ''), {D.brand('ci', 'swap_')}) AS brand, "
    f"coalesce(nullif(subcategory, ''), {D.subcategory('both_')}) AS subcategory FROM {CLEANED} AS p",
)
def fill_missing(spark, sf):
    return cleaned(spark, sf).select(
        "product_id",
        P.fill_missing("brand", X.brand("ci", "swap_")).alias("brand"),
        P.fill_missing("subcategory", X.subcategory("both_")).alias("subcategory"),
    )


@query(
    "entry_subcategory_prices",
    f"SELECT subcategory, count(*) AS n, round(avg(price), 4) AS avg_price, round(max(size), 4) AS max_size "
    f"FROM (SELECT {D.subcategory('both_')} AS subcategory, {D.PRICE1.format('price_text')} AS price, "
    f"{D.ATTRIBUTES['size_quantity']} AS size FROM {CLEANED} AS p) AS t GROUP BY subcategory",
)
def subcategory_prices(spark, sf):
    rows = cleaned(spark, sf).select(
        X.subcategory("both_").alias("subcategory"),
        X.parse_price("price_text", STORE1.header_text).alias("price"),
        X.size_quantity("ci").alias("size"),
    )
    return rows.groupBy("subcategory").agg(
        F.count("*").alias("n"),
        F.round(F.avg("price"), 4).alias("avg_price"),
        F.round(F.max("size"), 4).alias("max_size"),
    )

