"""Stored products: scans, writes, merges and reads (SC, SK, PJ, JN, AG, ST, PL7)."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import functions as F

from hylle.fixtures import as_sql, relation
from hylle.functions import attributes as A
from hylle.functions import text as X
from hylle.operators import filters as P
from hylle.operators import merge as M
from hylle.operators import summary as G
from hylle.plans.enrich import enrich, flat_attributes, with_product_columns
from hylle.profiles import STORE1
from hylle.schema import ATTRIBUTE_SCHEMA, PRODUCT_COLUMNS
from hylle.session import materialised, work_folder
from hylle.sources import codec
from hylle.sources import tables as S
from hylle.suite import dictionary_sql as D
from hylle.suite import query

SHOWN = [c for c in PRODUCT_COLUMNS if c != "attributes"]
ID = ["product_id"]


def rows(spark, sf, name="products"):
    """A derived relation as product rows, with its sequence column."""
    return (
        relation(spark, sf, name)
        .withColumns(
            {
                "price": X.parse_price("price_text", STORE1.header_text),
                "attributes": F.lit(None).cast(ATTRIBUTE_SCHEMA),
                "scraped_at": codec.iso_time("scraped_at"),
            }
        )
        .select(*PRODUCT_COLUMNS, "seq")
    )


def shown(df, *more):
    return df.withColumn("scraped_at", codec.iso_text("scraped_at")).select(*SHOWN, *more)


def rows_sql(name):
    return (
        f"(SELECT *, {D.PRICE1.format('price_text')} AS price, "
        f"coalesce(nullif(category, ''), 'uncategorized') AS category_part, "
        f"substr(scraped_at, 1, 10) AS scrape_date FROM {as_sql(name)} AS raw)"
    )


STORED = rows_sql("products")
BATCH = rows_sql("batch")
COLS = ", ".join(SHOWN)


def best(source, keys, order):
    return (
        f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn "
        f"FROM {source} AS src) AS ranked WHERE rn = 1)"
    )


LAST = best(BATCH, "product_id", "seq DESC")
FIRST = best(BATCH, "product_id", "seq")
UPSERTED = (
    f"(SELECT {COLS} FROM {STORED} AS s WHERE product_id NOT IN (SELECT product_id FROM {BATCH} AS b) "
    f"UNION ALL SELECT {COLS} FROM {LAST} AS l)"
)
INSERTED = (
    f"(SELECT {COLS} FROM {STORED} AS s UNION ALL SELECT {COLS} FROM {FIRST} AS f "
    f"WHERE product_id NOT IN (SELECT product_id FROM {STORED} AS s2))"
)


def file_target(spark, kind="parquet"):
    return S.Target(kind, work_folder(spark, f"products-{kind}"))


def table_target(spark, name="products"):
    return S.Target("table", f"{name}_{uuid.uuid4().hex}", work_folder(spark, name))


def stored_files(spark, sf, kind="parquet"):
    target = file_target(spark, kind)
    S.append_files(rows(spark, sf), target)
    return target


def stored_table(spark, sf, name="products"):
    target = table_target(spark)
    S.make_table(spark, rows(spark, sf, name).drop("seq"), target, "product_id")
    return target


# --- scans ---------------------------------------------------------------------


@query("sc1_scan_files", f"SELECT {COLS}, category_part FROM {STORED} AS s")
def scan_files(spark, sf):
    return shown(S.read_files(spark, stored_files(spark, sf)), "category_part")


@query("sc1_scan_csv_files", f"SELECT {COLS}, category_part FROM {STORED} AS s")
def scan_csv_files(spark, sf):
    return shown(S.read_files(spark, stored_files(spark, sf, "csv")), "category_part")


@query("sc2_scan_category", f"SELECT {COLS} FROM {STORED} AS s WHERE category = 'economy'")
def scan_category(spark, sf):
    return shown(S.load(spark, stored_files(spark, sf), category="economy"))


@query("sc3_scan_table", f"SELECT {COLS} FROM {STORED} AS s")
def scan_table(spark, sf):
    return shown(S.scan(spark, stored_table(spark, sf)))


@query(
    "sc8_decode_stored_rows",
    f"SELECT product_id, scraped_at, price, brand, subcategory, {', '.join(D.ATTRIBUTES)} FROM "
    f"{D.enriched(STORED, 1, 'product_id, scraped_at, price')} AS e",
)
def decode_stored_rows(spark, sf):
    encoded = codec.to_stored(enrich(rows(spark, sf), STORE1))
    decoded = codec.from_stored(encoded).withColumn("scraped_at", codec.iso_text("scraped_at"))
    return flat_attributes(
        decoded.select("product_id", "scraped_at", "price", "brand", "subcategory", "attributes")
    )


# --- writes --------------------------------------------------------------------


@query(
    "sk1_append_files",
    f"SELECT {COLS}, category_part FROM {STORED} AS s UNION ALL SELECT {COLS}, category_part FROM {BATCH} AS b",
)
def append_files(spark, sf):
    target = stored_files(spark, sf)
    S.save(spark, rows(spark, sf, "batch"), target, replace_existing=False, seq="seq")
    return shown(S.read_files(spark, target), "category_part")


DAY_KEYS = "category_part, scrape_date, product_id"
LAST_OF_DAY = best(BATCH, DAY_KEYS, "seq DESC")
ON_DAY = "n.category_part = s.category_part AND n.scrape_date = s.scrape_date AND n.product_id = s.product_id"
REPLACED = (
    "(SELECT " + ", ".join(f"CASE WHEN n.rn = 1 THEN n.{c} ELSE s.{c} END AS {c}" for c in SHOWN)
    + f" FROM {STORED} AS s LEFT JOIN {LAST_OF_DAY} AS n ON {ON_DAY} "
    f"UNION ALL SELECT {COLS} FROM {LAST_OF_DAY} AS n WHERE NOT EXISTS "
    f"(SELECT 1 FROM {STORED} AS s WHERE {ON_DAY}))"
)


@query("sk2_replace_files", f"SELECT {COLS} FROM {REPLACED} AS r")
def replace_files(spark, sf):
    target = stored_files(spark, sf)
    S.save(spark, rows(spark, sf, "batch"), target, replace_existing=True, seq="seq")
    return shown(S.read_files(spark, target))


@query("sk3_upsert_table", f"SELECT {COLS} FROM {UPSERTED} AS u")
def upsert_table(spark, sf):
    target = stored_table(spark, sf)
    S.save(spark, rows(spark, sf, "batch"), target, replace_existing=True, seq="seq")
    return shown(S.scan(spark, target))


@query("sk4_insert_if_absent", f"SELECT {COLS} FROM {INSERTED} AS i")
def insert_if_absent(spark, sf):
    target = stored_table(spark, sf)
    S.save(spark, rows(spark, sf, "batch"), target, replace_existing=False, seq="seq")
    return shown(S.scan(spark, target))


LARGEST = f"(SELECT * FROM {BATCH} AS b ORDER BY seq DESC LIMIT 1)"


@query(
    "sk5_save_one_product",
    f"SELECT {COLS} FROM {STORED} AS s WHERE product_id NOT IN (SELECT product_id FROM {LARGEST} AS o) "
    f"UNION ALL SELECT {COLS} FROM {LARGEST} AS o",
)
def save_one_product(spark, sf):
    target = stored_table(spark, sf)
    one = rows(spark, sf, "batch").orderBy(F.col("seq").desc()).limit(1)
    S.save(spark, one, target, replace_existing=True, seq="seq")
    return shown(S.scan(spark, target))


def counted(spark, df, name):
    """How many rows there are by now, kept in a file."""
    return materialised(spark, df.agg(F.count("*").alias(name)), "counts")


@query(
    "sk8_clear_files",
    f"SELECT count(*) AS n_before, 0 AS n_after FROM {STORED} AS s",
)
def clear_files(spark, sf):
    target = stored_files(spark, sf)
    before = counted(spark, S.read_files(spark, target), "n_before")
    S.clear(spark, target)
    after = S.read_files(spark, target).agg(F.count("*").cast("int")).scalar()
    return before.select("n_before", after.alias("n_after"))


PRICE_ROWS = f"(SELECT product_id, price, scraped_at FROM {STORED} AS s WHERE price IS NOT NULL)"


@query(
    "sk9_clear_tables",
    f"SELECT 'product_prices' AS table_name, true AS cleared, count(*) AS n_before, 0 AS n_after FROM {PRICE_ROWS} AS c "
    f"UNION ALL SELECT 'products', true, count(*), 0 FROM {STORED} AS p "
    f"UNION ALL SELECT 'scraping_runs', true, count(*), 0 FROM {as_sql('runs')} AS r",
)
def clear_tables(spark, sf):
    products, prices, runs = stored_table(spark, sf), table_target(spark, "prices"), table_target(spark, "runs")
    S.make_table(spark, relation(spark, sf, "runs"), runs, "run_id")
    priced = rows(spark, sf).where("price IS NOT NULL").select("product_id", "price", "scraped_at")
    S.publish(spark, priced, prices.location, prices.folder)
    tables = {"product_prices": prices, "products": products, "scraping_runs": runs}
    before = {name: counted(spark, spark.table(t.location), "n_before") for name, t in tables.items()}
    done = S.clear_tables(spark, prices, products, runs)
    result = None
    for name, target in tables.items():
        left = spark.table(target.location).agg(F.count("*").cast("int")).scalar()
        row = before[name].select(
            F.lit(name).alias("table_name"), F.lit(done[name]).alias("cleared"), "n_before", left.alias("n_after")
        )
        result = row if result is None else result.unionByName(row)
    return result


@query(
    "sk9_clear_without_prices",
    f"SELECT 'products' AS table_name, count(*) AS n_before, 0 AS n_after FROM {STORED} AS p",
)
def clear_without_prices(spark, sf):
    """A missing child table does not keep the others from being cleared."""
    products, runs = stored_table(spark, sf), table_target(spark, "runs")
    S.make_table(spark, relation(spark, sf, "runs"), runs, "run_id")
    before = counted(spark, spark.table(products.location), "n_before")
    done = S.clear_tables(spark, table_target(spark, "prices"), products, runs)
    cleared = [name for name, ok in done.items() if ok]
    left = spark.table(products.location).agg(F.count("*").cast("int")).scalar()
    return before.select(F.lit(cleared[0]).alias("table_name"), "n_before", left.alias("n_after"))


@query(
    "sk10_serialise_rows",
    f"SELECT product_id, scraped_at, name, run_id, coalesce(info, '') <> '' AS has_attributes FROM {STORED} AS s",
)
def serialise_rows(spark, sf):
    stored = codec.to_stored(enrich(rows(spark, sf), STORE1).select(*PRODUCT_COLUMNS))
    return stored.select(
        "product_id", "scraped_at", "name", "run_id",
        F.col("attributes").contains('"organic":').alias("has_attributes"),
    )


@query(
    "sk11_storage_kinds",
    f"SELECT kind, count(*) AS n, count(DISTINCT product_id) AS n_ids FROM ("
    f"SELECT 'csv' AS kind, product_id FROM {REPLACED} AS r "
    f"UNION ALL SELECT 'parquet', product_id FROM {REPLACED} AS r "
    f"UNION ALL SELECT 'table', product_id FROM {UPSERTED} AS u) AS t GROUP BY kind",
)
def storage_kinds(spark, sf):
    result = None
    for target in (
        stored_files(spark, sf, "csv"), stored_files(spark, sf), stored_table(spark, sf),
    ):
        S.save(spark, rows(spark, sf, "batch"), target, replace_existing=True, seq="seq")
        ids = S.load(spark, target).select(F.lit(target.kind).alias("kind"), "product_id")
        result = ids if result is None else result.unionByName(ids)
    return result.groupBy("kind").agg(
        F.count("*").alias("n"), F.countDistinct("product_id").alias("n_ids")
    )


# --- reads ---------------------------------------------------------------------


@query(
    "pj1_optional_filters",
    f"SELECT {COLS} FROM {STORED} AS s WHERE category = 'economy' AND subcategory = 'egg'",
)
def optional_filters(spark, sf):
    df = P.equal_where_given(
        rows(spark, sf), category="economy", subcategory="egg", run_id=""
    )
    return shown(df)


@query(
    "pj2_point_lookup",
    f"SELECT {COLS} FROM (SELECT * FROM {STORED} AS s UNION ALL SELECT * FROM {BATCH} AS b) AS u "
    "WHERE product_id = 'p78' ORDER BY scrape_date, scraped_at, name DESC LIMIT 1",
)
def point_lookup(spark, sf):
    """An id that files hold several times: its first day counts."""
    target = stored_files(spark, sf)
    S.append_files(rows(spark, sf, "batch"), target)
    return shown(P.by_id(S.read_files(spark, target), "p78", "scrape_date", "scraped_at", F.col("name").desc()))


@query("pj2_point_lookup_table", f"SELECT {COLS} FROM {STORED} AS s WHERE product_id = 'p78'")
def point_lookup_in_table(spark, sf):
    """One bucket of the table is read, and of its files the pages that can hold the id."""
    return shown(S.find(spark, stored_table(spark, sf), "p78"))


@query(
    "jn2_stored_ids",
    f"SELECT DISTINCT product_id FROM {BATCH} AS b WHERE product_id IN (SELECT product_id FROM {STORED} AS s) AND seq % 97 = 0",
)
def stored_ids(spark, sf):
    few = rows(spark, sf, "batch").where("seq % 97 = 0")
    return S.stored_ids(spark, stored_table(spark, sf), few)


@query(
    "pl7_filtered_read",
    f"SELECT {COLS} FROM {STORED} AS s WHERE category = 'promo' "
    "ORDER BY product_id LIMIT 25",
)
def filtered_read(spark, sf):
    target = stored_files(spark, sf)
    return shown(S.load(spark, target, category="promo", run_id=None, limit=25))


@query(
    "pj7_stamp_run",
    f"SELECT product_id, 'run9_' || coalesce(nullif(category, ''), 'dairy') AS run_id, "
    f"coalesce(nullif(category, ''), 'dairy') AS category FROM {STORED} AS s",
)
def stamp_run(spark, sf):
    stamped = P.stamp_run(
        rows(spark, sf),
        P.category_run_id(F.lit("run9"), P.fill_missing("category", F.lit("dairy"))),
        F.lit("dairy"),
    )
    return stamped.select("product_id", "run_id", "category")


@query(
    "pj19_missing_columns",
    "SELECT name, info, CAST(0.0 AS DOUBLE) AS price, '' AS price_text, CAST(NULL AS VARCHAR) AS brand, category, "
    f"36 AS id_length FROM {STORED} AS s",
)
def missing_columns(spark, sf):
    df = with_product_columns(relation(spark, sf, "products").select("name", "info", "category"))
    return df.select(
        "name", "info", "price", "price_text", "brand", "category",
        F.length("product_id").alias("id_length"),
    )


# --- joins and set operations --------------------------------------------------


@query(
    "jn1_new_ids",
    f"SELECT seq, product_id FROM {BATCH} AS b WHERE product_id NOT IN (SELECT product_id FROM {STORED} AS s)",
)
def new_ids(spark, sf):
    return M.new_rows(rows(spark, sf), rows(spark, sf, "batch"), ID).select("seq", "product_id")


@query(
    "jn2_existing_ids",
    f"SELECT DISTINCT product_id FROM {STORED} AS s WHERE product_id IN (SELECT product_id FROM {BATCH} AS b)",
)
def existing_ids(spark, sf):
    return M.keys_present(rows(spark, sf), rows(spark, sf, "batch"), ID)


MERGED = (
    "(SELECT " + ", ".join(f"CASE WHEN n.rn = 1 THEN n.{c} ELSE s.{c} END AS {c}" for c in SHOWN)
    + f" FROM {STORED} AS s LEFT JOIN {LAST} AS n ON n.product_id = s.product_id)"
)


@query("jn3_keyed_replace", f"SELECT {COLS} FROM {MERGED} AS m")
def keyed_replace(spark, sf):
    stored = rows(spark, sf)
    batch = rows(spark, sf, "batch")
    known = batch.join(M.keys_present(stored, batch, ID), ID, "left_semi")
    return shown(M.replace_or_append(stored.drop("seq"), known, ID, "seq"))


@query(
    "st2_keyed_difference",
    f"SELECT product_id FROM {BATCH} AS b EXCEPT ALL SELECT product_id FROM {STORED} AS s",
)
def keyed_difference(spark, sf):
    return rows(spark, sf, "batch").select("product_id").exceptAll(
        rows(spark, sf).select("product_id")
    )


@query(
    "st3_keyed_merge",
    f"SELECT {COLS} FROM {MERGED} AS m UNION ALL SELECT {COLS} FROM {LAST} AS l "
    f"WHERE product_id NOT IN (SELECT product_id FROM {STORED} AS s)",
)
def keyed_merge(spark, sf):
    stored = rows(spark, sf).drop("seq")
    return shown(M.replace_or_append(stored, rows(spark, sf, "batch"), ID, "seq"))


# --- counts --------------------------------------------------------------------


@query(
    "ag1_group_by_category",
    f"SELECT category_part, count(*) AS n, count(DISTINCT product_id) AS n_ids FROM {STORED} AS s GROUP BY category_part",
)
def group_by_category(spark, sf):
    return G.per_category(rows(spark, sf))


@query(
    "ag2_products_per_category",
    f"SELECT category_part, count(*) AS n FROM {STORED} AS s GROUP BY ROLLUP (category_part)",
)
def products_per_category(spark, sf):
    return G.category_totals(rows(spark, sf))


@query(
    "ag3_products_per_run",
    f"SELECT run_id, count(*) AS num_products FROM {STORED} AS s GROUP BY run_id",
)
def products_per_run(spark, sf):
    return G.per_run(rows(spark, sf))


@query(
    "ag6_any_match",
    f"SELECT category_part, bool_or(coalesce(subcategory, '') = 'egg') AS has_egg, count(*) > 0 AS has_rows "
    f"FROM {STORED} AS s GROUP BY category_part",
)
def any_match(spark, sf):
    return G.any_per_category(rows(spark, sf), F.col("subcategory") == "egg", "has_egg")


@query(
    "ag7_write_summary",
    f"SELECT is_new, count(*) AS n FROM (SELECT product_id NOT IN (SELECT product_id FROM {STORED} AS s) AS is_new "
    f"FROM {BATCH} AS b) AS t GROUP BY is_new",
)
def write_summary(spark, sf):
    return M.write_summary(rows(spark, sf), rows(spark, sf, "batch"), ID)


# --- stored attributes and random ids ------------------------------------------

RAW = (
    "(SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN '{\"size_quantity\":' || o_orderkey || '.5,\"organic\":true}' "
    "WHEN 1 THEN '{broken' WHEN 2 THEN NULL WHEN 3 THEN '[1,2]' ELSE '{\"size_unit\":\"' || o_orderstatus || '\"}' END AS t FROM orders)"
)


# Attributes of orders with keys of their own, nested and varying ones among them.
OPEN_JSON = """CASE o_orderkey % 5 WHEN 3 THEN '[1,2]' WHEN 4 THEN NULL ELSE concat('{"organic":', CASE WHEN o_orderkey % 2 = 0 THEN 'true' ELSE 'false' END,
 ',"origin":{"country":"', o_orderstatus, '","farms":[1,', cast(o_custkey AS string), ']},"k', cast(o_orderkey % 7 AS string), '":', cast(o_orderkey AS string), '}') END"""
LATER_JSON = """concat('{"origin":{"country":"NO"},"k3":"later","seen":', cast(o_custkey AS string), '}')"""


def open_rows(spark, sf, text, seq=0):
    """Orders as products with these attributes."""
    named = relation(spark, sf, "orders").selectExpr(
        "concat('o', o_orderkey) AS product_id", f"{text} AS attributes", "o_orderdate AS scraped_at", "'x' AS name"
    )
    return with_product_columns(named).withColumn("seq", F.lit(seq))


def open_keys(df):
    def value(path, kind):
        return F.try_variant_get("attributes", path, kind)

    return df.select(
        "product_id",
        value("$.organic", "boolean").alias("organic"),
        value("$.origin.country", "string").alias("country"),
        value("$.origin.farms[1]", "bigint").alias("farm"),
        value("$.k3", "string").alias("k3"),
        value("$.seen", "bigint").alias("seen"),
        F.cardinality(A.keys_of(F.col("attributes"))).cast("bigint").alias("n_keys"),
    )


def open_sql(country, farm, k3, seen, n):
    return (
        f"SELECT 'o' || o_orderkey AS product_id, CAST(a ->> '$.organic' AS BOOLEAN) AS organic, {country} AS country, "
        f"{farm} AS farm, {k3} AS k3, {seen} AS seen, CAST({n} AS BIGINT) AS n_keys "
        f"FROM (SELECT *, CASE WHEN o_orderkey % 5 < 3 THEN CAST({OPEN_JSON} AS JSON) END AS a FROM orders) AS o"
    )


@query(
    "sf31_open_attributes",
    open_sql(
        country="a ->> '$.origin.country'", farm="CAST(a ->> '$.origin.farms[1]' AS BIGINT)", k3="a ->> '$.k3'",
        seen="CAST(NULL AS BIGINT)", n="CASE WHEN a IS NULL THEN 0 ELSE 3 END",
    ),
)
def open_attributes(spark, sf):
    """Keys that no rule knows, and nested ones, survive a write and a read."""
    target = replace(table_target(spark), open_attributes=True)
    S.save(spark, open_rows(spark, sf, OPEN_JSON), target, replace_existing=True, seq="seq")
    return open_keys(S.load(spark, target))


@query(
    "sf36_merge_open_attributes",
    open_sql(
        country="'NO'", farm="CAST(NULL AS BIGINT)", k3="'later'", seen="o_custkey",
        n="CASE WHEN a IS NULL THEN 3 WHEN o_orderkey % 7 = 3 THEN 4 ELSE 5 END",
    ),
)
def merge_open_attributes(spark, sf):
    """Key by key the later value counts, a nested object as a whole; other keys stay."""
    earlier = open_rows(spark, sf, OPEN_JSON).select("product_id", A.from_text("attributes").alias("before"))
    later = open_rows(spark, sf, LATER_JSON).select("product_id", A.from_text("attributes").alias("after"))
    both = earlier.join(later, "product_id")
    return open_keys(both.select("product_id", A.merged("before", "after").alias("attributes")))


@query(
    "sf31_attributes_normalised",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN o_orderkey + 0.5::DOUBLE END AS size_quantity, "
    "CASE WHEN o_orderkey % 5 = 4 THEN o_orderstatus END AS size_unit, "
    "CASE WHEN o_orderkey % 5 = 0 THEN true END AS organic, true AS is_object FROM orders",
)
def attributes_normalised(spark, sf):
    key = F.col("o_orderkey").cast("string")
    kind = F.col("o_orderkey") % 5
    text = (
        F.when(kind == 0, F.concat(F.lit('{"size_quantity":'), key, F.lit('.5,"organic":true}')))
        .when(kind == 1, F.lit("{broken"))
        .when(kind == 3, F.lit("[1,2]"))
        .when(kind == 4, F.concat(F.lit('{"size_unit":"'), F.col("o_orderstatus"), F.lit('"}')))
    )
    parsed = relation(spark, sf, "orders").select(
        "o_orderkey", codec.attributes_of(text).alias("a")
    )
    return parsed.select(
        "o_orderkey", "a.size_quantity", "a.size_unit", "a.organic",
        F.col("a").isNotNull().alias("is_object"),
    )


@query(
    "sf37_random_product_id",
    f"SELECT count(*) AS n_rows, count(*) AS n_ids, true AS all_shaped FROM {STORED} AS s",
)
def random_product_id(spark, sf):
    """Products without an id get one each, of the right shape."""
    made = with_product_columns(rows(spark, sf).drop("product_id")).select("product_id")
    shape = "^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$"
    return made.agg(
        F.count("*").alias("n_rows"),
        F.countDistinct("product_id").alias("n_ids"),
        F.bool_and(F.col("product_id").rlike(shape)).alias("all_shaped"),
    )
