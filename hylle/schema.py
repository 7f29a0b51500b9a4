"""Table schemas. Readers always get one of these; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

ATTRIBUTE_FIELDS = (
    ("size_quantity", T.DoubleType()),
    ("size_unit", T.StringType()),
    ("fat_content", T.DoubleType()),
    ("pack_quantity", T.LongType()),
    ("unit_size", T.DoubleType()),
    ("unit_size_unit", T.StringType()),
    ("lactose_free", T.BooleanType()),
    ("gluten_free", T.BooleanType()),
    ("organic", T.BooleanType()),
    ("vegan", T.BooleanType()),
    ("flavor", T.StringType()),
    ("product_type", T.StringType()),
    ("egg_size", T.StringType()),
    ("egg_quantity", T.LongType()),
    ("egg_type", T.StringType()),
    ("cheese_type", T.StringType()),
    ("aging", T.StringType()),
    ("preparation", T.StringType()),
)

ATTRIBUTE_SCHEMA = T.StructType([T.StructField(n, t) for n, t in ATTRIBUTE_FIELDS])

PRODUCT_SCHEMA = T.StructType(
    [
        T.StructField("product_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("brand", T.StringType()),
        T.StructField("info", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("price_text", T.StringType()),
        T.StructField("unit_price", T.StringType()),
        T.StructField("image_url", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("subcategory", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("attributes", ATTRIBUTE_SCHEMA),
        T.StructField("scraped_at", T.TimestampType()),
        T.StructField("run_id", T.StringType()),
    ]
)
PRODUCT_COLUMNS = PRODUCT_SCHEMA.fieldNames()

# The same with attributes that may have any keys.
OPEN_PRODUCT_SCHEMA = T.StructType(
    [T.StructField(f.name, T.VariantType() if f.name == "attributes" else f.dataType) for f in PRODUCT_SCHEMA.fields]
)

# A stored product as text: attributes as JSON, time as ISO text.
STORED_PRODUCT_SCHEMA = T.StructType(
    [
        T.StructField(f.name, T.StringType())
        if f.name in ("attributes", "scraped_at")
        else f
        for f in PRODUCT_SCHEMA.fields
    ]
)

RUN_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("scraper_type", T.StringType()),
        T.StructField("category_url", T.StringType()),
        T.StructField("max_products", T.IntegerType()),
        T.StructField("replace_existing", T.BooleanType()),
        T.StructField("config_snapshot", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("start_time", T.TimestampType()),
        T.StructField("end_time", T.TimestampType()),
        T.StructField("num_products", T.LongType()),
        T.StructField("duration_seconds", T.LongType()),
        T.StructField("error_message", T.StringType()),
    ]
)
RUN_COLUMNS = RUN_SCHEMA.fieldNames()

CATEGORY_SCHEMA = T.StructType(
    [T.StructField("name", T.StringType()), T.StructField("url", T.StringType())]
)
