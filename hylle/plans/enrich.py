"""Enrichment of product rows: one projection chain, no shuffle and no Python rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hylle import fixed_values as V
from hylle.functions import attributes as A
from hylle.functions import text as X
from hylle.profiles import StoreProfile
from hylle.schema import ATTRIBUTE_FIELDS, ATTRIBUTE_SCHEMA, PRODUCT_SCHEMA

# Attributes written only when a rule matches; the others are always written.
KEPT_WHEN_UNMATCHED = ("fat_content", "flavor", "product_type")
# Attributes written only for rows of one subcategory.
ONLY_FOR = {
    "egg_size": "egg", "egg_quantity": "egg", "egg_type": "egg",
    "cheese_type": "ost", "aging": "ost", "preparation": "ost",
}


def attribute_rules(profile: StoreProfile, info: str, lower_info: str, both: str) -> dict:
    """Attribute name -> expression, for the groups the store uses."""
    groups: dict[str, dict[str, Column]] = {
        "size": {
            "size_quantity": X.leading_amount("_size"),
            "size_unit": X.trailing_unit("_size"),
        },
        "fat": {"fat_content": X.to_double(F.col("_fat"))},
        "pack": {
            "pack_quantity": F.coalesce(
                X.multipack_count("_multi"), X.pack_word_count(info)
            ).try_cast("bigint"),
            "unit_size": X.multipack_size("_multi"),
            "unit_size_unit": X.trailing_unit("_multi"),
        },
        "dietary": {flag: X.dietary_flag(lower_info, flag) for flag, _ in V.DIETARY_TERMS},
        "features": {"flavor": X.flavour(both), "product_type": X.product_type(both)},
        "egg": {
            "egg_size": X.egg_size(info),
            "egg_quantity": X.egg_quantity(info),
            "egg_type": X.egg_type(lower_info),
        },
        "cheese": {
            "cheese_type": X.cheese_type(lower_info),
            "aging": X.cheese_aging(info),
            "preparation": X.cheese_preparation(lower_info),
        },
    }
    return {name: rule for g in profile.attribute_groups for name, rule in groups[g].items()}


def enrich(products: DataFrame, profile: StoreProfile) -> DataFrame:
    """Fill brand and subcategory where missing and set the attributes struct.

    Rows without info pass through unchanged. Attributes may be the known fields or an
    open object, whose other keys are kept. Each layer of columns is used more
    than once by the next, so Catalyst keeps the layers and cleans a text once.
    """
    if "attributes" in products.columns and products.schema["attributes"].dataType.typeName() == "variant":
        # keys that no rule knows stay; those of the rules are merged in
        known = products.withColumns({"_open": F.col("attributes"), "attributes": A.fields_of("attributes")})
        done = enrich(known, profile)
        return done.withColumn("attributes", A.merged("_open", A.from_fields("attributes"))).drop("_open")
    if "attributes" not in products.columns:
        products = products.withColumn("attributes", F.lit(None).cast(ATTRIBUTE_SCHEMA))
    layered = (
        products.withColumns(
            {
                "_ok": X.has_text("info"),
                "_name": X.clean_text("name"),
                "_info": X.clean_text("info"),
            }
        )
        .withColumns(
            {
                "_lower": F.lower("_info"),
                "_both": F.lower(F.concat_ws(" ", "_name", "_info")),
                "_swap": F.lower(F.concat_ws(" ", "_info", "_name")),
                "_size": X.size_match("_info"),
                "_multi": X.multipack_match("_info"),
                "_fat": X.group_of("_info", V.PERCENTAGE),
            }
        )
        .withColumns(
            {
                "brand": F.when(
                    F.col("_ok"), F.coalesce(X.filled("brand"), X.brand("_info", "_swap"))
                ).otherwise(F.col("brand")),
                "subcategory": F.when(
                    F.col("_ok"), F.coalesce(X.filled("subcategory"), X.subcategory("_both"))
                ).otherwise(F.col("subcategory")),
            }
        )
    )
    rules = attribute_rules(profile, "_info", "_lower", "_both")
    fields = []
    for name, _ in ATTRIBUTE_FIELDS:
        old = F.col("attributes")[name]
        if name not in rules:
            new = old
        elif name in KEPT_WHEN_UNMATCHED:
            new = F.coalesce(rules[name], old)
        elif name in ONLY_FOR:
            new = F.when(F.col("subcategory") == ONLY_FOR[name], rules[name]).otherwise(old)
        else:
            new = rules[name]
        fields.append(new.alias(name))
    return layered.withColumn(
        "attributes", F.when(F.col("_ok"), F.struct(*fields)).otherwise(F.col("attributes"))
    ).drop("_ok", "_name", "_info", "_lower", "_both", "_swap", "_size", "_multi", "_fat")


def with_product_columns(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """All product columns in order; absent ones get their defaults."""
    defaults = {
        "product_id": F.uuid(),
        "name": F.lit(""),
        "info": F.lit(""),
        "price": F.lit(0.0),
        "price_text": F.lit(""),
        "scraped_at": F.current_timestamp(),
    }
    columns = []
    for field in PRODUCT_SCHEMA.fields:
        if field.name in df.columns:
            value = F.col(field.name)
            if field.name != "attributes":
                value = value.try_cast(field.dataType)
        else:
            value = defaults.get(field.name, F.lit(None)).cast(field.dataType)
        columns.append(value.alias(field.name))
    return df.select(*columns, *keep)


def enrich_frame(df: DataFrame, profile: StoreProfile) -> DataFrame:
    """Enrich any frame with name and info; without them it is returned as it is.

    The result has exactly the product columns; attributes are made anew. Only the first store reworks
    arbitrary frames; for the second the frame is returned unchanged.
    """
    if not {"name", "info"} <= set(df.columns) or profile.name == "store2":
        return df
    return enrich(with_product_columns(df.drop("attributes")), profile)


def flat_attributes(df: DataFrame) -> DataFrame:
    """The attributes struct as plain columns."""
    kept = [c for c in df.columns if c != "attributes"]
    return df.select(*kept, *[F.col("attributes")[n].alias(n) for n, _ in ATTRIBUTE_FIELDS])
