"""Stored form of product rows: attributes as JSON, time as ISO text (SC8, SK10, SF31, SF32)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hylle.functions import attributes as A
from hylle.functions import text as X
from hylle.schema import ATTRIBUTE_FIELDS, ATTRIBUTE_SCHEMA


def iso_text(ts: Column | str) -> Column:
    """ISO text of a time, with microseconds only where there are any."""
    t = X.col(ts)
    seconds = F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.when(micros.endswith(".000000"), seconds).otherwise(micros)


def iso_time(text: Column | str, missing: Column | None = None) -> Column:
    """Time of an ISO text, with Z, an offset or neither; ``missing`` where there is none."""
    fallback = F.current_timestamp() if missing is None else missing
    return F.coalesce(X.filled(text).try_cast("timestamp"), fallback)


def attributes_of(text: Column | str) -> Column:
    """Attributes of a JSON object; anything else counts as an object without fields."""
    empty = F.struct(*[F.lit(None).cast(t).alias(n) for n, t in ATTRIBUTE_FIELDS])
    t = X.col(text)
    return F.when(t.rlike(r"^\s*\{"), F.from_json(t, ATTRIBUTE_SCHEMA)).otherwise(empty)


def config_snapshot(scraper_type: Column, delay: Column, retries: Column, name: Column) -> Column:
    """JSON of the settings a run started with; missing settings stay visible as null."""
    scraper = F.struct(
        scraper_type.alias("type"),
        delay.alias("request_delay"),
        retries.alias("max_retries"),
    )
    return F.to_json(
        F.struct(scraper.alias("scraper"), name.alias("category")),
        {"ignoreNullFields": "false"},
    )


def encoded(name: str) -> Column:
    """A product column in its stored form."""
    if name == "attributes":
        return F.coalesce(F.to_json(name), F.lit("{}")).alias(name)
    return iso_text(name).alias(name) if name == "scraped_at" else F.col(name)


def decoded(name: str, missing_time: Column | None = None, open_attributes: bool = False) -> Column:
    """A product column from its stored form."""
    if name == "attributes":
        return (A.from_text(name) if open_attributes else attributes_of(name)).alias(name)
    return iso_time(name, missing_time).alias(name) if name == "scraped_at" else F.col(name)


def to_stored(products: DataFrame) -> DataFrame:
    return products.select(*[encoded(c) for c in products.columns])


def from_stored(
    rows: DataFrame, missing_time: Column | None = None, open_attributes: bool = False
) -> DataFrame:
    return rows.select(*[decoded(c, missing_time, open_attributes) for c in rows.columns])


def with_attributes(products: DataFrame, open_attributes: bool) -> DataFrame:
    """Attributes in the form that a store keeps: given as fields, as an open object or as JSON text."""
    kind = products.schema["attributes"].dataType.typeName()
    if kind == "string":
        read = A.from_text("attributes") if open_attributes else attributes_of("attributes")
    elif (kind == "variant") == open_attributes:
        return products
    else:
        read = A.from_fields("attributes") if open_attributes else A.fields_of("attributes")
    return products.withColumn("attributes", read)
