"""The categories relation (SC6): configured rows or one given URL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hylle.functions.urls import last_segment, with_base
from hylle.schema import CATEGORY_SCHEMA


def category_relation(configured: DataFrame, base_url: str | None) -> DataFrame:
    """Configured categories with the base URL in front of relative ones."""
    if not base_url:
        return configured.select("name", "url")
    return configured.select("name", with_base("url", base_url).alias("url"))


def category_of_url(spark: SparkSession, url: str) -> DataFrame:
    """One category named after the last path segment of its URL."""
    return categories_of_urls(spark.createDataFrame([(None, url)], CATEGORY_SCHEMA))


def categories_of_urls(given: DataFrame) -> DataFrame:
    """Categories named after the last path segment of their URLs."""
    return given.select(last_segment("url").alias("name"), "url")
