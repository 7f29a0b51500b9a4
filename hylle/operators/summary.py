"""Counts over products, links and runs, and what is different between lists (AG1-AG6, ST1).

All are partial aggregates: rows are summed up per task before anything is shuffled,
so a category or page that holds most rows costs one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hylle.functions import urls as U
from hylle.operators.filters import category_part


def per_category(products: DataFrame) -> DataFrame:
    """(category_part, n, n_ids): rows and distinct ids of each category's folder."""
    return (
        products.withColumn("category_part", category_part())
        .groupBy("category_part")
        .agg(F.count("*").alias("n"), F.countDistinct("product_id").alias("n_ids"))
    )


def category_totals(products: DataFrame) -> DataFrame:
    """(category_part, n) and the total, whose category is NULL."""
    parts = products.withColumn("category_part", category_part())
    return parts.rollup("category_part").agg(F.count("*").alias("n"))


def per_run(products: DataFrame) -> DataFrame:
    """(run_id, num_products)."""
    return products.groupBy("run_id").agg(F.count("*").alias("num_products"))


def per_page(links: DataFrame, category: str = "category") -> DataFrame:
    """Links and distinct products per page, per category and in all."""
    return (
        links.withColumn("_u", U.without_query("url"))
        .rollup(category, "page_no")
        .agg(F.count("*").alias("n_links"), F.countDistinct("_u").alias("n_products"))
    )


def distinct_urls(links: DataFrame) -> DataFrame:
    """URLs without their query, each once."""
    return links.select(U.without_query("url").alias("url")).distinct()


def any_per_category(products: DataFrame, test: Column, name: str) -> DataFrame:
    """(category_part, name, has_rows): whether any product of a category passes; NULL does not."""
    return (
        products.withColumn("category_part", category_part())
        .groupBy("category_part")
        .agg(
            F.bool_or(F.coalesce(test, F.lit(False))).alias(name),
            (F.count("*") > 0).alias("has_rows"),
        )
    )


def all_links(**lists: DataFrame) -> DataFrame:
    """(source, url): lists of URLs under each other, repeats kept."""
    result = None
    for source, frame in lists.items():
        part = frame.select(F.lit(source).alias("source"), "url")
        result = part if result is None else result.unionByName(part)
    return result
