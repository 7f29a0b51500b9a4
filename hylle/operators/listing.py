"""Listing pages: how far to read, what to keep (WN1-WN4, WN8, JN7, ST1).

Whether a page is read depends only on facts about pages, so the distinct page
numbers are compared first and one number per group is joined back: link rows are
never sorted by group, nor sent to all tasks however small they look beforehand.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hylle.functions import urls as U
from hylle.operators.ranking import first_per_key, top_per_group


def last_pages(
    pages: DataFrame,
    group: str,
    page_cap: int | None = None,
    has_rows: Column | None = None,
    is_last: Column | None = None,
) -> DataFrame:
    """(group, last_page): reading stops before the first page without rows, after
    a page marked last, and at the page cap if there is one.

    Page 1 and the page after each one with rows, less those that have rows themselves,
    are where the run from page 1 breaks: flags summed up per distinct page number and a
    minimum, so no group is sorted, no pages are joined and any number of pages is read.
    """
    number = F.col("page_no").cast("int")
    counted = number >= 1
    filled = counted if has_rows is None else counted & has_rows
    marks = [(F.lit(True), F.lit(1), False, False), (filled, number, True, False), (filled, number + 1, False, False)]
    if is_last is not None:
        marks.append((counted & is_last, number + 1, False, True))
    places = F.array(
        *[
            F.struct(F.when(holds, p).alias("_p"), F.lit(full).alias("_filled"), F.lit(end).alias("_end"))
            for holds, p, full, end in marks
        ]
    )
    flags = (
        pages.select(group, F.inline(places))
        .where(F.col("_p").isNotNull())
        .groupBy(group, "_p")
        .agg(F.max("_filled").alias("_filled"), F.max("_end").alias("_end"))
    )
    breaks = flags.where(~F.col("_filled") | F.col("_end"))
    stop = F.min("_p") - 1
    if page_cap is not None:
        stop = F.least(stop, F.lit(page_cap))
    return breaks.groupBy(group).agg(stop.alias("last_page"))


def read_pages(
    rows: DataFrame,
    group: str,
    page_cap: int | None = None,
    has_rows: Column | None = None,
    is_last: Column | None = None,
) -> DataFrame:
    """The rows on pages that sequential reading would reach."""
    limits = last_pages(rows, group, page_cap, has_rows, is_last)
    # sizes estimated ahead of an explode are far too small, and a broadcast once chosen
    # stays: by the hint neither side goes through the driver, and hot groups are split
    limits = limits.withColumnRenamed(group, "_group").hint("shuffle_hash")
    reached = (F.col(group) == F.col("_group")) & F.col("page_no").between(1, F.col("last_page"))
    return rows.join(limits, reached, "left_semi").select(group, *[c for c in rows.columns if c != group])


def capped(
    rows: DataFrame, group: list[str], order: list[str], max_products: int | None
) -> DataFrame:
    """The first max_products rows per group in page and position order."""
    if max_products is None:
        return rows
    return top_per_group(rows, group, order, max_products)


def first_occurrences(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per URL without its query, the first in order, within the given keys."""
    return first_per_key(
        rows.withColumn("_url", U.without_query("url")), [*keys, "_url"], list(order)
    ).drop("_url")


def with_main_category(links: DataFrame, main: DataFrame, on: list[str]) -> DataFrame:
    """Add the main category's own listing unless its URL is among the links."""
    return links.unionByName(main.join(links.select(*on), on, "left_anti"))
