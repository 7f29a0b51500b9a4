"""Row filters and fills (PJ1, PJ2, PJ4-PJ7, PJ17, LM1, LM2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hylle import fixed_values as V
from hylle.functions import text as X


def fill_missing(column: Column | str, value: Column) -> Column:
    """The column where it has text, else the value."""
    return F.coalesce(X.filled(column), value)


def equal_where_given(df: DataFrame, **wanted: str | None) -> DataFrame:
    """Equality filters; a None or empty value means no filter on that column."""
    for column, value in wanted.items():
        if value:
            df = df.where(F.col(column) == value)
    return df


def by_id(df: DataFrame, product_id: str, *order: str | Column) -> DataFrame:
    """One product's first row: by day and time as far as there are such columns, or as stated.

    The digest of the whole row breaks ties, so equal times give the same row each time.
    """
    first = order or [c for c in ("scrape_date", "scraped_at", "seq") if c in df.columns]
    plain = {f.name: F.to_json(f.name) if f.dataType.typeName() == "variant" else F.col(f.name) for f in df.schema}
    digest = F.xxhash64(*[plain[c] for c in sorted(df.columns)])
    return df.where(F.col("product_id") == product_id).orderBy(*first, digest).limit(1)


def first_rows(df: DataFrame, limit: int | None, *order: str) -> DataFrame:
    """The first rows in a stated order; None keeps all, 0 keeps none."""
    return df if limit is None else df.orderBy(*order).limit(limit)


def named_like(categories: DataFrame, part: str | None) -> DataFrame:
    """Categories whose name holds the text, ignoring case."""
    if not part:
        return categories
    return categories.where(F.lower(F.coalesce("name", F.lit(""))).contains(part.lower()))


def with_url(categories: DataFrame) -> DataFrame:
    return categories.where(X.has_text("url"))


def without_skipped(links: DataFrame, names: tuple[str, ...] = V.SKIPPED_LABELS) -> DataFrame:
    """Drop links whose label is on the skip list; a missing label is kept."""
    return links.where(~F.coalesce(F.col("name").isin(*names), F.lit(False)))


def complete_records(records: DataFrame) -> DataFrame:
    """Drop extractions that found no name or no price."""
    return records.where(F.col("name").isNotNull() & F.col("price_text").isNotNull())


def category_run_id(run_id: Column | str, name: Column | str) -> Column:
    return F.concat_ws("_", X.col(run_id), X.col(name))


def stamp_run(products: DataFrame, run_id: Column, category: Column) -> DataFrame:
    """Set the run id; a product without category takes the one being read."""
    return products.withColumns(
        {"run_id": run_id, "category": fill_missing("category", category)}
    )


def category_part(category: Column | str = "category") -> Column:
    """Folder name of a category; rows without one share a folder."""
    return fill_missing(category, F.lit(V.UNCATEGORIZED))
