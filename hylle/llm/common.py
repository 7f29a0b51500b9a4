"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hylle.session import work_folder

KEY = ("_k1", "_k2")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """The frame written to the shared folder and read back.

    Later stages read files, so a lost executor never makes them run the work
    that led here again.
    """
    path = work_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def row_key(id_col: str, text_col: str) -> dict[str, Column]:
    """Two columns that name a row by id and text.

    Rows that agree in both get the same result anyway, so repeated rows and
    null ids need no surrogate number, which a recomputed scan could deal anew.
    """
    return {
        KEY[0]: F.xxhash64(F.lit("id"), F.col(id_col).cast("string")),
        KEY[1]: F.xxhash64(F.lit("text"), F.col(text_col), F.length(text_col)),
    }


def carried(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``row`` (all columns as one struct), ``_text`` and the row key.

    Whatever the columns are called, none can clash with one that an operator adds.
    """
    return docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
        F.col(text_col).alias("_text"),
        *(c.alias(k) for k, c in row_key(id_col, text_col).items()),
    )


def without_keys(docs: DataFrame, keys: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``docs`` whose key is not among ``keys``, all columns as they were."""
    kept = carried(docs, id_col, text_col).join(keys.select(*KEY).distinct(), list(KEY), "left_anti")
    return kept.select("row.*")


def hash128(col: Column) -> tuple[Column, Column]:
    """Two 64-bit hashes; the literal comes first and so acts as a seed."""
    return F.xxhash64(F.lit(1), col), F.xxhash64(F.lit(2), col)


def fits(df: DataFrame, most_rows: int) -> bool:
    """Whether a frame has at most so many rows; reads no more than needed to tell."""
    return df.limit(most_rows + 1).count() <= most_rows
