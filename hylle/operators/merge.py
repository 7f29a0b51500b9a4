"""Merging a batch into stored rows, as relations (SK2-SK4, JN1-JN3, ST2, ST3, AG7).

Stored data is the large side. Joins are plain equi joins without hints: Spark
broadcasts the batch if its measured size allows, so stored rows are only scanned,
and otherwise sorts both sides and splits skewed partitions at run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hylle.operators.ranking import first_per_key, last_per_key


def keys_present(stored: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct batch keys that are already stored."""
    wanted = batch.select(*keys)
    return stored.select(*keys).join(wanted, keys, "left_semi").distinct()


def new_rows(stored: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Batch rows whose key is not stored yet."""
    return batch.join(keys_present(stored, batch, keys), keys, "left_anti")


def insert_absent(stored: DataFrame, batch: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """Rows to append: the first of each key in the batch, unless the key is stored."""
    others = [c for c in batch.columns if c not in (*keys, seq, "attributes")]
    return new_rows(stored, first_per_key(batch, keys, [seq, *others]), keys)


def upsert(stored: DataFrame, batch: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """Stored rows without those of the batch, plus the batch; the last of a key wins."""
    last = last_per_key(batch, keys, seq).select(*stored.columns)
    return stored.join(last.select(*keys), keys, "left_anti").unionByName(last)


def replace_or_append(
    stored: DataFrame, batch: DataFrame, keys: list[str], seq: str
) -> DataFrame:
    """Every stored row with a batch key becomes the batch row; new keys are added.

    A key stored n times stays n times. The batch has each key once, so one full
    outer join does both. Keys are compared as structs: missing parts are equal.
    """
    columns = stored.columns
    key = F.struct(*keys)
    last = last_per_key(batch, keys, seq)
    incoming = last.select(key.alias("_key"), F.struct(*columns).alias("_new"))
    rows = stored.select(key.alias("_key"), F.struct(*columns).alias("_old"))
    merged = rows.join(incoming, "_key", "full").select(F.coalesce("_new", "_old").alias("_row"))
    return merged.select("_row.*")


def write_summary(stored: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """(is_new, n): how many batch rows would be inserted and how many are stored."""
    present = keys_present(stored, batch, keys).withColumn("_stored", F.lit(True))
    flagged = batch.join(present, keys, "left").withColumn("is_new", F.col("_stored").isNull())
    return flagged.groupBy("is_new").agg(F.count("*").alias("n"))
