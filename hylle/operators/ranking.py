"""First, last and top-n rows per key.

A key may hold a large share of all rows, so nothing here sends whole groups to one
task. A rank filter of ``<= n`` becomes a per-partition limit ahead of the shuffle,
and n per group is ranked by parts of the group first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Input partitions whose first rows are ranked together before the group as a whole.
FAN_IN = 128


def first_per_key(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """One row per key: the first in the given order."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def last_per_key(df: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """One row per key: the last in sequence."""
    others = [F.col(c) for c in df.columns if c not in (*keys, seq, "attributes")]
    return first_per_key(df, keys, [F.col(seq).desc(), *others])


def top_per_group(df: DataFrame, group: list[str], order: list[str], n: int) -> DataFrame:
    """The first n rows of each group.

    A group is ranked in three rounds: among the rows that one input partition holds,
    among those left of ``FAN_IN`` partitions, and as a whole. A row among the first
    n of its group is so in each of its parts, so the result is exact, and whatever
    the group's size a task gets at most one partition's rows, then n per partition
    of its ``FAN_IN``, then n per part. Ties fall as in any ranking: which of equal
    rows stay is not said.
    """
    ranked = df.withColumn("_part", F.spark_partition_id())
    for part in (F.col("_part"), F.floor(F.col("_part") / FAN_IN), None):
        keys = group if part is None else [*group, part]
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        ranked = ranked.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")
    return ranked.drop("_part")
