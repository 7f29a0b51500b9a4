"""Connected components of a link table, by alternating star joins.

Each round moves every node's links to the smallest neighbour: first those of its
larger neighbours, then its own. The number of rounds grows with the logarithm of
the longest chain. Only minima are grouped, so a hub of many links is summed up
ahead of the shuffle; the joins back to the links are plain inner joins that the
engine can split at hot keys. Links are written between rounds and never collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hylle.llm.common import staged


def _to_smallest(directed: DataFrame, least: DataFrame) -> DataFrame:
    return (
        directed.join(least, "a")
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .where("a <> b")
    )


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node that has a link to another; root is the least node reachable.

    Links may repeat, stand in either direction or join a node with itself; rows
    with a null end are passed over. No links give no rows.
    """
    links = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b")
    links = staged(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state = None
    while True:
        # larger neighbours take the smallest node around as their neighbour
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = _to_smallest(both.where("b > a"), least)
        # the rest of a node's smaller neighbours, and the node, do the same
        large = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        large = staged(large, "links")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = _to_smallest(large, least).union(least.select("a", F.col("m").alias("b")))
        links = staged(small.distinct(), "links")
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if tuple(now) == state:
            break
        state = tuple(now)
    nodes = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.union(links.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
