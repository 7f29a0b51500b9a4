"""Catalogue tables laid out by a hash of their key, so that a batch costs what it touches.

Rows stand in ``buckets`` partitions by the hash of one key column, sorted by key in each
file, with Parquet bloom filters on the key. A batch reads and rewrites only the buckets
of its keys; a lookup reads one bucket, and there only the pages whose bounds hold the key.

New files go to a folder of their own. A bucket then changes by pointing its partition at
the new files, so a reader sees each bucket as it was before or after, never half written,
and a retry after a lost executor finds the old files where they were.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKET = "key_bucket"
KEY_PROPERTY, COUNT_PROPERTY = "hylle.key", "hylle.buckets"


@dataclass(frozen=True)
class Layout:
    """The key column of a table and its number of buckets."""

    key: str
    buckets: int

    def bucket(self, value: Column) -> Column:
        return F.pmod(F.xxhash64(value.cast("string")), F.lit(self.buckets)).cast("int")

    def placed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn(BUCKET, self.bucket(F.col(self.key)))

    def options(self) -> dict[str, str]:
        return {f"parquet.bloom.filter.enabled#{self.key}": "true"}


def layout_of(spark: SparkSession, table: str) -> Layout | None:
    """How a table is laid out; None if it was made otherwise or is not there."""
    if not spark.catalog.tableExists(table):
        return None
    found = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    if KEY_PROPERTY not in found:
        return None
    return Layout(found[KEY_PROPERTY], int(found[COUNT_PROPERTY]))


def sorted_files(rows: DataFrame, layout: Layout) -> DataFrame:
    """Rows with their bucket, gathered by bucket (a large one in several tasks) and sorted by key."""
    return layout.placed(rows).hint("rebalance", F.col(BUCKET)).sortWithinPartitions(BUCKET, layout.key)


def create(spark: SparkSession, rows: DataFrame, table: str, folder: str, layout: Layout) -> None:
    path = f"{folder.rstrip('/')}/{table}-{uuid.uuid4().hex}"
    writer = sorted_files(rows, layout).write.format("parquet").partitionBy(BUCKET).options(**layout.options())
    writer.option("path", path).saveAsTable(table)
    spark.sql(
        f"ALTER TABLE {table} SET TBLPROPERTIES ('{KEY_PROPERTY}'='{layout.key}', '{COUNT_PROPERTY}'='{layout.buckets}')"
    )


def rows_of(spark: SparkSession, table: str, buckets: list[int] | None = None) -> DataFrame:
    """The table's rows without the bucket column; of these buckets only, if given."""
    rows = spark.table(table)
    if buckets is not None:
        rows = rows.where(F.col(BUCKET).isin(buckets))
    return rows.drop(BUCKET)


def touched(keys: DataFrame, layout: Layout, key: str | None = None) -> list[int]:
    """The buckets of these keys: at most as many numbers as there are buckets."""
    bucket = layout.bucket(F.col(key or layout.key)).alias(BUCKET)
    return sorted(r[0] for r in keys.select(bucket).distinct().collect())


def replace(
    spark: SparkSession, rows: DataFrame, table: str, folder: str, layout: Layout, buckets: list[int]
) -> None:
    """Let these buckets hold ``rows``, all of which belong to them. Other buckets' files stay."""
    path = f"{folder.rstrip('/')}/{table}-{uuid.uuid4().hex}"
    sorted_files(rows, layout).write.partitionBy(BUCKET).options(**layout.options()).parquet(path)
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    filled = {s.getPath().getName() for s in files.listStatus(root) if s.isDirectory()}
    present = {r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    added = []
    for bucket in buckets:
        name, spec = f"{BUCKET}={bucket}", f"PARTITION ({BUCKET}={bucket})"
        if name in present:
            # a bucket without rows gets an empty folder: its former one may hold old files
            files.mkdirs(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}"))
            spark.sql(f"ALTER TABLE {table} {spec} SET LOCATION '{path}/{name}'")
        elif name in filled:
            added.append(f"{spec} LOCATION '{path}/{name}'")
    if added:
        spark.sql(f"ALTER TABLE {table} ADD {' '.join(added)}")
    spark.catalog.refreshTable(table)


def append(spark: SparkSession, rows: DataFrame, table: str, layout: Layout) -> None:
    """Add files to the rows' buckets; nothing stored is read or written again."""
    columns = [c for c in spark.table(table).columns if c != BUCKET]
    sorted_files(rows.select(*columns), layout).write.insertInto(table)


def with_key(spark: SparkSession, table: str, layout: Layout, value: str) -> DataFrame:
    """The rows of one key, from the one bucket that can hold it."""
    rows = spark.table(table).where(F.col(BUCKET) == layout.bucket(F.lit(value)))
    return rows.where(F.col(layout.key) == value).drop(BUCKET)
