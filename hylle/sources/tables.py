"""Product tables: files split by category and day, and catalogue tables.

Files (``parquet`` or ``csv``) are appended to, or replaced per category and day.
Product and run tables are laid out by a hash of their key (see ``keyed``): a batch reads
and writes only the buckets of its keys. A catalogue table without a key is replaced as a
whole: the new state goes to its own folder and the table's location is switched.
"""

from __future__ import annotations

import csv
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hylle.operators import filters as P
from hylle.operators import merge as M
from hylle.schema import OPEN_PRODUCT_SCHEMA, PRODUCT_COLUMNS, PRODUCT_SCHEMA, RUN_SCHEMA, STORED_PRODUCT_SCHEMA
from hylle.session import materialised, work_folder
from hylle.sources import keyed
from hylle.sources.codec import from_stored, to_stored, with_attributes

PARTS = ["category_part", "scrape_date"]
PART_FIELDS = [
    T.StructField("category_part", T.StringType()),
    T.StructField("scrape_date", T.DateType()),
]
CSV_OPTIONS = {
    "header": "true", "escape": '"', "multiLine": "true",
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
    "nullValue": "\\N",  # keeps NULL and the empty text apart
}


@dataclass(frozen=True)
class Target:
    """Where products live: kind ``parquet``, ``csv`` (a folder) or ``table`` (a name).

    ``folder`` is where a table keeps its versions, ``buckets`` how many parts a new
    one is laid out in: more for larger tables, so that a batch touches few of them.
    """

    kind: str
    location: str
    folder: str | None = None
    buckets: int = 16
    # whether attributes may have any keys (VARIANT) or only the known fields
    open_attributes: bool = False

    @property
    def schema(self) -> T.StructType:
        return OPEN_PRODUCT_SCHEMA if self.open_attributes else PRODUCT_SCHEMA


def with_parts(products: DataFrame) -> DataFrame:
    return products.withColumns(
        {"category_part": P.category_part(), "scrape_date": F.to_date("scraped_at")}
    )


def read_files(spark: SparkSession, target: Target) -> DataFrame:
    """Product columns plus the partition columns, which prune folders when filtered.

    Columns of CSV files go by the names in each file's header, in any order; columns
    that are no product columns are left out, and absent ones are NULL.
    """
    if target.kind == "parquet":
        return spark.read.schema(T.StructType([*target.schema.fields, *PART_FIELDS])).parquet(target.location)
    stored = read_csv(spark, target.location)
    return from_stored(stored, open_attributes=target.open_attributes)


def read_csv(spark: SparkSession, location: str) -> DataFrame:
    """Stored product rows; files with one header are read together."""
    known = {f.name: f for f in STORED_PRODUCT_SCHEMA.fields}
    names = [*known, *(f.name for f in PART_FIELDS)]
    reader = spark.read.options(**CSV_OPTIONS)
    by_header = files_by_header(spark, location)
    if all(list(header) == list(known) for header in by_header):
        return reader.schema(T.StructType([*known.values(), *PART_FIELDS])).csv(location)
    whole = None
    for header, files in sorted(by_header.items()):
        fields = [known.get(name, T.StructField(f"_other{i}", T.StringType())) for i, name in enumerate(header)]
        rows = reader.option("basePath", location).schema(T.StructType([*fields, *PART_FIELDS])).csv(files)
        absent = {n: F.lit(None).cast(f.dataType) for n, f in known.items() if n not in header}
        rows = rows.withColumns(absent).select(names) if absent else rows.select(names)
        whole = rows if whole is None else whole.unionByName(rows)
    return whole


def files_by_header(spark: SparkSession, location: str) -> dict[tuple[str, ...], list[str]]:
    """The CSV files below a folder by the names in their first line.

    One short read per file, many at a time: like the listing of a folder, its work goes
    by the number of files and not by what they hold.
    """
    conf = spark._jsc.hadoopConfiguration()
    root = spark._jvm.org.apache.hadoop.fs.Path(location)
    files = root.getFileSystem(conf)
    codecs = spark._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)
    found, listed = [], files.listFiles(root, True)
    base = files.makeQualified(root).toString()
    while listed.hasNext():
        path = listed.next().getPath()
        if not any(part.startswith(("_", ".")) for part in path.toString()[len(base) :].split("/")):
            found.append(path)

    def header(path) -> tuple[str, ...]:
        stream = files.open(path)
        codec = codecs.getCodec(path)
        opened = stream if codec is None else codec.createInputStream(stream)
        lines = spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(opened, "UTF-8"))
        try:
            line = lines.readLine()
        finally:
            lines.close()
        return tuple(next(csv.reader([line.removeprefix("\ufeff")]), ())) if line else ()

    by_header: dict[tuple[str, ...], list[str]] = {}
    with ThreadPoolExecutor(16) as pool:
        for path, names in zip(found, pool.map(header, found)):
            if names:
                by_header.setdefault(names, []).append(path.toString())
    return by_header


def write_files(rows: DataFrame, target: Target, mode: str, dynamic: bool = False) -> None:
    """Write rows that carry the partition columns.

    Rebalancing gathers a folder's rows into files of a good size and splits the
    folders that are large, so no task writes a whole hot category.
    """
    if target.kind == "csv":
        rows = to_stored(rows)
    writer = (
        rows.hint("rebalance", *[F.col(c) for c in PARTS]).write.partitionBy(*PARTS).mode(mode)
    )
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if target.kind == "csv":
        writer.options(**CSV_OPTIONS).csv(target.location)
    else:
        writer.parquet(target.location)


def append_files(products: DataFrame, target: Target) -> None:
    rows = with_attributes(products.select(*PRODUCT_COLUMNS), target.open_attributes)
    write_files(with_parts(rows), target, "append")


def replace_files(spark: SparkSession, products: DataFrame, target: Target, seq: str) -> None:
    """Replace or append by id inside each category and day that the batch touches.

    Only folders of the batch's days are read and only touched ones rewritten. The
    merged rows are first written to the shared work folder: a lost executor or a
    retry then never reads a folder that is being replaced.
    """
    batch = with_parts(products.select(*PRODUCT_COLUMNS, seq))
    merged = M.replace_or_append(
        touched_rows(read_files(spark, target), batch), batch, [*PARTS, "product_id"], seq
    )
    staged = Target("parquet", work_folder(spark, "staged"), open_attributes=target.open_attributes)
    write_files(merged, staged, "errorifexists")
    write_files(read_files(spark, staged), target, "overwrite", dynamic=True)


def touched_rows(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """Stored rows in the folders that the batch touches, rows without a day included.

    The batch's first and last day are scalar subqueries, which prune the folders of
    all other days before any file is listed for reading.
    """
    day = F.col("scrape_date")
    first, last = batch.agg(F.min("scrape_date")).scalar(), batch.agg(F.max("scrape_date")).scalar()
    near = stored.where(day.isNull() | day.between(first, last))
    folders = batch.select(F.struct(*PARTS).alias("_folder")).distinct()
    return near.join(folders, F.struct(*PARTS) == F.col("_folder"), "left_semi")


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def publish(
    spark: SparkSession, rows: DataFrame, table: str, folder: str, key: str | None = None, buckets: int = Target.buckets
) -> None:
    """Write the new state of a table to its own folder, then point the table at it.

    ``key`` lays a new table out by that column; an existing one keeps its layout.
    """
    layout = keyed.layout_of(spark, table)
    if layout is not None:
        keyed.replace(spark, rows, table, folder, layout, list(range(layout.buckets)))
    elif key is not None and not spark.catalog.tableExists(table):
        keyed.create(spark, rows, table, folder, keyed.Layout(key, buckets))
    else:
        path = f"{folder.rstrip('/')}/{table}-{uuid.uuid4().hex}"
        rows.write.parquet(path)
        if spark.catalog.tableExists(table):
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
            spark.catalog.refreshTable(table)
        else:
            spark.catalog.createTable(table, path, "parquet")


def append_table(spark: SparkSession, rows: DataFrame, table: str) -> None:
    layout = keyed.layout_of(spark, table)
    if layout is not None:
        keyed.append(spark, rows, table, layout)
    else:
        rows.select(*spark.table(table).columns).write.insertInto(table)


def near(spark: SparkSession, table: str, keys: DataFrame, key: str) -> tuple[DataFrame, list[int] | None]:
    """The stored rows among which rows with these keys can be, and their buckets (None: the whole table)."""
    layout = keyed.layout_of(spark, table)
    buckets = keyed.touched(keys, layout) if layout is not None and layout.key == key else None
    return keyed.rows_of(spark, table, buckets), buckets


def put(spark: SparkSession, rows: DataFrame, table: str, folder: str, buckets: list[int] | None) -> None:
    """Store what became of the rows that ``near`` gave."""
    if buckets is None:
        publish(spark, rows, table, folder)
    else:
        keyed.replace(spark, rows, table, folder, keyed.layout_of(spark, table), buckets)


def stored_ids(spark: SparkSession, target: Target, batch: DataFrame) -> DataFrame:
    """The batch's product ids that a table holds already, looked up in their buckets alone."""
    stored, _ = near(spark, target.location, batch, "product_id")
    return M.keys_present(stored, batch, ["product_id"])


def find(spark: SparkSession, target: Target, product_id: str) -> DataFrame:
    """One product's first row; of a table laid out by key, one bucket is read."""
    layout = keyed.layout_of(spark, target.location) if target.kind == "table" else None
    if layout is None or layout.key != "product_id":
        return P.by_id(scan(spark, target), product_id)
    return P.by_id(keyed.with_key(spark, target.location, layout, product_id), product_id)


def save(
    spark: SparkSession, products: DataFrame, target: Target, replace_existing: bool, seq: str
) -> None:
    """Store a batch: files append or replace per day, tables insert or upsert.

    A batch is read more than once, so one that might differ from reading to reading
    (random ids, the current time) is written to the work folder first.
    """
    if target.kind not in ("parquet", "csv", "table"):
        raise ValueError(f"unknown storage kind: {target.kind}")
    if not products._jdf.queryExecution().analyzed().deterministic():
        products = materialised(spark, products.select(*PRODUCT_COLUMNS, seq), "batch")
    products = with_attributes(products, target.open_attributes)
    if target.kind in ("parquet", "csv"):
        if replace_existing and has_files(spark, target):
            replace_files(spark, products, target, seq)
        else:
            append_files(products, target)
    else:
        batch = products.select(*PRODUCT_COLUMNS, seq)
        if not spark.catalog.tableExists(target.location):
            make_table(spark, empty(spark, target.schema), target, "product_id")
        stored, buckets = near(spark, target.location, batch, "product_id")
        if replace_existing:
            merged = M.upsert(stored, batch, ["product_id"], seq)
            put(spark, merged, target.location, target.folder, buckets)
        else:
            fresh = M.insert_absent(stored, batch, ["product_id"], seq).drop(seq)
            append_table(spark, fresh, target.location)


def make_table(spark: SparkSession, rows: DataFrame, target: Target, key: str) -> None:
    publish(spark, rows, target.location, target.folder, key, target.buckets)


def has_files(spark: SparkSession, target: Target) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(target.location)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def scan(spark: SparkSession, target: Target) -> DataFrame:
    if target.kind == "table":
        return keyed.rows_of(spark, target.location)
    if target.kind in ("parquet", "csv"):
        return read_files(spark, target)
    raise ValueError(f"unknown storage kind: {target.kind}")


def load(
    spark: SparkSession,
    target: Target,
    category: str | None = None,
    subcategory: str | None = None,
    run_id: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Products with optional filters; a category reads only its own folders."""
    by_category = "category" if target.kind == "table" else "category_part"
    rows = P.equal_where_given(
        scan(spark, target),
        **{by_category: category, "subcategory": subcategory, "run_id": run_id},
    )
    return P.first_rows(rows.select(*PRODUCT_COLUMNS), limit, "product_id")


def clear(spark: SparkSession, target: Target) -> None:
    """Leave the target readable and without rows."""
    if target.kind == "table":
        publish(spark, empty(spark, scan(spark, target).schema), target.location, target.folder)
    else:
        rows = empty(spark, T.StructType([*target.schema.fields, *PART_FIELDS]))
        write_files(rows, target, "overwrite")


def clear_tables(
    spark: SparkSession, prices: Target, products: Target, runs: Target
) -> dict[str, bool]:
    """Clear child, parent and run tables in that order; says which were cleared.

    Runs that start while clearing goes on are kept: only ids listed at the start go.
    """
    listed = Target("parquet", work_folder(spark, "listed"))
    spark.table(runs.location).select("run_id").write.parquet(listed.location)

    def clear_listed_runs():
        ids = spark.read.schema("run_id string").parquet(listed.location)
        left = scan(spark, runs).join(ids, "run_id", "left_anti")
        publish(spark, left, runs.location, runs.folder)

    steps = {
        "product_prices": lambda: clear(spark, prices),
        "products": lambda: clear(spark, products),
        "scraping_runs": clear_listed_runs,
    }
    done = {}
    for name, step in steps.items():
        try:
            step()
            done[name] = True
        except AnalysisException:  # no such table: the others are still cleared
            done[name] = False
    return done


def empty_runs(spark: SparkSession) -> DataFrame:
    return empty(spark, RUN_SCHEMA)
