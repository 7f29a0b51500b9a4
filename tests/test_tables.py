"""Writes and merges: what is kept, replaced and added."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from hylle.operators import merge as M
from hylle.plans.enrich import with_product_columns
from hylle.schema import ATTRIBUTE_FIELDS, PRODUCT_COLUMNS
from hylle.session import work_folder
from hylle.sources import tables as S

DAY1, DAY2 = dt.datetime(2024, 1, 1, 8), dt.datetime(2024, 1, 2, 8)


def products(spark, *rows):
    """Rows of (seq, product_id, name, category, scraped_at)."""
    df = spark.createDataFrame(
        [(*r, "1 l, 'x'\n\"y\"", "") for r in rows],
        "seq int, product_id string, name string, category string, scraped_at timestamp, info string, brand string",
    )
    return with_product_columns(df, keep=("seq",))


def table(spark, df=None):
    target = S.Target("table", f"t_{uuid.uuid4().hex}", work_folder(spark, "t"))
    if df is not None:
        S.publish(spark, df.drop("seq"), target.location, target.folder)
    return target


def files(spark, kind):
    return S.Target(kind, work_folder(spark, kind))


def names(df):
    return sorted((r.product_id, r.name) for r in df.collect())


@pytest.mark.parametrize("kind", ["parquet", "csv"])
def test_files_keep_every_value(spark, kind):
    df = products(spark, (1, "1", "  Øl, \"x\" ", None, DAY1), (2, "02", "", "melk & ost/1", DAY2))
    known = {"organic": F.lit(True), "size_quantity": F.lit(1.5)}
    fields = [known.get(n, F.lit(None)).cast(t).alias(n) for n, t in ATTRIBUTE_FIELDS]
    df = df.withColumn("attributes", F.struct(*fields))
    target = files(spark, kind)
    S.save(spark, df, target, replace_existing=False, seq="seq")
    got = S.load(spark, target).orderBy("product_id").collect()
    want = df.select(*PRODUCT_COLUMNS).orderBy("product_id").collect()
    assert got == want
    assert [r.category_part for r in S.read_files(spark, target).orderBy("product_id").collect()] == [
        "melk & ost/1", "uncategorized",
    ]


@pytest.mark.parametrize("kind", ["parquet", "csv"])
def test_replace_is_per_category_and_day(spark, kind):
    target = files(spark, kind)
    first = products(
        spark, (1, "a", "old", "m", DAY1), (2, "a", "old", "m", DAY2), (3, "a", "old", "n", DAY1),
        (4, "b", "old", "m", DAY1), (5, "a", "old", "m", DAY1),
    )
    S.save(spark, first, target, replace_existing=True, seq="seq")
    batch = products(spark, (1, "a", "new1", "m", DAY1), (2, "a", "new2", "m", DAY1), (3, "c", "new", "m", DAY1))
    S.save(spark, batch, target, replace_existing=True, seq="seq")
    assert names(S.load(spark, target)) == [
        ("a", "new2"), ("a", "new2"), ("a", "old"), ("a", "old"), ("b", "old"), ("c", "new"),
    ]
    assert names(S.load(spark, target, category="n")) == [("a", "old")]


def test_replace_reads_only_days_of_the_batch(spark):
    target = files(spark, "parquet")
    days = [dt.datetime(2024, 1, d, 8) for d in range(1, 9)]
    S.save(spark, products(spark, *[(i, f"p{i}", "old", "m", d) for i, d in enumerate(days)]), target, replace_existing=False, seq="seq")
    batch = S.with_parts(products(spark, (1, "p2", "new", "m", days[2])))
    touched = S.touched_rows(S.read_files(spark, target), batch)
    assert [r.product_id for r in touched.collect()] == ["p2"]
    text = touched._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in text.splitlines() if "FileScan" in line)
    filters = scan[scan.index("PartitionFilters:") :]
    assert "scrape_date" in filters and "subquery" in filters.lower()


def test_rows_without_day_are_replaced_too(spark):
    target = files(spark, "parquet")
    S.save(spark, products(spark, (1, "a", "old", "m", None), (2, "b", "old", "m", None)), target, replace_existing=True, seq="seq")
    S.save(spark, products(spark, (1, "a", "new", "m", None), (2, "c", "new", "m", DAY1)), target, replace_existing=True, seq="seq")
    assert names(S.load(spark, target)) == [("a", "new"), ("b", "old"), ("c", "new")]


def test_upsert_twice_is_upsert_once(spark):
    target = table(spark, products(spark, (1, "a", "old", "m", DAY1), (2, "b", "old", "m", DAY1)))
    batch = products(spark, (1, "a", "x", "m", DAY2), (2, "a", "y", "m", DAY2), (3, "c", "z", None, DAY2))
    want = [("a", "y"), ("b", "old"), ("c", "z")]
    for _ in range(2):
        S.save(spark, batch, target, replace_existing=True, seq="seq")
        assert names(S.load(spark, target)) == want


def test_insert_never_changes_a_stored_row(spark):
    target = table(spark, products(spark, (1, "a", "old", "m", DAY1)))
    batch = products(spark, (1, "a", "x", "m", DAY2), (2, "c", "first", "m", DAY2), (3, "c", "second", "m", DAY2))
    for _ in range(2):
        S.save(spark, batch, target, replace_existing=False, seq="seq")
        assert names(S.load(spark, target)) == [("a", "old"), ("c", "first")]


def test_table_is_created_by_the_first_save(spark):
    target = table(spark)
    S.save(spark, products(spark, (1, "a", "x", "m", DAY1)), target, replace_existing=False, seq="seq")
    assert names(S.load(spark, target)) == [("a", "x")]


def test_empty_filters_and_limits(spark):
    target = table(spark, products(spark, *[(i, f"p{i}", "x", "m", DAY1) for i in range(5)]))
    assert S.load(spark, target, category="", run_id=None).count() == 5
    assert S.load(spark, target, limit=0).count() == 0
    assert [r.product_id for r in S.load(spark, target, limit=2).collect()] == ["p0", "p1"]
    assert S.load(spark, target, category="none").count() == 0


def test_category_filter_is_equality(spark):
    target = files(spark, "parquet")
    S.save(spark, products(spark, (1, "a", "x", "egg", DAY1), (2, "b", "x", "egg_x", DAY1)), target, False, "seq")
    assert names(S.load(spark, target, category="egg")) == [("a", "x")]


def test_clear_keeps_the_target_readable(spark):
    for target in (files(spark, "parquet"), files(spark, "csv"), table(spark)):
        S.save(spark, products(spark, (1, "a", "x", "m", DAY1)), target, False, "seq")
        S.clear(spark, target)
        assert S.load(spark, target).count() == 0


def test_unknown_kind_is_an_error(spark):
    target = S.Target("ftp", "x")
    with pytest.raises(ValueError):
        S.load(spark, target)
    with pytest.raises(ValueError):
        S.save(spark, products(spark), target, False, "seq")


def test_merge_keeps_multiplicity(spark):
    stored = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1)], "k string, v int")
    batch = spark.createDataFrame([("a", 2, 1), ("a", 3, 2), ("c", 4, 3)], "k string, v int, seq int")
    got = M.replace_or_append(stored, batch, ["k"], "seq")
    assert sorted(map(tuple, got.collect())) == [("a", 3), ("a", 3), ("b", 1), ("c", 4)]
    counts = {r.is_new: r.n for r in M.write_summary(stored, batch, ["k"]).collect()}
    assert counts == {True: 1, False: 2}


def test_a_category_reads_only_its_folders(spark):
    target = files(spark, "parquet")
    S.save(spark, products(spark, (1, "a", "x", "m", DAY1), (2, "b", "x", "n", DAY1)), target, False, "seq")
    plan = S.load(spark, target, category="m").select("name")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(category_part" in plan
    assert "ReadSchema: struct<name:string>" in plan


def test_filters_reach_the_scan(spark):
    target = table(spark, products(spark, (1, "a", "x", "m", DAY1)))
    plan = S.load(spark, target, category="m").select("name")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(category), EqualTo(category,m)]" in plan
    assert "ReadSchema: struct<name:string,category:string>" in plan


def test_rows_without_category_have_their_own_folder(spark):
    target = files(spark, "parquet")
    S.save(spark, products(spark, (1, "a", "x", None, DAY1), (2, "b", "x", "", DAY1), (3, "c", "x", "m", DAY1)), target, False, "seq")
    got = S.load(spark, target, category="uncategorized").orderBy("product_id").collect()
    assert [(r.product_id, r.category) for r in got] == [("a", None), ("b", "")]


def test_random_ids_are_fixed_before_saving(spark):
    df = spark.createDataFrame([(1, "x", "i"), (2, "y", "i")], "seq int, name string, info string")
    target = table(spark)
    for n in (2, 4):
        S.save(spark, with_product_columns(df, keep=("seq",)), target, replace_existing=True, seq="seq")
        assert S.load(spark, target).select("product_id").distinct().count() == n
