"""Tables laid out by key: what a batch touches, what a lookup reads, what stays as it was."""

import datetime as dt
import json
import os
import uuid
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from hylle.operators import runs as R
from hylle.plans.ingest import record_end
from hylle.session import work_folder
from hylle.sources import keyed
from hylle.sources import tables as S
from test_tables import DAY1, names, products


def many(spark, n):
    return products(spark, *[(i, f"p{i}", "old", "m", DAY1) for i in range(n)])


def stored(spark, rows, buckets=16):
    target = S.Target("table", f"t_{uuid.uuid4().hex}", work_folder(spark, "t"), buckets)
    S.make_table(spark, rows.drop("seq"), target, "product_id")
    return target


def files_by_bucket(spark, target):
    """The files that a read of the table opens, with their times, per bucket."""
    found = {}
    rows = spark.table(target.location).select(keyed.BUCKET, F.input_file_name().alias("f")).distinct().collect()
    for r in rows:
        found.setdefault(r[0], set()).add((r.f, os.path.getmtime(urlparse(r.f).path)))
    return found


@pytest.mark.parametrize("replace", [True, False])
def test_untouched_buckets_keep_their_files(spark, replace):
    target = stored(spark, many(spark, 400))
    before = files_by_bucket(spark, target)
    assert len(before) == 16
    batch = products(spark, (1, "p7", "new", "m", DAY1), (2, "q1", "new", "m", DAY1))
    layout = keyed.layout_of(spark, target.location)
    touched = keyed.touched(batch, layout)
    S.save(spark, batch, target, replace_existing=replace, seq="seq")
    after = files_by_bucket(spark, target)
    assert 1 <= len(touched) <= 2
    for bucket in before:
        if bucket not in touched:
            assert after[bucket] == before[bucket]
    got = dict(names(S.load(spark, target)))
    assert got["p7"] == ("new" if replace else "old") and got["q1"] == "new" and len(got) == 401


def test_appends_add_files_only(spark):
    target = stored(spark, many(spark, 200))
    before = files_by_bucket(spark, target)
    S.save(spark, products(spark, *[(i, f"n{i}", "new", "m", DAY1) for i in range(50)]), target, replace_existing=False, seq="seq")
    after = files_by_bucket(spark, target)
    assert all(before[b] <= after[b] for b in before)
    assert S.load(spark, target).count() == 250


def test_every_row_of_an_id_is_replaced_and_null_ids_are_kept(spark):
    rows = products(spark, (1, "a", "old", "m", DAY1), (2, "a", "old", "m", DAY1), (3, None, "none", "m", DAY1), (4, "b", "old", "m", DAY1))
    target = stored(spark, rows, buckets=3)
    S.save(spark, products(spark, (1, "a", "x", "m", DAY1), (2, "a", "y", "m", DAY1)), target, replace_existing=True, seq="seq")
    got = S.load(spark, target).select("product_id", "name").collect()
    assert sorted(got, key=str) == sorted([("a", "y"), ("b", "old"), (None, "none")], key=str)


def test_emptied_buckets_and_clearing(spark):
    target = stored(spark, many(spark, 40), buckets=4)
    layout = keyed.layout_of(spark, target.location)
    left = S.scan(spark, target).where(layout.bucket(F.col("product_id")) != 2)
    count = left.count()
    keyed.replace(spark, left.limit(0), target.location, target.folder, layout, [2])
    assert S.scan(spark, target).count() == count
    S.save(spark, many(spark, 40), target, replace_existing=False, seq="seq")
    assert S.scan(spark, target).count() == 40
    S.clear(spark, target)
    assert S.scan(spark, target).count() == 0 and S.scan(spark, target).columns == S.PRODUCT_COLUMNS
    S.save(spark, many(spark, 5), target, replace_existing=True, seq="seq")
    assert S.scan(spark, target).count() == 5


def test_layout_is_kept_with_the_table(spark):
    target = stored(spark, many(spark, 10), buckets=5)
    other = S.Target("table", target.location, target.folder, buckets=64)
    S.save(spark, many(spark, 20), other, replace_existing=True, seq="seq")
    assert keyed.layout_of(spark, target.location) == keyed.Layout("product_id", 5)
    assert S.load(spark, other).count() == 20
    plain = f"t_{uuid.uuid4().hex}"
    S.publish(spark, spark.range(3), plain, target.folder)
    assert keyed.layout_of(spark, plain) is None


def scanned_rows(spark, df):
    """Rows that the scans of a query gave, and the files they read, by its own metrics."""
    df.collect()
    total, parts = 0, 0
    todo = [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
            continue
        if "QueryStage" in node.nodeName():
            todo.append(node.plan())
            continue
        if node.metrics().contains("numFiles"):
            total += node.metrics().apply("numOutputRows").value()
            parts += node.metrics().apply("numFiles").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return total, parts


def test_lookups_read_less_than_is_stored(spark):
    n = 60_000
    rows = many_rows(spark, n)
    target = stored(spark, rows, buckets=4)
    found = S.find(spark, target, "p777")
    read, files = scanned_rows(spark, found)
    assert [r.product_id for r in found.collect()] == ["p777"]
    assert files == 1 and read < n / 4
    none = S.find(spark, target, "absent")
    assert none.count() == 0
    few = products(spark, (1, "p5", "x", "m", DAY1), (2, "zzz", "x", "m", DAY1)).select("product_id")
    ids = S.stored_ids(spark, target, few)
    read, files = scanned_rows(spark, ids)
    assert [r.product_id for r in ids.collect()] == ["p5"]
    assert files <= 2 and read <= n / 4 * 2.2


def many_rows(spark, n):
    """As ``many``, made by Spark."""
    one = products(spark, (0, "p", "old", "m", DAY1))
    return spark.range(n).select("id").crossJoin(F.broadcast(one)).select(
        *[F.concat(F.lit("p"), F.col("id").cast("string")).alias(c) if c == "product_id" else F.col(c) for c in one.columns]
    )


def test_files_carry_bloom_filters_and_order(spark):
    import pyarrow.parquet as pq

    target = stored(spark, many_rows(spark, 5_000), buckets=2)
    for name in {f for own in files_by_bucket(spark, target).values() for f, _ in own}:
        path = urlparse(name).path
        ids = pq.read_table(path, columns=["product_id"]).column(0).to_pylist()
        assert ids == sorted(ids)
        group = pq.ParquetFile(path).metadata.row_group(0)
        places = {group.column(i).path_in_schema: group.column(i) for i in range(group.num_columns)}
        assert places["product_id"].statistics.has_min_max
    plan = json.dumps(keyed.Layout("product_id", 2).options())
    assert "bloom.filter" in plan


def test_ends_of_runs_rewrite_their_buckets(spark):
    start = dt.datetime(2024, 1, 1, 8)
    rows = R.run_rows(spark.createDataFrame([(f"2024010{i % 9}_{i:012d}_c", "running", start) for i in range(200)], "run_id string, status string, start_time timestamp"))
    target = S.Target("table", f"r_{uuid.uuid4().hex}", work_folder(spark, "r"))
    S.make_table(spark, rows, target, "run_id")
    before = files_by_bucket(spark, target)
    outcomes = spark.createDataFrame(
        [(1, "20240105_000000000005_c", "completed", 4, None, start + dt.timedelta(seconds=90)), (2, "19990101_new", "failed", 0, "why", start)],
        "seq long, run_id string, status string, num_products long, error_message string, end_time timestamp",
    )
    record_end(spark, target, outcomes)
    after = files_by_bucket(spark, target)
    assert sum(after.get(b) != before.get(b) for b in set(before) | set(after)) <= 2
    done = {r.run_id: r for r in S.scan(spark, target).where("status <> 'running'").collect()}
    assert set(done) == {"20240105_000000000005_c", "19990101_new"} and S.scan(spark, target).count() == 201
    assert done["20240105_000000000005_c"].duration_seconds == 90 and done["19990101_new"].error_message == "why"
