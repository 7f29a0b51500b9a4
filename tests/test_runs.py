"""Run ids and run history on hand-made rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from hylle.fixtures import relation
from hylle.operators import filters as P
from hylle.operators import runs as R
from hylle.plans.ingest import ingest
from hylle.profiles import STORE1
from hylle.sources import tables as S
from hylle.sources.categories import category_of_url
from hylle.suite.tables import table_target



def now():
    return F.lit("2024-03-01T08:00:00Z").cast("timestamp")


def stored(spark, *ids):
    return R.run_rows(spark.createDataFrame([(i,) for i in ids], "run_id string"))


def asked(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "run_id string")


def matches(df):
    return {r.run_id: r.matched_run_id for r in df.collect()}


def test_matching_order(spark):
    runs = stored(
        spark, "20240101_aa_egg", "20240101_ab_ost", "20240102_cc_egg", "x_20240103_dd", "abc-d_ost", "20240104"
    )
    got = matches(
        R.match_run_ids(
            asked(
                spark, "20240102_cc_egg", "20240101_zz", "20240101", "2024010", "20240103_dd", "c_d_ost",
                "ost", "_ost", "20240104_x", "19990101_zz", None, "20240109_dd",
            ),
            runs,
        )
    )
    assert got == {
        "20240102_cc_egg": "20240102_cc_egg",  # exact
        "20240101_zz": "20240101_aa_egg",  # same base, least id
        "20240101": "20240101_aa_egg",
        "20240103_dd": "x_20240103_dd",  # ending
        "c_d_ost": "abc-d_ost",  # an underscore stands for any character
        "_ost": "20240101_ab_ost",
        "20240104_x": "20240104",
    }


def test_matching_against_brute_force(spark):
    import itertools
    import re

    alphabet = ["20240101", "20240101a", "2024", "ab", "x", ""]
    ids = ["_".join(p) for n in (1, 2, 3) for p in itertools.product(alphabet, repeat=n)]
    runs, wanted = [i for i in ids[::3] if i], [i for i in ids if i]

    def expected(w):
        if w in runs:
            return w
        base = w.split("_")[0]
        if len(base) >= 8 and (hit := [r for r in runs if r.startswith(base)]):
            return min(hit)
        like = re.compile(".*" + re.escape(w).replace("_", "."), re.S)
        if "_" in w and (hit := [r for r in runs if like.fullmatch(r)]):
            return min(hit)
        return None

    got = matches(R.match_run_ids(asked(spark, *wanted), stored(spark, *runs)))
    assert got == {w: m for w in wanted if (m := expected(w)) is not None}


def test_ending_runs(spark):
    runs = stored(spark, "20240101_aa_egg", "20240102_bb").withColumns(
        {"status": F.lit("running"), "start_time": F.lit("2024-03-01T07:59:00.5Z").cast("timestamp")}
    )
    outcomes = spark.createDataFrame(
        [
            (1, "20240101_aa_egg", "failed", None, "no disk"), (2, "20240101_aa_egg", "completed", 7, ""),
            (3, "20240105_new", "completed", 3, None), (4, "short_id", "completed", 3, None),
            (5, "20240109", "completed", 3, None),
        ],
        "seq int, run_id string, status string, num_products int, error_message string",
    ).withColumn("end_time", now())
    rows = {r.run_id: r for r in R.end_runs(runs, outcomes).collect()}
    assert set(rows) == {"20240101_aa_egg", "20240102_bb", "20240105_new"}
    done = rows["20240101_aa_egg"]
    assert (done.status, done.num_products, done.error_message, done.duration_seconds) == (
        "completed", 7, "no disk", 59,
    )
    assert rows["20240102_bb"].status == "running" and rows["20240102_bb"].end_time is None
    new = rows["20240105_new"]
    assert (new.scraper_type, new.status, new.num_products, new.duration_seconds) == ("unknown", "completed", 3, 0)


def test_run_ids(spark):
    df = spark.range(1).select(
        R.seeded_run_id(F.lit("seed")).alias("seeded"),
        R.seeded_run_id(F.lit("")).alias("random"),
        R.dated_run_id(F.lit("x"), F.lit("2024-03-01").cast("date")).alias("dated"),
        R.dated_run_id(F.lit("x"), None).alias("bare"),
    ).first()
    assert df.seeded == "fe4c0f30aa35"
    assert len(df.random) == 12 and df.random != df.seeded
    assert (df.dated, df.bare) == ("20240301_x", "x")


def test_durations_are_cut_toward_zero(spark):
    a, b = dt.datetime(2024, 1, 1, 0, 0, 0), dt.datetime(2024, 1, 1, 0, 0, 1, 900000)
    df = spark.createDataFrame([(a, b), (b, a)], "s timestamp, e timestamp")
    assert [r[0] for r in df.select(R.seconds_between("s", "e")).collect()] == [1, -1]


def test_one_given_category(spark):
    row = category_of_url(spark, "https://shop.example/no/categories/60-drikke/").first()
    assert (row.name, row.url) == ("60-drikke", "https://shop.example/no/categories/60-drikke/")


def test_category_filter(spark):
    cats = spark.createDataFrame([("Meieri",), ("brus",), (None,)], "name string")
    assert [r.name for r in P.named_like(cats, "MEI").collect()] == ["Meieri"]
    assert P.named_like(cats, "").count() == 3


def test_failed_ingest_is_recorded(spark, sf_dir):
    products, runs = table_target(spark), table_target(spark, "runs")

    def crawl(categories, max_products):
        raise RuntimeError("no pages")

    with pytest.raises(RuntimeError):
        ingest(spark, relation(spark, sf_dir, "categories"), crawl, STORE1, "20240301_ab", products, runs, now=now())
    rows = S.scan(spark, runs).collect()
    assert rows and {(r.status, r.num_products, r.error_message) for r in rows} == {("failed", 0, "no pages")}
