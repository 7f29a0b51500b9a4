"""Open attributes and CSV headers: what is written comes back, whatever its keys and their order."""

import json
import os
import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from hylle.functions import attributes as A
from hylle.plans.enrich import enrich
from hylle.profiles import STORE1
from hylle.schema import ATTRIBUTE_FIELDS
from hylle.session import work_folder
from hylle.sources import tables as S
from test_tables import DAY1, files, names, products, table

JSON = {"organic": True, "origin": {"country": "NO", "farms": [1, {"x": None}]}, "note": None, "egg_quantity": 6, "Ø%": "é"}


def open_products(spark):
    return products(spark, (1, "a", "x", "m", DAY1), (2, "b", "y", "m", DAY1)).withColumn(
        "attributes", F.when(F.col("seq") == 1, F.lit(json.dumps(JSON)))
    )


@pytest.mark.parametrize("kind", ["parquet", "csv", "table"])
def test_open_attributes_survive(spark, kind):
    target = replace(table(spark) if kind == "table" else files(spark, kind), open_attributes=True)
    S.save(spark, open_products(spark), target, replace_existing=False, seq="seq")
    S.save(spark, open_products(spark).where("seq = 2"), target, replace_existing=True, seq="seq")
    rows = S.load(spark, target).select("product_id", F.to_json("attributes").alias("j")).collect()
    got = {r.product_id: json.loads(r.j) for r in rows}
    assert got == {"a": JSON, "b": {}}
    one = S.find(spark, target, "a").select(A.fields_of("attributes").alias("f")).first().f
    assert one.organic is True and one.egg_quantity == 6 and one.flavor is None
    S.clear(spark, target)
    assert S.load(spark, target).count() == 0


def test_closed_store_takes_the_known_fields(spark):
    target = files(spark, "parquet")
    S.save(spark, open_products(spark), target, replace_existing=False, seq="seq")
    row = S.load(spark, target).where("product_id = 'a'").first()
    assert row.attributes.organic is True and row.attributes.egg_quantity == 6
    assert set(row.attributes.asDict()) == {n for n, _ in ATTRIBUTE_FIELDS}


def test_merging_is_dict_update(spark):
    rng = random.Random(1)
    value = lambda: rng.choice([None, 1, "x", True, {"p": 1}, [1, 2], 2.5])
    pairs = [[{rng.choice("abcde"): value() for _ in range(rng.randint(0, 4))} for _ in range(2)] for _ in range(80)]
    df = spark.createDataFrame([(i, json.dumps(a), json.dumps(b)) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    out = df.select("i", F.to_json(A.merged(A.from_text("a"), A.from_text("b"))).alias("m")).collect()
    assert {r.i: json.loads(r.m) for r in out} == {i: {**a, **b} for i, (a, b) in enumerate(pairs)}
    none = spark.createDataFrame([(None, "[1]")], "a string, b string").select(F.to_json(A.merged(A.from_text("a"), A.from_text("b"))).alias("m"))
    assert none.first().m == "{}"


def test_enrichment_keeps_foreign_keys(spark):
    df = open_products(spark).withColumn("info", F.lit("6 stk, økologisk, Prior")).withColumn("attributes", A.from_text("attributes"))
    got = json.loads(enrich(df, STORE1).where("seq = 1").select(F.to_json("attributes").alias("j")).first().j)
    assert got["origin"] == JSON["origin"] and got["Ø%"] == "é" and got["organic"] is True and got["vegan"] is False


def rewrite_header(path, order, extra=None):
    """Write a CSV file's columns in another order, one of them left out or a new one put first."""
    import csv

    with open(path, newline="", encoding="utf-8") as f:
        rows = list(csv.reader(f, doublequote=True))
    at = [rows[0].index(c) for c in order]
    with open(path, "w", newline="", encoding="utf-8") as f:
        out = csv.writer(f)
        for i, r in enumerate(rows):
            out.writerow(([extra if i == 0 else "z"] if extra else []) + [r[k] for k in at])


def test_csv_columns_go_by_their_headers(spark):
    target = S.Target("csv", work_folder(spark, "csv"))
    want = []
    for n, (shuffle, extra) in enumerate([(False, None), (True, None), (True, "colour")]):
        S.append_files(products(spark, (n, f"p{n}", f"name, \"{n}\"", "m", DAY1)), target)
        want.append((f"p{n}", f'name, "{n}"'))
        new = max((os.path.join(d, f) for d, _, fs in os.walk(target.location) for f in fs if f.endswith(".csv")), key=os.path.getmtime)
        if shuffle:
            order = [c for c in S.PRODUCT_COLUMNS if c != ("brand" if extra else "")]
            random.Random(n).shuffle(order)
            os.utime(new)
            rewrite_header(new, order, extra)
            for crc in (os.path.join(os.path.dirname(new), f".{os.path.basename(new)}.crc"),):
                open(crc, "a").close()
                os.truncate(crc, 0)
    spark._jvm.org.apache.hadoop.fs.FileSystem.closeAll()
    assert len(S.files_by_header(spark, target.location)) == 3
    rows = S.load(spark, target)
    assert names(rows) == want
    assert {r.category for r in rows.collect()} == {"m"} and rows.where("price = 0.0").count() == 3
    assert names(S.load(spark, target, category="m")) == want and S.load(spark, target, category="n").count() == 0


def test_one_header_is_one_read(spark):
    target = S.Target("csv", work_folder(spark, "csv"))
    S.append_files(products(spark, (1, "a", "x", "m", DAY1), (2, "b", "y", None, DAY1)), target)
    assert "Union" not in S.read_files(spark, target)._jdf.queryExecution().optimizedPlan().toString()
