"""Order-free comparison of a Spark result with a SQL result."""

from __future__ import annotations

import math


def canonical(value):
    if value is None:
        return None
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    if isinstance(value, bool):
        return value
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return value


def spark_rows(df):
    order = sorted(df.columns)
    return sorted(
        (tuple(canonical(r[c]) for c in order) for r in df.collect()), key=repr
    ), order


def duck_rows(con, sql):
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    order = sorted(names)
    places = [names.index(c) for c in order]
    rows = result.fetchall()
    return sorted((tuple(canonical(r[i]) for i in places) for r in rows), key=repr), order


def assert_same(df, con, sql):
    left, left_cols = spark_rows(df)
    right, right_cols = duck_rows(con, sql)
    assert left_cols == right_cols
    assert len(left) == len(right), (len(left), len(right))
    for a, b in zip(left, right):
        assert a == b, (left_cols, a, b)
