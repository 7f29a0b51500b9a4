"""Link resolution and character references against Python's own rules."""

import html
import random
from html.entities import html5
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from hylle.functions import urls as U

BASES = ["https://shop.example", "https://shop.example/", "https://shop.example/no/a/b", "https://shop.example/no/a/b/", "http://x.example/a/../b/./c"]


@pytest.mark.parametrize("base", BASES)
def test_links_resolve_as_urljoin_does(spark, base):
    rng = random.Random(base)
    parts = ["..", ".", "", "a", "b c", "ø", "..a", ".b.", "x;p", "..;q"]
    links = ["", "../", "./", "a/../../b", "/../x", "/a/./b/..", "/..", "..", ".", "a//b", "//cdn.example/../i", "https://y.example/a/../b",
             "mailto:x@y", "#f", "?q=1", "a?x=../y", "/a/..?x#y", "a#..//b", "../?q", " ../x", "a\n/../b", "x?", "x#", "/", "//h", "a/b;c/../d"]
    for _ in range(400):
        path = "/".join(rng.choice(parts) for _ in range(rng.randint(1, 7)))
        links.append(rng.choice(["", "/"]) + path + rng.choice(["", "", "?q=1", "#f", "?a=../b#c"]))
    links = [x for x in links if not x.startswith("//") or x.startswith(("//cdn", "//h"))]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(links)], "i int, u string")
    got = {r.i: r.r for r in df.select("i", U.resolve("u", base).alias("r")).collect()}
    wrong = [(x, got[i], urljoin(base, x)) for i, x in enumerate(links) if got[i] != urljoin(base, x)]
    assert not wrong, wrong[:8]


def test_missing_link_stays_missing(spark):
    row = spark.createDataFrame([(None,)], "u string").select(U.resolve("u", BASES[2]).alias("r"), U.unescaped("u").alias("x")).first()
    assert (row.r, row.x) == (None, None)


def test_references_are_read_as_html_unescape_does(spark):
    rng = random.Random(3)
    names = sorted(html5)
    cases = ["", "&", "&&", "&;", "&#;", "&#x;", "&#xZ", "&amp;lt;", "&amp;amp;", "&ampx", "&notit;", "&notin;", "&copy2024", "&#228;r", "&#xE4;", "&#XE4 x",
             "&#0;", "&#13;", "&#128;", "&#129;", "&#x9f;", "&#11;", "&#127;", "&#55296;", "&#1114111;", "&#1114112;", "&#99999999999999999999;", "&#x110000;",
             "&#xFFFFFFFFFFFFFFFFFFFFF;", "&#x0000000000000041;", "&#64976;", "&#65534;", "&#x1F600;", "&frac12", "&unknown;", "&ø;", "a & b", "&\t&amp", "&lt&gt", "x&quot;y"]
    cases += [f"<{'&' + n}|&{n[: rng.randint(1, len(n))]}{rng.choice(['', ';', 'z', ' '])}" for n in rng.sample(names, 600)]
    cases += ["".join(rng.choice(["&", "amp", ";", "#", "x", "41", "lt", " ", "é", "not"]) for _ in range(rng.randint(1, 9))) for _ in range(600)]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(cases)], "i int, t string")
    got = {r.i: r.u for r in df.select("i", U.unescaped("t").alias("u")).collect()}
    wrong = [(x, got[i], html.unescape(x)) for i, x in enumerate(cases) if got[i] != html.unescape(x)]
    assert not wrong, wrong[:8]


def test_all_names(spark):
    df = spark.createDataFrame([(n,) for n in html5], "n string").select("n", U.unescaped(F.concat(F.lit("&"), "n")).alias("u"))
    assert {r.n: r.u for r in df.collect()} == {n: html.unescape("&" + n) for n in html5}
