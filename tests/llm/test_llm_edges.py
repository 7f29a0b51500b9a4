"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

import corpus_pipeline
from hylle.llm import (
    decontaminate,
    embedding_dedup,
    language_id,
    license_scan,
    line_dedup,
    ngram_join,
    packing,
    sanitise,
    substrings,
    toxicity,
)
from hylle.llm.common import row_key
from hylle.llm.queries import tokenizer_path

# names that the operators use themselves, beside those of documents
CLASHING = ("row", "_k1", "_text", "words", "spans", "cls", "id", "kept")
SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        *(T.StructField(c, T.StringType()) for c in CLASHING),
    ]
)


def documents(spark, rows):
    full = [(i, t, lang, None, len(t) if t is not None else None, *CLASHING) for i, t, lang in rows]
    return spark.createDataFrame(full, SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    words = " ".join(f"word{i % 97}x{i % 13}" for i in range(6_000))
    rows = [
        (1, None, "en"),
        (2, "", "en"),
        (3, " \t\n", None),
        (4, words, "en"),
        (4, words, "en"),
        (5, words.replace("word5x5", "other"), None),
        (None, "short text", "en"),
        (None, None, None),
        (6, "a" * 30_000, "en"),
        (7, "short text", "en"),
        (8, "\n".join(["same line"] * 40), "en"),
        (9, "zażółć gęślą jaźń 漢字 \U0001f600", "pl"),
    ]
    return documents(spark, rows).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return documents(spark, [])


def test_line_dedup(odd, empty):
    out = line_dedup.with_kept_text(odd, line_dedup.line_bitmaps(odd, min_docs=2))
    rows = out.select("row.doc_id", "n_lines", "n_dropped", "kept").collect()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r[1:])
    assert len(rows) == odd.count()
    assert by[1] == [(1, 0, "")] and by[2] == [(1, 0, "")] and by[3] == [(2, 0, " \t\n")]
    assert by[4] == [(1, 1, "")] * 2  # repeated rows are two documents
    assert sorted(by[None]) == [(1, 0, ""), (1, 1, "")] and by[7] == [(1, 1, "")]
    assert by[8] == [(40, 0, "\n".join(["same line"] * 40))]  # one document holds it
    first = line_dedup.with_kept_text(odd, line_dedup.line_bitmaps(odd, min_docs=1, keep="first"))
    kept = {(r.doc_id, r.kept) for r in first.select("row.doc_id", "kept").collect()}
    assert (8, "same line") in kept
    assert sum(k == "short text" for _, k in kept) == 1
    assert line_dedup.with_kept_text(empty, line_dedup.line_bitmaps(empty)).count() == 0


def test_line_dedup_long(spark):
    lines = [f"own {i}" if i % 3 else "shared" for i in range(5_000)]
    docs = documents(spark, [(i, "\n".join(f"{x} {i}" if x != "shared" else x for x in lines), "en") for i in range(3)])
    out = line_dedup.with_kept_text(docs, line_dedup.line_bitmaps(docs, min_docs=3)).select("row.doc_id", "n_dropped", "kept")
    for r in out.collect():
        assert r.n_dropped == 1_667
        assert r.kept == "\n".join(f"{x} {r.doc_id}" for x in lines if x != "shared")


def test_hot_lines_over_many_ranges(spark):
    rows = [(i, f"hot\nown {i}\n{'rare' if i < 3 else 'pair ' + str(i // 2)}\nhot", None) for i in range(900)]
    places = line_dedup.line_places(documents(spark, rows)).cache()
    found = line_dedup.repeated_lines(places, min_docs=2)
    by = {(r._h1, r._h2): (r._docs, r._first) for r in found.collect()}
    firsts, docs = {}, {}
    for r in places.collect():
        key, place = (r._h1, r._h2), (r._k1, r._k2, r._at)
        firsts[key] = min(firsts.get(key, place), place)
        docs.setdefault(key, set()).add((r._k1, r._k2))
    assert by == {k: (len(docs[k]), firsts[k]) for k in docs if len(docs[k]) > 1}
    assert 900 in {n for n, _ in by.values()}
    # the sorted ranges are read on without another shuffle or sort until their sums are carried on
    plan = line_dedup.repeated_lines(places, min_docs=2)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange rangepartitioning") == 1 and plan.count("Exchange hashpartitioning") == 1
    assert plan.index("Exchange hashpartitioning") < plan.index("Window [") < plan.index("Exchange rangepartitioning")
    first = line_dedup.line_bitmaps(documents(spark, rows), min_docs=2, keep="first")
    out = line_dedup.with_kept_text(documents(spark, rows), first).select("kept").collect()
    assert sum(r.kept.split("\n").count("hot") for r in out) == 1
    assert sum("rare" in r.kept for r in out) == 1


def test_ngram_join(odd, empty):
    rows = ngram_join.join(odd).select("doc_id", "n_links", "component_id", "kept").collect()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append((r.n_links, r.component_id))
    assert by[4] == [(2, 4)] * 2 and by[5] == [(2, 4)]
    assert by[1] == [(0, 1)] and by[2] == [(0, 2)] and by[3] == [(0, 3)]
    assert by[7] == [(1, 7)] and sorted(by[None], key=str) == [(0, None), (1, 7)]
    kept = ngram_join.one_per_group(odd, ngram_join.join(odd))
    assert kept.columns == odd.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=lambda x: (x is None, x))
    assert ids == [1, 2, 3, 4, 6, 7, 8, 9, None]
    assert ngram_join.join(empty).count() == 0


def test_prefix_depth():
    depth = ngram_join.prefix_depth(0.8, 0.9999)
    assert 1 - (1 - 0.8**depth) ** ngram_join.TREES >= 0.9999
    assert 1 - (1 - 0.8 ** (depth + 1)) ** ngram_join.TREES < 0.9999


def test_shingles_are_the_words(spark):
    texts = ["a b c d e f", "A  b\tc\nd e f", "a b c", "", None, "a b c d e", " x ", "é b c d e f g"]
    sets = ngram_join.Shingler().sets(texts)
    assert [len(s) for s in sets] == [2, 2, 1, 0, 0, 1, 1, 3]
    assert np.array_equal(sets[0], sets[1]) and sets[5][0] in sets[0]


def test_decontaminate(spark, odd, empty):
    item = " ".join(f"tok{i}" for i in range(20))
    worn = " ".join("other" if i in (4, 13) else f"tok{i}" for i in range(20))
    bench = spark.createDataFrame([(1, item), (2, None), (3, "too short"), (4, "")], "item_id long, text string")
    docs = documents(spark, [(1, f"before {item} after", None), (2, worn, None), (2, worn, None), (3, "tok1 tok2 tok3", None), (4, None, None), (None, item, None)])
    found = decontaminate.overlaps(docs, bench)
    got = sorted(((r.doc_id, r._item, r._shift, r._score, r._matched) for r in found.collect()), key=str)
    # repeated rows share one row of the result
    assert got == [(1, 1, 1, 20, 20), (2, 1, 0, 16, 18), (None, 1, 0, 20, 20)]
    left = decontaminate.without_overlaps(docs, found)
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == [3, 4]
    assert decontaminate.overlaps(odd, bench).count() == 0
    assert decontaminate.overlaps(empty, bench).count() == 0
    assert decontaminate.overlaps(docs, bench.limit(0)).count() == 0


def test_packing(odd, empty):
    cut = packing.pieces(odd, tokenizer_path())
    rows = packing.pack(cut, group=4).collect()
    check_packing(rows, 2048)
    docs = {}
    for r in rows:
        docs.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    assert sum(len(p) for p in docs.values()) == cut.count()
    assert {r.doc_tokens for r in rows if r.doc_id in (1, 2)} == {1}
    assert packing.pack(packing.pieces(empty, tokenizer_path())).count() == 0


def check_packing(rows, size):
    bins = {}
    for r in rows:
        assert 0 < r.length <= size and 0 <= r.start and r.start + r.length <= r.doc_tokens
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in bins.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= size


def test_first_fit_is_first_fit():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 7, 300):
        lengths = rng.integers(1, 101, n)
        bins, offsets = packing.first_fit_decreasing(lengths, 100)
        room, want = [], np.zeros(n, int)
        for i in np.argsort(-lengths, kind="stable"):
            b = next((k for k, free in enumerate(room) if free >= lengths[i]), len(room))
            if b == len(room):
                room.append(100)
            room[b] -= lengths[i]
            want[i] = b
        assert np.array_equal(bins, want)


def test_encoder_equals_tokenizer():
    import random

    encoder = packing.Encoder(tokenizer_path())
    rng = random.Random(5)
    letters = "abcDEF'sdtrelvm ΣςσİIıßéÉȩ́ \n\t\x0b\x1c\x85\xa0.,;:!?-_*#<|endoftext|>0123९Ⅷ½字漢ー😀ͅﬁ"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(3_000)]
    texts += ["", "x" * 500, "<|endoftext|> x<|startoftext|>.", "it's. IT'S!"]
    for text, ids in zip(texts, encoder.encode(texts)):
        want = encoder.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want, text


def test_encoder_splits_marks_off_known_words():
    encoder = packing.Encoder(tokenizer_path())
    known = "thretian hareathesh véile ſtraße x1 don't <|endoftext|>"
    encoder.encode([known])
    asked = []
    whole = encoder.tokenizer

    class Counted:
        def encode_batch_fast(self, texts, **kw):
            asked.extend(texts)
            return whole.encode_batch_fast(texts, **kw)

    encoder.tokenizer = Counted()
    text = "Thretian&&& hareathesh.), véile### x1;; thretian.'s don't'. a|> <|endoftext|>. x1<|endoftext|> thretian&&&'"
    (ids,) = encoder.encode([text])
    assert np.frombuffer(ids, "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids
    assert {"&&&", ".),", "###", ";;"} <= set(asked)
    assert not {"thretian&&&", "hareathesh.),", "véile###", "x1;;"} & set(asked)


def test_language_is_scored_in_small_slices(monkeypatch):
    grams, sizes = language_id.grams, []
    texts = ["ab " * 9_000, None, "", "x" * 250_000, "y" * 900_001, *["cd " * 100] * 3_000]
    found, _ = grams(["ab cd " * 50])
    found, n = np.unique(found, return_counts=True)
    models = {"a": language_id.KneserNey(language_id.levels_of(found, n))}

    def seen(parts):
        sizes.append(parts)
        return grams(parts)

    monkeypatch.setattr(language_id, "grams", seen)
    got = language_id.Scorer(models).total_bits(texts)
    assert all(sum(map(len, p[:-1])) < 100_000 for p in sizes)
    # parts of a long text are as before
    assert [p for ps in sizes for p in ps] == [
        (t or "")[at : at + 400_000] for t in texts for at in range(0, max(len(t or ""), 1), 400_000)
    ]
    monkeypatch.setattr(language_id, "SCORED_AT_ONCE", language_id.CHUNK)
    for own, whole in zip(got, language_id.Scorer(models).total_bits(texts)):
        assert np.array_equal(own, whole)


def test_language(odd, empty, spark):
    rows = language_id.identify(odd).select("doc_id", "lang_pred", "score", "rejected").collect()
    assert len(rows) == odd.count()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    for i in (1, 2, 3):
        assert by[i][0].lang_pred == "und" and by[i][0].score == 0 and by[i][0].rejected
    assert all(0 <= r.score <= 1 for r in rows)
    assert {r.lang_pred for r in rows} <= {"en", "pl", "und"}
    assert language_id.identify(empty).count() == 0
    none = language_id.identify(odd.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in none.collect()} == {"und"}


def test_substrings(odd, empty, spark):
    out = substrings.without_spans(odd, substrings.repeated_spans(odd)).select(
        "row.doc_id", "n_bytes", "n_removed", "n_spans", "kept"
    )
    rows = out.collect()
    assert len(rows) == odd.count()
    for r in rows:
        if r.doc_id == 4:
            assert (r.n_removed, r.n_spans, bytes(r.kept)) == (r.n_bytes, 1, b"")
        if r.doc_id == 6:
            assert (r.n_bytes, r.n_removed, r.n_spans) == (30_000, 30_000, 1)
        if r.doc_id in (1, 2, 3, 7, 9):
            assert (r.n_removed, r.n_spans) == (0, 0)
    assert substrings.without_spans(empty, substrings.repeated_spans(empty)).count() == 0


def test_toxicity(spark, odd, empty):
    labels = spark.createDataFrame(
        [(i, 1, 1 if i % 2 else 0) for i in range(120)] + [(None, 1, 1), (3, 1, None)], "doc_id long, quality int, toxic int"
    )
    docs = documents(spark, [(i, f"plain words here {i}" + " nasty" * (3 * (i % 2)), "en") for i in range(120)])
    rows = toxicity.scores(docs, labels).collect()
    assert len(rows) == 120 and all(0 <= r.score <= 1 for r in rows)
    assert all((r.score >= 0.5) == bool(r.doc_id % 2) for r in rows)
    rows = toxicity.scores(odd, labels.limit(0)).collect()
    assert len(rows) == odd.count() and {r.score for r in rows} == {0.0}
    assert toxicity.scores(empty, labels).count() == 0
    assert toxicity.scores(odd, labels).count() == odd.count()


def test_all_telling_words_count(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    telling = [f"x{a}{b}zq" for a in letters for b in letters][:400]
    # each word in ten of 400 toxic texts, beside many copies of one more toxic text
    toxic = [" ".join(telling[(i + 40 * k) % 400] for k in range(10)) + f" text {i}" for i in range(400)]
    rows = [(t, 1) for t in [*toxic, *["copied text of one kind"] * 5_000]] + [(f"one two three four five six seven eight nine ten eleven twelve plain text number {i}", 0) for i in range(1_600)]
    found = toxicity.lexicon(spark.createDataFrame(rows, "text string, toxic int"))
    assert sorted(found) == [w[:3] for w in telling]
    known = [(i, t, x) for i, (t, x) in enumerate(rows) if t != "copied text of one kind"]
    docs = documents(spark, [(i, t, None) for i, t, _ in known])
    labels = spark.createDataFrame([(i, x) for i, _, x in known], "doc_id long, toxic int")
    scored = toxicity.scores(docs, labels).collect()
    assert all(r.score < 0.5 for r in scored if r.doc_id >= 400)
    assert sum(r.score >= 0.5 for r in scored if r.doc_id < 400) >= 0.95 * 400


def test_licenses(spark, odd, empty):
    mit = license_scan.SENTENCES
    wrapped = "# Copyright X\n" + mit["bsd-conditions"].replace(" are ", "\n# are ") + ":\n1. " + mit["bsd-source"] + ".\n2. " + mit["bsd-binary"] + ".\n"
    docs = documents(
        spark,
        [
            (1, "Intro.\nReleased under the\nMIT License. And more", None),
            (2, "SPDX-License-Identifier: Apache-2.0\ncode", None),
            (3, "All rights reserved", None),
            (3, "All rights reserved", None),
            (4, f"{mit['mit-warranty']}. Nothing else.", None),
            (5, None, None),
            (6, wrapped, None),
        ],
    )
    got = sorted((r.doc_id, r.licenses, r.n_unmatched) for r in license_scan.with_licenses(docs).collect())
    assert got[:5] == [(1, "MIT", 0), (2, "Apache-2.0", 0), (3, "All-rights-reserved", 0), (3, "All-rights-reserved", 0), (4, "", 1)]
    assert license_scan.with_licenses(odd).count() == 0 and license_scan.with_licenses(empty).count() == 0


MIT = """MIT License

Copyright (c) 2020 Some One

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
BSD = """Copyright (c) 2020, Some One

Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."""
APACHE = """Copyright 2020 Some One

Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""


def test_whole_license_texts_at_any_width(spark):
    import textwrap

    rows, want = [], {}
    for name, text in (("MIT", MIT), ("BSD-3-Clause", BSD), ("Apache-2.0", APACHE)):
        for width in (24, 40, 60, 72, 78, 80, 100, 10_000):
            for mark in ("", "# "):
                lines = [x for part in text.split("\n\n") for x in [*textwrap.wrap(part, width), ""]]
                rows.append((len(rows), "\n".join(mark + x for x in lines), None))
                want[len(rows) - 1] = name
    docs = documents(spark, rows)
    got = {r.doc_id: (r.licenses, r.n_unmatched) for r in license_scan.with_licenses(docs).collect()}
    assert got == {i: (name, 0) for i, name in want.items()}


def test_known_sentences_have_keywords():
    for sentence in license_scan.known_sentences():
        assert any(w in sentence for w in license_scan.KEYWORDS), sentence


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def base_spans(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {
                "email": True,
                "ip": kind != "ip" or all(int(x) <= 255 for x in m[0].split(".")),
                "card": 16 <= len(digits) <= 19 and luhn(digits),
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            if ok:
                out.append((kind, m.start(), m.end()))
    return out


def test_base_spans(spark, odd, empty):
    import random

    rng = random.Random(2)
    letters = "a1b2.@%+- ()é😀4\n0"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 80))) for _ in range(400)]
    texts += [
        None,
        "",
        "x@a.b%c@d.e, 1.2.3.4.5.6.7.8 300.1.1.1 001.002.003.004",
        "4111 1111 1111 1111 and 4111-1111-1111-1112 +47 (22) 33.44-55 +1((((",
        "a" * 50_000,
        "1" * 20_000,
        "a@" * 5_000,
        "9.9.9.9 " * 3_000,
    ]
    docs = documents(spark, [(i, t, None) for i, t in enumerate(texts)])
    keyed = docs.select(F.col("doc_id").alias("_k1"), F.lit(0).alias("_k2"), F.coalesce("text", F.lit("")).alias("_text"))
    got = {}
    for r in sanitise.base_spans(keyed).select("_k1", "kind", "start", "end").collect():
        got.setdefault(r._k1, []).append((r.kind, r.start, r.end))
    for i, text in enumerate(texts):
        assert sorted(got.get(i, [])) == sorted(base_spans(text or "")), text
    assert sanitise.find_spans(odd).count() == 0 and sanitise.find_spans(empty).count() == 0


def test_disclosing_terms(spark):
    rows = [(i, f"{'abcdefghij'[i]} note: the zanzibarian wrote to boss@corp.com from place{i}, the end", None) for i in range(6)]
    rows += [(10 + i, f"the common note text number {i}, wrote from home to the end", None) for i in range(40)]
    rows += [(60, "a zanzibarian stands alone here", None)]
    docs = documents(spark, rows)
    found = sanitise.find_spans(docs)
    out = {r.doc_id: r.sanitised for r in sanitise.sanitised(docs, found).select("row.doc_id", "sanitised").collect()}
    assert "zanzibarian" not in out[60] and "alone" in out[60]
    assert "boss@" not in out[0] and "[email]" in out[0] and " the end" in out[0]
    assert out[10] == rows[6][1]


def test_terms_of_rare_entities(spark):
    common = "the common note text was wrote from home to the end and of it"
    rows = [(i, f"{common} number {i % 7}", None) for i in range(60)]
    rows += [(100, f"{common} zebulonia jane.roe@corp.com {common}", None)]  # once in the corpus
    rows += [(110 + i, f"{common} quillfeather{' ' * (i + 1)}+47 22 33 44 55 {common}", None) for i in range(2)]
    rows += [(120 + i, f"{common} copyline ann@corp.com {common}", None) for i in range(50)]  # copies
    rows += [(200, f"{common} widespread bob@corp.com {common}", None)]
    rows += [(201 + i, f"{common} widespread {common}", None) for i in range(3)]
    rows += [(220 + i, f"{common} {common} {i}@corp.com {common} {common}", None) for i in range(7)]
    rows += [(300, "alone quillfeather", None)]
    docs = documents(spark, rows)
    keyed = docs.select("doc_id", *(c.alias(k) for k, c in row_key("doc_id", "text").items()), F.col("text").alias("_text"))
    terms = sanitise.disclosing_terms(keyed.drop("doc_id"), sanitise.base_spans(keyed))
    found = {r.term: (r.kind, r.bits_left) for r in terms.collect()}
    # ten addresses with a context each, one phone number with two
    assert set(found) == {"zebulonia", "quillfeather", "copyline"}
    assert found["zebulonia"] == ("generalised", pytest.approx(-np.log2((1 + 1 / 10) / 2)))
    assert found["copyline"] == ("generalised", pytest.approx(-np.log2((1 + 1 / 10) / 2)))
    assert found["quillfeather"] == ("removed", pytest.approx(-np.log2((2 + 1) / (2 * 3 / 2 + 1))))
    spans = sanitise.find_spans(docs)
    out = {r.doc_id: r.sanitised for r in sanitise.sanitised(docs, spans).select("row.doc_id", "sanitised").collect()}
    assert out[100] == f"{common} [generalised] [email] {common}" and out[300] == "alone "
    assert all(out[i] == t for i, t, _ in rows if i < 100 or 201 <= i < 204)


def test_near_vectors(spark):
    rng = np.random.default_rng(1)
    base = rng.standard_normal((30, 16))
    rows = [(i, [float(x) for x in v], i % 2) for i, v in enumerate(base)]
    rows += [(100 + i, [float(x) for x in v + rng.standard_normal(16) * 0.05], i % 2) for i, v in enumerate(base)]
    rows += [(200, rows[0][1], 0), (200, rows[0][1], 0), (201, None, 0), (202, [], 0), (203, [0.0] * 16, 0)]
    rows += [(204, [None] + [1.0] * 15, 0), (205, [float("nan")] * 16, 0), (206, rows[0][1], None), (None, rows[1][1], 1)]
    rows += [(207, rows[0][1][:8], 0), (208, [x * 1e30 for x in rows[2][1]], 0)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = embedding_dedup.near_vectors(frame).collect()
    want = brute_vectors(rows, 0.93)
    assert sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in got), key=str) == sorted(want, key=str)
    assert embedding_dedup.near_vectors(frame.limit(0)).count() == 0


def brute_vectors(rows, threshold):
    def usable(r):
        v = r[1]
        return r[2] is not None and v and None not in v and np.isfinite(v).all() and any(v)

    n = len(rows)
    near = [[] for _ in rows]
    for i in range(n):
        for j in range(n):
            a, b = rows[i], rows[j]
            if i != j and usable(a) and usable(b) and a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = np.asarray(a[1]), np.asarray(b[1])
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= threshold - 1e-12:
                    near[i].append(j)
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        component = min(ids) if ids else None
        out.append((rows[i][0], len(near[i]), component, rows[i][0] == component))
    return out


def test_pipeline_stages(spark, odd, empty, tmp_path):
    spark.createDataFrame([(1, "one two three")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for docs in (odd, empty):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, str(tmp_path))
            assert out.columns == docs.columns, name
            docs = spark.createDataFrame(out.collect(), SCHEMA)
        packed = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
        check_packing(packed, 2048)
    assert isinstance(Row(a=1), Row) and hashlib
