"""Fill-in-middle, periodic runs and token fertility against plain Python, and their edge cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from hylle.llm import fertility, fill_in_middle, periodic_runs, queries
from hylle.llm.common import row_key
from hylle.llm.queries import tokenizer_path
from test_llm_edges import CLASHING, documents, empty, odd  # noqa: F401

PATHS = ("byte_bpe_50k.tiktoken", "piece_bpe_32k.model")


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    return {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_fim(doc_id, text):
    """(n, form, prefix_chars, middle_chars, output) by the rule's own words."""
    tokens = TOKEN.findall(text)
    n, h = len(tokens), sha(f"42:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(tokens[x:y]) for x, y in ((0, a), (a, b), (b, n)))
    if h4 % 100 < 80:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def check_fim(found, want):
    rows = found.select(
        "row.doc_id", "row.text", "found.*",
        fill_in_middle.rendered(found).alias("output"),
    )
    rows = rows.withColumn("back", fill_in_middle.original(rows["output"], rows["form"])).collect()
    assert len(rows) == want
    for r in rows:
        text = r.text or ""
        n, form, prefix, middle, output = plain_fim(r.doc_id, text)
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == (n, form, prefix, middle, output)
        assert (r.output_sha256, r.restored_sha256, r.back) == (sha(output), sha(text), text)
    return rows


def test_fill_in_middle_of_odd_texts(odd, empty):  # noqa: F811
    check_fim(fill_in_middle.rearranged(odd), odd.count())
    assert fill_in_middle.rearranged(empty).count() == 0


def test_fill_in_middle_round_trip(spark, texts):
    rng = np.random.default_rng(4)
    letters = list("ab é漢\t\n\x0b\x0c\r\x85 <P>S😀  ")
    rows = [(i, "".join(rng.choice(letters, rng.integers(0, 60))), None) for i in range(900)]
    rows += [(900 + i, t, None) for i, t in enumerate(["<P>", "x <S> y", "<M", " ", "  a", "a  ", "a" * 200_000, "é " * 50_000])]
    rows += [(r.doc_id, r.text, r.lang) for r in texts.values()]
    found = check_fim(fill_in_middle.rearranged(documents(spark, rows)), len(rows))
    assert {r.form for r in found} == {"plain", "psm", "spm"}


def test_other_sentinels_and_shares(spark):
    marks = ("[pré]", "[suf]", "[mid]")
    docs = documents(spark, [(i, f"one two three {i} four", None) for i in range(60)])
    found = fill_in_middle.rearranged(docs, fim_percent=100, spm_percent=0, sentinels=marks)
    out = found.select("row.text", "found.form", fill_in_middle.rendered(found, sentinels=marks).alias("out"))
    rows = out.withColumn("back", fill_in_middle.original(out["out"], out["form"], sentinels=marks)).collect()
    assert all(r.form == "psm" and r.out.startswith("[pré]") and r.back == r.text for r in rows)


def test_split_keeps_bytes():
    table = [(0, 0, 5), (1, 3, 6), (0, 5, 9)]
    for at in range(13):
        left, right = fill_in_middle.split(table, at)
        size = lambda t: sum(e - s for _, s, e in t)
        assert size(left) == at and size(left) + size(right) == 12
        flat = [(b, i) for b, s, e in left + right for i in range(s, e)]
        assert flat == [(b, i) for b, s, e in table for i in range(s, e)]


def brute_runs(words, least):
    """Every maximal stretch per lag; a stretch keeps its smallest lag."""
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, 3 * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def random_words(rng):
    """Few different words, with planted periods, some of whose blocks are themselves nearly periodic."""
    n = int(rng.choice([0, 1, 5, 30, 100, 300, 700]))
    words = rng.integers(0, rng.choice([1, 2, 3, 10, 50]), n)
    for _ in range(rng.integers(0, 4)):
        if n > 10:
            a = int(rng.integers(0, n))
            p = 1 + int(rng.integers(0, max(1, (n - a) // 3)))
            if rng.random() < 0.4:
                block = np.arange(p) % rng.integers(1, 6)
                block[rng.integers(0, p)] = 99
                words[a : a + p] = block[: n - a]
            end = int(rng.integers(a, n + 1))
            for i in range(a, end):
                words[i] = words[a + (i - a) % p]
    return words.astype(np.int64)


@pytest.mark.parametrize("least", [1, 24])
def test_runs_are_all_runs(least):
    rng = np.random.default_rng(least)
    seen = 0
    for _ in range(250):
        docs = [random_words(rng) for _ in range(rng.integers(1, 5))]
        want = [brute_runs(d.tolist(), least) for d in docs]
        assert periodic_runs.runs_of_texts(docs, least) == want
        seen += sum(map(len, want))
    assert seen > 100


def test_runs_survive_equal_hashes(monkeypatch):
    """With hashes that tell little apart, words are still compared one by one."""
    of = periodic_runs.Hashes.of
    monkeypatch.setattr(periodic_runs.Hashes, "of", lambda self, first, size: of(self, first, size) & np.uint64(0xFFFFFF0))
    rng = np.random.default_rng(9)
    for _ in range(60):
        words = random_words(rng)
        for start, length, period in periodic_runs.runs_of_texts([words], 24)[0]:
            own = words[start : start + length]
            assert (own[period:] == own[:-period]).all()


def planted(doc_id, text):
    words = WORD.findall(text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def test_periodic_runs_query(spark, sf_dir, texts):
    rows = queries.QUERIES["op12_periodic_runs"](spark, sf_dir).collect()
    assert {r.doc_id for r in rows} == set(texts) and len(rows) == len(texts)
    for r in rows:
        words = planted(r.doc_id, texts[r.doc_id].text)
        runs = brute_runs(words, 24)
        assert r.n_runs == len(runs)
        best = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=None)
        want = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        assert (r.start, r.length, r.period, r.exponent_milli) == want
        assert r.runs_sha256 == sha("".join(f"{s},{n},{q}\n" for s, n, q in runs))
        dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
        assert r.collapsed_sha256 == sha(" ".join(w for i, w in enumerate(words) if i not in dropped))
    assert sum(r.n_runs > 0 for r in rows) > 0.05 * len(rows)


def test_runs_of_odd_texts(spark, odd, empty):  # noqa: F811
    rows = periodic_runs.with_runs(odd).select("row.doc_id", "row.text", "found.*").collect()
    assert len(rows) == odd.count()
    for r in rows:
        words = WORD.findall(r.text or "")
        runs = brute_runs(words, 24) if len(words) < 2_000 else [(0, 6_000, 1_261)]
        if len(words) >= 2_000 and r.doc_id == 5:
            continue  # one word in many is another
        assert (r.n, [tuple(x) for x in r.runs]) == (len(words), runs)
        if not runs:
            assert r.collapsed == " ".join(words)
    assert periodic_runs.with_runs(empty).count() == 0
    long = documents(spark, [(1, "a b " * 300_000 + "c", "en"), (2, " ".join(f"w{i % 9_973}" for i in range(60_000)), None)])
    got = {r.doc_id: (r.n, [tuple(x) for x in r.runs], r.collapsed) for r in periodic_runs.with_runs(long).select("row.doc_id", "found.*").collect()}
    assert got[1] == (600_001, [(0, 600_000, 2)], "a b c")
    assert got[2][:2] == (60_000, [(0, 60_000, 9_973)]) and len(got[2][2].split()) == 9_973


def plain_counts(text):
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    again = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(again),
    )


@pytest.fixture(scope="module")
def vocabularies():
    return [fertility.Vocabulary(tokenizer_path(p)) for p in PATHS]


def plain_measures(text, vocabularies):
    """Tokens of each word by itself, with a blank before it."""
    words = WORD.findall(text)
    byte, piece = ([t for w in words for t in v.encode([w.encode()])[0].tolist()] for v in vocabularies)
    fallback = sum(bool(v.bytes[t]) for v, own in zip(vocabularies, (byte, piece)) for t in own)
    entropy = -sum(n / len(byte) * math.log2(n / len(byte)) for n in Counter(byte).values())
    return len(byte), len(piece), fallback, entropy


def check_fertility(rows, vocabularies):
    for r in rows:
        text = r.text or ""
        base = plain_counts(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base
        assert r.base_failed == (base[0] < 20 or 100 * base[4] > 30 * base[0])
        assert r.kept == (not r.base_failed and not r.outside)
        byte, piece, fallback, entropy = plain_measures(text, vocabularies)
        assert (r.tokens_byte, r.tokens_piece, r.fallback) == (byte, piece, fallback)
        assert math.isclose(r.entropy, entropy, abs_tol=1e-9)


def test_fertility_counts(spark, sf_dir, texts, vocabularies):
    rows = queries.QUERIES["op13_token_fertility"](spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), "doc_id").collect()
    assert {r.doc_id for r in rows} == set(texts) and len(rows) == len(texts)
    check_fertility(rows, vocabularies)


def test_fertility_of_odd_texts(odd, empty, vocabularies):  # noqa: F811
    paths = tuple(map(tokenizer_path, PATHS))
    found = fertility.quality(odd, paths)
    kept = fertility.kept_documents(odd, found)
    assert kept.columns == odd.columns and kept.count() == found.where("kept").count()
    text = odd.select(*(c.alias(k) for k, c in row_key("doc_id", "text").items()), "text").distinct()
    rows = found.join(text, ["_k1", "_k2"]).select("row.doc_id", "text", *fertility.COUNTS, "entropy", "script", "base_failed", "outside", "kept").collect()
    assert len(rows) == odd.count()
    check_fertility(rows, vocabularies)
    by = {r.doc_id: r for r in rows}
    assert by[1].script == "" and by[4].script == "latin"
    assert by[9].fallback > 0
    assert fertility.quality(empty, paths).count() == 0


def test_fertility_of_texts_without_words(spark):
    """All columns can be read: shares of no tokens are null and the texts are not kept."""
    rows = [(1, "", "en"), (2, None, None), (3, " \n\t", "en"), (4, "some words", "en")]
    out = {r.doc_id: r for r in fertility.quality(documents(spark, rows), tuple(map(tokenizer_path, PATHS))).select("row.doc_id", "*").collect()}
    shares = ("chars_per_token_byte", "chars_per_token_piece", "fallback_share")
    assert len(out) == 4 and all(out[i][c] is None for i in (1, 2, 3) for c in shares)
    assert all(out[4][c] is not None for c in shares)
    assert not any(r.kept or r.outside for r in out.values())


def test_long_rows_of_blanks_and_words(vocabularies, monkeypatch):
    """The pattern gives up on a million blanks; what is cut before it is encoded as before."""
    byte = vocabularies[0]
    flat, sizes = byte.encode([("\xa0" * 1_500_000 + "x").encode(), b"end"])
    assert sizes.tolist() == [len(flat) - 1, 1]
    assert byte.model.decode(flat.tolist()) == " " + "\xa0" * 1_500_000 + "x end"
    monkeypatch.setattr(fertility, "BLANKS", re.compile(fertility.BLANKS.pattern.replace("100000", "3")))
    monkeypatch.setattr(fertility, "SPLIT", 40)
    rng = random.Random(1)
    for _ in range(100):
        words = ["".join(rng.choices(["\xa0", "\u3000", "\x85", "ab", "#", "1", "'s", "é"], k=rng.randint(1, 40))) for _ in range(20)]
        flat, sizes = byte.encode([w.encode() for w in words])
        want = [byte.model.encode_ordinary(" " + w) for w in words]
        assert flat.tolist() == [t for w in want for t in w] and sizes.tolist() == list(map(len, want))


def test_scripts():
    for text, script in (("abc", "latin"), ("ñandú é", "latin"), ("привет мир", "cyrillic"), ("漢字かな漢", "han"), ("ελληνικά", "greek"), ("한국어", "hangul"), ("שלום", "hebrew"), ("مرحبا", "arabic"), ("123 #!", ""), ("", "")):
        assert fertility.script_of(text.encode()) == script


def test_bands_reject_what_is_unlike_its_language(spark):
    """Bands come from distinct texts: copies of one odd text don't move them."""
    rng = np.random.default_rng(6)
    common = ["the", "and", "house", "river", "with", "from", "garden", "morning", "people", "little", "under", "where"]
    plain = [" ".join(f"{rng.choice(common)}{'' if rng.random() < 0.8 else rng.integers(0, 10)}" for _ in range(120)) for _ in range(300)]
    junk = " ".join(f"{rng.integers(0, 10**9):x}###" for _ in range(120))
    cyrillic = ["".join(map(chr, rng.integers(0x430, 0x44F, 4))) for _ in range(100)]
    foreign = " ".join(cyrillic)
    rows = [(i, t, "en") for i, t in enumerate(plain)] + [(1_000 + i, junk, "en") for i in range(600)]
    rows += [(5_000, foreign, None), (5_001, " ".join(["emoji 😀🧬"] + [f"𝔘{i}" for i in range(100)]), "en")]
    out = fertility.quality(documents(spark, rows), tuple(map(tokenizer_path, PATHS)), least=100).select("row.doc_id", "kept", "outside", "band_group").collect()
    by = {r.doc_id: r for r in out}
    assert all(by[i].kept for i in range(300))
    assert not any(by[1_000 + i].kept for i in range(600))
    assert "chars_per_token_byte" in by[1_000].outside and by[1_000].band_group == "lang:latin:en"
    assert not by[5_001].kept and "fallback_share" in by[5_001].outside
    few = fertility.quality(documents(spark, rows), tuple(map(tokenizer_path, PATHS)), least=10_000)
    assert all(r.kept or r.base_failed for r in few.select("kept", "base_failed").collect())
