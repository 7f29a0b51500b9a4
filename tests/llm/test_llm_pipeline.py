"""The pipeline's stages against plain Python, on the smallest tables."""

import math
import re
import unicodedata
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from hylle.llm import decontaminate, language_id, queries
from test_llm_edges import check_packing


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def symbols(text):
    """Lower-case letters with one blank after each run; the first character counts as it is."""
    out = []
    for i, ch in enumerate(text + "\n"):
        letter = unicodedata.category(ch)[0] == "L"
        if letter:
            out.append(ch.lower() if len(ch.lower()) == 1 else ch)
        elif i == 0 or out[-1] != " ":
            out.append(" ")
    return "".join(out)


class PlainModel:
    """Interpolated Kneser-Ney with dictionaries."""

    def __init__(self, texts, order=4):
        self.counts = [None] * (order + 1)
        self.counts[order] = Counter()
        for text in texts:
            s = symbols(text)
            padded = " " * (order - 1) + s
            self.counts[order].update(padded[i : i + order] for i in range(len(s)))
        for n in range(order - 1, 0, -1):
            self.counts[n] = Counter(gram[1:] for gram in self.counts[n + 1])
        self.totals, self.kinds, self.discounts = [None], [None], [None]
        for n in range(1, order + 1):
            total, kinds = Counter(), Counter()
            for gram, c in self.counts[n].items():
                total[gram[:-1]] += c
                kinds[gram[:-1]] += 1
            once = sum(c == 1 for c in self.counts[n].values())
            twice = sum(c == 2 for c in self.counts[n].values())
            self.totals.append(total)
            self.kinds.append(kinds)
            self.discounts.append(min(max(once / (once + 2 * twice), 0.1), 0.95) if once else 0.5)
        self.order, self.floor = order, 1 / (len(self.counts[1]) + 1)

    def probability(self, gram):
        if not gram:
            return self.floor
        n, context = len(gram), gram[:-1]
        lower = self.probability(gram[1:]) if n > 1 else self.floor
        if not self.totals[n][context]:
            return lower
        d, total = self.discounts[n], self.totals[n][context]
        return max(self.counts[n][gram] - d, 0) / total + d * self.kinds[n][context] / total * lower

    def bits(self, text):
        s = symbols(text)
        padded = " " * (self.order - 1) + s
        return -sum(math.log2(self.probability(padded[i : i + self.order])) for i in range(len(s))) / len(s)


def test_language_models(docs):
    rows = docs.collect()
    training = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 != 2 and r.lang is not None and r.text is not None]
    by = defaultdict(list)
    for r in training:
        by[r.lang].append(r.text)
    models = {lang: PlainModel(texts) for lang, texts in by.items()}
    found = {r.doc_id: r for r in language_id.identify(docs).collect()}
    for r in rows[::5]:
        bits = {lang: m.bits(r.text) for lang, m in models.items()}
        best = min(sorted(bits), key=bits.get)
        assert found[r.doc_id].lang_pred == best
        assert abs(found[r.doc_id].bits - bits[best]) < 1e-3


def plain_line_dedup(rows, least=10):
    def key(line):
        line = line.strip(" \t\n\x0b\x0c\r")
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line)

    seen = Counter(k for t in rows.values() for k in {key(x) for x in t.split("\n")} if k)
    return {i: "\n".join(x for x in t.split("\n") if seen[key(x)] < least or not key(x)) for i, t in rows.items()}


def plain_near_duplicates(rows, threshold=0.8):
    sets = {}
    for i, text in rows.items():
        words = text.lower().encode().split()
        sets[i] = {tuple(words[k : k + 5]) for k in range(max(len(words) - 4, 1 if words else 0))}
    holds = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holds[x].append(i)
    common = Counter((a, b) for own in holds.values() for a in own for b in own if a < b)
    head = {i: i for i in rows}

    def top(i):
        while head[i] != i:
            i = head[i]
        return i

    for (a, b), n in common.items():
        if n >= threshold * (len(sets[a]) + len(sets[b]) - n) - 1e-9:
            x, y = sorted((top(a), top(b)))
            head[y] = x
    return {i: t for i, t in rows.items() if top(i) == i}


def plain_overlaps(rows, items):
    def tokens(text):
        return re.findall(r"[^\W_]+", text.lower())

    seeds = defaultdict(set)
    words = {k: tokens(t) for k, t in items.items()}
    for k, w in words.items():
        for j in range(len(w) - 11):
            for m, mask in enumerate(decontaminate.MASKS):
                seeds[m, tuple(w[j + t] for t in mask)].add((k, j))
    bad = set()
    for i, text in rows.items():
        w = tokens(text)
        hits = {
            (k, at - j)
            for at in range(0, len(w) - 11, 2)
            for m, mask in enumerate(decontaminate.MASKS)
            for k, j in seeds.get((m, tuple(w[at + t] for t in mask)), ())
        }
        for k, shift in hits:
            run = best = 0
            for t, word in enumerate(words[k]):
                run = max(0, run + (1 if 0 <= t + shift < len(w) and w[t + shift] == word else -1))
                best = max(best, run)
            if best >= 12:
                bad.add(i)
    return {i: t for i, t in rows.items() if i not in bad}


def test_pipeline_against_plain_python(spark, sf_dir, docs):
    from tokenizers import Tokenizer

    rejected = {r.doc_id for r in language_id.identify(docs).where("rejected").collect()}
    rows = {r.doc_id: r.text or "" for r in docs.collect() if r.doc_id not in rejected}
    items = {r.item_id: r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    want = [dict(rows)]
    for step in (plain_line_dedup, plain_near_duplicates, lambda x: plain_overlaps(x, items)):
        want.append(step(want[-1]))
    at = docs
    for (name, stage), expected in zip(corpus_pipeline.STAGES, want):
        at = stage(spark, at, sf_dir)
        assert at.columns == docs.columns
        got = {r.doc_id: r for r in at.collect()}
        assert {i: r.text for i, r in got.items()} == expected, name
        assert all(r.n_chars == len(r.text) for r in got.values())
    assert len(want[1]) > len(want[2]) > len(want[3])
    packed = corpus_pipeline.run(spark, sf_dir).collect()
    check_packing(packed, 2048)
    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    ids = {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 1] for i, t in want[-1].items()}
    assert {(r.doc_id, r.doc_tokens) for r in packed} == {(i, len(x)) for i, x in ids.items()}
    for r in packed:
        piece = np.asarray(ids[r.doc_id][r.start : r.start + r.length], "<u4")
        assert len(piece) == r.length and zlib.crc32(piece.tobytes()) == r.ids_crc32
    assert sum(r.length for r in packed) == sum(map(len, ids.values()))


def test_no_gram_is_left_out(spark, docs):
    base = [(r.doc_id, r.text[:300], r.lang) for r in docs.where("lang is not null and text is not null").limit(60).collect()]
    # a small language beside a large one, each of its grams few times
    small = [(10_000 + i, f"żółw gęślą jaźń {'ąćęłńóśźż'[i % 9]}", "xx") for i in range(6)]
    frame = spark.createDataFrame(base + small, "doc_id long, text string, lang string")
    frame = frame.unionAll(frame.where("doc_id = 10000"))
    whole = {r.doc_id: r for r in language_id.identify(frame).collect()}
    grams = language_id.gram_counts(frame).count()
    assert len(list(language_id.fit(frame, max_grams=grams // 4))) > 4
    rows = language_id.identify(frame, max_grams=grams // 4).collect()
    assert len(rows) == frame.count()
    for r in rows:
        want = whole[r.doc_id]
        assert (r.lang_pred, r.rejected) == (want.lang_pred, want.rejected)
        assert abs(r.bits - want.bits) < 1e-6 and abs(r.score - want.score) < 1e-6
    assert {r.lang_pred for r in rows if r.doc_id >= 10_000} == {"xx"}


def test_passes_cover_all_symbols():
    for sizes, most in (([], 5), ([(0, 50), (3, 1), (4, 1), (9, 12), (65535, 3)], 5), ([(7, 4), (8, 4)], 5)):
        found = language_id.passes(sizes, most)
        packed = (np.arange(65536, dtype=np.uint64) << np.uint64(16)) | (np.uint64(11) << np.uint64(32))
        assert (sum(p.places(packed).astype(int) for p in found) == 1).all()


@pytest.mark.parametrize("junk", [2, 60])
def test_foreign_text_is_rejected_at_every_share(spark, docs, junk):
    rng = np.random.default_rng(4)
    rows = [(r.doc_id, r.text, r.lang) for r in docs.collect()]
    for letters in ("abcdefghijklmnopqrstuvwxyz", "абвгдежзиклмнопрстуфхцчшщыэюя"):
        for _ in range(junk):
            words = ("".join(rng.choice(list(letters), rng.integers(3, 9))) for _ in range(60))
            rows.append((100_000 + len(rows), " ".join(words), None))
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    rejected = {r.doc_id for r in language_id.identify(frame).where("rejected").collect()}
    assert {i for i, _, _ in rows if i >= 100_000} <= rejected
    assert len([i for i in rejected if i < 100_000]) <= 0.02 * docs.count()


def test_sparse_length_classes_are_pooled():
    sizes = [("a", 9, 700), ("a", 8, 400), ("a", 7, 1000), ("a", 3, 5), ("b", 4, 2)]
    assert language_id.pools(sizes, 1000) == [("a", 8, 63), ("a", 0, 7), ("b", 0, 63)]
