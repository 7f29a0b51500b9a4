"""The registered queries against SQL, brute force and held-out labels."""

import hashlib
import math
import os
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from compare import assert_same
from hylle.llm import decontaminate, queries, sanitise
from hylle.llm import substrings
from hylle.llm.common import row_key
from test_llm_edges import BASE, base_spans, check_packing


@pytest.mark.parametrize("name", sorted(queries.CHECKS))
def test_against_sql(spark, sf_dir, duck, name):
    assert_same(queries.QUERIES[name](spark, sf_dir), duck, queries.CHECKS[name])


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    return {r.doc_id: r for r in rows}


def test_pieces_and_sequences(spark, sf_dir, texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    rows = queries.QUERIES["op3_pack_first_fit"](spark, sf_dir).collect()
    check_packing(rows, 2048)
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert set(by) == set(texts)
    used = set()
    for doc, own in by.items():
        ids = np.asarray([*tokenizer.encode(texts[doc].text or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for r in sorted(own, key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
            used.add(r.sequence_id)
        assert at == len(ids)
    total = sum(r.length for r in rows)
    assert total / (2048 * len(used)) > 0.9


def brute_spans(docs, length):
    def windows(data):
        return [hashlib.blake2b(data[i : i + length], digest_size=12).digest() for i in range(len(data) - length + 1)]

    seen, twice = set(), set()
    for data in docs:
        for h in windows(data):
            (twice if h in seen else seen).add(h)
    out = []
    for data in docs:
        covered = np.zeros(len(data) + 1, bool)
        for i, h in enumerate(windows(data)):
            if h in twice:
                covered[i : i + length] = True
        covered[len(data)] = False
        spans = int((np.diff(np.concatenate(([0], covered.astype(int)))) == 1).sum())
        kept = bytes(np.frombuffer(data, np.uint8)[~covered[:-1]]) if data else b""
        out.append((len(data), int(covered.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("pieces", [2, substrings.SHARD_PIECES])
def test_repeated_bytes(spark, sf_dir, texts, pieces, monkeypatch):
    monkeypatch.setattr(substrings, "SHARD_PIECES", pieces)  # few: anchors spread over shards
    ids = sorted(texts)
    want = dict(zip(ids, brute_spans([(texts[i].text or "").encode() for i in ids], 400)))
    rows = queries.QUERIES["op4_suffix_dedup"](spark, sf_dir).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows} == want
    assert any(w[1] for w in want.values())


def hashed_spans(docs, length):
    """As ``brute_spans``, with two rolling hashes per window in place of its bytes."""
    data = np.frombuffer(b"".join(docs), np.uint8)
    sizes = np.asarray([len(d) for d in docs])
    starts = np.cumsum(sizes) - sizes
    keys = []
    for base in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F):
        one = np.zeros(len(data), np.uint64)
        two = np.random.default_rng(base).integers(1, 2**63, 256, np.uint64)[data]
        step, at = np.uint64(base), 0
        # the hash of 2^k bytes is that of its halves, the first times base^(2^(k-1))
        for k in range(length.bit_length()):
            if length >> k & 1:
                one = one * step + np.append(two[at:], np.zeros(at, np.uint64))
                at += 1 << k
            half = np.append(two[1 << k :], np.zeros(min(1 << k, len(two)), np.uint64))[: len(two)]
            two, step = two * step + half, step * step
        keys.append(one)
    window = np.concatenate([np.arange(a, a + n - length + 1) for a, n in zip(starts, sizes) if n >= length])
    order = window[np.lexsort((keys[1][window], keys[0][window]))]
    same = (keys[0][order[1:]] == keys[0][order[:-1]]) & (keys[1][order[1:]] == keys[1][order[:-1]])
    edge = np.zeros(len(data) + length + 1, np.int64)
    hit = np.union1d(order[1:][same], order[:-1][same])
    edge[hit] += 1
    edge[hit + length] -= 1
    covered = np.cumsum(edge)[: len(data)] > 0
    out = []
    for a, n in zip(starts.tolist(), sizes.tolist()):
        own = covered[a : a + n]
        spans = int((np.diff(np.append(0, own.astype(int))) == 1).sum())
        out.append((n, int(own.sum()), spans, hashlib.sha256(data[a : a + n][~own].tobytes()).hexdigest()))
    return out


def test_hashed_spans():
    rng = np.random.default_rng(2)
    docs = [bytes(rng.integers(97, 99, n, np.uint8)) for n in rng.integers(0, 60, 80)]
    for length in (7, 8, 13):
        assert hashed_spans(docs, length) == brute_spans(docs, length)


def test_repeated_bytes_of_larger_tables(spark):
    sf_dir = os.environ.get("HYLLE_LARGE_DIR", "/root/testdata/sf0.1")
    docs = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    want = dict(zip(docs, hashed_spans(list(docs.values()), 400)))
    rows = queries.QUERIES["op4_suffix_dedup"](spark, sf_dir).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows} == want


def test_ties_beyond_the_window_length():
    """Pairs that share 700 bytes must not lend their length to pieces that share nothing."""
    rng = np.random.default_rng(8)
    text = lambda n: bytes(rng.integers(97, 105, n, np.uint8))
    long = [text(700) for _ in range(300)]
    shard = [text(768) for _ in range(600)]
    for s in long:
        shard += [text(30) + s + text(38), text(12) + s + text(56)]
    rng.shuffle(shard)
    seen = {}
    for i, p in enumerate(shard):
        for at in range(len(p) - 399):
            seen.setdefault(p[at : at + 400], []).append((i, at))
    repeated, leads = substrings.repeated_windows(shard, 400)
    for places in seen.values():
        assert all(bool(repeated[i][at]) == (len(places) > 1) for i, at in places)
        assert sum(bool(leads[i][at]) for i, at in places) == 1


def test_personal_data(spark, sf_dir, texts):
    rows = queries.QUERIES["op6_pii_disclosure"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        spans = base_spans(texts[r.doc_id].text or "")
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert r.n_email == sum(k == "email" for k, _, _ in spans)
        assert r.spans.startswith(joined)


def plain_terms(texts):
    """Terms and their kinds by counting in Python, distinct contexts and back-off as documented."""
    import regex

    word = regex.compile(r"[\p{L}\p{N}]+")
    n_t, n_te, seen, n_e = Counter(), Counter(), defaultdict(set), defaultdict(set)
    for text in texts:
        n_t.update(m[0] for m in word.finditer(text.lower()))
        valid = set(base_spans(text))
        for kind, pattern in BASE.items():
            matches = list(re.finditer(pattern, text))
            edges = [0, *(x for m in matches for x in m.span()), len(text)]
            for i, m in enumerate(matches):
                if (kind, *m.span()) not in valid:
                    continue
                lo, hi = max(edges[2 * i], m.start() - 80), min(edges[2 * i + 3], m.end() + 80)
                before, after = text[lo : m.start()], text[m.end() : hi]
                entity = (kind, m[0].lower() if kind == "email" else re.sub(r"[ ().-]", "", m[0]))
                n_e[entity].add((before, after))
                whole = [w for w in word.finditer(text, lo, m.start()) if w.start() > lo or len(before) < 80]
                whole += [w for w in word.finditer(text, m.end(), hi) if w.end() < hi or len(after) < 80]
                for w in whole:
                    # words that the match itself cuts
                    if w.end() == m.start() and word.match(m[0]) or w.start() == m.end() and word.match(m[0][-1]):
                        continue
                    t = w[0].lower()
                    if len(t) >= 3:
                        n_te[t, entity] += 1
                        seen[t, entity].add((before, after))
    kinds = Counter()
    for (kind, _), contexts in n_e.items():
        kinds[kind] += len(contexts)
    best = {}
    for (t, entity), n in n_te.items():
        if not n_t[t]:  # cut by the match before or after
            continue
        c = len(seen[t, entity])
        p = (c + len(n_e[entity]) / kinds[entity[0]]) / (c / min(n / n_t[t], 1) + 1)
        best[t] = min(best.get(t, 99.0), -math.log2(p))
    return {t: "removed" if b <= 0.6 else "generalised" for t, b in best.items() if b <= 1}


def test_terms_by_plain_counts(spark):
    sf_dir = os.environ.get("HYLLE_LARGE_DIR", "/root/testdata/sf0.1")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    keyed = docs.select(
        *(c.alias(k) for k, c in row_key("doc_id", "text").items()), F.coalesce("text", F.lit("")).alias("_text")
    )
    found = sanitise.disclosing_terms(keyed, sanitise.base_spans(keyed)).collect()
    want = plain_terms([r._text for r in keyed.select("_text").collect()])
    assert {r.term: r.kind for r in found} == want and len(found) == len(want) > 0


def test_languages(spark, sf_dir, texts):
    rows = queries.QUERIES["op9_language_id"](spark, sf_dir).collect()
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {i for i in texts if zlib.crc32(str(i).encode()) % 4 == 2}
    right = sum(r.lang_pred == texts[r.doc_id].lang for r in held)
    assert right >= 0.95 * len(held)
    assert sum(r.rejected for r in rows) <= 0.02 * len(rows)


def test_toxic_documents(spark):
    # the smallest tables have too few labels to learn from
    sf_dir = os.environ.get("HYLLE_LABELS_DIR", "/root/testdata/sf0.01")
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = queries.QUERIES["op2_toxicity"](spark, sf_dir).collect()
    held = [r for r in rows if r.held_out and r.doc_id in toxic]
    right = sum(r.predicted == toxic[r.doc_id] for r in held)
    assert right >= 0.93 * len(held)
    assert sum(r.predicted for r in held if toxic[r.doc_id] == 1) >= 0.5 * sum(toxic[r.doc_id] for r in held)


def test_runs_of_twelve_tokens_at_any_offset(spark):
    item = " ".join(f"tok{i}" for i in range(12))
    rows = [(n, " ".join([f"w{i}" for i in range(n)] + [item, "and more"])) for n in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = decontaminate.overlaps(docs, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert sorted((r.doc_id, r._shift, r._score) for r in found.collect()) == [(n, n, 12) for n in range(6)]
