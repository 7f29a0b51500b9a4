"""Removal of every byte that a repeated string of ``length`` bytes covers.

All texts are cut at anchors first. In each window of ``length`` bytes the 32-byte
gram with the least hash (the first of equals) is its anchor, so equal windows have
equal anchors at equal places. Neighbouring windows with one anchor form a piece:
about 185 windows, known by its anchor's hash and by a hash of its bytes.

* A piece whose bytes occur twice is repeated as a whole. Counting pieces is a sum by
  hash ahead of the shuffle, so groups of copies of any size cost one row per task.
* Only pieces that occur once, but share their anchor with others, need a closer
  look. They are gathered, one copy of each piece, in shards by anchor. A shard's
  suffix array is built by Larsson-Sadakane refinement (only groups that are still
  tied are sorted again, by twice the depth each time) and the common prefixes of
  neighbours by Kasai's scan, which runs over all pieces of the shard side by side.
  A window with a common prefix of ``length`` with a neighbour is repeated.
* An anchor with more pieces than a shard may hold is dealt out over several. The
  windows that a shard finds only once are then sent on as sorted runs of
  fingerprints, by range, and the shards' runs are merged by binary search.

What is taken out is decided on the input alone, then cut once per document.

Defined cases: a null text is empty; texts shorter than ``length`` have no windows;
matches never cross documents and may overlap themselves; rows with the same id and
text are two documents that repeat each other; invalid UTF-8 does not occur in a
string column; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hylle.llm.common import KEY, carried, partitions, row_key, staged

LENGTH, GRAM = 400, 32
SEGMENT = 1 << 19  # bytes looked at together; positions must fit 20 bits
SHARD_BYTES, SHARD_PIECES = 1 << 20, 1_000
MERGE_WINDOWS = 1 << 20
PLACE = np.uint64((1 << 20) - 1)


def _odd(seed: int, n: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64([41, seed])).integers(0, 2**63, n, np.uint64) * np.uint64(2) + np.uint64(1)


class Sums:
    """Polynomial hashes of any stretch of a buffer, from running sums modulo 2^64."""

    _up: dict[int, np.ndarray] = {}
    _down: dict[int, np.ndarray] = {}

    def __init__(self, data: np.ndarray, seed: int) -> None:
        base = _odd(seed, 1)[0]
        n = len(data) + 1
        if len(self._up.get(seed, ())) < n:
            inverse = np.uint64(pow(int(base), -1, 1 << 64))
            for store, b in ((self._up, base), (self._down, inverse)):
                p = np.full(n, b, np.uint64)
                p[0] = 1
                store[seed] = np.multiply.accumulate(p)
        self.seed = seed
        self.total = np.zeros(n, np.uint64)
        np.cumsum(_odd(seed + 100, 256)[data] * self._up[seed][: n - 1], out=self.total[1:])

    def of(self, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        x = (self.total[end] - self.total[first]) * self._down[self.seed][first]
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(29))


def least_in_windows(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours, from block-wise running minima."""
    n = len(x) - width + 1
    whole = np.full(-(-len(x) // width) * width, np.uint64(0xFFFFFFFFFFFFFFFF))
    whole[: len(x)] = x
    grid = whole.reshape(-1, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def segments(texts: list[bytes], length: int) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Rows, offsets and stretches of bytes; every window lies in exactly one stretch."""
    rows, offsets, parts, held = [], [], [], 0
    for row, text in enumerate(texts):
        for at in range(0, len(text) - length + 1, SEGMENT - length + 1):
            part = text[at : at + SEGMENT]
            if held and held + len(part) > SEGMENT:
                yield rows, offsets, parts
                rows, offsets, parts, held = [], [], [], 0
            rows.append(row)
            offsets.append(at)
            parts.append(part)
            held += len(part)
    if rows:
        yield rows, offsets, parts


def cut(rows: list[int], offsets: list[int], parts: list[bytes], length: int) -> tuple[np.ndarray, ...]:
    """Pieces: row, first and last window, anchor hash and two hashes of the bytes."""
    data = np.frombuffer(b"".join(parts), np.uint8)
    sizes = np.asarray([len(p) for p in parts])
    starts = np.cumsum(sizes) - sizes
    one, two = Sums(data, 1), Sums(data, 2)
    at = np.arange(len(data) - GRAM + 1)
    gram = one.of(at, at + GRAM)
    least = least_in_windows((gram & ~PLACE) | at.astype(np.uint64), length - GRAM + 1)
    anchor = (least & PLACE).astype(np.int64)
    window = np.repeat(starts, sizes - length + 1) + np.concatenate([np.arange(n - length + 1) for n in sizes])
    part = np.repeat(np.arange(len(parts)), sizes - length + 1)
    own = anchor[window]
    new = np.flatnonzero(np.append(True, (own[1:] != own[:-1]) | (part[1:] != part[:-1])))
    first, last = window[new], window[np.append(new[1:], len(window)) - 1]
    part = part[new]
    shift = np.asarray(offsets)[part] - starts[part]
    return (
        np.asarray(rows)[part],
        first + shift,
        last + shift,
        gram[own[new]].view(np.int64),
        one.of(first, last + length).view(np.int64),
        two.of(first, last + length).view(np.int64),
    )


def runs_of(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last places of the runs of set flags."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return edge[::2], edge[1::2] - 1


PIECES = "_k1 long, _k2 long, first long, last long, anchor long, h1 long, h2 long, times long"


def pieces(keyed: DataFrame, length: int) -> DataFrame:
    """Pieces of each row of (_k1, _k2, _text).

    A piece that a document holds several times is one row with that many ``times``;
    the windows of all of them are rows without an anchor, which are known repeated.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                k1, k2 = (part.column(i).to_numpy() for i in (0, 1))
                texts = [(t or "").encode() for t in part.column(2).to_pylist()]
                found = [cut(*s, length) for s in segments(texts, length)]
                if not found:
                    continue
                row, first, last, anchor, h1, h2 = (np.concatenate(x) for x in zip(*found))
                order = np.lexsort((first, h2, h1, row))
                same = np.zeros(len(order), bool)
                a, b = order[1:], order[:-1]
                same[1:] = (row[a] == row[b]) & (h1[a] == h1[b]) & (h2[a] == h2[b])
                lead = np.flatnonzero(~same)
                times = np.diff(np.append(lead, len(order)))
                kept = order[lead]
                many = np.repeat(times > 1, times)
                sure = order[many]
                columns = [
                    np.concatenate([k1[row[kept]], k1[row[sure]]]),
                    np.concatenate([k2[row[kept]], k2[row[sure]]]),
                    np.concatenate([first[kept], first[sure]]),
                    np.concatenate([last[kept], last[sure]]),
                    np.concatenate([anchor[kept], np.zeros(len(sure), np.int64)]),
                    np.concatenate([h1[kept], np.zeros(len(sure), np.int64)]),
                    np.concatenate([h2[kept], np.zeros(len(sure), np.int64)]),
                    np.concatenate([times, np.zeros(len(sure), np.int64)]),
                ]
                if len(sure):
                    columns = _merged(columns, len(kept))
                none = columns[7] == 0
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, mask=none if 4 <= i <= 6 else None) for i, c in enumerate(columns)],
                    ["_k1", "_k2", "first", "last", "anchor", "h1", "h2", "times"],
                )

    return keyed.select(*KEY, "_text").mapInArrow(run, PIECES)


def _merged(columns: list[np.ndarray], kept: int) -> list[np.ndarray]:
    """Neighbouring windows known to be repeated as one row, so that a long period is one row."""
    k1, k2, first, last = (c[kept:] for c in columns[:4])
    order = np.lexsort((first, k2, k1))
    k1, k2, first, last = k1[order], k2[order], first[order], last[order]
    new = np.append(True, (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1]) | (first[1:] > last[:-1] + 1))
    lead = np.flatnonzero(new)
    end = np.maximum.reduceat(last, lead)
    out = [k1[lead], k2[lead], first[lead], end, *(np.zeros(len(lead), np.int64) for _ in range(4))]
    return [np.concatenate([c[:kept], o]) for c, o in zip(columns, out)]


def suffix_array(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Order of all suffixes by their first ``depth`` symbols, at least.

    Larsson-Sadakane: a suffix's rank is the end of its group of ties; a round at
    depth h sorts only the suffixes still tied, by the rank of the suffix h further on.
    """
    n = len(symbols)
    # the first ranks: as many symbols as a 64-bit number holds
    bits = int(symbols.max(initial=0)).bit_length() + 1
    h = max(1, 63 // bits)
    wide = np.zeros(n, np.int64)
    for k in range(h):
        wide <<= bits
        wide[: max(n - k, 0)] |= symbols[k:].astype(np.int64) + 1
    order = np.argsort(wide, kind="stable")
    value = wide[order]
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    edge = np.append(value[1:] != value[:-1], True)
    ends = np.flatnonzero(edge)
    rank[order] = np.repeat(ends, np.diff(np.append(-1, ends)))
    # places of the order that are still in groups of more than one
    tied = np.flatnonzero(np.repeat(np.diff(np.append(-1, ends)) > 1, np.diff(np.append(-1, ends))))
    while h < depth and len(tied):
        suffix = order[tied]
        group = rank[suffix]
        ahead = rank[np.minimum(suffix + h, n)]
        by = np.argsort(group * (n + 1) + ahead + 1, kind="stable")
        suffix, group, ahead = suffix[by], group[by], ahead[by]
        order[tied] = suffix
        edge = np.append((group[1:] != group[:-1]) | (ahead[1:] != ahead[:-1]), True)
        ends = np.flatnonzero(edge)
        sizes = np.diff(np.append(-1, ends))
        rank[suffix] = np.repeat(tied[ends], sizes)
        tied = tied[np.repeat(sizes > 1, sizes)]
        h *= 2
    return order


def common_prefixes(symbols: np.ndarray, order: np.ndarray, starts: np.ndarray, sizes: np.ndarray, most: int) -> np.ndarray:
    """Per suffix the symbols it shares with the one before it in order, up to ``most``.

    Kasai: the next suffix of a text shares at least one less, given that all suffixes
    are fully sorted. The scan takes one step in every piece at a time; a separator,
    unlike all others, ends each piece.
    """
    n = len(symbols)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    shared = np.zeros(n, np.int64)
    padded = np.append(symbols, np.full(most + 1, -1, symbols.dtype))
    lane = np.argsort(-sizes, kind="stable")
    at, end = starts[lane].copy(), (starts + sizes)[lane]
    common = np.zeros(len(lane), np.int64)
    while len(at):
        prior = before[at]
        more = (prior >= 0) & (common < most)
        more &= padded[at + common] == padded[np.maximum(prior, 0) + common]
        common += more
        done = ~more
        shared[at[done]] = common[done]
        at = at + done
        common = np.where(done, np.maximum(common - 1, 0), common)
        live = at < end
        if not live.all():
            at, end, common = at[live], end[live], common[live]
    return shared


def repeated_windows(shard: list[bytes], length: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For each piece and window: whether it occurs elsewhere in the shard, and whether it is its first there."""
    sizes = np.asarray([len(p) for p in shard])
    starts = np.cumsum(sizes + 1) - sizes - 1
    symbols = np.zeros(int((sizes + 1).sum()), np.int32)
    for i, (a, p) in enumerate(zip(starts.tolist(), shard)):
        symbols[a : a + len(p)] = np.frombuffer(p, np.uint8)
        symbols[a + len(p)] = 256 + i
    # no tie is left beyond the longest piece; only in a full order may a prefix be carried on
    order = suffix_array(symbols, int(sizes.max(initial=0)) + 1)
    shared = common_prefixes(symbols, order, starts, sizes, length)
    hit = np.flatnonzero(shared[order] >= length)
    flags = np.zeros(len(symbols), bool)
    flags[order[hit]] = True
    flags[order[hit - 1]] = True
    spans = [(a, a + n - length + 1) for a, n in zip(starts.tolist(), sizes.tolist())]
    return [flags[a:b] for a, b in spans], [shared[a:b] < length for a, b in spans]


RUNS = "_k1 long, _k2 long, first long, last long, anchor long, rng int, run binary"
WINDOW = np.dtype([("f1", "<u8"), ("f2", "<u8"), ("k1", "<i8"), ("k2", "<i8"), ("at", "<i8")])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * 7
    kinds = [pa.int64()] * 5 + [pa.int32(), pa.binary()]
    names = ["_k1", "_k2", "first", "last", "anchor", "rng", "run"]
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds)], names)


def in_shards(gathered: DataFrame, length: int) -> DataFrame:
    """Runs of repeated windows in pieces that occur once, and what spread anchors' shards send on.

    ``gathered``: anchor, part, parts, lone, _k1, _k2, first, body.
    """

    def solve(held: list[tuple]) -> Iterator[tuple]:
        repeated, leads = repeated_windows([h[7] for h in held], length)
        spread: dict[tuple[int, int], list[np.ndarray]] = {}
        for (anchor, _, parts, lone, k1, k2, first, body), hit, lead in zip(held, repeated, leads):
            if lone:
                for a, b in zip(*runs_of(hit)):
                    yield k1, k2, first + int(a), first + int(b), None, None, None
            if parts > 1:
                data = np.frombuffer(body, np.uint8)
                at = np.flatnonzero(lead)
                rows = np.empty(len(at), WINDOW)
                rows["f1"], rows["f2"] = (Sums(data, k).of(at, at + length) for k in (1, 2))
                rows["k1"], rows["k2"], rows["at"] = k1, k2, at + first
                spread.setdefault((anchor, parts), []).append(rows)
        for (anchor, parts), found in spread.items():
            rows = np.concatenate(found)
            rows = rows[np.argsort(rows["f1"], kind="stable")]
            bits = max(0, (parts * SHARD_PIECES * length // MERGE_WINDOWS).bit_length())
            rng = (rows["f1"] >> np.uint64(63 - bits) >> np.uint64(1)).astype(np.int64)
            edge = np.flatnonzero(np.append(True, rng[1:] != rng[:-1]))
            for a, b in zip(edge, np.append(edge[1:], len(rows))):
                yield None, None, None, None, anchor, int(rng[a]), rows[a:b].tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, at, out = 0, None, []
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(8))):
                if row[:2] != at and size >= SHARD_BYTES:
                    out.extend(solve(held))
                    held, size = [], 0
                    if len(out) > 2_000:
                        yield _batch(out)
                        out = []
                at = row[:2]
                held.append(row)
                size += len(row[7])
        if held:
            out.extend(solve(held))
        yield _batch(out)

    names = ["anchor", "part", "parts", "lone", "_k1", "_k2", "first", "body"]
    return (
        gathered.select(names)
        .repartition(partitions(gathered.sparkSession), "anchor", "part")
        .sortWithinPartitions("anchor", "part")
        .mapInArrow(run, RUNS)
    )


def across_shards(sent: DataFrame) -> DataFrame:
    """Windows found in more than one shard of an anchor: the shards' sorted runs, merged by binary search."""

    def merge(runs: list[bytes]) -> Iterator[tuple]:
        merged = np.frombuffer(runs[0], WINDOW)
        hit = np.zeros(len(merged), bool)
        for data in runs[1:]:
            other = np.frombuffer(data, WINDOW)
            # a fingerprint's first half orders the runs; few rows share one
            at = np.searchsorted(merged["f1"], other["f1"], "left")
            end = np.searchsorted(merged["f1"], other["f1"], "right")
            same = np.zeros(len(other), bool)
            for step in range(int((end - at).max(initial=0))):
                near = np.flatnonzero(at + step < end)
                near = near[merged["f2"][at[near] + step] == other["f2"][near]]
                same[near] = True
                hit[at[near] + step] = True
            both = np.concatenate([merged, other])
            order = np.argsort(both["f1"], kind="stable")
            merged, hit = both[order], np.concatenate([hit, same])[order]
        for k1, k2, at in merged[hit][["k1", "k2", "at"]].tolist():
            yield k1, k2, at, at, None, None, None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, out = None, [], []
        for batch in batches:
            for anchor, rng, data in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if (anchor, rng) != at and held:
                    out.extend(merge(held))
                    held = []
                    if len(out) > 20_000:
                        yield _batch(out)
                        out = []
                at = (anchor, rng)
                held.append(data)
        if held:
            out.extend(merge(held))
        yield _batch(out)

    return (
        sent.select("anchor", "rng", "run")
        .repartition(partitions(sent.sparkSession), "anchor", "rng")
        .sortWithinPartitions("anchor", "rng")
        .mapInArrow(run, RUNS)
    )


def bodies(keyed: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The bytes of the wanted pieces: one row per piece, read once per document."""
    by_doc = wanted.groupBy(*KEY).agg(
        F.collect_list(F.struct("first", "last", "anchor", "part", "parts", "lone")).alias("_wanted")
    )
    by_doc = by_doc.hint("shuffle_hash")
    cut_out = F.transform(
        "_wanted",
        lambda w: F.struct(
            *(w[c].alias(c) for c in ("anchor", "part", "parts", "lone", "first")),
            F.substring(
                F.col("_text").cast("binary"),
                (w["first"] + 1).cast("int"),
                (w["last"] - w["first"] + length).cast("int"),
            ).alias("body"),
        ),
    )
    return keyed.join(by_doc, list(KEY)).select(*KEY, F.inline(cut_out))


def repeated_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, length: int = LENGTH
) -> DataFrame:
    """Row key and ``spans``, a sorted array of (start, end) in bytes, for documents with any."""
    keyed = docs.select(
        *(c.alias(k) for k, c in row_key(id_col, text_col).items()),
        F.coalesce(F.col(text_col), F.lit("")).alias("_text"),
    )
    found = staged(pieces(keyed, length), "pieces")
    anchored = found.where("anchor is not null")
    live = (
        anchored.groupBy("anchor")
        .agg(F.sum("times").alias("n"), F.min("h1").alias("lo"), F.max("h1").alias("hi"))
        .where("n > 1")
        .select("anchor", (F.col("lo") != F.col("hi")).alias("mixed"))
    )
    shared = staged(anchored.join(live, "anchor"), "shared-pieces")
    kind = ["anchor", "h1", "h2"]
    kinds = staged(
        shared.groupBy(*kind).agg(
            F.sum("times").alias("n"),
            F.max("mixed").alias("mixed"),
            F.min(F.struct(*KEY, "first", "last")).alias("_one"),
        ),
        "kinds",
    )
    whole = shared.join(kinds.where("n > 1").select(kind), kind).select(*KEY, "first", "last")
    # anchors with a piece that occurs once beside others
    mixed = kinds.where("mixed")
    open_anchors = (
        mixed.groupBy("anchor")
        .agg(F.count(F.lit(1)).alias("_kinds"), F.min("n").alias("_least"))
        .where("_least = 1")
        .select("anchor", F.ceil(F.col("_kinds") / SHARD_PIECES).cast("int").alias("parts"))
    )
    wanted = staged(
        mixed.join(open_anchors, "anchor").select(
            "anchor",
            F.pmod("h2", F.col("parts").cast("long")).cast("int").alias("part"),
            "parts",
            (F.col("n") == 1).alias("lone"),
            "_one.*",
        ),
        "open-pieces",
    )
    solved = staged(in_shards(bodies(keyed, wanted, length), length), "shard-runs")
    crossed = across_shards(solved.where("run is not null"))
    place = [*KEY, "first", "last"]
    runs = (
        found.where("anchor is null").select(place)
        .unionByName(whole)
        .unionByName(solved.where("run is null").select(place))
        .unionByName(crossed.select(place))
    )
    runs = runs.withColumn("end", F.col("last") + length).drop("last")
    by_place = Window.partitionBy(*KEY).orderBy("first", "end")
    reached = F.max("end").over(by_place.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(reached.isNull() | (F.col("first") > reached), 1).otherwise(0)
    return (
        runs.withColumn("_new", new)
        .withColumn("_island", F.sum("_new").over(by_place.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*KEY, "_island")
        .agg(F.min("first").alias("start"), F.max("end").alias("end"))
        .groupBy(*KEY)
        .agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))
    )


def without_spans(
    docs: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``row`` (the document's columns), ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept``, the remaining bytes."""
    raw = "cast(coalesce(_text, '') AS binary)"
    kept = F.expr(
        f"aggregate(spans, named_struct('at', 0L, 'out', cast('' AS binary)), (s, x) -> named_struct("
        f" 'at', x.end, 'out', concat(s.out, substring({raw}, int(s.at) + 1, int(x.start - s.at)))),"
        f" s -> concat(s.out, substring({raw}, int(s.at) + 1)))"
    )
    return (
        carried(docs, id_col, text_col)
        .join(spans.hint("shuffle_hash"), list(KEY), "left")
        .select(
            "row",
            F.octet_length(F.coalesce("_text", F.lit(""))).cast("long").alias("n_bytes"),
            F.expr("coalesce(aggregate(spans, 0L, (n, x) -> n + x.end - x.start), 0L)").alias("n_removed"),
            F.coalesce(F.size("spans"), F.lit(0)).cast("long").alias("n_spans"),
            F.when(F.col("spans").isNull(), F.expr(raw)).otherwise(kept).alias("kept"),
        )
    )
