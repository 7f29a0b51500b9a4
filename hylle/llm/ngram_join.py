"""Jaccard similarity join of documents over word n-grams, by a MinHash forest.

1. One pass makes each document's set of five-word shingles and from it an exact
   class key (copies share it), and ``TREES`` labels of ``DEPTH`` MinHash values.
2. A label is a path in a prefix trie. The paths are shortened, one value at a
   time, until a pair at the threshold shares a prefix in at least one tree with
   the target recall. Documents with the same prefix are linked to the least one
   of them, and the components of these links are the candidate groups: every
   pair that shares a prefix anywhere lies in one group.
3. Each group's texts are read once and compared exactly. Groups are split into
   blocks by number and size and each pair of blocks is a task of its own, so a
   group of any size spreads out. A task counts common shingles as a product of
   0/1 matrices and returns one row per document, never one per pair.

Words are runs of characters other than ASCII blanks, in lower case. A text of one
to four words has one shingle, all its words.

Defined cases: texts that are null or have no words link with nothing; rows with
the same id and text are separate rows of one class and count as each other's
links; the row with the least id is kept, null ids last, ties by the row's hash;
equal similarity to the threshold counts as a link; no rows give no rows; other
columns are not touched and may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hylle.llm.common import KEY, carried, fits, partitions, row_key, staged
from hylle.llm.graph import connected_components

TREES, DEPTH = 32, 8
CHUNK = 1_000_000
# A block of a candidate group: documents and shingles; bounds what one task holds.
BLOCK_DOCS, BLOCK_SHINGLES = 200, 500_000
COLUMNS = 4096
BROADCAST_ROWS = 100_000


def prefix_depth(threshold: float, recall: float, trees: int = TREES, depth: int = DEPTH) -> int:
    """The longest prefix at which a pair at the threshold is met with the target recall."""
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < recall:
        depth -= 1
    return depth


def _numbers(seed: int, n: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).integers(0, 2**63, n, np.uint64) * np.uint64(2) + np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


class Shingler:
    """Sets of hashed word n-grams of many texts at once."""

    def __init__(self, n: int = 5) -> None:
        self.n = n
        self.bytes = _numbers(1, 256)
        base = _numbers(2, 1)[0]
        inverse = np.uint64(pow(int(base), -1, 1 << 64))
        self.base, self.inverse = base, inverse
        self.up, self.down = np.ones(1, np.uint64), np.ones(1, np.uint64)
        self.places = _numbers(3, n + 1)
        self.blank = np.zeros(256, bool)
        self.blank[[9, 10, 11, 12, 13, 32]] = True

    def _powers(self, n: int) -> None:
        if len(self.up) < n:
            for name, base in (("up", self.base), ("down", self.inverse)):
                p = np.full(n, base, np.uint64)
                p[0] = 1
                setattr(self, name, np.multiply.accumulate(p))

    def words(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hash and first byte of each word."""
        if not len(data):
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        word = ~self.blank[data]
        edge = np.flatnonzero(np.diff(np.concatenate(([False], word, [False]))))
        first, end = edge[::2], edge[1::2]
        self._powers(len(data) + 1)
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.bytes[data] * self.up[: len(data)], out=total[1:])
        return _mix((total[end] - total[first]) * self.down[first] + (end - first).astype(np.uint64)), first

    def sets(self, texts: list[str | None]) -> list[np.ndarray]:
        """For each text its distinct shingle hashes in order."""
        out, held, size = [], [], 0
        for text in texts:
            data = (text or "").lower().encode("utf-8", "replace")
            held.append(data)
            size += len(data)
            if size >= CHUNK:
                out += self._sets(held)
                held, size = [], 0
        return out + self._sets(held)

    def _sets(self, texts: list[bytes]) -> list[np.ndarray]:
        if not texts:
            return []
        data = np.frombuffer(b"\n".join(texts), np.uint8)
        hashes, first = self.words(data)
        starts = np.cumsum([0] + [len(t) + 1 for t in texts])
        bounds = np.searchsorted(first, starts)
        count = np.diff(bounds)
        left = np.repeat(bounds[1:], count) - np.arange(len(hashes))  # words from here to the text's end
        mixed = np.zeros(len(hashes), np.uint64)
        for k in range(min(self.n, len(hashes))):
            term = np.zeros(len(hashes), np.uint64)
            term[: len(hashes) - k] = hashes[k:] * self.places[k]
            term[left <= k] = 0
            mixed += term
        mixed = _mix(mixed + np.minimum(left, self.n).astype(np.uint64) * self.places[self.n])
        return [np.unique(mixed[a : max(b - self.n + 1, min(a + 1, b))]) for a, b in zip(bounds[:-1], bounds[1:])]


def labels(sets: list[np.ndarray], depth: int) -> np.ndarray:
    """For each set, the hash of its prefix of ``depth`` MinHash values in every tree."""
    full = [i for i, s in enumerate(sets) if len(s)]
    out = np.zeros((len(sets), TREES), np.uint64)
    if not full:
        return out
    factors, shifts = _numbers(4, TREES * DEPTH), _numbers(5, TREES * DEPTH)
    held: list[int] = []
    size = 0
    for i in [*full, -1]:
        if i >= 0:
            held.append(i)
            size += len(sets[i])
            if size < 1 << 17 and i != full[-1]:
                continue
        if not held:
            continue
        x = np.concatenate([sets[j] for j in held])
        starts = np.cumsum([0] + [len(sets[j]) for j in held[:-1]])
        work = np.empty_like(x)
        for tree in range(TREES):
            path = np.full(len(held), np.uint64(tree + 1))
            for level in range(depth):
                k = tree * DEPTH + level
                np.multiply(x, factors[k], out=work)
                np.add(work, shifts[k], out=work)
                path = _mix(path * np.uint64(0x9E3779B97F4A7C15) + np.minimum.reduceat(work, starts))
            out[held, tree] = path
        held, size = [], 0
    return out


def sketches(docs: DataFrame, id_col: str, text_col: str, *, n: int, depth: int) -> DataFrame:
    """Per row: row key, id, class key (null without words), number of shingles, labels."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(n)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                sets = shingler.sets(part.column(3).to_pylist())
                classes = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                found = labels(sets, depth).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(i) for i in range(3)),
                        pa.array(classes, pa.binary()),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.ListArray.from_arrays(
                            pa.array(np.arange(0, found.size + 1, TREES), pa.int32()), pa.array(found.ravel())
                        ),
                    ],
                    [*KEY, "id", "cls", "shingles", "labels"],
                )

    rows = docs.select(
        *(c.alias(k) for k, c in row_key(id_col, text_col).items()),
        F.col(id_col).alias("id"),
        F.col(text_col).alias("text"),
    )
    kind = dict(rows.dtypes)["id"]
    return rows.mapInArrow(
        run, f"_k1 long, _k2 long, id {kind}, cls binary, shingles long, labels array<long>"
    )


def candidate_groups(classes: DataFrame) -> DataFrame:
    """(node, root) of classes that share a prefix with another; ``node`` numbers a class."""
    paths = classes.select("node", F.explode("labels").alias("label"))
    hubs = (
        paths.groupBy("label")
        .agg(F.min("node").alias("hub"), F.max("node").alias("last"))
        .where("hub <> last")
        .select("label", "hub")
    )
    return connected_components(paths.join(hubs, "label").select("node", "hub"), "node", "hub")


def _links(mine: list[np.ndarray], other: list[np.ndarray], threshold: float) -> np.ndarray:
    """Whether each set of one list and each of the other are similar enough."""
    both = mine + other
    column = np.unique(np.concatenate(both), return_inverse=True)[1]
    row = np.repeat(np.arange(len(both)), [len(s) for s in both])
    seen = np.bincount(column)
    keep = seen[column] > 1
    row, column = row[keep], (np.cumsum(seen > 1) - 1)[column[keep]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    common = np.zeros((len(mine), len(other)), np.float64)
    width = int(column[-1]) + 1 if len(column) else 0
    for at in range(0, width, COLUMNS):
        a, b = np.searchsorted(column, [at, at + COLUMNS])
        dense = np.zeros((len(both), min(COLUMNS, width - at)), np.float32)
        dense[row[a:b], column[a:b] - at] = 1
        common += dense[: len(mine)] @ dense[len(mine) :].T
    sizes = np.asarray([len(s) for s in both], np.float64)
    union = sizes[: len(mine), None] + sizes[None, len(mine) :] - common
    return common >= threshold * union - 1e-9


def verify(members: DataFrame, *, n: int, threshold: float) -> DataFrame:
    """(cls, links, head) per class and pair of blocks in which it has links.

    ``members`` has cls, copies, text, grp, block, blocks. ``links`` counts rows of
    other classes; ``head`` is the least class among those joined within the task.
    """
    tasks = members.withColumn("_x", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "grp",
        F.least("block", "_x").alias("lo"),
        F.greatest("block", "_x").alias("hi"),
        "block",
        "cls",
        "copies",
        "text",
    )

    def compare(rows: list[tuple], shingler: Shingler) -> Iterator[tuple[bytes, int, bytes]]:
        rows = list({r[0]: r for r in rows}.values())
        lo, hi = rows[0][3], rows[0][4]
        sets = shingler.sets([r[2] for r in rows])
        left = [i for i, r in enumerate(rows) if r[5] == lo]
        right = left if lo == hi else [i for i, r in enumerate(rows) if r[5] == hi]
        if not left or not right:
            return
        linked = _links([sets[i] for i in left], [sets[i] for i in right], threshold)
        if lo == hi:
            np.fill_diagonal(linked, False)
        copies = np.asarray([r[1] for r in rows], np.int64)
        total = np.zeros(len(rows), np.int64)
        total[left] += linked @ copies[right]
        if lo != hi:
            total[right] += linked.T @ copies[left]
        head = list(range(len(rows)))

        def top(i: int) -> int:
            while head[i] != i:
                head[i] = head[head[i]]
                i = head[i]
            return i

        for i, own in zip(left, linked):
            for j in np.flatnonzero(own).tolist():
                a, b = top(i), top(right[j])
                if a != b:
                    a, b = (a, b) if rows[a][0] < rows[b][0] else (b, a)
                    head[b] = a
        for i in np.flatnonzero(total).tolist():
            yield rows[i][0], int(total[i]), rows[top(i)][0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(n)

        def packed(found: list[tuple[bytes, int, bytes]]) -> pa.RecordBatch:
            a, b, c = zip(*found) if found else ((), (), ())
            return pa.record_batch(
                [pa.array(a, pa.binary()), pa.array(b, pa.int64()), pa.array(c, pa.binary())], ["cls", "links", "head"]
            )

        at, held, found = None, [], []
        for batch in batches:
            columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in
                       ("cls", "copies", "text", "lo", "hi", "block", "grp")]
            for row in zip(*columns):
                key = (row[6], row[3], row[4])
                if key != at and held:
                    found += compare(held, shingler)
                    held = []
                    if len(found) > 10_000:
                        yield packed(found)
                        found = []
                at = key
                held.append(row)
        if held:
            found += compare(held, shingler)
        yield packed(found)

    deal = ["grp", "lo", "hi"]
    return (
        tasks.repartition(partitions(members.sparkSession), *deal)
        .sortWithinPartitions(*deal)
        .mapInArrow(run, "cls binary, links long, head binary")
    )


def join(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    n: int = 5,
    threshold: float = 0.8,
    recall: float = 0.9999,
) -> DataFrame:
    """Per row: row key, id, ``cls``, ``copies``, ``n_links``, ``component_id``, ``kept``.

    ``n_links`` counts the other rows with similarity of ``threshold`` or more,
    copies included; ``component_id`` is the least id reachable by links; that id's
    row is kept.
    """
    rows = staged(sketches(docs, id_col, text_col, n=n, depth=prefix_depth(threshold, recall)), "sketches")
    worded = rows.where(F.col("cls").isNotNull())
    classes = staged(
        worded.groupBy("cls").agg(
            F.count(F.lit(1)).alias("copies"),
            F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", *KEY)).alias("_row"),
            F.first("shingles").alias("shingles"),
            F.first("labels").alias("labels"),
        ).withColumn("node", F.xxhash64("cls")),
        "classes",
    )
    groups = staged(candidate_groups(classes), "groups")
    members = groups.join(classes.drop("labels"), "node").withColumnRenamed("root", "grp")
    sizes = members.groupBy("grp").agg(
        F.greatest(
            F.ceil(F.count(F.lit(1)) / BLOCK_DOCS), F.ceil(F.sum("shingles") / BLOCK_SHINGLES)
        ).cast("int").alias("blocks")
    )
    members = staged(
        members.join(sizes, "grp").select(
            "grp", "cls", "copies", *(F.col(f"_row.{k}") for k in KEY), "blocks", F.expr("pmod(xxhash64(cls, 7), blocks)").cast("int").alias("block")
        ),
        "members",
    )
    wanted = F.broadcast(members) if fits(members, BROADCAST_ROWS) else members
    texts = docs.select(
        *(c.alias(k) for k, c in row_key(id_col, text_col).items()), F.col(text_col).alias("text")
    )
    linked = staged(verify(texts.join(wanted, list(KEY)), n=n, threshold=threshold), "class-links")
    heads = connected_components(linked, "cls", "head")
    found = (
        classes.select("cls", "copies", "_row")
        .join(linked.groupBy("cls").agg(F.sum("links").alias("_links")), "cls", "left")
        .join(heads.withColumnRenamed("node", "cls"), "cls", "left")
        .withColumn("root", F.coalesce("root", "cls"))
    )
    found = staged(found, "class-results")
    least = found.groupBy("root").agg(F.min("_row").alias("_least"))
    found = found.join(least, "root").select(
        "cls", "copies", (F.coalesce("_links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "_least"
    )
    out = rows.select(*KEY, "id", "cls").join(found, "cls", "left")
    wordless = F.col("cls").isNull()
    return out.select(
        *KEY,
        F.col("id").alias(id_col),
        "cls",
        F.coalesce("copies", F.lit(1)).alias("copies"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.when(wordless, F.col("id")).otherwise(F.col("_least.id")).alias("component_id"),
        (wordless | ((F.col("_least._k1") == F.col("_k1")) & (F.col("_least._k2") == F.col("_k2")))).alias("kept"),
    )


def one_per_group(
    docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The documents with one of each group, all columns as they were.

    ``found`` is what ``join`` gave for them. Only narrow keys are joined; texts move
    only for rows that repeat another one's id and text.
    """
    keyed = carried(docs, id_col, text_col)
    dropped = found.where("not kept").select(*KEY).distinct()
    repeated = found.where("kept").groupBy(*KEY).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    repeated = staged(repeated, "repeated-rows")
    stay = keyed.join(dropped, list(KEY), "left_anti")
    return (
        stay.join(repeated, list(KEY), "left_anti")
        .unionByName(stay.join(repeated, list(KEY), "left_semi").dropDuplicates(list(KEY)))
        .select("row.*")
    )
