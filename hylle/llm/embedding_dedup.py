"""Near-duplicate vectors by counting collisions of one-dimensional projections.

Vectors are compared only within a label. Each is scaled to length one and projected
on ``PROJECTIONS`` random directions. Two vectors at the threshold are at most
d = sqrt(2 - 2 t) apart, so their projections on one direction differ by a normal
number of deviation d: in a window of half-width d around the query they collide
with probability 0.68, unrelated vectors with about 0.2. A pair is a candidate if it
collides in at least ``least`` windows, the largest number that keeps the target
recall (binomial tail), and is then verified by its cosine in double precision.

Rows are sorted by (label, first projection) over ranges and cut into blocks, which
are cut again by the second projection. Blocks whose spans in either projection are
further apart than ``REACH`` d never meet. Any two other blocks of a label are one
task: it sorts the projections, finds each query's window by binary search, adds the
collisions up and verifies the candidates. Blocks have a fixed size, so a label that
is a third of all rows is many tasks; equal vectors are one member with a count. The
number of tasks grows with the square of a label's distinct vectors, less what the
spans rule out: the price of counting links exactly in large groups.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components, and rows without a label, link with nothing; vectors of different
lengths are never linked; rows with one id are separate vectors; null ids are no
component's id while others have one; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hylle.llm.common import partitions, staged
from hylle.llm.graph import connected_components
from hylle.llm.pairs import tally

PROJECTIONS = 40
BLOCK, SLABS = 512, 8
REACH = 3.3
HIT = 0.6827  # share of a normal distribution within one deviation


def least_collisions(recall: float, projections: int = PROJECTIONS) -> int:
    """The most collisions that may be asked of a pair at the threshold for the target recall."""
    tail, least = 0.0, projections + 1
    while tail < recall and least > 0:
        least -= 1
        tail += comb(projections, least) * HIT**least * (1 - HIT) ** (projections - least)
    return least


def directions(dim: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64([dim, PROJECTIONS])).standard_normal((dim, PROJECTIONS))


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one in double precision, first by their largest component."""
    x = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def classes(rows: DataFrame) -> DataFrame:
    """(id, label, vec) rows with ``cls``, null where the vector links with nothing."""
    names = [*rows.columns, "cls"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = []
            for label, vec in zip(batch.column(1).to_pylist(), batch.column(2)):
                key = None
                if label is not None and vec.is_valid and len(vec.values) and not vec.values.null_count:
                    x = vec.values.to_numpy().astype(np.float64) + 0.0  # one zero
                    if np.isfinite(x).all() and x.any():
                        key = hashlib.blake2b(f"{label}:".encode() + x.tobytes(), digest_size=16).digest()
                keys.append(key)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.binary())], names)

    schema = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes)
    return rows.mapInArrow(run, f"{schema}, cls binary")


def projected(members: DataFrame) -> DataFrame:
    """``members`` (cls, copies, grp, vec) with the vector's first two projections."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(batch.schema.get_field_index("vec"))
            at = np.zeros((batch.num_rows, 2))
            lengths = np.asarray([len(v.values) for v in vectors])
            for dim in set(lengths.tolist()):
                own = np.flatnonzero(lengths == dim)
                x = np.stack([vectors[int(i)].values.to_numpy() for i in own]).astype(np.float64)
                at[own] = unit(x) @ directions(dim)[:, :2]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(at[:, 0]), pa.array(at[:, 1])], [*batch.schema.names, "p0", "p1"]
            )

    schema = ", ".join(f"`{n}` {t}" for n, t in members.dtypes)
    return members.mapInArrow(run, f"{schema}, p0 double, p1 double")


def blocked(members: DataFrame) -> DataFrame:
    """``members`` with a block number, unique over all, of at most BLOCK rows of one group."""
    names = members.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, used = TaskContext.get().partitionId() << 32, 0
        held: list[pa.Table] = []
        rows, at = 0, None

        def cut(table: pa.Table, used: int) -> tuple[pa.RecordBatch, int]:
            table = table.take(pa.array(np.argsort(table.column("p1").to_numpy(), kind="stable")))
            block = np.arange(table.num_rows) // BLOCK + used + task
            table = table.append_column("block", pa.array(block))
            return table.combine_chunks().to_batches()[0], used + -(-table.num_rows // BLOCK)

        for batch in batches:
            groups = np.asarray(batch.column(batch.schema.get_field_index("grp")).to_pylist(), object)
            edges = [0, *(np.flatnonzero(groups[1:] != groups[:-1]) + 1).tolist(), len(groups)]
            for a, b in zip(edges[:-1], edges[1:]):
                while a < b:
                    if held and (groups[a] != at or rows == BLOCK * SLABS):
                        out, used = cut(pa.concat_tables(held), used)
                        yield out
                        held, rows = [], 0
                    n = min(b - a, BLOCK * SLABS - rows)
                    held.append(pa.Table.from_batches([batch.slice(a, n)]))
                    at, rows, a = groups[a], rows + n, a + n
        if held:
            yield cut(pa.concat_tables(held), used)[0]

    schema = ", ".join(f"`{n}` {t}" for n, t in members.dtypes)
    return (
        members.repartitionByRange(partitions(members.sparkSession), "grp", "p0", "cls")
        .sortWithinPartitions("grp", "p0", "cls")
        .select(names)
        .mapInArrow(run, f"{schema}, block long")
    )


def collisions(a: np.ndarray, b: np.ndarray, width: float) -> np.ndarray:
    """How many of the projections of each row of ``b`` lie in the window around each row of ``a``."""
    total = np.zeros((len(a), len(b)), np.int16)
    rows = np.arange(len(a))
    for j in range(a.shape[1]):
        order = np.argsort(b[:, j])
        column = b[order, j]
        step = np.zeros((len(a), len(b) + 1), np.int8)
        step[rows, np.searchsorted(column, a[:, j] - width, "left")] += 1
        np.subtract.at(step, (rows, np.searchsorted(column, a[:, j] + width, "right")), 1)
        inside = np.cumsum(step, axis=1, dtype=np.int8)[:, :-1]
        back = np.empty_like(order)
        back[order] = np.arange(len(order))
        total += inside[:, back]
    return total


def compared(tasks: DataFrame, *, threshold: float, recall: float) -> DataFrame:
    """(cls, links, head) from rows of (lo, hi, block, cls, copies, vec)."""
    width, least = float(np.sqrt(2 - 2 * threshold)), least_collisions(recall)

    def pair(held: list[tuple]) -> Iterator[tuple[bytes, int, bytes]]:
        lo, hi = held[0][:2]
        keys = [h[3] for h in held]
        copies = np.asarray([h[4] for h in held], np.int64)
        block = np.asarray([h[2] for h in held])
        x = unit(np.stack([h[5] for h in held]).astype(np.float64))
        p = x @ directions(x.shape[1])
        left = np.flatnonzero(block == lo)
        right = left if lo == hi else np.flatnonzero(block == hi)
        if not len(left) or not len(right):
            return
        linked = np.zeros((len(left), len(right)), bool)
        i, j = np.nonzero(collisions(p[left], p[right], width) >= least)
        if lo == hi:
            i, j = i[i != j], j[i != j]
        linked[i, j] = np.einsum("ij,ij->i", x[left[i]], x[right[j]]) >= threshold
        if lo == hi:
            linked |= linked.T
        yield from tally(keys, copies, left, right, linked)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, found = None, [], []

        def packed() -> pa.RecordBatch:
            a, b, c = zip(*found) if found else ((), (), ())
            return pa.record_batch(
                [pa.array(a, pa.binary()), pa.array(b, pa.int64()), pa.array(c, pa.binary())], ["cls", "links", "head"]
            )

        for batch in batches:
            lo, hi, block, cls, copies = (batch.column(i).to_pylist() for i in range(5))
            for k, vec in enumerate(batch.column(5)):
                if (lo[k], hi[k]) != at and held:
                    found.extend(pair(held))
                    held = []
                    if len(found) > 10_000:
                        yield packed()
                        found = []
                at = (lo[k], hi[k])
                held.append((lo[k], hi[k], block[k], cls[k], copies[k], vec.values.to_numpy()))
        if held:
            found.extend(pair(held))
        yield packed()

    return (
        tasks.select("lo", "hi", "block", "cls", "copies", "vec")
        .repartition(partitions(tasks.sparkSession), "lo", "hi")
        .sortWithinPartitions("lo", "hi")
        .mapInArrow(run, "cls binary, links long, head binary")
    )


def near_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
    *,
    threshold: float = 0.93,
    recall: float = 0.999,
) -> DataFrame:
    """Per row: id, ``n_links``, ``component_id`` (least id reachable) and ``kept`` (id is that)."""
    rows = vectors.select(
        F.col(id_col).alias("id"), F.col(label_col).cast("string").alias("label"), F.col(vec_col).alias("vec")
    )
    rows = staged(classes(rows), "vectors")
    members = (
        rows.where(F.col("cls").isNotNull())
        .groupBy("cls")
        .agg(
            F.count(F.lit(1)).alias("copies"),
            F.min(F.struct(F.col("id").isNull().alias("no_id"), "id")).alias("_least"),
            F.first("label").alias("label"),
            F.first("vec").alias("vec"),
        )
        .select("cls", "copies", "_least", F.concat_ws(":", F.size("vec"), "label").alias("grp"), "vec")
    )
    members = staged(projected(members), "projected")
    blocks = staged(blocked(members.drop("_least")), "blocks")
    spans = blocks.groupBy("grp", "block").agg(
        *(f(c).alias(f"{n}_{c}") for c in ("p0", "p1") for n, f in (("lo", F.min), ("hi", F.max)))
    )
    spans = staged(spans, "spans")
    far = REACH * float(np.sqrt(2 - 2 * threshold))
    other = spans.select("grp", *(F.col(c).alias(f"o_{c}") for c in spans.columns if c != "grp"))
    met = spans.join(other, "grp").where(
        " and ".join(
            ["block <= o_block", *(f"lo_{c} - o_hi_{c} <= {far} and o_lo_{c} - hi_{c} <= {far}" for c in ("p0", "p1"))]
        )
    )
    met = met.select(F.col("block").alias("lo"), F.col("o_block").alias("hi"))
    sides = met.select("lo", "hi", F.explode(F.array_distinct(F.array("lo", "hi"))).alias("block"))
    linked = staged(compared(blocks.join(sides, "block"), threshold=threshold, recall=recall), "vector-links")
    heads = connected_components(linked, "cls", "head")
    found = (
        members.select("cls", "copies", "_least")
        .join(linked.groupBy("cls").agg(F.sum("links").alias("_links")), "cls", "left")
        .join(heads.withColumnRenamed("node", "cls"), "cls", "left")
        .withColumn("root", F.coalesce("root", "cls"))
    )
    found = staged(found, "vector-results")
    least = found.groupBy("root").agg(F.min("_least").alias("_of_all"))
    found = found.join(least, "root").select(
        "cls", (F.coalesce("_links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "_of_all"
    )
    out = rows.select("id", "cls").join(found, "cls", "left")
    return out.select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.when(F.col("cls").isNull(), F.col("id")).otherwise(F.col("_of_all.id")).alias("component_id"),
    ).withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))
