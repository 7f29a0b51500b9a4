"""Benchmark passages in documents, by spaced seeds over tokens.

Tokens are lower-case runs of letters and digits. A seed looks at a window of
twelve tokens through a mask that ignores every third one; the three masks are the
three shifts, so any one substitution in a window is ignored by one of them. All
windows of the benchmark and of the documents are hashed and joined. A hit fixes an alignment (document, item, shift); the alignment is then
scored over the item's whole length: +1 for an equal token, -1 for another, best
run. Alignments with a score of at least ``min_score`` are overlaps.

The benchmark's seeds are broadcast while they are few (checked); beyond that both
sides are shuffled by hash. Document tokens never leave their row until hits are
known, and then only documents with hits are read again.

Defined cases: null or empty texts and texts of fewer than twelve tokens have no
seeds; so have items of fewer than twelve tokens; repeated rows are each reported;
of equal scores the smaller shift is reported; nothing is found with an empty
benchmark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hylle.llm.common import KEY, fits, row_key, staged, without_keys

SPAN = 12
MASKS = tuple(tuple(t for t in range(SPAN) if t % 3 != skipped) for skipped in (2, 1, 0))
BROADCAST_ROWS = 300_000


def tokens(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def token_hashes(text: Column) -> Column:
    return F.transform(tokens(text), lambda w: F.xxhash64(w))


def seeds(hashes: str) -> Column:
    """(at, hash) for each mask and window of an array column of token hashes."""
    masked = ", ".join(
        f"xxhash64({m}, " + ", ".join(f"{hashes}[i + {t}]" for t in mask) + ")"
        for m, mask in enumerate(MASKS)
    )
    return F.expr(
        f"transform(if(size({hashes}) < {SPAN}, array(), sequence(0, size({hashes}) - {SPAN})),"
        f" i -> struct(i AS at, array({masked}) AS masked))"
    )


def overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    *,
    min_score: int = 12,
) -> DataFrame:
    """One row per document row and item that overlap: id, row key, ``_item``, ``_shift``, ``_score``, ``_matched``."""
    items = benchmark.select(
        F.col(item_col).alias("_item"), token_hashes(F.col(item_text_col)).alias("_item_tokens")
    ).where(F.size("_item_tokens") >= SPAN)
    item_seeds = staged(
        items.select("_item", F.inline(seeds("_item_tokens")).alias("_item_at", "_masked")).select(
            "_item", "_item_at", F.explode("_masked").alias("_seed")
        ),
        "item-seeds",
    )
    few = fits(item_seeds, BROADCAST_ROWS)
    keyed = docs.select(
        F.col(id_col).alias("_id"),
        *(c.alias(k) for k, c in row_key(id_col, text_col).items()),
        F.col(text_col).alias("_text"),
    )
    hits = (
        keyed.select(*KEY, token_hashes(F.col("_text")).alias("_tokens"))
        .select(*KEY, F.inline(seeds("_tokens")).alias("_at", "_masked"))
        .select(*KEY, "_at", F.explode("_masked").alias("_seed"))
        .join(F.broadcast(item_seeds) if few else item_seeds, "_seed")
        .select(*KEY, "_item", (F.col("_at") - F.col("_item_at")).alias("_shift"))
        .distinct()
    )
    hits = staged(hits, "seed-hits")
    items = items.withColumn("_length", F.size("_item_tokens"))
    lengths = items.select("_item", "_length").distinct()
    # three numbers an alignment; the item's tokens are looked up where it is scored
    aligned = (
        hits.join(F.broadcast(lengths) if few else lengths, "_item")
        .groupBy(*KEY)
        .agg(F.collect_list(F.struct("_item", "_shift", "_length")).alias("_aligned"))
    )
    if fits(hits, BROADCAST_ROWS // 10):
        aligned = F.broadcast(aligned)
    # only what the alignments touch goes on with each of them, never the whole text
    touched = F.transform(
        "_aligned",
        lambda a: F.struct(
            a["_item"].alias("_item"),
            a["_shift"].alias("_shift"),
            a["_length"].alias("_length"),
            F.greatest(a["_shift"], F.lit(0)).alias("_from"),
            F.slice(
                F.col("_tokens"),
                F.greatest(a["_shift"], F.lit(0)) + 1,
                F.greatest(a["_length"] + F.least(a["_shift"], F.lit(0)), F.lit(0)),
            ).alias("_part"),
        ),
    )
    return (
        keyed.join(aligned, list(KEY))
        .select("_id", *KEY, token_hashes(F.col("_text")).alias("_tokens"), "_aligned")
        .select("_id", *KEY, F.inline(touched))
        .join(F.broadcast(items) if few else items, ["_item", "_length"])
        .select(
            "_id",
            *KEY,
            "_item",
            "_shift",
            F.expr(best_run_of("_part", "_item_tokens", "_shift - _from")).alias("_found"),
        )
        .where(F.col("_found.best") >= min_score)
        .groupBy("_id", *KEY, "_item")
        .agg(
            F.min(
                F.struct(
                    (-F.col("_found.best")).alias("worst"),
                    F.col("_shift").alias("shift"),
                    F.col("_found.matched").alias("matched"),
                )
            ).alias("_best")
        )
        .select(
            F.col("_id").alias(id_col),
            *KEY,
            "_item",
            F.col("_best.shift").alias("_shift"),
            (-F.col("_best.worst")).alias("_score"),
            F.col("_best.matched").alias("_matched"),
        )
    )


def best_run_of(part: str, item: str, shift: str) -> str:
    """SQL for the best run of an alignment: token t of the item against t + shift of the part."""
    step = f"if(get({part}, t + {shift}) <=> {item}[t], 1, -1)"
    return (
        f"aggregate(sequence(0, size({item}) - 1), named_struct('run', 0, 'best', 0, 'matched', 0),"
        f" (s, t) -> named_struct('run', greatest(0, s.run + {step}), 'best', greatest(s.best, s.run + {step}),"
        f" 'matched', s.matched + greatest(0, {step})))"
    )


def without_overlaps(
    docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The documents that no benchmark item overlaps, all columns as they were."""
    return without_keys(docs, found, id_col, text_col)
