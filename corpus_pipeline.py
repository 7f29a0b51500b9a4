"""From raw documents to packed sequences, in five stages over whole tables.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and
read again as the next one's ``docs``. All but the last return the columns of
``documents``. Null and empty texts and texts without a letter leave in the first
stage; an empty table passes through all of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hylle.llm import decontaminate, language_id, line_dedup, ngram_join, packing
from hylle.llm.common import KEY, read, staged, without_keys
from hylle.llm.queries import tokenizer_path


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that are unlike all languages learned from the documents themselves."""
    rejected = language_id.identify(docs).where("rejected").select(*KEY).distinct()
    rejected = staged(rejected, "rejected")
    return without_keys(docs, rejected, "doc_id", "text")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts lines that ten documents or more have."""
    found = line_dedup.with_kept_text(docs, line_dedup.line_bitmaps(docs, min_docs=10))
    changed = F.col("n_dropped") > 0
    own = found.withColumn(
        "row",
        F.col("row")
        .withField("n_chars", F.when(changed, F.length("kept").cast("long")).otherwise(F.col("row.n_chars")))
        .withField("text", F.when(changed, F.col("kept")).otherwise(F.col("row.text"))),
    )
    return own.select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group linked by five-word shingles at 0.8 or more."""
    found = staged(ngram_join.join(docs), "near-duplicates")
    return ngram_join.one_per_group(docs, found)


def drop_benchmark_overlaps(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a passage of the benchmark."""
    found = staged(decontaminate.overlaps(docs, read(spark, sf_dir, "benchmark")), "overlaps")
    return decontaminate.without_overlaps(docs, found)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of 2048 tokens at most, with the sequence that holds each."""
    return packing.pack(packing.pieces(docs, tokenizer_path()))


STAGES = [
    ("language_id", identify_languages),
    ("line_dedup", drop_repeated_lines),
    ("ngram_join", drop_near_duplicates),
    ("decontaminate", drop_benchmark_overlaps),
    ("packing", pack_sequences),
]

# Character models have no SQL form; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
