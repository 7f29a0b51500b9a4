"""Run history: ids, start and end of runs, matching of run ids (SK6, SK7, JN4, JN5)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hylle import fixed_values as V
from hylle.functions.text import col, filled, has_text
from hylle.operators.dictionary import keyword_hits
from hylle.operators.filters import category_run_id
from hylle.schema import RUN_SCHEMA
from hylle.sources.codec import config_snapshot


def seeded_run_id(seed: Column | str) -> Column:
    """Twelve hex digits of the seed's hash; a random one without a seed."""
    random = F.md5(F.concat_ws("-", F.current_timestamp().cast("string"), F.uuid()))
    return F.substring(F.coalesce(F.md5(filled(seed)), random), 1, V.RUN_HASH_LENGTH)


def dated_run_id(run_id: Column | str, day: Column | None) -> Column:
    """yyyyMMdd_id, or the bare id without a day."""
    if day is None:
        return col(run_id)
    return F.concat_ws("_", F.date_format(day, "yyyyMMdd"), col(run_id))


def run_base(run_id: Column | str) -> Column:
    """Text before the first underscore, NULL if shorter than eight characters."""
    base = F.substring_index(col(run_id), "_", 1)
    return F.when(F.length(base) >= V.RUN_BASE_LENGTH, base)


def seconds_between(start: Column | str, end: Column | str) -> Column:
    return F.timestamp_diff("SECOND", col(start), col(end))


def first_by_prefix(stored: DataFrame, bases: DataFrame) -> DataFrame:
    """(base, prefix_match): the least stored id that starts with each base.

    A base has no underscore, so it can only start a stored id as a prefix of that
    id's own base. Listing those prefixes (one, for dated ids) turns the prefix
    rule into an equality, with the least id per prefix taken before the shuffle.
    """
    own = F.substring_index("run_id", "_", 1)
    lengths = F.when(
        F.length(own) >= V.RUN_BASE_LENGTH,
        F.sequence(F.lit(V.RUN_BASE_LENGTH), F.length(own)),
    )
    prefixes = stored.select(
        "run_id", F.explode(F.transform(lengths, lambda n: F.left(own, n))).alias("base")
    )
    least = prefixes.groupBy("base").agg(F.min("run_id").alias("prefix_match"))
    return least.join(bases, "base", "left_semi")


def first_by_suffix(stored: DataFrame, requests: DataFrame, among: DataFrame) -> DataFrame:
    """(run_id, suffix_match): the least stored id that ends like each requested id.

    ``among`` (run_id) holds the requests, and may hold more ids if it is cheaper to read.

    An underscore in the requested id stands for any one character. Requests are
    reduced to their shapes (length and places of underscores). A stored id gives
    its endings of the lengths asked for (a scalar subquery: the distinct lengths,
    few as ids are short), each is masked by the shapes of its length, and a
    request then equals the masked ending. Endings that nobody asks for go before
    anything is shuffled, where the requests are few enough to be sent to all tasks;
    the others are summed up to the least id. The work grows with stored ids times
    shapes, not requests.
    """
    shape = F.regexp_replace("run_id", "[^_]", "x")
    shapes = requests.select(shape.alias("shape")).distinct().select(
        F.length("shape").alias("size"),
        F.filter(
            F.sequence(F.lit(1), F.length("shape")),
            lambda i: F.substring("shape", i, F.lit(1)) == "_",
        ).alias("marks"),
    )
    sized = stored.withColumn("_sizes", shapes.agg(F.collect_set("size")).scalar())
    asked = F.filter("_sizes", lambda n: n <= F.length("run_id"))
    endings = sized.select("run_id", F.explode(asked).alias("size")).join(shapes, "size")
    masked = F.aggregate(
        "marks",
        F.right("run_id", F.col("size")),
        lambda text, mark: F.overlay(text, F.lit("_"), mark, F.lit(1)),
    )
    asked_for = among.select(F.col("run_id").alias("wanted"))
    hits = endings.select(masked.alias("wanted"), "run_id").join(asked_for, "wanted", "left_semi")
    return hits.groupBy("wanted").agg(F.min("run_id").alias("suffix_match")).select(
        F.col("wanted").alias("run_id"), "suffix_match"
    )


def first_by_pattern(stored: DataFrame, requests: DataFrame) -> DataFrame:
    """(run_id, suffix_match): the least stored id that ends like each requested pattern.

    In these ids a percent sign stands for any text and an underscore for any character.
    A pattern's longest literal piece must be in the id, so ids are joined with the pieces
    through their rarest grams and only those pairs are compared with the pattern. A
    pattern without a literal piece asks for a length alone, and lengths are few.
    """
    pieces = F.filter(F.split("run_id", "[%_]"), lambda p: p != "")
    longest = F.array_max(F.transform(pieces, lambda p: F.struct(F.length(p).alias("size"), p.alias("piece"))))
    patterns = requests.select(F.col("run_id").alias("pattern"), longest["piece"].alias("keyword"))
    ids = stored.select("run_id", F.col("run_id").alias("_text")).distinct()
    near = keyword_hits(ids, patterns.where("keyword is not null"), key="run_id", text="_text")
    like = F.like(F.col("run_id"), F.concat(F.lit("%"), F.col("pattern")), F.lit("\x01"))
    by_piece = near.where(like).groupBy("pattern").agg(F.min("run_id").alias("suffix_match"))
    by_size = stored.groupBy(F.length("run_id").alias("size")).agg(F.min("run_id").alias("least"))
    by_size = (
        by_size.select(F.explode(F.sequence(F.lit(0), "size")).alias("size"), "least")
        .groupBy("size")
        .agg(F.min("least").alias("suffix_match"))
    )
    bare = patterns.where("keyword is null").select("pattern", F.length(F.replace("pattern", F.lit("%"))).alias("size"))
    found = by_piece.unionByName(bare.join(by_size, "size").select("pattern", "suffix_match"))
    return found.withColumnRenamed("pattern", "run_id")


def match_run_ids(requests: DataFrame, runs: DataFrame) -> DataFrame:
    """(run_id, matched_run_id) per distinct requested id, for ids that match.

    Exact id first, then the least run of the same base, then the least run whose
    id ends like the requested one.
    """
    wanted = requests.select("run_id").where(F.col("run_id").isNotNull()).distinct()
    stored = runs.select("run_id")
    tried = with_exact_and_prefix(wanted, stored)
    open_ids = tried.where(
        F.col("matched_run_id").isNull() & F.col("run_id").contains("_")
    ).select("run_id")
    wild = F.col("run_id").contains("%")
    by_suffix = first_by_suffix(stored, open_ids.where(~wild), wanted)
    # patterns among the ids matched already do no harm: an earlier match counts first
    patterns = wanted.where(wild & F.col("run_id").contains("_"))
    if not patterns.isEmpty():
        by_suffix = by_suffix.unionByName(first_by_pattern(stored, patterns))
    return (
        tried.join(by_suffix, "run_id", "left")
        .select("run_id", F.coalesce("matched_run_id", "suffix_match").alias("matched_run_id"))
        .where(F.col("matched_run_id").isNotNull())
    )


def with_exact_and_prefix(wanted: DataFrame, stored: DataFrame) -> DataFrame:
    """Distinct ids with their exact or, failing that, same-base match."""
    exact = stored.join(wanted, "run_id", "left_semi").distinct()
    exact = exact.withColumn("exact_match", F.col("run_id"))
    based = wanted.withColumn("base", run_base("run_id"))
    bases = based.select("base").where(F.col("base").isNotNull()).distinct()
    return (
        based.join(exact, "run_id", "left")
        .join(first_by_prefix(stored, bases), "base", "left")
        .select(
            "run_id",
            "base",
            F.col("exact_match").isNotNull().alias("is_exact"),
            F.coalesce("exact_match", "prefix_match").alias("matched_run_id"),
        )
    )


def match_ended_runs(requests: DataFrame, runs: DataFrame) -> DataFrame:
    """(run_id, matched_run_id, is_created) for ids whose end can be recorded.

    Without an exact match an id needs an underscore and a base of eight or more
    characters; then the least run of that base is taken, or a run is created.
    """
    wanted = requests.select("run_id").where(F.col("run_id").isNotNull()).distinct()
    tried = with_exact_and_prefix(wanted, runs.select("run_id"))
    related = F.col("run_id").contains("_") & F.col("base").isNotNull()
    return tried.where(F.col("is_exact") | related).select(
        "run_id",
        F.coalesce("matched_run_id", "run_id").alias("matched_run_id"),
        F.col("matched_run_id").isNull().alias("is_created"),
    )


def run_rows(df: DataFrame) -> DataFrame:
    """Run columns in order; absent ones are NULL."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in RUN_SCHEMA.fields
        ]
    )


def start_runs(
    categories: DataFrame,
    run_id: Column | str,
    scraper_type: str,
    start_time: Column,
    max_products: int | None = None,
    replace_existing: bool = False,
    request_delay: float | None = None,
    max_retries: int | None = None,
) -> DataFrame:
    """One running run per category with a URL."""
    return run_rows(
        categories.where(has_text("url")).select(
            category_run_id(run_id, "name").alias("run_id"),
            F.lit(scraper_type).alias("scraper_type"),
            F.col("url").alias("category_url"),
            F.lit(max_products).cast("int").alias("max_products"),
            F.lit(replace_existing).alias("replace_existing"),
            config_snapshot(
                F.lit(scraper_type),
                F.lit(request_delay).cast("double"),
                F.lit(max_retries).cast("int"),
                F.col("name"),
            ).alias("config_snapshot"),
            F.lit("running").alias("status"),
            start_time.alias("start_time"),
        )
    )


def run_changes(runs: DataFrame, outcomes: DataFrame) -> DataFrame:
    """(run_id, is_created, end, error): what a batch of outcomes changes, one row per run.

    Outcomes are (seq, run_id, status, num_products, error_message, end_time). Ids
    are matched against the table as it was before the batch; of several outcomes
    of one run the last counts, but an error message stays until another is given.
    Of ``runs`` only the ids are read.
    """
    matched = outcomes.join(match_ended_runs(outcomes, runs), "run_id")
    return matched.groupBy(F.col("matched_run_id").alias("run_id")).agg(
        F.max("is_created").alias("is_created"),
        F.max_by(
            F.struct(
                "status",
                F.coalesce("num_products", F.lit(0)).cast("bigint").alias("num_products"),
                "end_time",
            ),
            "seq",
        ).alias("end"),
        F.max_by("error_message", F.when(has_text("error_message"), F.col("seq"))).alias("error"),
    )


def with_changes(runs: DataFrame, changes: DataFrame) -> DataFrame:
    """These run rows after the changes, with the runs that the changes create."""
    updates = changes.where(~F.col("is_created")).select("run_id", "end", "error")
    updated = runs.join(updates, "run_id", "left")
    ended = F.col("end").isNotNull()
    columns = {
        "status": F.when(ended, F.col("end.status")).otherwise(F.col("status")),
        "num_products": F.when(ended, F.col("end.num_products")).otherwise(F.col("num_products")),
        "duration_seconds": F.when(
            ended, seconds_between("start_time", "end.end_time")
        ).otherwise(F.col("duration_seconds")),
        "error_message": F.coalesce("error", "error_message"),
        "end_time": F.when(ended, F.col("end.end_time")).otherwise(F.col("end_time")),
    }
    created = changes.where("is_created").select(
        "run_id",
        F.lit("unknown").alias("scraper_type"),
        F.lit("unknown").alias("category_url"),
        F.lit(False).alias("replace_existing"),
        F.col("end.status").alias("status"),
        F.col("end.end_time").alias("start_time"),
        F.col("end.end_time").alias("end_time"),
        F.col("end.num_products").alias("num_products"),
        F.lit(0).cast("bigint").alias("duration_seconds"),
        F.col("error").alias("error_message"),
    )
    return run_rows(updated.withColumns(columns)).unionByName(run_rows(created))


def end_runs(runs: DataFrame, outcomes: DataFrame) -> DataFrame:
    """The run table after a batch of outcomes."""
    return with_changes(runs, run_changes(runs, outcomes))
