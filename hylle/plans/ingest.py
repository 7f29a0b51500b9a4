"""The whole job: categories, products, enrichment, storage and run history (PL6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hylle.operators import filters as P
from hylle.operators import runs as R
from hylle.plans.crawl import Crawl
from hylle.plans.enrich import enrich, with_product_columns
from hylle.profiles import StoreProfile
from hylle.session import materialised
from hylle.sources import tables as S
from hylle.sources.categories import category_relation


def record_end(
    spark: SparkSession, runs: S.Target, batch_of_outcomes: DataFrame
) -> None:
    """Apply outcomes to the run table: all ids are read, but only rows near changed ones written."""
    changes = materialised(spark, R.run_changes(S.scan(spark, runs), batch_of_outcomes), "run-changes")
    stored, buckets = S.near(spark, runs.location, changes, "run_id")
    S.put(spark, R.with_changes(stored, changes), runs.location, runs.folder, buckets)


def ingest(
    spark: SparkSession,
    configured: DataFrame,
    crawl: Crawl,
    profile: StoreProfile,
    run_id: str,
    products: S.Target,
    runs: S.Target | None = None,
    category_filter: str | None = None,
    max_products: int | None = None,
    replace_existing: bool = False,
    now: Column | None = None,
    request_delay: float | None = None,
    max_retries: int | None = None,
    clear: str | None = None,
    prices: S.Target | None = None,
) -> DataFrame | None:
    """Read, enrich and store the products of all categories as one job.

    ``crawl`` takes the categories (name, url) and the cap on products and gives
    product columns plus ``category_name`` and ``seq``, the reading order (see
    ``store1_source`` and ``store2_source``). Each category has its own run; one
    without products stays running. If reading fails, the categories are read in
    halves and halves of those, so that only the ones at fault fail and the others
    are stored; if all fail, the last problem is raised. ``clear`` empties products,
    runs and, if given, prices ``"before"`` reading, or ``"only"`` does that.
    Returns the stored batch, None after ``clear="only"``.
    """
    if clear not in (None, "before", "only"):
        raise ValueError(f"unknown way to clear: {clear}")
    if clear:
        clear_all(spark, products, runs, prices)
        if clear == "only":
            return None
    clock = F.current_timestamp() if now is None else now
    categories = P.with_url(
        category_relation(P.named_like(configured, category_filter), profile.base_url)
    ).withColumn("name", F.coalesce("name", F.lit("unknown")))
    # read several times: made once, in as many files as there are cores
    categories = materialised(spark, categories.repartition(spark.sparkContext.defaultParallelism), "categories")
    if runs is not None:
        if not spark.catalog.tableExists(runs.location):
            S.make_table(spark, S.empty_runs(spark), runs, "run_id")
        started = R.start_runs(
            categories, F.lit(run_id), profile.name, clock, max_products, replace_existing,
            request_delay, max_retries,
        )
        S.append_table(spark, started, runs.location)

    def read(part: DataFrame) -> DataFrame:
        stamped = P.stamp_run(
            crawl(part, max_products),
            P.category_run_id(F.lit(run_id), "category_name"),
            F.col("category_name"),
        )
        return materialised(spark, enrich(with_product_columns(stamped, keep=("seq",)), profile), "batch")

    batches, failed, problem = [], [], None
    # the configured names: a short list that someone wrote
    todo: list[list[str] | None] = [None]
    while todo:
        names = todo.pop()
        part = categories if names is None else categories.where(F.col("name").isin(names))
        try:
            batches.append(read(part))
        except Exception as found:
            problem = found
            if names is None:
                names = sorted(r.name for r in categories.select("name").distinct().collect())
            if len(names) > 1:
                half = len(names) // 2
                todo += [names[half:], names[:half]]
            else:
                failed += [(name, str(found)) for name in names]
    try:
        if not batches:
            raise problem
        batch = batches[0]
        for more in batches[1:]:
            batch = batch.unionByName(more)
        S.save(spark, batch, products, replace_existing, seq="seq")
    except Exception as found:
        failed = [(r.name, str(found)) for r in categories.select("name").distinct().collect()]
        if runs is not None:
            record_end(spark, runs, failures(spark, run_id, failed, clock))
        raise
    if runs is not None:
        done = batch.groupBy("run_id").agg(F.count("*").alias("num_products")).select(
            F.lit(0).cast("bigint").alias("seq"),
            "run_id",
            F.lit("completed").alias("status"),
            "num_products",
            F.lit(None).cast("string").alias("error_message"),
            clock.alias("end_time"),
        )
        record_end(spark, runs, done.unionByName(failures(spark, run_id, failed, clock)))
    return batch


def failures(
    spark: SparkSession, run_id: str, failed: list[tuple[str, str]], clock: Column
) -> DataFrame:
    """Outcomes of the categories that could not be read or stored, with the reason."""
    return spark.createDataFrame(failed, "name string, problem string").select(
        F.lit(0).cast("bigint").alias("seq"),
        P.category_run_id(F.lit(run_id), "name").alias("run_id"),
        F.lit("failed").alias("status"),
        F.lit(0).cast("bigint").alias("num_products"),
        F.col("problem").alias("error_message"),
        clock.alias("end_time"),
    )


def clear_all(
    spark: SparkSession, products: S.Target, runs: S.Target | None, prices: S.Target | None
) -> None:
    """Leave products, runs and prices without rows, as far as they are there."""
    if products.kind == "table" and runs is not None and spark.catalog.tableExists(runs.location):
        S.clear_tables(spark, prices or products, products, runs)
    elif products.kind != "table" or spark.catalog.tableExists(products.location):
        S.clear(spark, products)
