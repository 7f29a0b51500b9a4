"""Run history (SC4, SF18, SF19, SF32, SF33, SF35, SF38, JN4, JN5, SK6, SK7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from hylle.fixtures import as_sql, relation
from hylle.operators import runs as R
from hylle.plans.ingest import record_end
from hylle.sources import codec
from hylle.sources import tables as S
from hylle.suite import query
from hylle.suite.tables import table_target

RUNS = as_sql("runs")
REQUESTS = as_sql("run_requests")


def utc(column):
    """A stored time as UTC ISO text, whatever time type the file carries."""
    return codec.iso_text(F.col(column).cast("timestamp"))


def runs(spark, sf):
    return R.run_rows(relation(spark, sf, "runs"))


def requests(spark, sf):
    return relation(spark, sf, "run_requests")


ISO = "strftime({0}, '%Y-%m-%dT%H:%M:%S')"


@query("sc4_scan_runs", f"SELECT run_id, {ISO.format('start_time')} AS start_time FROM {RUNS} AS r")
def scan_runs(spark, sf):
    target = table_target(spark, "runs")
    S.make_table(spark, runs(spark, sf), target, "run_id")
    return S.scan(spark, target).select("run_id", utc("start_time").alias("start_time"))


@query("sf18_seeded_run_id", f"SELECT seq, substr(md5(run_id), 1, 12) AS id FROM {RUNS} AS r")
def seeded_run_id(spark, sf):
    return relation(spark, sf, "runs").select("seq", R.seeded_run_id("run_id").alias("id"))


@query(
    "sf18_random_run_id",
    f"SELECT count(*) AS n_rows, count(*) AS n_ids, true AS all_shaped FROM {RUNS} AS r",
)
def random_run_id(spark, sf):
    """Random ids have no fixed value, but one per row, each of the right shape."""
    ids = relation(spark, sf, "runs").select(R.seeded_run_id(F.lit("")).alias("id"))
    return ids.agg(
        F.count("*").alias("n_rows"),
        F.countDistinct("id").alias("n_ids"),
        F.bool_and(F.col("id").rlike("^[0-9a-f]{12}$")).alias("all_shaped"),
    )


@query(
    "sf19_dated_run_id",
    f"SELECT seq, strftime(start_time, '%Y%m%d') || '_' || scraper_type AS id, scraper_type AS bare FROM {RUNS} AS r",
)
def dated_run_id(spark, sf):
    return relation(spark, sf, "runs").select(
        "seq",
        R.dated_run_id("scraper_type", F.col("start_time")).alias("id"),
        R.dated_run_id("scraper_type", None).alias("bare"),
    )


@query(
    "sf32_iso_time",
    f"SELECT seq, strftime(CASE seq % 4 WHEN 2 THEN start_time - INTERVAL 2 HOUR WHEN 3 THEN TIMESTAMP '2000-01-01' "
    f"ELSE start_time END, '%Y-%m-%dT%H:%M:%S') AS t FROM {RUNS} AS r",
)
def iso_time(spark, sf):
    text = utc("start_time")
    kind = F.col("seq") % 4
    given = (
        F.when(kind == 0, text)
        .when(kind == 1, F.concat(text, F.lit("Z")))
        .when(kind == 2, F.concat(text, F.lit("+02:00")))
    )
    missing = F.lit("2000-01-01T00:00:00Z").cast("timestamp")
    return relation(spark, sf, "runs").select(
        "seq", codec.iso_text(codec.iso_time(given, missing)).alias("t")
    )


@query(
    "sf33_duration",
    "SELECT l_orderkey, l_linenumber, CAST(trunc(epoch(l_shipdate - o_orderdate)) AS BIGINT) AS seconds "
    "FROM lineitem JOIN orders ON l_orderkey = o_orderkey",
)
def duration(spark, sf):
    joined = relation(spark, sf, "lineitem").join(
        relation(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    return joined.select(
        "l_orderkey", "l_linenumber", R.seconds_between("o_orderdate", "l_shipdate").alias("seconds")
    )


@query(
    "sf35_config_snapshot",
    "SELECT seq, '{\"scraper\":{\"type\":\"' || scraper_type || '\",\"request_delay\":0.2,\"max_retries\":' || "
    "CASE WHEN seq % 2 = 0 THEN cast(seq % 7 AS VARCHAR) ELSE 'null' END || '},\"category\":\"' || status || '\"}' AS snapshot "
    f"FROM {RUNS} AS r",
)
def config_snapshot(spark, sf):
    retries = F.when(F.col("seq") % 2 == 0, F.col("seq") % 7).cast("int")
    return relation(spark, sf, "runs").select(
        "seq",
        codec.config_snapshot(
            F.col("scraper_type"), F.lit(0.2), retries, F.col("status")
        ).alias("snapshot"),
    )


@query(
    "sf38_run_base",
    "SELECT seq, CASE WHEN length(split_part(run_id, '_', 1)) >= 8 THEN split_part(run_id, '_', 1) END AS base "
    f"FROM {REQUESTS} AS q",
)
def run_base(spark, sf):
    return requests(spark, sf).select("seq", R.run_base("run_id").alias("base"))


IDS = f"(SELECT DISTINCT run_id FROM {REQUESTS} AS q0)"
# the least stored id with each base, and with each ending of a requested length
BY_BASE = f"""(SELECT b.base, min(r.run_id) AS m FROM (SELECT DISTINCT split_part(run_id, '_', 1) AS base FROM {IDS} AS i) AS b
 JOIN {RUNS} AS r ON starts_with(r.run_id, b.base) WHERE length(b.base) >= 8 GROUP BY b.base)"""
TRIED = f"""(SELECT i.run_id, split_part(i.run_id, '_', 1) AS base, e.run_id AS exact, p.m AS prefixed FROM {IDS} AS i
 LEFT JOIN (SELECT DISTINCT run_id FROM {RUNS} AS r1) AS e ON e.run_id = i.run_id
 LEFT JOIN {BY_BASE} AS p ON p.base = split_part(i.run_id, '_', 1))"""
BY_SUFFIX = f"""(SELECT t.run_id, min(r.run_id) AS m FROM {TRIED} AS t JOIN {RUNS} AS r
  ON r.run_id LIKE '%' || t.run_id WHERE t.exact IS NULL AND t.prefixed IS NULL AND contains(t.run_id, '_') GROUP BY t.run_id)"""


@query(
    "jn4_match_run_ids",
    f"SELECT t.run_id, coalesce(t.exact, t.prefixed, s.m) AS matched_run_id FROM {TRIED} AS t "
    f"LEFT JOIN {BY_SUFFIX} AS s ON s.run_id = t.run_id WHERE coalesce(t.exact, t.prefixed, s.m) IS NOT NULL",
)
def match_run_ids(spark, sf):
    return R.match_run_ids(requests(spark, sf), runs(spark, sf))


ENDED = f"""(SELECT run_id, coalesce(exact, prefixed, run_id) AS matched_run_id, coalesce(exact, prefixed) IS NULL AS is_created
 FROM {TRIED} AS t WHERE exact IS NOT NULL OR (contains(run_id, '_') AND length(base) >= 8))"""


@query("jn5_match_ended_runs", f"SELECT * FROM {ENDED} AS e")
def match_ended_runs(spark, sf):
    return R.match_ended_runs(requests(spark, sf), runs(spark, sf))


@query(
    "sk6_start_runs",
    "SELECT 'r20_' || url_id AS run_id, 'store1' AS scraper_type, url AS category_url, 5 AS max_products, "
    "true AS replace_existing, "
    "'{\"scraper\":{\"type\":\"store1\",\"request_delay\":0.2,\"max_retries\":null},\"category\":\"' || url_id || '\"}' AS config_snapshot, "
    "'running' AS status, '2024-03-01T08:00:00' AS start_time, CAST(NULL AS BIGINT) AS num_products "
    f"FROM {as_sql('urls')} AS u WHERE coalesce(url, '') <> ''",
)
def start_runs(spark, sf):
    cats = relation(spark, sf, "urls").select(F.col("url_id").cast("string").alias("name"), "url")
    started = R.start_runs(
        cats, F.lit("r20"), "store1", F.lit("2024-03-01T08:00:00Z").cast("timestamp"),
        max_products=5, replace_existing=True, request_delay=0.2,
    )
    target = table_target(spark, "runs")
    S.make_table(spark, S.empty_runs(spark), target, "run_id")
    S.append_table(spark, started, target.location)
    return S.scan(spark, target).select(
        "run_id", "scraper_type", "category_url", "max_products", "replace_existing",
        "config_snapshot", "status", utc("start_time").alias("start_time"), "num_products",
    )


OUTCOMES = f"""(SELECT e.matched_run_id, bool_or(e.is_created) AS is_created, max_by(q.status, q.seq) AS status,
  max_by(q.num_products, q.seq) AS num_products, arg_max(q.error_message, q.seq) FILTER (WHERE q.error_message IS NOT NULL) AS error_message
 FROM {REQUESTS} AS q JOIN {ENDED} AS e ON e.run_id = q.run_id GROUP BY e.matched_run_id)"""


ENDED_RUNS = (
    f"""SELECT r.run_id, r.scraper_type, coalesce(o.status, r.status) AS status, CAST(o.num_products AS BIGINT) AS num_products, o.error_message,
 CASE WHEN o.status IS NOT NULL THEN '2024-03-02T10:00:00' END AS end_time,
 CASE WHEN o.status IS NOT NULL THEN CAST(trunc(epoch(TIMESTAMP '2024-03-02 10:00:00' - r.start_time)) AS BIGINT) END AS duration_seconds
 FROM {RUNS} AS r LEFT JOIN {OUTCOMES} AS o ON o.matched_run_id = r.run_id AND NOT o.is_created
 UNION ALL SELECT matched_run_id, 'unknown', status, CAST(num_products AS BIGINT), error_message, '2024-03-02T10:00:00', 0 FROM {OUTCOMES} AS o WHERE is_created"""
)


def outcomes(spark, sf):
    return requests(spark, sf).withColumn("end_time", F.lit("2024-03-02T10:00:00Z").cast("timestamp"))


def shown_ends(ended):
    return ended.select(
        "run_id", "scraper_type", "status", "num_products", "error_message",
        utc("end_time").alias("end_time"), "duration_seconds",
    )


@query("sk7_end_runs", ENDED_RUNS)
def end_runs(spark, sf):
    return shown_ends(R.end_runs(runs(spark, sf), outcomes(spark, sf)))


@query("sk7_record_ends", ENDED_RUNS)
def record_ends(spark, sf):
    """The same on a stored run table, of which only the buckets of ended runs are rewritten."""
    target = table_target(spark, "runs")
    S.make_table(spark, runs(spark, sf), target, "run_id")
    record_end(spark, target, outcomes(spark, sf))
    return shown_ends(S.scan(spark, target))
