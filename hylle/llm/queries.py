"""The registered queries of this subpackage and the SQL they agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hylle.llm import (
    decontaminate,
    embedding_dedup,
    fertility,
    fill_in_middle,
    language_id,
    license_scan,
    line_dedup,
    ngram_join,
    packing,
    periodic_runs,
    sanitise,
    substrings,
    toxicity,
)
from hylle.llm.common import KEY, read, row_key

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query, and the SQL it must agree with where SQL can say it."""

    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            CHECKS[name] = sql
        return fn

    return register


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


@query("op3_pack_first_fit")
def pack_first_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(read(spark, sf_dir, "documents"), tokenizer_path()))


@query(
    "op8_line_dedup",
    r"""
WITH l AS (
 SELECT rowid AS r, doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
  generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
 FROM documents),
k AS (
 SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT r) >= 10)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(f.key) AS n_dropped,
 sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (f.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN f USING (key) GROUP BY r
""".replace("rowid", "row_number() OVER ()"),
)
def line_dedup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = line_dedup.with_kept_text(docs, line_dedup.line_bitmaps(docs, min_docs=10))
    return out.select(
        "row.doc_id",
        "n_lines",
        "n_dropped",
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query("op9_language_id")
def language_id_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language_id.identify(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "held_out", "lang_pred", "score", "bits", "rejected")


TOKENS = r"regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+')"


def _masked(of: str, at: str) -> str:
    rows = (", ".join(f"{of}[{at} + {t + 1}]" for t in mask) for mask in decontaminate.MASKS)
    return "[" + ", ".join(f"concat_ws(chr(32), {m}, {r})" for m, r in enumerate(rows)) + "]"


@query(
    "op1_spaced_seeds",
    f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {TOKENS} AS w FROM documents),
b AS (SELECT item_id, {TOKENS} AS w FROM benchmark),
dw AS (SELECT r, w, unnest(range(0, len(w) - 11)) AS i FROM d WHERE len(w) >= 12),
bw AS (SELECT item_id, w, unnest(range(0, len(w) - 11)) AS j FROM b WHERE len(w) >= 12),
hits AS (
 SELECT DISTINCT r, item_id, i - j AS shift
 FROM (SELECT r, i, unnest({_masked('w', 'i')}) AS s FROM dw)
 JOIN (SELECT item_id, j, unnest({_masked('w', 'j')}) AS s FROM bw) USING (s)),
pairs AS (
 SELECT h.*, t, CASE WHEN t + shift >= 0 AND coalesce(d.w[t + shift + 1] = b.w[t + 1], false) THEN 1 ELSE 0 END AS same
 FROM hits h JOIN d USING (r) JOIN b USING (item_id), unnest(range(0, len(b.w))) AS u(t)),
sums AS (
 SELECT *, sum(2 * same - 1) OVER (PARTITION BY r, item_id, shift ORDER BY t) AS total FROM pairs),
runs AS (
 SELECT *, total - least(0, coalesce(min(total) OVER (PARTITION BY r, item_id, shift ORDER BY t
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS run FROM sums),
scored AS (
 SELECT r, item_id, shift, max(run) AS score, sum(same) AS matched FROM runs GROUP BY ALL HAVING max(run) >= 12)
SELECT doc_id, item_id, CAST(shift AS INTEGER) AS shift, CAST(score AS INTEGER) AS score, CAST(matched AS INTEGER) AS matched
FROM scored JOIN d USING (r)
QUALIFY row_number() OVER (PARTITION BY r, item_id ORDER BY score DESC, shift) = 1
""",
)
def spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.overlaps(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        F.col("_item").alias("item_id"),
        F.col("_shift").alias("shift"),
        F.col("_score").alias("score"),
        F.col("_matched").alias("matched"),
    )


@query(
    "op10_ngram_join",
    r"""
WITH RECURSIVE w AS (
 SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[^ \t\n\r\f\v]+') AS w FROM documents),
s AS (
 SELECT DISTINCT doc_id, md5(array_to_string(w[i : i + 4], chr(32))) AS s
 FROM w, unnest(range(1, greatest(len(w) - 3, 2))) AS u(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (
 SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id
 JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
 GROUP BY a.doc_id, b.doc_id, na.n, nb.n HAVING count(*) >= 0.8 * (na.n + nb.n - count(*)) - 1e-9),
reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, (SELECT count(*) FROM links l WHERE l.a = doc_id) AS n_links, component_id,
 doc_id = component_id AS kept
FROM least
""",
)
def ngram_join_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_join.join(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_links", "component_id", "kept")


@query("op6_pii_disclosure")
def pii_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    rows = docs.select("doc_id", *(c.alias(k) for k, c in row_key("doc_id", "text").items()))
    spans = F.coalesce("spans", F.array().cast("array<struct<order:int,start:bigint,end:bigint,kind:string>>"))
    found = rows.join(sanitise.find_spans(docs), list(KEY), "left").withColumn("spans", spans)
    base = F.filter("spans", lambda s: s["order"] <= len(sanitise.PATTERNS))
    return found.select(
        "doc_id",
        *(
            F.expr(f"cast(size(filter(spans, s -> s.kind = '{kind}')) AS bigint)").alias(f"n_{kind}")
            for kind in sanitise.PATTERNS
        ),
        F.sha2(sanitise.spans_text(base), 256).alias("base_sha256"),
        sanitise.spans_text(F.col("spans")).alias("spans"),
    )


def _license_sql() -> str:
    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    known = ", ".join(f"({quoted(a)}, {quoted(b)})" for a, b in license_scan.known_sentences().items())
    left, names = "'<' || string_agg(sentence_id, '><' ORDER BY place, line) || '>'", []
    steps = []
    for n, (name, pattern) in enumerate(license_scan.rule_patterns()):
        steps.append(f"r{n} AS (SELECT *, regexp_replace(l{n}, {quoted(pattern)}, '|', 'g') AS l{n + 1},"
                     f" CASE WHEN regexp_matches(l{n}, {quoted(pattern)}) THEN {quoted(name)} END AS n{n} FROM {f'r{n - 1}' if n else 'ids'})")
        names.append(f"n{n}")
    last = len(names)
    firsts = ", ".join(
        f"CASE WHEN {' OR '.join([f'{names[k]} IS NOT NULL' for k in range(n) if license_scan.RULES[k][0] == license_scan.RULES[n][0]] or ['false'])} THEN NULL ELSE {names[n]} END"
        for n in range(last)
    )
    longest = max(map(len, license_scan.known_sentences()))
    return rf"""
WITH RECURSIVE known(plain, sentence_id) AS (VALUES {known}),
d AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
s AS (
 SELECT r, unnest(p) AS one, generate_subscripts(p, 1) AS place
 FROM (SELECT r, string_split(regexp_replace(text, '([.!?])[ \t\n\v\f\r]+', '\1' || chr(1), 'g'), chr(1)) AS p FROM d)),
n AS (
 SELECT r, place, list_filter(list_transform(string_split(one, chr(10)), lambda x: replace(trim(
  regexp_replace(lower(x), '[^\p{{L}}\p{{N}}]+', ' ', 'g')), 'licence', 'license')), lambda x: x <> '') AS lines FROM s),
starts AS (
 SELECT r, place, lines, i AS line FROM n, unnest(range(1, len(lines) + 1)) AS u(i)
 WHERE split_part(lines[i], ' ', 1) IN (SELECT split_part(plain, ' ', 1) FROM known)),
runs AS (
 SELECT r, place, line, m AS more, array_to_string(lines[line : line + m], ' ') AS run
 FROM starts, unnest(range(0, least(len(lines) - line, {longest // 2}) + 1)) AS v(m)),
hits AS (
 SELECT r, place, line, max(more) AS more, arg_max(sentence_id, more) AS sentence_id
 FROM runs JOIN known ON plain = run GROUP BY ALL),
follow AS (
 SELECT a.r, a.place, a.line, a.sentence_id, min(b.line) AS next FROM hits a
 LEFT JOIN hits b ON a.r = b.r AND a.place = b.place AND b.line > a.line + a.more GROUP BY ALL),
taken AS (
 SELECT r, place, line, sentence_id, next FROM follow
 QUALIFY row_number() OVER (PARTITION BY r, place ORDER BY line) = 1
 UNION ALL
 SELECT f.r, f.place, f.line, f.sentence_id, f.next FROM taken t JOIN follow f
 ON f.r = t.r AND f.place = t.place AND f.line = t.next),
ids AS (
 SELECT r, string_agg(sentence_id, ',' ORDER BY place, line) AS sentence_ids, {left} AS l0 FROM taken GROUP BY r),
{', '.join(steps)}
SELECT doc_id, sentence_ids, concat_ws(',', {firsts}) AS licenses,
 CAST(len(l{last}) - len(replace(l{last}, '<', '')) AS BIGINT) AS n_unmatched
FROM r{last - 1} JOIN d USING (r)
"""


@query("op7_license_rules", _license_sql())
def license_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.with_licenses(read(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op2_toxicity")
def toxicity_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return found.select(
        "doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


@query(
    "op5_embedding_dedup",
    """
WITH RECURSIVE v AS (
 SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
 WHERE label IS NOT NULL AND embedding IS NOT NULL),
links AS (
 SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
 WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT vec_id, (SELECT count(*) FROM links l WHERE l.a = vec_id) AS n_links, component_id,
 vec_id = component_id AS kept
FROM least
""",
)
def embedding_dedup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(read(spark, sf_dir, "embeddings"))


@query("op4_suffix_dedup")
def suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = substrings.without_spans(docs, substrings.repeated_spans(docs))
    return found.select(
        "row.doc_id",
        "n_bytes",
        "n_removed",
        "n_spans",
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query(
    "op11_fill_in_middle",
    r"""
WITH d AS (
 SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || doc_id) AS h,
  regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS w
 FROM documents),
h AS (
 SELECT doc_id, text, w, len(w) AS n, CAST('0x' || h[1:8] AS UBIGINT) AS h1, CAST('0x' || h[9:16] AS UBIGINT) AS h2,
  CAST('0x' || h[17:24] AS UBIGINT) AS h3, CAST('0x' || h[25:32] AS UBIGINT) AS h4 FROM d),
c AS (
 SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
  CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50
   THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (
 SELECT *, array_to_string(w[1 : a], '') AS prefix, array_to_string(w[a + 1 : b], '') AS middle,
  array_to_string(w[b + 1 :], '') AS suffix FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
 CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
 CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
 sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
  ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
 sha256(text) AS restored_sha256
FROM p
""",
)
def fill_in_middle_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fill_in_middle.rearranged(read(spark, sf_dir, "documents").select("doc_id", "text"))
    names = ("n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")
    return found.select("row.doc_id", *(f"found.{c}" for c in names))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """Documents of which every tenth, by a hash of its id, repeats a stretch of words to its end."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.expr(r"regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0)")
    planted = docs.withColumn("_w", F.when(h % 10 == 0, words)).withColumn("_n", F.size("_w").cast("long"))
    planted = planted.withColumn("_g", F.floor(h / 10)).withColumn("_a", F.expr("if(_n > 0, _g % _n, 0)"))
    planted = planted.withColumn("_p", F.expr("1 + (_n - _a) div (3 + _g % 8)"))
    repeated = F.expr("array_join(transform(_w, (w, i) -> if(i < _a, w, _w[int(_a + (i - _a) % _p)])), ' ')")
    return planted.withColumn("text", F.when(F.col("_n") > 0, repeated).otherwise(F.col("text"))).select(docs.columns)


@query("op12_periodic_runs")
def periodic_runs_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_planted_runs(read(spark, sf_dir, "documents").select("doc_id", "text"))
    found = periodic_runs.with_runs(docs).select("row.doc_id", "found.*")
    longest = F.expr(
        "aggregate(runs, cast(null AS struct<start:bigint,length:bigint,period:bigint>),"
        " (best, r) -> if(best is null or r.length * best.period > best.length * r.period, r, best))"
    )
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return found.withColumn("_best", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "_best.start",
        "_best.length",
        "_best.period",
        F.expr("1000 * _best.length div _best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query("op13_token_fertility")
def token_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    paths = (tokenizer_path("byte_bpe_50k.tiktoken"), tokenizer_path("piece_bpe_32k.model"))
    found = fertility.quality(docs, paths)
    return found.select(
        "row.doc_id",
        *fertility.COUNTS,
        "chars_per_token_byte",
        "chars_per_token_piece",
        "fallback_share",
        "entropy",
        "script",
        "band_group",
        "base_failed",
        F.concat_ws(",", "outside").alias("outside"),
        "kept",
    )
