"""Personal data and the terms that give it away.

Base spans are e-mail addresses, IP addresses, card and phone numbers. Around each
of them the words within ``REACH`` characters are its context. Over the whole
corpus, n(t, e) counts occurrences of term t in contexts of entity e, c(t, e) those
contexts that differ, and n(t) all occurrences of t. A term reveals an entity by
log p(e | t) - log p(e); what it leaves of the entity's information -log p(e) is

    bits left = -log2 p(e | t),    p(e | t) = (c(t, e) + m p(e | kind)) / (c(t, e) n(t) / n(t, e) + m).

The share n(t, e) / n(t) thus counts as that of so many occurrences as the contexts
that differ give, so that copies are no evidence, and backs off to the entity's share
of its kind's different contexts by ``smoothing`` m occurrences. Terms that leave ``generalise`` bits or
fewer of some entity are generalised, those that leave ``remove`` or fewer are removed,
wherever they stand. At the defaults a term that stands once in the corpus, beside an
entity, is generalised and one that stands twice, both times beside it, is removed.
The bars are in bits left, so they mean the same in a corpus of any size.

Only DataFrame functions are used. A pattern's matches and the gaps between them
come from one pass each; offsets are running sums over a document's own matches.
Counts are summed ahead of their shuffles; no pair of terms or documents is formed.

Defined cases: a null text is empty and has no spans; rows with the same id and text
share their spans and each count in the corpus; offsets are code points, end
exclusive; a term inside a base span is left alone; an empty corpus has no terms;
columns beside id and text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hylle.llm.common import KEY, carried, fits, row_key, staged

# The patterns of the four kinds. A pattern starts at the end of the
# last match or where a run of its characters starts, and repeats are possessive, so
# a long run that doesn't match is read once.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = (*PATTERNS, "generalised", "removed")
WORD = r"[\p{L}\p{N}]+"
REACH = 80
BROADCAST_ROWS = 200_000


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def is_valid(kind: Column, match: Column) -> Column:
    """Whether a match is one: octets, number of digits, check digit."""
    digits = _digits(match)
    octets = F.forall(
        F.split(match, r"\."),
        lambda part: (F.length(F.ltrim(part, F.lit("0"))) <= 3)
        & (F.coalesce(F.left(F.concat(F.lit("0"), F.ltrim(part, F.lit("0"))), F.lit(4)).cast("int"), F.lit(0)) <= 255),
    )
    # from the right, every second digit counts twice, less nine above nine
    twice = F.aggregate(
        F.transform(
            F.split(F.reverse(digits), "(?<=.)(?=.)"),
            lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
                (d.cast("int") * 2) - F.when(d.cast("int") > 4, 9).otherwise(0)
            ),
        ),
        F.lit(0),
        lambda a, b: a + b,
    )
    return (
        F.when(kind == "ip", octets)
        .when(kind == "card", F.when(F.length(digits).between(16, 19), twice % 10 == 0).otherwise(F.lit(False)))
        .when(kind == "phone", F.length(digits).between(8, 15))
        .otherwise(F.lit(True))
    )


def located(keyed: DataFrame, patterns: dict[str, str], text: str = "_text") -> DataFrame:
    """Row key, kind, ``start``, ``end``, ``match`` and the gaps at either side, per match.

    Repeated rows give their matches once.
    """
    names = list(patterns)
    found = keyed.select(
        *KEY, text, *(F.regexp_extract_all(text, F.lit(p), F.lit(0)).alias(f"_m{i}") for i, p in enumerate(patterns.values()))
    )
    found = found.where(" or ".join(f"size(_m{i}) > 0" for i in range(len(names))))
    each = F.array(
        *(
            F.struct(
                F.lit(kind).alias("kind"),
                F.col(f"_m{i}").alias("matches"),
                F.when(F.size(f"_m{i}") > 0, F.split(text, patterns[kind], -1)).alias("gaps"),
            )
            for i, kind in enumerate(names)
        )
    )
    rows = (
        found.select(*KEY, F.inline(each))
        .where("size(matches) > 0")
        .select(
            *KEY,
            "kind",
            F.posexplode(
                F.transform(
                    "matches",
                    lambda m, i: F.struct(
                        m.alias("match"),
                        F.length(F.get("gaps", i)).alias("gap"),
                        F.right(F.get("gaps", i), F.lit(REACH)).alias("before"),
                        F.left(F.get("gaps", i + 1), F.lit(REACH)).alias("after"),
                    ),
                )
            ).alias("i", "one"),
        )
        .select(*KEY, "kind", "i", "one.*")
        .repartition(*KEY, "kind")
        .dropDuplicates([*KEY, "kind", "i"])
    )
    so_far = Window.partitionBy(*KEY, "kind").orderBy("i")
    end = F.sum(F.col("gap") + F.length("match")).over(so_far)
    return rows.withColumn("end", end).withColumn("start", F.col("end") - F.length("match")).drop("gap", "i")


def base_spans(keyed: DataFrame) -> DataFrame:
    return located(keyed, PATTERNS).where(is_valid(F.col("kind"), F.col("match")))


def located_terms(keyed: DataFrame, terms: DataFrame) -> DataFrame:
    """Row key, kind, start and end of the words that are terms.

    Every word takes part in the running sum, but what moves of it are three numbers:
    its kind, if it is a term, is joined on first.
    """
    found = keyed.select(
        *KEY, F.regexp_extract_all("_text", F.lit(WORD), F.lit(0)).alias("_m"), F.split("_text", WORD, -1).alias("_g")
    )
    rows = found.select(
        *KEY,
        F.posexplode(
            F.transform(
                "_m", lambda m, i: F.struct(F.lower(m).alias("term"), F.length(m).alias("len"), F.length(F.get("_g", i)).alias("gap"))
            )
        ).alias("i", "one"),
    )
    rows = (
        rows.select(*KEY, "i", "one.*")
        .join(terms.select("term", "kind"), "term", "left")
        .select(*KEY, "i", "len", (F.col("gap") + F.col("len")).alias("step"), "kind")
        .repartition(*KEY)
        .dropDuplicates([*KEY, "i"])
    )
    end = F.sum("step").over(Window.partitionBy(*KEY).orderBy("i"))
    return (
        rows.withColumn("end", end)
        .where(F.col("kind").isNotNull())
        .select(*KEY, "kind", (F.col("end") - F.col("len")).alias("start"), "end")
    )


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def context_words(before: Column, after: Column, match: Column) -> Column:
    """Words of both gaps' ends; a word that the cut or the match halves is left out."""
    first, last = r"^[\p{L}\p{N}]+", r"[\p{L}\p{N}]+$"
    left = F.when(F.length(before) == REACH, F.regexp_replace(before, first, "")).otherwise(before)
    right = F.when(F.length(after) == REACH, F.regexp_replace(after, last, "")).otherwise(after)
    left = F.when(match.rlike(r"^[\p{L}\p{N}]"), F.regexp_replace(left, last, "")).otherwise(left)
    right = F.when(match.rlike(r"[\p{L}\p{N}]$"), F.regexp_replace(right, first, "")).otherwise(right)
    return F.concat(words(left), words(right))


def disclosing_terms(
    keyed: DataFrame,
    spans: DataFrame,
    *,
    smoothing: float = 1.0,
    generalise: float = 1.0,
    remove: float = 0.6,
) -> DataFrame:
    """(term, bits_left, kind): terms that leave few enough bits of some entity.

    Contexts of repeated rows are counted as often as the rows stand in the corpus.
    """
    times = keyed.groupBy(*KEY).agg(F.count(F.lit(1)).alias("_times"))
    value = F.when(F.col("kind") == "email", F.lower("match")).otherwise(F.regexp_replace("match", r"[\x20().-]", ""))
    near = spans.join(times, list(KEY)).select(
        F.col("kind").alias("_kind"),
        value.alias("entity"),
        F.xxhash64("before", "after").alias("_context"),
        "_times",
        context_words(F.col("before"), F.col("after"), F.col("match")).alias("_words"),
    )
    near = staged(near, "contexts")
    entities = (
        near.select("_kind", "entity", "_context").distinct().groupBy("_kind", "entity").agg(F.count(F.lit(1)).alias("_n_e"))
    )
    kinds = entities.groupBy("_kind").agg(F.sum("_n_e").alias("_n_kind"))
    entities = entities.join(F.broadcast(kinds), "_kind")  # a row per pattern
    together = (
        near.select("_kind", "entity", "_context", "_times", F.explode("_words").alias("term"))
        .where(F.length("term") >= 3)
        .groupBy("term", "_kind", "entity", "_context")
        .agg(F.sum("_times").alias("_times"))
        .groupBy("term", "_kind", "entity")
        .agg(F.sum("_times").alias("_n_te"), F.count(F.lit(1)).alias("_contexts"))
    )
    together = staged(together, "terms-near")
    terms = staged(together.select("term").distinct(), "terms-named")
    everywhere = keyed.select(F.explode(words(F.col("_text"))).alias("term"))
    if fits(terms, BROADCAST_ROWS):
        everywhere = everywhere.join(F.broadcast(terms), "term")
    # many terms are counted with all other words, summed ahead of the shuffle
    everywhere = everywhere.groupBy("term").agg(F.count(F.lit(1)).alias("_n_t"))
    share = F.least(F.col("_n_te") / F.col("_n_t"), F.lit(1.0))
    back_off = F.lit(smoothing) * F.col("_n_e") / F.col("_n_kind")
    p_et = (F.col("_contexts") + back_off) / (F.col("_contexts") / share + smoothing)
    return (
        together.join(everywhere, "term")
        .join(entities, ["_kind", "entity"])
        .groupBy("term")
        .agg(F.min(-F.log2(p_et)).alias("bits_left"))
        .where(F.col("bits_left") <= generalise)
        .select("term", "bits_left", F.when(F.col("bits_left") <= remove, "removed").otherwise("generalised").alias("kind"))
    )


def term_spans(keyed: DataFrame, terms: DataFrame, spans: DataFrame) -> DataFrame:
    """Row key, kind, start, end of the terms' occurrences outside the base spans."""
    holding = (
        keyed.select(*KEY, F.explode(F.array_distinct(words(F.col("_text")))).alias("term"))
        .join(terms.select("term"), "term", "left_semi")
        .select(*KEY)
        .distinct()
    )
    holding = staged(holding, "holding")
    found = located_terms(keyed.join(holding, list(KEY), "left_semi"), terms)
    # sweep over each document: what base spans that start before a word's end reach to
    events = found.select(*KEY, (F.col("end") - 1).alias("_at"), F.lit(None).cast("long").alias("_to"), "kind", "start", "end").unionByName(
        spans.join(holding, list(KEY), "left_semi").select(
            *KEY, F.col("start").alias("_at"), F.col("end").cast("long").alias("_to"), F.lit(None).cast("string").alias("kind"), "start", "end"
        )
    )
    sweep = Window.partitionBy(*KEY).orderBy("_at", F.col("_to").isNull())
    reached = F.coalesce(F.max("_to").over(sweep.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0))
    return events.withColumn("_reached", reached).where("kind is not null and _reached <= start").select(*KEY, "kind", "start", "end")


def find_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **thresholds: float
) -> DataFrame:
    """Row key and ``spans``: array of (order, start, end, kind), sorted, for documents with any."""
    keyed = docs.select(
        *(c.alias(k) for k, c in row_key(id_col, text_col).items()),
        F.coalesce(F.col(text_col), F.lit("")).alias("_text"),
    )
    base = staged(base_spans(keyed), "base-spans")
    terms = staged(disclosing_terms(keyed, base, **thresholds), "terms")
    # few terms are sought by broadcast, many by shuffled words
    terms = F.broadcast(terms) if fits(terms, BROADCAST_ROWS) else terms
    both = base.select(*KEY, "kind", "start", "end").unionByName(term_spans(keyed, terms, base))
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    return both.groupBy(*KEY).agg(
        F.sort_array(F.collect_list(F.struct(order.alias("order"), "start", "end", "kind"))).alias("spans")
    )


def spans_text(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def sanitised(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``row`` (the document's columns) and ``sanitised``: spans replaced by their kind in brackets, removed terms by nothing.

    Where base spans overlap, the later one's rest is cut with it.
    """
    parts = F.expr(
        "aggregate(array_sort(spans, (a, b) -> int(if(a.start <> b.start, a.start - b.start, b.end - a.end))),"
        " named_struct('at', 0L, 'out', ''), (s, x) -> named_struct("
        " 'at', greatest(s.at, x.end), 'out', concat(s.out, if(x.start < s.at, '', concat("
        " substring(_text, int(s.at) + 1, int(x.start - s.at)),"
        " if(x.kind = 'removed', '', concat('[', x.kind, ']')))))),"
        " s -> concat(s.out, substring(_text, int(s.at) + 1)))"
    )
    return (
        carried(docs, id_col, text_col)
        .join(found, list(KEY), "left")
        .select("row", F.when(F.col("spans").isNull(), F.coalesce("_text", F.lit(""))).otherwise(parts).alias("sanitised"))
    )
