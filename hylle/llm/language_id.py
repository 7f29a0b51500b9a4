"""Language of a text by interpolated Kneser-Ney character models.

Texts become runs of lower-case letters with one blank between them. Every task
counts the four-letter grams of its training rows in numpy and the counts meet in
one Spark sum per language and gram. From those sums each language gets absolute
discounts per order, continuation counts for the lower orders and interpolation
weights, kept as sorted arrays of hashed grams with probabilities beside them.
A text gets the language with the least cross-entropy per symbol.

A text is rejected where its cross-entropy is above what nearly all training texts
of that language and length class have (quantile ``q`` plus ``margin`` bits, over
all training rows that are given and found to be of that language), and where it has
no letter. Length classes with too few rows to tell the quantile are pooled.

No gram is left out, however many there are. A pass over the texts holds the grams of
a range of next-to-last symbols, ``max_grams`` of them or so: a gram, its contexts and
all that it falls back to share that symbol. A symbol with more grams is cut further by
the symbol before it. Most corpora take one pass; where more are needed, a text's bits
are summed over them, so the result is that of one pass. Only the grams of a pass, the
single letters and the discounts meet on the driver.

Defined cases: null, empty and letterless texts are ``und`` with score 0 and are
rejected; ties go to the language that sorts first; rows with a null language or id
are never learned from; without any training row every text is ``und``; languages
are taken as they are spelled; repeated rows count and are scored each.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hylle.llm.common import KEY, fits, row_key, staged

ORDER = 4
CHUNK = 400_000
# characters scored at a time; a task's arrays hold some hundred bytes for each
SCORED_AT_ONCE = 100_000
ROWS_AT_ONCE = 512
SLOTS = 1 << 20
MIX = np.uint64(0x9E3779B97F4A7C15)


_SYMBOLS: list[np.ndarray] = []


def symbols() -> np.ndarray:
    """Code point to symbol: a letter's lower case in 16 bits, 0 for anything else."""
    if _SYMBOLS:
        return _SYMBOLS[0]
    table = np.zeros(0x110000, np.uint16)
    for cp in range(0x110000):
        if 0xD800 <= cp < 0xE000:
            continue
        ch = chr(cp)
        if unicodedata.category(ch)[0] == "L":
            low = ch.lower()
            cp_low = ord(low) if len(low) == 1 else cp
            # letters beyond 16 bits share the private-use codes, which are no letters
            table[cp] = cp_low if cp_low < 0x10000 else 0xE000 + cp_low % 0x1900
    _SYMBOLS.append(table)
    return table


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Packed grams (latest symbol lowest) of the texts in a row, and the text of each.

    A text ends with a blank and its first grams reach back to blanks.
    """
    codes = np.frombuffer("".join(t + "\n" for t in texts).encode("utf-32-le", "replace"), np.uint32)
    place = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in texts])
    s = symbols()[codes].astype(np.uint64)
    first = np.ones(len(s), bool)
    first[1:] = place[1:] != place[:-1]
    keep = (s != 0) | first
    keep[1:] |= s[:-1] != 0  # one blank after each run of letters
    s, place, first = s[keep], place[keep], first[keep]
    s = s.copy()
    out = s.copy()
    starts = np.flatnonzero(first)
    offset = np.arange(len(s)) - np.repeat(starts, np.diff(np.append(starts, len(s))))
    for back in range(1, ORDER):
        prev = np.zeros_like(s)
        prev[back:] = s[:-back]
        prev[offset < back] = 0
        out |= prev << np.uint64(16 * back)
    return out, place


def slices(texts: list[str | None], at_once: int = CHUNK) -> Iterator[tuple[list[int], list[str]]]:
    """Rows and parts of their texts, each of CHUNK characters at most, about ``at_once`` of them at a time."""
    rows, parts, held = [], [], 0
    for row, text in enumerate(texts):
        text = text or ""
        for at in range(0, max(len(text), 1), CHUNK):
            part = text[at : at + CHUNK]
            rows.append(row)
            parts.append(part)
            held += len(part)
            if held >= at_once:
                yield rows, parts
                rows, parts, held = [], [], 0
    if rows:
        yield rows, parts


def is_held_out(id_col: str, modulo: int = 4, remainder: int = 2) -> Column:
    crc = F.crc32(F.col(id_col).cast("string").cast("binary"))
    return F.coalesce(crc % modulo == remainder, F.lit(False))


def gram_counts(training: DataFrame, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """Occurrences of each gram per language over all rows given."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, ROWS_AT_ONCE) for b in batches for at in range(0, b.num_rows, ROWS_AT_ONCE)):
            by: dict[str, list] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                by.setdefault(lang, []).append(text)
            for lang, texts in by.items():
                for _, parts in slices(texts):
                    found, _ = grams(parts)
                    found.sort()
                    new = np.flatnonzero(np.append(True, found[1:] != found[:-1])) if len(found) else []
                    n = np.diff(np.append(new, len(found))).astype(np.int64)
                    yield pa.record_batch(
                        [pa.array([lang] * len(n), pa.string()), pa.array(found[new].view(np.int64)), pa.array(n)],
                        ["lang", "gram", "n"],
                    )

    return (
        training.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
        .where("lang is not null and text is not null")
        .mapInArrow(count, "lang string, gram long, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
    )


def hashed(grams_: np.ndarray) -> np.ndarray:
    """Grams to hashes, one to one: odd multiplier and a shift, both reversible."""
    h = grams_ * MIX
    return h ^ (h >> np.uint64(29))


def run_sums(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order and the sums of the values for each."""
    if not len(keys):
        return (keys, *values)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    new = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return (keys[new], *(np.add.reduceat(v[order], new) for v in values))


def lookup(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the keys in a sorted table and whether each is there."""
    at = np.searchsorted(table, keys)
    at[at == len(table)] = 0
    return at, table[at] == keys if len(table) else np.zeros(len(keys), bool)


def pick(values: np.ndarray, at: np.ndarray, found: np.ndarray, other: np.ndarray) -> np.ndarray:
    """The values at the places found, elsewhere the other ones."""
    return np.where(found, values[at], other) if len(values) else other


def discount_of(once: float, twice: float) -> float:
    return min(max(once / (once + 2 * twice), 0.1), 0.95) if once else 0.5


Level = tuple[np.ndarray, np.ndarray]


def levels_of(grams_: np.ndarray, counts: np.ndarray, least: int = 1) -> list[Level]:
    """Grams of each order from ``least`` up, with counts; a shorter gram counts the kinds it ends."""
    levels = [(grams_, counts.astype(np.float64))]
    for order in range(ORDER - 1, least - 1, -1):
        mask = np.uint64((1 << (16 * order)) - 1)
        higher = levels[-1][0]
        levels.append(run_sums(higher & mask, np.ones(len(higher))))
    levels.reverse()
    return levels


class KneserNey:
    """One language's model: for each order, sorted hashes with probabilities and weights."""

    @classmethod
    def of_arrays(cls, arrays: tuple) -> KneserNey:
        """A model from its arrays, as they are broadcast."""
        model = cls.__new__(cls)
        model.tables, model.weights, model.floor = arrays
        return model

    def arrays(self) -> tuple:
        return self.tables, self.weights, self.floor

    def __init__(self, levels: list[Level], discounts: list[float] | None = None) -> None:
        """``discounts`` per order are given where the levels are those of a pass only."""
        self.tables: list[tuple[np.ndarray, np.ndarray]] = []
        self.weights: list[tuple[np.ndarray, np.ndarray]] = []
        self.floor = 1.0 / (len(levels[0][0]) + 1)
        for order, (keys, n) in enumerate(levels, start=1):
            if discounts is None:
                discount = discount_of(float((n == 1).sum()), float((n == 2).sum()))
            else:
                discount = discounts[order - 1]
            context = keys >> np.uint64(16)
            ctx, total, kinds = run_sums(context, n, np.ones(len(n)))
            weight = discount * kinds / total
            at, _ = lookup(ctx, context)
            lower = self.probability(keys, order - 1)
            p = np.maximum(n - discount, 0) / total[at] + weight[at] * lower
            for store, k, v in ((self.tables, keys, p), (self.weights, ctx, weight)):
                h = hashed(k)
                by = np.argsort(h)
                store.append((h[by], v[by]))

    def probability(self, keys: np.ndarray, order: int = ORDER) -> np.ndarray:
        """Of each gram's latest symbol after the ``order`` - 1 symbols before it."""
        p = np.full(len(keys), self.floor)
        for n in range(1, order + 1):
            own = keys & np.uint64((1 << (16 * n)) - 1)
            (table, value), (contexts, weight) = self.tables[n - 1], self.weights[n - 1]
            c, known = lookup(contexts, hashed(own >> np.uint64(16)))
            p = p * pick(weight, c, known, np.ones(len(keys)))
            at, found = lookup(table, hashed(own))
            p = pick(value, at, found, p)
        return p


class Pass(NamedTuple):
    """Grams whose next-to-last symbol is in a range and, modulo ``of``, the one before it ``part``."""

    low: int = 0
    high: int = 0xFFFF
    part: int = 0
    of: int = 1

    def rows(self, gram: str = "gram") -> Column:
        last, before = symbol_of(gram, 1), symbol_of(gram, 2)
        return last.between(self.low, self.high) & (before % self.of == self.part)

    def places(self, grams_: np.ndarray) -> np.ndarray:
        last = grams_ >> np.uint64(16) & np.uint64(0xFFFF)
        before = grams_ >> np.uint64(32) & np.uint64(0xFFFF)
        return (last >= self.low) & (last <= self.high) & (before % np.uint64(self.of) == self.part)


def symbol_of(gram: str, back: int) -> Column:
    """The gram's symbol so many places before the latest one."""
    return F.shiftrightunsigned(gram, 16 * back).bitwiseAND(F.lit(0xFFFF))


def passes(sizes: list[tuple[int, int]], max_grams: int) -> list[Pass]:
    """Passes of about ``max_grams`` at most over (symbol, grams), which covers all symbols."""
    out, low, held = [], 0, 0
    for symbol, n in sorted(sizes):
        if held and held + n > max_grams:
            out.append(Pass(low, symbol - 1))
            low, held = symbol, 0
        if n > max_grams:
            if low < symbol:
                out.append(Pass(low, symbol - 1))
            of = -(-n // max_grams)
            out += [Pass(symbol, symbol, part, of) for part in range(of)]
            low, held = symbol + 1, 0
        else:
            held += n
    if low <= 0xFFFF:
        out.append(Pass(low, 0xFFFF))
    return out


class Scorer:
    """All languages' models, with a direct-addressed memory of grams met lately."""

    def __init__(self, models: dict[str, KneserNey], own: Pass = Pass()) -> None:
        self.langs = sorted(models)
        self.own = own
        self.models = [models[x] for x in self.langs]
        self.keys = np.full(SLOTS, np.uint64(0xFFFFFFFFFFFFFFFF))
        self.bits = np.zeros((SLOTS, len(self.langs)), np.float32)

    def total_bits(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text: bits under each language, symbols, and letters."""
        bits = np.zeros((len(texts), len(self.langs)))
        n, letters = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        for rows, parts in slices(texts, SCORED_AT_ONCE):
            found, place = grams(parts)
            starts = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
            row = np.asarray(rows)[place[starts]]
            np.add.at(n, row, np.diff(np.append(starts, len(place))))
            is_letter = (found & np.uint64(0xFFFF)) != 0
            np.add.at(letters, row, np.add.reduceat(is_letter.astype(np.int64), starts))
            if not self.models:
                continue
            if self.own != Pass():
                own = self.own.places(found)
                found, place = found[own], place[own]
                if not len(found):
                    continue
                starts = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
                row = np.asarray(rows)[place[starts]]
            slot = (hashed(found) >> np.uint64(64 - 20)).astype(np.int64)
            miss = self.keys[slot] != found
            each = self.bits[slot]
            if miss.any():
                new, back = np.unique(found[miss], return_inverse=True)
                own = np.stack([-np.log2(m.probability(new)) for m in self.models], 1).astype(np.float32)
                each[miss] = own[back]
                at = (hashed(new) >> np.uint64(64 - 20)).astype(np.int64)
                self.keys[at], self.bits[at] = new, own
                # of two new grams with one slot, numpy keeps the last of both arrays
            np.add.at(bits, row, np.add.reduceat(each, starts, axis=0, dtype=np.float64))
        return bits, n, letters


def by_language(table: pa.Table) -> dict[str, Level]:
    """Sorted grams and their counts of each language in (lang, gram, n)."""
    out = {}
    langs, keys, n = (table.column(c) for c in ("lang", "gram", "n"))
    langs = langs.combine_chunks().dictionary_encode()
    codes, keys, n = langs.indices.to_numpy(), keys.to_numpy().view(np.uint64), n.to_numpy()
    for code, lang in enumerate(langs.dictionary.to_pylist()):
        own = np.flatnonzero(codes == code)
        own = own[np.argsort(keys[own])]
        out[lang] = keys[own], n[own].astype(np.float64)
    return out


def fit(
    training: DataFrame, lang_col: str = "lang", text_col: str = "text", *, max_grams: int = 4_000_000
) -> Iterator[tuple[Pass, dict[str, KneserNey]]]:
    """Passes that hold about ``max_grams`` grams each and cover all, with a model per language."""
    counts = staged(gram_counts(training, lang_col, text_col), "gram-counts")
    if fits(counts, max_grams):
        yield Pass(), {k: KneserNey(levels_of(*v)) for k, v in by_language(counts.toArrow()).items()}
        return

    def shorter(higher: DataFrame, order: int) -> DataFrame:
        gram = F.col("gram").bitwiseAND(F.lit((1 << (16 * order)) - 1))
        return higher.groupBy("lang", gram.alias("gram")).agg(F.count(F.lit(1)).alias("n"))

    triples = staged(shorter(counts, 3), "gram-triples")
    pairs = staged(shorter(triples, 2), "gram-pairs")
    singles = staged(shorter(pairs, 1), "gram-singles")
    discounts: dict[str, list[float]] = {}
    for level in (singles, pairs, triples, counts):
        few = level.groupBy("lang").agg(F.count_if(F.col("n") == 1).alias("once"), F.count_if(F.col("n") == 2).alias("twice"))
        for row in few.collect():  # one row per language
            discounts.setdefault(row.lang, []).append(discount_of(row.once, row.twice))
    first = by_language(singles.toArrow())  # 65,536 letters at most per language
    sizes = counts.groupBy(symbol_of("gram", 1).alias("symbol")).count().collect()
    nothing = np.zeros(0, np.uint64), np.zeros(0)
    for own in passes([(r["symbol"], r["count"]) for r in sizes], max_grams):
        second = by_language(pairs.where(symbol_of("gram", 1).between(own.low, own.high)).toArrow())
        fourth = by_language(counts.where(own.rows()).toArrow())
        models = {}
        for lang, single in first.items():
            upper = levels_of(*fourth.get(lang, nothing), least=3)
            models[lang] = KneserNey([single, second.get(lang, nothing), *upper], discounts[lang])
        yield own, models


def pass_bits(
    docs: DataFrame, own: Pass, models: dict[str, KneserNey], id_col: str, text_col: str, lang_col: str
) -> DataFrame:
    """Row key, id, ``_given`` language, ``total`` (bits of the pass's grams under each language), ``n`` symbols and ``letters``."""
    names = [*KEY, id_col, "_given"]
    shared = docs.sparkSession.sparkContext.broadcast({k: m.arrays() for k, m in models.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer({k: KneserNey.of_arrays(a) for k, a in shared.value.items()}, own)
        for batch in (b.slice(at, ROWS_AT_ONCE) for b in batches for at in range(0, b.num_rows, ROWS_AT_ONCE)):
            total, n, letters = scorer.total_bits(batch.column(len(names)).to_pylist())
            ends = np.arange(len(total) + 1, dtype=np.int32) * len(scorer.langs)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(i) for i in range(len(names))),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(total.ravel())),
                    pa.array(n),
                    pa.array(letters),
                ],
                [*names, "total", "n", "letters"],
            )

    keys = (c.alias(k) for k, c in row_key(id_col, text_col).items())
    rows = docs.select(*keys, id_col, F.col(lang_col).alias("_given"), text_col)
    kind = dict(rows.dtypes)[id_col]
    return rows.mapInArrow(
        run, f"_k1 long, _k2 long, `{id_col}` {kind}, _given string, total array<double>, n long, letters long"
    )


def score(
    docs: DataFrame,
    fitted: Iterator[tuple[Pass, dict[str, KneserNey]]],
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """Row key, id, ``_given`` language, ``lang_pred``, ``score``, ``bits`` per symbol and ``letters`` per row."""
    parts: list[DataFrame] = []
    langs: list[str] = []
    for own, models in fitted:
        langs = sorted(models)
        found = pass_bits(docs, own, models, id_col, text_col, lang_col)
        parts.append(found if own == Pass() else staged(found, "pass-bits"))
    found = parts[0]
    if len(parts) > 1:
        # rows of one key have the same bits, so any of them stands for all in each pass
        numbered = [p.select(*KEY, "total", F.lit(i).alias("_pass")) for i, p in enumerate(parts)]
        each = reduce(DataFrame.unionAll, numbered).groupBy(*KEY, "_pass").agg(F.any_value("total").alias("total"))
        total = F.array(*(F.sum(F.get("total", F.lit(i))) for i in range(len(langs))))
        found = found.drop("total").join(each.groupBy(*KEY).agg(total.alias("total")), list(KEY))
    least = F.array_min("total")
    chance = 1 / F.aggregate(
        "total", F.lit(0.0), lambda a, bits: a + F.pow(F.lit(2.0), F.greatest(least - bits, F.lit(-1000.0)))
    )
    names = F.array(*map(F.lit, langs)).cast("array<string>")
    known = (F.col("letters") > 0) & F.lit(bool(langs))
    return found.select(
        *KEY,
        id_col,
        "_given",
        F.when(known, F.get(names, (F.array_position("total", least) - 1).cast("int"))).otherwise("und").alias("lang_pred"),
        F.when(known, chance).otherwise(0.0).alias("score"),
        F.when(known, least / F.greatest("n", F.lit(1))).otherwise(0.0).alias("bits"),
        "letters",
    )


def pools(sizes: list[tuple[str, int, int]], least: int) -> list[tuple[str, int, int]]:
    """(lang, low, high): length classes pooled to ``least`` rows, all 64 of a language covered.

    ``sizes`` has the rows of each (lang, class); what is left of the short ones joins the class above.
    """
    out = []
    for lang in sorted({x[0] for x in sizes}):
        own, high, held = [], 63, 0
        for size, n in sorted(((s, n) for x, s, n in sizes if x == lang), reverse=True):
            held += n
            if held >= least:
                own.append((size, high))
                high, held = size - 1, 0
        own = [*own[:-1], (0, own[-1][1])] if own else [(0, 63)]
        out += [(lang, *x) for x in own]
    return out


def with_rejection(scored: DataFrame, *, q: float = 0.999, margin: float = 1.5) -> DataFrame:
    """Adds ``rejected``; ``scored`` has a boolean ``training``.

    One threshold per language and pool of length classes (power of two of letters): a
    table of languages times 64 at most, from the rows marked.
    """
    size = F.floor(F.log2(F.greatest(F.col("letters"), F.lit(1)))).cast("int")
    scored = scored.withColumn("_size", size)
    sure = scored.where("training and lang_pred <> 'und'")
    sizes = [tuple(r) for r in sure.groupBy("lang_pred", "_size").count().collect()]
    pooled = scored.sparkSession.createDataFrame(
        pools(sizes, round(1 / (1 - q))), "_lang string, _low int, _high int"
    )
    own = (F.col("lang_pred") == F.col("_lang")) & F.col("_size").between(F.col("_low"), F.col("_high"))
    limits = (
        sure.join(F.broadcast(pooled), own)
        .groupBy("_lang", "_low", "_high")
        .agg((F.percentile_approx("bits", q, 10000) + margin).alias("_limit"))
    )
    return (
        scored.join(F.broadcast(limits), own, "left")
        .withColumn("rejected", (F.col("lang_pred") == "und") | F.coalesce(F.col("bits") > F.col("_limit"), F.lit(False)))
        .drop("_size", "_lang", "_low", "_high", "_limit")
    )


def identify(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    *,
    max_grams: int = 4_000_000,
) -> DataFrame:
    """Learn from the rows not held out, score all, reject what is unlike any language."""
    held_out = is_held_out(id_col)
    training = docs.where(~held_out & F.col(id_col).isNotNull())
    fitted = fit(training, lang_col, text_col, max_grams=max_grams)
    scored = score(docs, fitted, id_col, text_col, lang_col)
    sure = ~held_out & F.col(id_col).isNotNull() & F.coalesce(F.col("_given") == F.col("lang_pred"), F.lit(False))
    scored = scored.withColumn("held_out", held_out).withColumn("training", sure).drop("_given")
    return with_rejection(staged(scored, "language-scores"))
