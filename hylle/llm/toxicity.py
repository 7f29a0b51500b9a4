"""Toxicity by weak supervision.

1. Lexicons come from the labelled training rows: the toxic and the clean documents
   that hold a word, or a word of some beginning, are counted over all of them, copies
   once, and all that exceed the base rate significantly are kept; of a beginning and a
   longer one with the same counts, the shorter. They are dealt, strongest first,
   out to ``LEXICONS`` lexicon voters, which fire on one such word; further voters fire
   on several telling words and on their share of all words, and four pattern voters
   on shouting, masked words, digits inside words and runs of exclamation marks.
2. One pass over all documents notes which voters fire and, for each feature found,
   how many of a hundred words have it.
3. A generative label model is fitted to the counts of voting patterns over all
   documents: how often each voter fires in toxic and in clean documents, by
   expectation maximisation. Pairs of voters that fire together more than that
   explains are taken as correlated and then share one table of joint votes. On
   training rows the given label is one more voter of the accuracy ``label_accuracy``.
4. A linear classifier over the features is trained on the model's posteriors for at
   most ``max_fit`` training rows and scores every document.

There are 2^16 voting patterns at most, whatever the corpus; they, the features (the
words and beginnings that stand out, which grow as the vocabulary does) and the sample of ``max_fit`` feature rows are all that meets in one place.

Defined cases: null and empty texts have no votes and get the classifier's constant;
rows without id or label are not learned from but scored; several labels of one id
count one by one; without labelled rows of both kinds every score is the share of
toxic labels, 0 without any; repeated rows are scored each.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hylle.llm.common import fits, staged

LEXICONS = 8
SHORTEST, LONGEST = 3, 8
BROADCAST_ROWS = 500_000
REMEMBERED = 300_000
ROWS_AT_ONCE = 512

WORD = re.compile(r"[^\W\d_]+")
PATTERNS = (
    re.compile(r"\b[A-Z]{4,}\b.*\b[A-Z]{4,}\b.*\b[A-Z]{4,}\b"),
    re.compile(r"[^\W\d_][*#$%&@]{2,}"),
    re.compile(r"[^\W\d_][0-9]+[^\W\d_]"),
    re.compile(r"!!"),
)
# Telling words, and telling words in a hundred, from which the voters on amounts fire.
AMOUNTS, RATES = (2, 4), (1.0, 2.0)
VOTERS = LEXICONS + len(AMOUNTS) + len(RATES) + len(PATTERNS)
MOST_RATE = 5.0


def is_held_out(id_col: str, modulo: int = 5, remainder: int = 0) -> Column:
    crc = F.crc32(F.col(id_col).cast("string").cast("binary"))
    return F.coalesce(crc % modulo == remainder, F.lit(False))


def beginnings(word: str) -> list[str]:
    """The word's features: itself, marked by a closing blank, and its beginnings."""
    return [word + " ", *(word[:n] for n in range(SHORTEST, min(LONGEST, len(word)) + 1))]


def word_counts(labelled: DataFrame) -> DataFrame:
    """word, toxic, clean: rows of (text, toxic) that hold the word, copies once."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, ROWS_AT_ONCE) for b in batches for at in range(0, b.num_rows, ROWS_AT_ONCE)):
            by = (Counter(), Counter())
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                by[toxic].update(set(WORD.findall((text or "").lower())))
            words = list(by[0] | by[1])
            yield pa.record_batch(
                [pa.array(words, pa.string()), *(pa.array([by[k][w] for w in words], pa.int64()) for k in (1, 0))],
                ["word", "toxic", "clean"],
            )

    once = labelled.select("text", F.col("toxic").cast("int").alias("toxic"), F.xxhash64("text").alias("_h"))
    counted = (
        once.dropDuplicates(["_h", "toxic"])
        .select("text", "toxic")
        .mapInArrow(count, "word string, toxic long, clean long")
    )
    return counted.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def lexicon(labelled: DataFrame, *, share: float = 0.6) -> list[str]:
    """The features that stand out in toxic rows, strongest first.

    A feature has five words' worth of toxic rows at least, copies once.
    """
    counts = staged(word_counts(labelled), "word-counts")
    total = counts.agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c")).first()
    if not total.t or not total.c:
        return []
    base = total.t / (total.t + total.c)
    sizes = F.sequence(F.lit(SHORTEST), F.least(F.length("word"), F.lit(LONGEST)))
    own = F.array(F.concat(F.col("word"), F.lit(" ")))
    begun = F.transform(sizes, lambda n: F.left("word", n))
    n = F.col("toxic") + F.col("clean")
    strength = (F.col("toxic") - base * n) / F.sqrt(n * base * (1 - base))
    found = (
        counts.select(
            F.explode(F.when(F.length("word") >= SHORTEST, F.concat(own, begun)).otherwise(own)).alias("feature"),
            "toxic",
            "clean",
        )
        .groupBy("feature")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .where((F.col("toxic") >= 5) & (F.col("toxic") >= share * n) & (strength >= 5))
    )
    found = staged(found, "features")
    # a beginning with the same counts passes as well, so it stands for the longer feature
    shorter = F.sequence(F.lit(SHORTEST), F.least(F.length("feature") - 1, F.lit(LONGEST)))
    nested = (
        found.where(F.length("feature") > SHORTEST)
        .select("feature", "toxic", "clean", F.explode(F.transform(shorter, lambda k: F.left("feature", k))).alias("begun"))
        .join(found.select(F.col("feature").alias("begun"), "toxic", "clean"), ["begun", "toxic", "clean"])
        .select("feature")
    )
    kept = found.join(nested, "feature", "left_anti").orderBy(strength.desc(), F.length("feature"), "feature")
    return [row.feature for row in kept.select("feature", "toxic", "clean").collect()]


def votes(docs: DataFrame, features: list[str], id_col: str, text_col: str) -> DataFrame:
    """id, ``hits`` and ``rates`` (features found and their shares), ``votes`` (a bit per voter).

    Two features stand behind those given: all telling words' share, and their number's logarithm.
    """
    number = {f: i for i, f in enumerate(features)}
    shared = docs.sparkSession.sparkContext.broadcast(number)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value
        plain: set[str] = set()
        telling: dict[str, list[int]] = {}
        for batch in (b.slice(at, ROWS_AT_ONCE) for b in batches for at in range(0, b.num_rows, ROWS_AT_ONCE)):
            hits, rates, fired = [], [], []
            for text in batch.column(1).to_pylist():
                words = WORD.findall((text or "").lower())
                for word in set(words).difference(plain, telling):
                    own = [number[f] for f in beginnings(word) if f in number]
                    if own:
                        telling[word] = own
                    elif len(word) <= 40:
                        plain.add(word)
                found = [w for w in words if w in telling]
                times = Counter(i for w in found for i in telling[w])
                if len(plain) > REMEMBERED:
                    plain = set()
                if len(telling) > REMEMBERED:
                    telling = {}
                each = 100.0 / max(len(words), 1)
                voted = [False] * LEXICONS
                for i in times:
                    voted[i % LEXICONS] = True
                voted += [len(found) >= n for n in AMOUNTS]
                voted += [len(found) * each >= r for r in RATES]
                voted += [bool(text and p.search(text)) for p in PATTERNS]
                fired.append(sum(v << k for k, v in enumerate(voted)))
                numbers = sorted(times)
                if numbers:
                    times[len(number)] = len(found)
                    numbers.append(len(number))
                hits.append([*numbers, len(number) + 1] if numbers else [])
                rates.append(
                    [*(min(times[i] * each, MOST_RATE) for i in numbers), float(np.log1p(len(found)))] if numbers else []
                )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(hits, pa.list_(pa.int32())),
                    pa.array(rates, pa.list_(pa.float64())),
                    pa.array(fired, pa.int32()),
                ],
                [id_col, "hits", "rates", "votes"],
            )

    rows = docs.select(id_col, text_col)
    return rows.mapInArrow(run, f"`{id_col}` {rows.dtypes[0][1]}, hits array<int>, rates array<double>, votes int")


class LabelModel:
    """Voters' firing rates in toxic and clean documents, with joint tables for correlated ones."""

    def __init__(self, patterns: np.ndarray, counts: np.ndarray, start: np.ndarray, prior: float) -> None:
        """``start``: firing rates [2, voters] to begin from, clean first."""
        fired = (patterns[:, None] >> np.arange(VOTERS)) & 1
        self.groups = [[j] for j in range(VOTERS)]
        self.prior = prior
        self._start_tables(start)
        self._fit(fired, counts)
        self.correlated = self._correlated(fired, counts)
        if self.correlated:
            joint = [list(pair) for pair in self.correlated]
            alone = [[j] for j in range(VOTERS) if all(j not in g for g in joint)]
            post = self.posterior(patterns)
            self.groups = joint + alone
            self._from_posterior(fired, counts, post)
            self._fit(fired, counts)

    def _start_tables(self, rates: np.ndarray) -> None:
        self.tables = [np.stack([1 - rates[:, j], rates[:, j]], 1) for j in range(VOTERS)]

    def _cells(self, fired: np.ndarray) -> list[np.ndarray]:
        return [sum(fired[:, j] << k for k, j in enumerate(g)) for g in self.groups]

    def _from_posterior(self, fired: np.ndarray, counts: np.ndarray, post: np.ndarray) -> None:
        weight = np.stack([(1 - post) * counts, post * counts])
        self.prior = float(np.clip(weight[1].sum() / weight.sum(), 1e-6, 0.5))
        self.tables = []
        for group, cell in zip(self.groups, self._cells(fired)):
            size = 1 << len(group)
            table = np.stack([np.bincount(cell, w, size) for w in weight]) + 0.05
            self.tables.append(table / table.sum(axis=1, keepdims=True))

    def _fit(self, fired: np.ndarray, counts: np.ndarray, rounds: int = 50) -> None:
        for _ in range(rounds):
            before = self.prior
            self._from_posterior(fired, counts, self._post(self._cells(fired)))
            if abs(self.prior - before) < 1e-9:
                break

    def _post(self, cells: list[np.ndarray]) -> np.ndarray:
        log_odds = np.log(self.prior / (1 - self.prior))
        for table, cell in zip(self.tables, cells):
            log_odds = log_odds + np.log(table[1, cell]) - np.log(table[0, cell])
        return 1 / (1 + np.exp(-np.clip(log_odds, -500, 500)))

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """How likely a document with these votes is toxic."""
        return self._post(self._cells((patterns[:, None] >> np.arange(VOTERS)) & 1))

    def _correlated(self, fired: np.ndarray, counts: np.ndarray, least: float = 0.2) -> list[tuple[int, int]]:
        """Disjoint pairs of voters, by how far they agree beyond what the classes explain."""
        post = self._post(self._cells(fired))
        n, excess = counts.sum(), np.zeros((VOTERS, VOTERS))
        for side in (1 - post, post):
            w = side * counts
            mean = w @ fired / max(w.sum(), 1e-9)
            dev = fired - mean
            cov = (dev * w[:, None]).T @ dev / max(w.sum(), 1e-9)
            sd = np.sqrt(np.diag(cov))
            excess += w.sum() / n * np.abs(cov) / np.maximum(np.outer(sd, sd), 1e-4)
        pairs, used = [], set()
        for j, k in sorted(zip(*np.triu_indices(VOTERS, 1)), key=lambda p: -excess[p]):
            if excess[j, k] >= least and not used & {j, k}:
                pairs.append((int(j), int(k)))
                used |= {j, k}
        return pairs


def classifier(sample: DataFrame, features: int) -> tuple[np.ndarray, float]:
    """Weights and constant of a logistic regression on (hits, rates, posterior)."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.linalg import Vectors, VectorUDT

    sparse = F.udf(lambda hits, rates: Vectors.sparse(features, hits, rates), VectorUDT())
    rows = sample.select(
        sparse("hits", "rates").alias("features"),
        F.explode(
            F.array(
                F.struct(F.lit(1.0).alias("label"), F.col("posterior").alias("weight")),
                F.struct(F.lit(0.0).alias("label"), (1 - F.col("posterior")).alias("weight")),
            )
        ).alias("_one"),
    ).select("features", "_one.*").where("weight > 1e-6")
    model = LogisticRegression(
        weightCol="weight", regParam=1e-4, maxIter=40, standardization=False, aggregationDepth=2
    ).fit(staged(rows, "fit-sample"))
    return np.asarray(model.coefficients.toArray()), float(model.intercept)


def scores(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    *,
    max_fit: int = 20_000,
    label_accuracy: float = 0.95,
) -> DataFrame:
    """Id, ``held_out`` and ``score`` of each row; learns from labels of rows not held out.

    ``max_fit`` bounds the rows that the linear classifier is fitted on; lexicons and
    the label model are drawn from all rows.
    """
    held_out = is_held_out(id_col)
    known = labels.select(id_col, F.col(label_col).cast("int").alias("toxic")).where(
        F.col(id_col).isNotNull() & F.col("toxic").isin(0, 1) & ~held_out
    )
    small = fits(known, BROADCAST_ROWS)
    known = F.broadcast(known) if small else known.hint("shuffle_hash")
    labelled = docs.select(id_col, F.col(text_col).alias("text")).join(known, id_col)
    features = lexicon(labelled)
    found = staged(votes(docs, features, id_col, text_col).withColumn("held_out", held_out), "votes")

    voted = found.join(known, id_col, "left")
    table = (
        voted.groupBy("votes")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count(F.when(F.col("toxic") == 1, 1)).alias("toxic"),
            F.count(F.when(F.col("toxic") == 0, 1)).alias("clean"),
        )
        .orderBy("votes")
        .toPandas()
    )
    patterns = table["votes"].to_numpy(np.int64)
    n, toxic, clean = (table[c].to_numpy(float) for c in ("n", "toxic", "clean"))
    share = float(toxic.sum() / max(toxic.sum() + clean.sum(), 1))
    if not features or not toxic.sum() or not clean.sum():
        return found.select(id_col, "held_out", F.lit(share).alias("score"))
    fired = (patterns[:, None] >> np.arange(VOTERS)) & 1
    start = np.stack([(w @ fired + 0.5) / (w.sum() + 1) for w in (clean, toxic)])
    model = LabelModel(patterns, n, start, share)

    spark = docs.sparkSession
    posterior = spark.createDataFrame(
        list(zip(patterns.tolist(), model.posterior(patterns).tolist())), "votes int, posterior double"
    )
    # rows by a hash of the id, as many as the bound lets through
    rate = min(1.0, max_fit / max(1.0, float(toxic.sum() + clean.sum())))
    sample = (
        voted.where(F.col("toxic").isNotNull())
        .where(F.pmod(F.xxhash64(F.lit("fit"), F.col(id_col)), F.lit(1 << 20)) < int(rate * (1 << 20)))
        .join(F.broadcast(posterior), "votes")
    )
    # the given label as one more vote
    said = F.col("posterior") * F.when(F.col("toxic") == 1, label_accuracy).otherwise(1 - label_accuracy)
    unsaid = (1 - F.col("posterior")) * F.when(F.col("toxic") == 0, label_accuracy).otherwise(1 - label_accuracy)
    sample = sample.withColumn("posterior", said / (said + unsaid))
    weights, constant = classifier(sample, len(features) + 2)
    given = F.split(F.lit(",".join(repr(float(w)) for w in weights)), ",").cast("array<double>")
    parts = F.zip_with("hits", "rates", lambda i, r: r * F.get(given, i))
    linear = F.aggregate(parts, F.lit(constant), lambda a, b: a + b)
    return found.select(id_col, "held_out", (1 / (1 + F.exp(-linear))).alias("score"))
