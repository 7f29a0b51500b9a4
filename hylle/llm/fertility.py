"""Quality by what a text costs in tokens of public vocabularies, beside plain word rules.

The different words of some megabytes of texts are encoded together, by a byte-level
vocabulary and by one that falls back to bytes, each word with a blank before it. A
text's measures are

* characters per token, in either vocabulary,
* the share of tokens that are bytes of characters the second vocabulary lacks, or
  parts of characters in the first,
* the entropy of its tokens.

All depend on language and length, so texts are compared within their language (or
script, where no language is given) and class of length in words, which doubles from
one to the next. A class's band is its median
plus and minus ``WIDTH`` times its spread, taken from the distance of its quartiles, of
the distinct texts that pass the word rules: copies of one text count once. The
quartiles come from counts of fixed bins, which add up ahead of the shuffle and give the
same bands however the rows are dealt. A class with fewer than ``LEAST`` texts takes the
band of its script, then that of all texts; if that has too few, nothing is rejected.

Defined cases: a null text has no words and fails the word rules, as any text below
twenty words does; measures that are shares of no tokens are null; a null or unknown language counts by script; repeated rows give the
same result; no rows give none; columns beside id, text and language travel in one
struct, so their names cannot clash.
"""

from __future__ import annotations

import base64
import importlib
import itertools
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hylle.llm.blocks import begins_character, blank, blocks
from hylle.llm.common import KEY, carried, staged, without_keys

SYMBOLS = b"#*$%&|<>"
REPEAT = 8  # words of a window
FEWEST_WORDS, REPEAT_PERCENT = 20, 30
LEAST, WIDTH = 100, 6.0
# per measure: bins in a unit, and the least spread
MEASURES = {
    "chars_per_token_byte": (256, 0.03),
    "chars_per_token_piece": (256, 0.03),
    "fallback_share": (1024, 0.01),
    "entropy": (64, 0.08),
}
# first code points of blocks of letters, and the script of each block
SCRIPTS = (
    (0x41, "latin"), (0x370, "greek"), (0x400, "cyrillic"), (0x530, "armenian"), (0x590, "hebrew"),
    (0x600, "arabic"), (0x900, "indic"), (0xE00, "thai"), (0x1100, "hangul"), (0x1E00, "latin"),
    (0x1F00, "greek"), (0x2000, ""), (0x3040, "kana"), (0x3100, "han"), (0xAC00, "hangul"), (0xD800, ""),
    (0xF900, "han"), (0xFB00, ""), (0x20000, "han"), (0x30000, ""),
)

# bytes that are split by one pattern at most: it gives up on some million blanks in a row
SPLIT = 400_000
# the vocabulary's blanks; of these only the first stands at the begin of a word, for the one before it
BLANKS = re.compile("[ \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{100000,}")

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "tokens_byte", "tokens_piece", "fallback")
FOUND = f"struct<{','.join(f'{c}:long' for c in COUNTS)},entropy:double,script:string>"


class Vocabulary:
    """Token ids of words, and which tokens are bytes."""

    def __init__(self, path: str) -> None:
        self.ranked = not path.endswith(".model")
        if self.ranked:
            with open(path, "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            pattern = importlib.import_module("public_tokenizers").PATTERN
            self.model = importlib.import_module("tiktoken").Encoding("words", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
            self.bytes = np.zeros(max(ranks.values()) + 1, bool)
            self.bytes[[r for token, r in ranks.items() if not _whole(token)]] = True
            self.widths = np.zeros(len(self.bytes), np.int64)
            self.widths[list(ranks.values())] = [len(token) for token in ranks]
        else:
            self.model = importlib.import_module("sentencepiece").SentencePieceProcessor(model_file=path)
            self.bytes = np.asarray([self.model.is_byte(i) for i in range(self.model.get_piece_size())])

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All words' tokens in a row, each word with a blank before it, and each word's number of them."""
        if self.ranked and words:
            stops = np.cumsum([len(w) + 1 for w in words])
            if stops[-1] > SPLIT and len(words) > 1:
                half = min(max(1, int(np.searchsorted(stops, stops[-1] // 2))), len(words) - 1)
                parts = self.encode(words[:half]), self.encode(words[half:])
                return tuple(np.concatenate(p) for p in zip(*parts))
            if stops[-1] > SPLIT:
                flat = np.asarray(self._long(" " + words[0].decode()), np.int64)
                return flat, np.asarray([len(flat)])
            # no token reaches over a blank, so that words can be encoded in one call
            flat = np.asarray(self.model.encode_ordinary((b" " + b" ".join(words)).decode()), np.int64)
            ends = np.cumsum(self.widths[flat])
            places = np.searchsorted(ends, stops)
            if places[-1] < len(ends) and np.array_equal(ends[places], stops):
                return flat, np.diff(places + 1, prepend=0)
            lists = [self.model.encode_ordinary(" " + w.decode()) for w in words]
        else:
            lists = self.model.encode([w.decode() for w in words], num_threads=1) if words else []
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        return np.fromiter(itertools.chain.from_iterable(lists), np.int64, int(sizes.sum())), sizes

    def _long(self, text: str) -> list[int]:
        """A long word's tokens. Long rows of blanks are taken out of the pattern's sight.

        The pattern makes all blanks of a row one piece, but for the last one before another character.
        """
        tokens, at = [], 0
        for run in BLANKS.finditer(text):
            last = run.end() - (run.end() < len(text))
            tokens += self.model.encode_ordinary(text[at : run.start()])
            tokens += self.model._encode_single_piece(text[run.start() : last])
            at = last
        return tokens + self.model.encode_ordinary(text[at:])


def _whole(token: bytes) -> bool:
    try:
        token.decode()
    except UnicodeDecodeError:
        return False
    return True


def spread_out(flat: np.ndarray, sizes: np.ndarray, of: np.ndarray) -> np.ndarray:
    """The tokens of the words numbered ``of``, in a row."""
    own = sizes[of]
    begins = (np.cumsum(sizes) - sizes)[of]
    within = np.arange(int(own.sum())) - np.repeat(np.cumsum(own) - own, own)
    return flat[np.repeat(begins, own) + within]


def entropies(doc: np.ndarray, tokens: np.ndarray, docs: int) -> np.ndarray:
    """Bits per token of each document's own distribution of tokens."""
    if not len(doc):
        return np.zeros(docs)
    keys = np.sort((doc << 32) | tokens)
    lead = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    times = np.diff(np.append(lead, len(keys))).astype(float)
    total = np.bincount(doc, minlength=docs).astype(float)
    held = np.bincount(keys[lead] >> 32, weights=times * np.log2(times), minlength=docs)
    return np.log2(np.maximum(total, 1)) - held / np.maximum(total, 1)


def repeated_words(ids: np.ndarray, doc: np.ndarray, docs: int, width: int = REPEAT) -> np.ndarray:
    """Per document the words in windows of ``width`` words (a power of two) that it holds twice or more."""
    name, size = ids, 1
    while size < width:  # a window's number is that of the pair of its halves
        if len(name) <= size:
            return np.zeros(docs, np.int64)
        pair = (name[:-size].astype(np.int64) << 32) | name[size:]
        name = np.unique(pair, return_inverse=True)[1].astype(np.int64)
        size *= 2
    n = len(name)
    inside = np.flatnonzero(doc[:n] == doc[size - 1 : size - 1 + n])
    key = (doc[inside].astype(np.int64) << 32) | name[inside]
    _, back, times = np.unique(key, return_inverse=True, return_counts=True)
    edge = np.zeros(len(ids) + 1, np.int32)
    hit = inside[times[back] > 1]
    np.add.at(edge, hit, 1)
    np.add.at(edge, hit + size, -1)
    return np.bincount(doc[np.cumsum(edge[:-1]) > 0], minlength=docs)


def repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(lines) - len(set(lines))


def script_of(text: bytes) -> str:
    """The script of most letters; empty if there is none."""
    points = np.frombuffer(text.decode().encode("utf-32-le"), "<u4")
    low = points[points < 0x80]
    wide = points[points >= 0xAA]
    block = np.bincount(np.searchsorted([a for a, _ in SCRIPTS], wide, "right"), minlength=len(SCRIPTS) + 1)
    letters = {"latin": int((((low | 32) >= 97) & ((low | 32) <= 122)).sum())}
    for (_, script), n in zip(SCRIPTS, block[1:].tolist()):
        if script and n:
            letters[script] = letters.get(script, 0) + n
    best = max(letters, key=lambda s: (letters[s], s))
    return best if letters[best] else ""


def _measurer(paths: tuple[str, str]):
    made: list[Vocabulary] = []

    def measure(texts: pa.Array) -> pa.Array:
        if not made:
            made.extend(map(Vocabulary, paths))
        parts = [_measured(made, *block) for _, *block in blocks(texts)]
        columns = [np.concatenate(c) if parts else [] for c in zip(*parts)] if parts else [[]] * (len(COUNTS) + 2)
        return pa.StructArray.from_arrays([pa.array(c) for c in columns], [*COUNTS, "entropy", "script"]).cast(ARROW)

    return measure


ARROW = pa.struct([*((c, pa.int64()) for c in COUNTS), ("entropy", pa.float64()), ("script", pa.string())])


def _measured(vocabularies: list[Vocabulary], blob: bytes, starts: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    docs = len(starts)
    data = np.frombuffer(blob, np.uint8)
    per_doc = lambda flags: np.diff(np.concatenate(([0], np.cumsum(flags)))[np.append(starts, ends[-1:])])
    chars = per_doc(begins_character(data) & ~blank(data))
    symbols = per_doc(np.isin(data, np.frombuffer(SYMBOLS, np.uint8)))
    numbers: dict[bytes, int] = {}
    number = numbers.setdefault
    texts = [blob[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
    split = [[number(w, len(numbers)) for w in t.split()] for t in texts]  # at ASCII blanks, as these are bytes
    sizes = np.asarray([len(s) for s in split], np.int64)
    ids = np.fromiter(itertools.chain.from_iterable(split), np.int64, int(sizes.sum()))
    doc = np.repeat(np.arange(docs), sizes)
    (flat, own), (pieces, own_pieces) = (v.encode(list(numbers)) for v in vocabularies)
    count = lambda weights: np.bincount(doc, weights=weights[ids], minlength=docs).astype(np.int64)
    total, total_pieces = count(own), count(own_pieces)
    per_word = lambda flags, n: np.diff(np.concatenate(([0], np.cumsum(flags)))[np.concatenate(([0], np.cumsum(n)))])
    byte, piece = vocabularies
    fallback = count(per_word(byte.bytes[flat], own)) + count(per_word(piece.bytes[pieces], own_pieces))
    entropy = entropies(np.repeat(np.arange(docs), total), spread_out(flat, own, ids), docs)
    return [
        sizes,
        chars,
        symbols,
        np.asarray([repeated_lines(t) for t in texts], np.int64),
        repeated_words(ids, doc, docs),
        total,
        total_pieces,
        fallback,
        entropy,
        np.asarray([script_of(t) for t in texts], object),
    ]


def measured(docs: DataFrame, paths: tuple[str, str], id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``row``, the row key, ``found`` (counts, entropy, script), ``base_failed`` and the text's language and class.

    ``row`` holds the document's columns but for the text, which need not be written again.
    ``paths``: a file of ranked byte sequences, and a sentence-piece model with byte fallback.
    """
    udf = F.arrow_udf(_measurer(paths), FOUND).asNondeterministic()
    lang = F.col(f"row.`{lang_col}`") if lang_col in docs.columns else F.lit(None).cast("string")
    failed = (F.col("found.n_words") < FEWEST_WORDS) | (
        100 * F.col("found.n_repeat_words") > REPEAT_PERCENT * F.col("found.n_words")
    )
    return (
        carried(docs, id_col, text_col)
        .withColumn("row", F.struct(*[F.col(f"row.`{c}`") for c in docs.columns if c != text_col]))
        .select("row", *KEY, lang.alias("_lang"), udf(F.coalesce("_text", F.lit(""))).alias("found"))
        .select(
            "*",
            failed.alias("base_failed"),
            F.floor(F.log2(F.greatest("found.n_words", F.lit(1)))).cast("int").alias("_class"),
        )
    )


def measures() -> dict[str, Column]:
    f = lambda c: F.col(f"found.{c}")
    return {
        "chars_per_token_byte": F.try_divide(f("word_chars"), f("tokens_byte")),
        "chars_per_token_piece": F.try_divide(f("word_chars"), f("tokens_piece")),
        "fallback_share": F.try_divide(f("fallback"), f("tokens_byte") + f("tokens_piece")),
        "entropy": f("entropy"),
    }


def groups() -> list[Column]:
    """From the narrowest to the widest: language and script, script, all."""
    script = F.col("found.script")
    return [
        F.when(F.col("_lang").isNotNull(), F.concat_ws(":", F.lit("lang"), script, F.col("_lang"))),
        F.concat_ws(":", F.lit("script"), script),
        F.lit("all"),
    ]


def bands(found: DataFrame, *, least: int = LEAST, width: float = WIDTH) -> DataFrame:
    """``_group``, ``_class`` and per measure the least and greatest value that is kept."""
    bins = F.create_map(
        *(x for name, value in measures().items() for x in (F.lit(name), F.floor(value * MEASURES[name][0]).cast("long")))
    )
    # copies of a text agree in key, and so in all that is counted here
    distinct = (
        found.where("not base_failed and found.tokens_piece > 0")
        .groupBy("_k2", "_lang", "_class", F.col("found.script").alias("script"))
        .agg(F.first("found").alias("found"))
    )
    counted = (
        distinct.select("_class", F.explode(F.filter(F.array(*groups()), lambda g: g.isNotNull())).alias("_group"), bins.alias("bins"))
        .select("_group", "_class", F.explode("bins").alias("measure", "bin"))
        .groupBy("_group", "_class", "measure", "bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    key = ["_group", "_class", "measure"]
    up = Window.partitionBy(*key).orderBy("bin")
    whole = Window.partitionBy(*key)
    placed = counted.select("*", F.sum("n").over(up).alias("upto"), F.sum("n").over(whole).alias("total"))
    at = lambda share: F.min(F.when(F.col("upto") >= share * F.col("total"), F.col("bin")))
    quartiles = placed.groupBy(*key).agg(at(0.25).alias("q1"), at(0.5).alias("q2"), at(0.75).alias("q3"), F.max("total").alias("total"))
    scale = F.create_map(*(F.lit(x) for name, (per, _) in MEASURES.items() for x in (name, per)))
    floor = F.create_map(*(F.lit(x) for name, (_, low) in MEASURES.items() for x in (name, low)))
    per = scale[F.col("measure")]
    spread = F.greatest((F.col("q3") - F.col("q1") + 1) / per / 1.349, floor[F.col("measure")])
    middle = (F.col("q2") + 0.5) / per
    return (
        quartiles.where(F.col("total") >= least)
        .select("_group", "_class", "measure", (middle - width * spread).alias("low"), (middle + width * spread).alias("high"))
        .groupBy("_group", "_class")
        .agg(F.map_from_entries(F.collect_list(F.struct("measure", F.struct("low", "high")))).alias("band"))
    )


def judged(found: DataFrame, known: DataFrame) -> DataFrame:
    """``found`` with ``band_group``, the measures, ``outside`` (those out of their band) and ``kept``."""
    out, names = found, []
    for k, group in enumerate(groups()):
        band = known.select(F.col("_group").alias(f"_g{k}"), "_class", F.col("band").alias(f"_b{k}"))
        out = out.withColumn(f"_g{k}", group).join(band, [f"_g{k}", "_class"], "left")
        names.append(F.when(F.col(f"_b{k}").isNotNull(), F.struct(F.col(f"_g{k}").alias("group"), F.col(f"_b{k}").alias("band"))))
    out = out.withColumn("_used", F.coalesce(*names))
    values = measures()
    outside = F.filter(
        F.array(
            *(
                F.when(~value.between(F.col("_used.band")[name]["low"], F.col("_used.band")[name]["high"]), F.lit(name))
                for name, value in values.items()
            )
        ),
        lambda name: name.isNotNull(),
    )
    outside = F.when(F.col("found.tokens_piece") > 0, outside).otherwise(F.array().cast("array<string>"))
    return out.withColumn("outside", outside).select(
        "row",
        *KEY,
        *(f"found.{c}" for c in COUNTS),
        *(value.alias(name) for name, value in values.items() if name != "entropy"),
        "found.entropy",
        "found.script",
        F.col("_used.group").alias("band_group"),
        "base_failed",
        "outside",
        (~F.col("base_failed") & (F.size("outside") == 0)).alias("kept"),
    )


def kept_documents(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that ``quality`` keeps, all columns as they were."""
    return without_keys(docs, found.where(~F.col("kept")), id_col, text_col)


def quality(docs: DataFrame, paths: tuple[str, str], id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", *, least: int = LEAST, width: float = WIDTH) -> DataFrame:
    """One row per document: ``row``, counts, measures, the measures outside their band, and whether it is kept.

    ``row`` holds the document's columns but for its text; ``_k1`` and ``_k2`` name the document.
    """
    found = staged(measured(docs, paths, id_col, text_col, lang_col), "fertility")
    return judged(found, staged(bands(found, least=least, width=width), "bands"))
