"""Lines that many documents repeat, as per-document bitmaps.

Line keys are hashed to 128 bits and every line becomes a place: hash, document and
position. The places are dealt by range of (hash, document) and sorted so within a
range, by position last. A pass over each sorted range lets through the first
occurrence of a line in each document, without a further shuffle. What a range found of
a hash, its number of documents and its first occurrence, is carried on as one row, and
the rows of a hash that reaches over range borders are put together. The document in
the range key spreads a line that a third of all documents share over many ranges, and
each of them carries one row of it.

Places whose hash enough documents hold are dropped: all (``keep="none"``) or all but
the first occurrence of all (``keep="first"``). What comes back is, for each document,
the 64-line words of its bitmap that have a bit set.

Defined cases: a null text is one empty line; a key of no code points is never
dropped; repeated rows (same id and text) count as documents of their own and
share one result; with ``keep="first"`` ties go to the smaller row key, and of
repeated rows all keep the line; columns beside id and text pass untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hylle.llm.common import KEY, carried, fits, hash128, row_key, staged

BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Rows of (hash, first place) that may be broadcast: about 50 bytes each, 10 MB.
BROADCAST_ROWS = 200_000


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """The line without blanks at its ends, A-Z in lower case."""
    bare = F.btrim(line, F.lit(BLANKS))
    ascii_only = F.octet_length(bare) == F.char_length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def line_places(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Hash, row key and position of every line whose key is not empty."""
    h1, h2 = hash128(line_key(F.col("_line")))
    # there is always a line; the outer form spares a filter that would split texts once more
    return (
        docs.select(
            *(c.alias(k) for k, c in row_key(id_col, text_col).items()),
            F.posexplode_outer(lines_of(F.col(text_col))).alias("_at", "_line"),
        )
        .where(F.btrim("_line", F.lit(BLANKS)) != "")
        .select(h1.alias("_h1"), h2.alias("_h2"), *KEY, "_at")
    )


def repeated_lines(places: DataFrame, *, min_docs: int = 10) -> DataFrame:
    """Line hashes that at least ``min_docs`` documents hold, with their first occurrence.

    The window's groups are whole within a range and in its order, so it only reads on.
    Repeated rows tie at a document's first position and count one by one.
    """
    by = ["_h1", "_h2", *KEY]
    ranges = places.repartitionByRange(*by).sortWithinPartitions(*by, "_at")
    nth = F.rank().over(Window.partitionBy(*by).orderBy("_at"))
    return (
        ranges.withColumn("_nth", nth)
        .where(F.col("_nth") == 1)
        .groupBy("_h1", "_h2")
        .agg(F.count(F.lit(1)).alias("_docs"), F.min(F.struct(*KEY, "_at")).alias("_first"))
        .where(F.col("_docs") >= min_docs)
    )


def line_bitmaps(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    min_docs: int = 10,
    keep: str = "none",
) -> DataFrame:
    """For each document with dropped lines: its row key and the set words of its bitmap.

    ``words`` is an array of (word, bits): bit b of word w stands for line 64 w + b.
    """
    if keep not in ("none", "first"):
        raise ValueError("keep is 'none' or 'first'")
    # ranges are drawn from a sample, which would hash all texts once more
    places = staged(line_places(docs, id_col, text_col), "line-places")
    repeated = staged(repeated_lines(places, min_docs=min_docs), "repeated-lines")
    if fits(repeated, BROADCAST_ROWS):
        repeated = F.broadcast(repeated)
    places = places.join(repeated, ["_h1", "_h2"])
    if keep == "first":
        places = places.where(F.struct(*KEY, "_at") != F.col("_first"))
    return (
        places.withColumn("_word", F.expr("_at div 64"))
        .groupBy(*KEY, "_word")
        .agg(F.bit_or(F.expr("shiftleft(1L, _at % 64)")).alias("_bits"))
        .groupBy(*KEY)
        .agg(F.sort_array(F.collect_list(F.struct("_word", "_bits"))).alias("words"))
    )


def with_kept_text(
    docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``row`` (the document's columns), ``n_lines``, ``n_dropped`` and ``kept``, the text without dropped lines."""
    # sparse words to an array by word number: the lookup per line is then by place
    dense = F.expr(
        "transform(sequence(0L, element_at(words, -1)._word),"
        " w -> coalesce(element_at(map_from_entries(words), w), 0L))"
    )
    kept = F.array_join(
        F.filter(
            lines_of(F.col("_text")),
            lambda line, i: F.expr("1L").bitwiseAND(
                F.call_function(
                    "shiftrightunsigned",
                    F.coalesce(
                        F.get(F.col("_dense"), (i / 64).cast("int")), F.lit(0).cast("long")
                    ),
                    i % 64,
                )
            )
            == 0,
        ),
        "\n",
    )
    return (
        carried(docs, id_col, text_col)
        .join(bitmaps.hint("shuffle_hash"), list(KEY), "left")
        .withColumn("_dense", F.when(F.col("words").isNotNull(), dense))
        .select(
            "row",
            F.size(lines_of(F.col("_text"))).cast("long").alias("n_lines"),
            F.expr("coalesce(aggregate(words, 0L, (n, w) -> n + bit_count(w._bits)), 0L)").alias("n_dropped"),
            F.when(F.col("words").isNull(), F.coalesce("_text", F.lit(""))).otherwise(kept).alias("kept"),
        )
    )
