"""Token sequences of fixed length by first-fit decreasing in randomised groups.

Each document is tokenised once; only ids' counts and checksums leave the task.
A document is cut at multiples of the sequence length, so at most one piece of
it, the tail, is shorter. Pieces are dealt by a hash of their place, each task
sorts its pieces by that hash and takes them in groups of fixed size, and each
group is packed alone: the longest piece first, into the first bin with room.
A tournament tree over the bins' free space finds that bin in log(bins) steps.
Neither a long document nor a source that is most of the table weighs on one task.

Defined cases: a null text is empty, and an empty document is the closing id
alone; repeated rows are packed as documents of their own (same id, same pieces);
no rows give no sequences; the document id may be null.
"""

from __future__ import annotations

import os
import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hylle.llm.common import partitions

WORD_CACHE = 500_000
LONGEST_CACHED = 64
TEXTS_AT_ONCE = 64
# marks of which neither an ending with an apostrophe nor a special token is made, and what may stand before them
MARKS = "!\"#$%&()*+,-./:;=?@[\\]^_`{}~"
CLOSED = frozenset("abcdefghijklmnopqrstuvwxyz0123456789" + "".join(map(chr, [*range(0xDF, 0xF7), *range(0xF8, 0x100)])))
# letters whose lower case depends on what stands around them
CONTEXT = re.compile("[\u0130\u03a3]")


class Encoder:
    """Ids of whole texts, encoded word by word with a bounded cache.

    The vocabulary's pre-tokeniser never joins across blanks, so a text's ids are
    its words' ids in a row; only words not met lately go through the tokeniser.
    It also parts a letter or digit from marks that end the word, so such a word is
    put together from the ids of both. Words of letters alone are one pre-token each:
    those of ASCII letters stand in the vocabulary as they are and go to its model,
    the others are encoded in one call and told apart by the ids that end a word.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        # a task has one core; threads of its own would only hold memory
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.ends = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.cache: dict[str, bytes] = {"": b""}

    def words(self, text: str) -> list[str]:
        # the tokeniser composes and lowers too; a text that it could compose
        # otherwise once lowered is left as it is
        if text.isascii() or (unicodedata.is_normalized("NFC", text) and not CONTEXT.search(text)):
            text = text.lower()
        return text.replace("\n", " ").split(" ")

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit numbers."""
        split = [self.words(t) for t in texts]
        if len(self.cache) > WORD_CACHE:
            self.cache = {"": b""}
        cache = self.cache
        long: dict[str, bytes] = {}
        self._add(set().union(*split).difference(cache), long)
        if long:
            return [b"".join([cache[w] if w in cache else long[w] for w in words]) for words in split]
        return [b"".join(map(cache.__getitem__, words)) for words in split]

    def _add(self, words: set[str], long: dict[str, bytes]) -> None:
        cache = self.cache
        plain = {w for w in words if w.isalpha()}
        rest = words - plain
        marked = []
        for word in rest:
            head = word.rstrip(MARKS)
            if len(head) < len(word) and head[-1:] in CLOSED:
                marked.append((word, head, word[len(head) :]))
        for word, head, tail in marked:
            rest.remove(word)
            if head not in cache:
                (plain if head.isalpha() else rest).add(head)
            if tail not in cache:
                rest.add(tail)
        found: dict[str, bytes] = {}
        letters = []
        for word in plain:
            if len(word) > LONGEST_CACHED:
                rest.add(word)
            elif word.isascii() and word.islower():
                found[word] = np.array([t.id for t in self.model.tokenize(word)], "<u4").tobytes()
            else:
                letters.append(word)
        if letters:
            got = self.tokenizer.encode_batch_fast([" ".join(letters)], add_special_tokens=False)[0]
            ids = np.asarray(got.ids, "<u4")
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) == len(letters):
                packed, stops = ids.tobytes(), (4 * stops).tolist()
                found.update(zip(letters, [packed[a:b] for a, b in zip([0, *stops], stops)]))
            else:
                rest.update(letters)
        each = list(rest)
        for word, got in zip(each, self.tokenizer.encode_batch_fast(each, add_special_tokens=False)):
            found[word] = np.asarray(got.ids, "<u4").tobytes()
        for word, head, tail in marked:
            found[word] = (found[head] if head in found else cache[head]) + (found[tail] if tail in found else cache[tail])
        long.update([(w, ids) for w, ids in found.items() if len(w) > LONGEST_CACHED])
        for word in long:
            del found[word]
        cache.update(found)


def first_fit_decreasing(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece; pieces of equal length are taken in their order.

    The tree's leaves are the bins' free space and each inner node holds the larger
    of its two children; descending to the left child wherever it has room ends at
    the first bin that fits.
    """
    n = len(lengths)
    leaves = 1
    while leaves < max(n, 1):
        leaves *= 2
    tree = [size] * (2 * leaves)
    bins, offsets = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for i in np.argsort(-lengths, kind="stable").tolist():
        need, node = int(lengths[i]), 1
        while node < leaves:
            node *= 2
            if tree[node] < need:
                node += 1
        bins[i], offsets[i] = node - leaves, size - tree[node]
        tree[node] -= need
        node //= 2
        while node:
            left, right = tree[2 * node], tree[2 * node + 1]
            best = left if left > right else right
            if tree[node] == best:
                break
            tree[node] = best
            node //= 2
    return bins, offsets


def pieces(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    size: int = 2048,
    end_id: int = 1,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens."""
    schema = pa.schema(
        [("doc_id", pa.int64()), *((c, pa.int64()) for c in ("start", "length", "ids_crc32", "doc_tokens"))]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer_path)
        end = np.asarray([end_id], "<u4").tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = batch.slice(at, TEXTS_AT_ONCE)
                texts = [t or "" for t in part.column(1).to_pylist()]
                rows: list[list[int | None]] = [[], [], [], [], []]
                for doc, ids in zip(part.column(0).to_pylist(), encoder.encode(texts)):
                    ids += end
                    n = len(ids) // 4
                    for start in range(0, n, size):
                        piece = ids[4 * start : 4 * (start + size)]
                        for out, value in zip(rows, (doc, start, len(piece) // 4, zlib.crc32(piece), n)):
                            out.append(value)
                yield pa.record_batch([pa.array(x, pa.int64()) for x in rows], schema=schema)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        cut, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
    )


def pack(cut: DataFrame, *, size: int = 2048, group: int = 8192) -> DataFrame:
    """The pieces with the sequence that holds each and its offset there.

    ``group`` bounds the pieces packed at once. A sequence's number is the task's
    number times 2^32 plus its number in the task.
    """
    names = cut.columns
    order = [*names, "_deal"]

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, used, held, rows = TaskContext.get().partitionId() << 32, 0, [], 0

        def packed(table: pa.Table, used: int) -> tuple[pa.RecordBatch, int]:
            bins, offsets = first_fit_decreasing(table.column("length").to_numpy(), size)
            table = table.append_column("sequence_id", pa.array(bins + (task + used)))
            table = table.append_column("offset", pa.array(offsets))
            return table.combine_chunks().to_batches()[0], used + int(bins.max()) + 1

        for batch in batches:
            held.append(batch.select(names))
            rows += batch.num_rows
            while rows >= group:
                table = pa.Table.from_batches(held)
                out, used = packed(table.slice(0, group), used)
                held = table.slice(group).to_batches()
                rows -= group
                yield out
        if rows:
            yield packed(pa.Table.from_batches(held), used)[0]

    schema = ", ".join(f"{n} {t}" for n, t in cut.dtypes)
    return (
        cut.withColumn("_deal", F.xxhash64("doc_id", "start", "ids_crc32"))
        .repartition(partitions(cut.sparkSession), "_deal")
        .sortWithinPartitions("_deal", *names)
        .select(*order)
        .mapInArrow(fill, f"{schema}, sequence_id long, offset long")
    )
