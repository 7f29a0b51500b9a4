"""Documents rearranged so that a model learns to fill in their middle.

A document is a piece table: descriptors (buffer, start, end) over two buffers that
never change, the text's UTF-8 bytes and the sentinels'. Cutting splits a descriptor
in two, an arrangement permutes the three that result and puts sentinel descriptors
between them, and the inverse permutation puts them back. Hashes read the bytes that
descriptors name, one after the other, so no rearranged text is built in a task.
``rendered`` builds it from the descriptors where it is wanted.

A text is cut between tokens: blanks with the word that follows, or the blanks at its
end. Four numbers drawn from the document's id decide on the cuts and the form.

Defined cases: a null text is empty; an empty text, or one that holds a sentinel, stays
plain; a null id counts as the empty id; repeated rows give the same result; no rows
give none; columns beside id and text travel in one struct, so their names cannot clash.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hylle.llm.blocks import begins_character, blank, blocks
from hylle.llm.common import carried

TEXT, MARKS = 0, 1
PREFIX, MIDDLE, SUFFIX = range(3)
SENTINELS = ("<P>", "<S>", "<M>")
# what follows each sentinel, in order of output: (sentinel, part)
ARRANGEMENTS = {
    "psm": ((0, PREFIX), (1, SUFFIX), (2, MIDDLE)),
    "spm": ((1, SUFFIX), (0, PREFIX), (2, MIDDLE)),
}

Descriptor = tuple[int, int, int]
FOUND = "struct<n:long,form:string,prefix_chars:long,middle_chars:long,pieces:array<struct<buffer:int,start:long,end:long>>,output_sha256:string,restored_sha256:string>"


def split(table: list[Descriptor], at: int) -> tuple[list[Descriptor], list[Descriptor]]:
    """The table's first ``at`` bytes and the rest; a descriptor across the cut becomes two."""
    left, right = [], []
    for buffer, start, end in table:
        cut = min(max(start + at, start), end)
        left.append((buffer, start, cut))
        right.append((buffer, cut, end))
        at -= end - start
    return [d for d in left if d[1] < d[2]], [d for d in right if d[1] < d[2]]


def arranged(parts: list[list[Descriptor]], form: str, marks: list[Descriptor]) -> list[Descriptor]:
    return [d for mark, part in ARRANGEMENTS[form] for d in (marks[mark], *parts[part])]


def restored(table: list[Descriptor], form: str) -> list[Descriptor]:
    """The text's own descriptors, put back by the inverse of the form's permutation."""
    if form == "plain":
        return table
    groups: list[list[Descriptor]] = []
    for d in table:
        if d[0] == MARKS:
            groups.append([])
        else:
            groups[-1].append(d)
    by_part = {part: group for (_, part), group in zip(ARRANGEMENTS[form], groups)}
    return [d for part in (PREFIX, MIDDLE, SUFFIX) for d in by_part[part]]


def streamed(table: list[Descriptor], buffers: tuple[memoryview, memoryview]) -> str:
    digest = hashlib.sha256()
    for buffer, start, end in table:
        digest.update(buffers[buffer][start:end])
    return digest.hexdigest()


def token_ends(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Ends of words, each text's first and last one among them, and its number of tokens."""
    void = blank(data)
    stops = np.append(void[1:], True) if len(data) else np.zeros(0, bool)
    some = ends > starts
    stops[ends[some] - 1] = True
    word = np.flatnonzero(~void & stops) + 1
    lo, hi = np.searchsorted(word, starts, "right"), np.searchsorted(word, ends, "right")
    trailing = np.zeros(len(starts), bool)
    trailing[some] = void[ends[some] - 1]
    return word, lo, hi, hi - lo + trailing


def _rearranger(sentinels: tuple[str, str, str], fim_percent: int, spm_percent: int):
    marks_buffer = "".join(sentinels).encode()
    sizes = [len(s.encode()) for s in sentinels]
    marks = [(MARKS, sum(sizes[:i]), sum(sizes[: i + 1])) for i in range(3)]
    needles = [s.encode() for s in sentinels]

    def rearrange(texts: pa.Array, draws: pa.Array) -> pa.Array:
        out: list[dict] = []
        for first, blob, starts, ends in blocks(texts):
            data = np.frombuffer(blob, np.uint8)
            word, lo, hi, tokens = token_ends(data, starts, ends)
            chars = np.concatenate(([0], np.cumsum(begins_character(data))))
            view = memoryview(blob)
            rows = zip(starts.tolist(), ends.tolist(), lo.tolist(), hi.tolist(), tokens.tolist())
            for k, (a, b, w0, w1, n) in enumerate(rows):
                h = draws[first + k].as_py()
                h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
                own = (view[a:b], memoryview(marks_buffer))
                table = [(TEXT, 0, b - a)] if b > a else []
                row = {"n": n, "form": "plain", "prefix_chars": None, "middle_chars": None}
                if table and h3 % 100 < fim_percent and all(blob.find(x, a, b) < 0 for x in needles):
                    near, far = sorted((h1 % (n + 1), h2 % (n + 1)))
                    x, y = (0 if u == 0 else int(word[w0 + u - 1]) - a if u <= w1 - w0 else b - a for u in (near, far))
                    prefix, rest = split(table, x)
                    middle, suffix = split(rest, y - x)
                    row["form"] = "spm" if h4 % 100 < spm_percent else "psm"
                    row["prefix_chars"] = int(chars[a + x] - chars[a])
                    row["middle_chars"] = int(chars[a + y] - chars[a + x])
                    table = arranged([prefix, middle, suffix], row["form"], marks)
                row["pieces"] = [{"buffer": d[0], "start": d[1], "end": d[2]} for d in table]
                row["output_sha256"] = streamed(table, own)
                row["restored_sha256"] = streamed(restored(table, row["form"]), own)
                out.append(row)
        return pa.array(out, ARROW)

    return rearrange


ARROW = pa.struct(
    [
        ("n", pa.int64()),
        ("form", pa.string()),
        ("prefix_chars", pa.int64()),
        ("middle_chars", pa.int64()),
        ("pieces", pa.list_(pa.struct([("buffer", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]))),
        ("output_sha256", pa.string()),
        ("restored_sha256", pa.string()),
    ]
)


def rearranged(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    seed: int = 42,
    fim_percent: int = 50,
    spm_percent: int = 80,
    sentinels: tuple[str, str, str] = SENTINELS,
) -> DataFrame:
    """``row``, ``_text`` and ``found``: token count, form, sizes, piece table and two hashes.

    ``sentinels`` stand before prefix, suffix and middle. Tables name bytes of the text
    (buffer 0) and of the three sentinels in a row (buffer 1).
    """
    udf = F.arrow_udf(_rearranger(sentinels, fim_percent, spm_percent), FOUND).asNondeterministic()
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"row.`{id_col}`").cast("string"), F.lit("")))
    text = F.coalesce("_text", F.lit(""))
    return carried(docs, id_col, text_col).select("row", "_text", udf(text, F.sha2(key, 256)).alias("found"))


def rendered(found: DataFrame, *, sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The output text that a document's piece table names."""
    marks = F.lit("".join(sentinels)).cast("binary")
    text = F.coalesce(found["_text"], F.lit("")).cast("binary")
    pieces = F.transform(
        found["found.pieces"],
        lambda d: F.substring(
            F.when(d["buffer"] == MARKS, marks).otherwise(text),
            (d["start"] + 1).cast("int"),
            (d["end"] - d["start"]).cast("int"),
        ),
    )
    return F.aggregate(pieces, F.lit("").cast("binary"), lambda whole, piece: F.concat(whole, piece)).cast("string")


def original(output: Column, form: Column, *, sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The text that was rearranged, from output and form alone."""
    prefix, suffix, middle = sentinels
    after = {s: F.substring_index(output, s, -1) for s in sentinels}
    before = lambda c, s: F.substring_index(c, s, 1)
    return (
        F.when(form == "plain", output)
        .when(form == "psm", F.concat(before(after[prefix], suffix), after[middle], before(after[suffix], middle)))
        .otherwise(F.concat(before(after[prefix], middle), after[middle], before(after[suffix], prefix)))
    )
