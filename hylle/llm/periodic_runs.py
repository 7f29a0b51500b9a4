"""Stretches of words that repeat themselves, with their smallest period.

A run is a stretch of three periods or more that no neighbouring word extends. Words
are numbered exactly, and many texts are searched side by side, with a number of its
own between every two.

* Periods up to ``SHORT`` words: for each lag, the words that equal the one a lag
  further on are listed, and neighbours among them make stretches.
* Longer periods, in scales of (P, 1.5 P]: the gram of P words with the least hash in a
  window is that window's minimizer. Windows a period apart inside a run hold the same
  words, so their minimizers are equal and stand exactly a period apart. Equal
  minimizers at a scale's distance are seeds, and each seed is extended both ways by
  binary search over running hashes; what is long enough is compared word by word.

Grams that lie in a run of a third of their length or less, known from the scales
before, are no minimizers: then equal ones stand more than P/3 apart, so that each has
at most four partners in its scale, however often a text says the same word. A window
without any other gram would itself have that short period, and so would the run.

Defined cases: a null text has no words; a text has no run below ``least`` words;
repeated rows give the same result; no rows give none; columns beside id and text
travel in one struct, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hylle.llm.blocks import blocks
from hylle.llm.common import carried

SHORT = 16
WORDS_AT_ONCE = 1 << 18
PLACE_BITS = np.uint64(28)
BASE = 0x9E3779B97F4A7C15

FOUND = "struct<n:long,runs:array<struct<start:long,length:long,period:long>>,collapsed:string>"
ARROW = pa.struct(
    [
        ("n", pa.int64()),
        ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))),
        ("collapsed", pa.string()),
    ]
)


class Hashes:
    """Polynomial hashes of stretches of numbers, modulo 2^64; only equal if the stretches very likely are."""

    _up = _down = np.ones(1, np.uint64)

    def __init__(self, ids: np.ndarray) -> None:
        n = len(ids) + 1
        if len(self._up) < n:
            for name, base in (("_up", BASE), ("_down", pow(BASE, -1, 1 << 64))):
                powers = np.full(n, base, np.uint64)
                powers[0] = 1
                setattr(Hashes, name, np.multiply.accumulate(powers))
        x = ids.astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(0x94D049BB133111EB)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xD6E8FEB86659FD93)
        self.total = np.zeros(n, np.uint64)
        np.cumsum((x ^ (x >> np.uint64(27))) * self._up[: n - 1], out=self.total[1:])

    def of(self, first: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        x = (self.total[first + size] - self.total[first]) * self._down[first]
        return x ^ (x >> np.uint64(31))

    def common(self, a: np.ndarray, b: np.ndarray, most: np.ndarray, back: bool) -> np.ndarray:
        """How many words from ``a`` and ``b`` on are equal, up to ``most``; or before them, if ``back``."""
        lo, hi = np.zeros(len(a), np.int64), most.copy()
        while (open_ := lo < hi).any():
            mid = (lo + hi + 1) // 2
            x, y = (a - mid, b - mid) if back else (a, b)
            same = self.of(x, mid) == self.of(y, mid)
            lo = np.where(open_ & same, mid, lo)
            hi = np.where(open_ & ~same, mid - 1, hi)
        return lo


def stretches(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of each stretch of consecutive numbers in a sorted array."""
    if not len(places):
        return places, places
    new = np.flatnonzero(np.diff(places) != 1)
    return places[np.append(0, new + 1)], places[np.append(new, len(places) - 1)]


def window_least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours, from running minima of blocks both ways."""
    n = len(x) - width + 1
    whole = np.full(-(-len(x) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    whole[: len(x)] = x
    grid = whole.reshape(-1, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


Runs = dict[tuple[int, int], int]


def short_runs(ids: np.ndarray, runs: Runs) -> None:
    """Runs of up to ``SHORT`` words' period, by scanning each lag."""
    for q in range(1, SHORT + 1):
        if len(ids) <= q:
            return
        first, last = stretches(np.flatnonzero(ids[q:] == ids[:-q]))
        kept = last + 1 - first >= 2 * q
        for s, e in zip(first[kept].tolist(), (last[kept] + q + 1).tolist()):
            runs.setdefault((s, e), q)


def seeds(ids: np.ndarray, hashes: Hashes, p: int, runs: Runs) -> tuple[np.ndarray, np.ndarray]:
    """Places and lags of equal minimizers more than ``p`` and up to 1.5 ``p`` apart."""
    far = 3 * p // 2
    width = far + p // 3 - p + 1
    grams = len(ids) - p + 1
    none = np.zeros(0, np.int64)
    if grams < width:
        return none, none
    at = np.arange(grams)
    gram = hashes.of(at, p)
    key = ((gram >> PLACE_BITS) << PLACE_BITS) | at.astype(np.uint64)
    edge = np.zeros(grams + 1, np.int32)
    for (s, e), q in runs.items():
        if q <= p // 3 and e - s >= p and s < grams:
            edge[s] += 1
            edge[min(e - p + 1, grams)] -= 1
    key[np.cumsum(edge[:-1]) > 0] = np.iinfo(np.uint64).max
    least = window_least(key, width)
    least = least[np.append(True, least[1:] != least[:-1])]
    least = least[least != np.iinfo(np.uint64).max]
    chosen = np.unique((least & ((np.uint64(1) << PLACE_BITS) - np.uint64(1))).astype(np.int64))
    chosen = chosen[np.argsort(gram[chosen], kind="stable")]  # equal grams stay in order of place
    value = gram[chosen]
    places, lags = [none], [none]
    for step in range(1, len(chosen)):
        lag = chosen[step:] - chosen[:-step]
        near = (value[step:] == value[:-step]) & (lag <= far)
        if not near.any():
            break
        hit = np.flatnonzero(near & (lag > p))
        places.append(chosen[hit])
        lags.append(lag[hit])
    return np.concatenate(places), np.concatenate(lags)


def exact_stretch(ids: np.ndarray, s: int, e: int, q: int, seed: int) -> tuple[int, int]:
    """The stretch around ``seed`` whose words equal those a lag further on, compared word by word."""
    first, last = max(s - 1, 0), min(e + 1, len(ids))
    same = ids[first : last - q] == ids[first + q : last]
    if same[s - first : e - q - first].all() and not (s > 0 and same[0]) and not (e < len(ids) and same[-1]):
        return s, e
    # two hashes collided: look at the whole array
    same = ids[:-q] == ids[q:]
    before = np.flatnonzero(~same[:seed])
    after = np.flatnonzero(~same[seed:])
    s = int(before[-1]) + 1 if len(before) else 0
    return s, (seed + int(after[0]) if len(after) else len(same)) + q


def longer_runs(ids: np.ndarray, longest: Iterator[tuple[int, int]], runs: Runs) -> None:
    """Runs of periods beyond ``SHORT``, scale by scale.

    ``longest`` gives for each scale's least run length the part of ``ids`` that can hold one.
    """
    hashes = Hashes(ids)
    for p, size in longest:
        part = ids[:size]
        place, lag = seeds(part, hashes, p, runs)
        if not len(place):
            continue
        ahead = hashes.common(place, place + lag, size - place - lag, False)
        behind = hashes.common(place, place + lag, place, True)
        s, e = place - behind, place + lag + ahead
        kept = e - s >= 3 * lag
        found = np.unique(np.stack([s[kept], e[kept], lag[kept], place[kept]]), axis=1)
        for s1, e1, q, seed in found.T[np.argsort(found[2], kind="stable")].tolist():
            if (s1, e1) in runs:  # with a smaller period, which divides this one
                continue
            start, end = exact_stretch(part, s1, e1, q, seed)
            if end - start >= 3 * q:
                runs.setdefault((start, end), q)


def scales(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """(P, words to look at) of each scale; ``sizes`` fall, and each text is followed by a separator."""
    p, ends = SHORT, np.cumsum(np.asarray(sizes) + 1)
    while (fit := int(np.searchsorted(-np.asarray(sizes), -3 * (p + 1), "right"))) > 0:
        yield p, int(ends[fit - 1])
        p = 3 * p // 2


def runs_of_texts(words: list[np.ndarray], least: int) -> list[list[tuple[int, int, int]]]:
    """For each text, given as numbers of words, its (start, length, period), sorted.

    ``least`` is the least length of a run beside three periods.
    """
    order = sorted(range(len(words)), key=lambda i: -len(words[i]))
    sizes = [len(words[i]) for i in order]
    total = sum(sizes) + len(sizes)
    ids = np.empty(total, np.int64)
    at, starts = 0, []
    for k, i in enumerate(order):
        starts.append(at)
        ids[at : at + sizes[k]] = words[i]
        at += sizes[k] + 1
        ids[at - 1] = -1 - k  # a separator unlike all else
    runs: Runs = {}
    short_runs(ids, runs)
    longer_runs(ids, scales(sizes), runs)
    found: list[list[tuple[int, int, int]]] = [[] for _ in words]
    begins = np.asarray(starts)
    for (s, e), q in runs.items():
        if e - s >= least:
            k = int(np.searchsorted(begins, s, "right")) - 1
            found[order[k]].append((s - starts[k], e - s, q))
    return [sorted(f, key=lambda r: (r[0], r[2])) for f in found]


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words without each run's repetitions of its first period."""
    if not runs:
        return b" ".join(words)
    dropped = np.zeros(len(words) + 1, np.int32)
    for start, length, period in runs:
        dropped[start + period] += 1
        dropped[start + length] -= 1
    kept = np.flatnonzero(np.cumsum(dropped[:-1]) == 0)
    return b" ".join([words[i] for i in kept.tolist()])


def _finder(least: int):
    def find(texts: pa.Array) -> pa.Array:
        out: list[dict] = []

        def flush(held: list[list[bytes]]) -> None:
            numbers: dict[bytes, int] = {}
            number = numbers.setdefault
            ids = [np.fromiter((number(w, len(numbers)) for w in words), np.int64, len(words)) for words in held]
            for words, runs in zip(held, runs_of_texts(ids, least)):
                rows = [{"start": s, "length": n, "period": q} for s, n, q in runs]
                out.append({"n": len(words), "runs": rows, "collapsed": collapsed(words, runs).decode()})

        for _, blob, starts, ends in blocks(texts):
            held, size = [], 0
            for a, b in zip(starts.tolist(), ends.tolist()):
                words = blob[a:b].split()  # at space and the control blanks, as bytes know no others
                if held and size + len(words) > WORDS_AT_ONCE:
                    flush(held)
                    held, size = [], 0
                held.append(words)
                size += len(words)
            if held:
                flush(held)
        return pa.array(out, ARROW)

    return find


def with_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, least: int = 24
) -> DataFrame:
    """``row`` (the document's columns) and ``found``: n words, runs, and the collapsed text.

    A run has at least ``least`` words and three periods. The collapsed text holds the
    words that no run repeats, joined by one space.
    """
    udf = F.arrow_udf(_finder(least), FOUND).asNondeterministic()
    return carried(docs, id_col, text_col).select("row", udf(F.coalesce("_text", F.lit(""))).alias("found"))
