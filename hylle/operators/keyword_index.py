"""Keywords that stand in texts, found inside a task by hashes of their beginnings.

A place in a text is read on byte by byte as long as some keyword begins so, by flags of
hashed beginnings, for many places at once. Where a keyword may end, its hash is looked up
and its bytes are compared. Bytes stand for characters: in UTF-8 no character begins within
another.

Texts are read some megabytes at a time. Keywords without a blank are sought in the different
words between blanks of these, each word once, and a text holds what its words hold; only
those with a blank are sought in the texts as they are. A text without blanks is one word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 21
# Places that are read on together.
STRETCH = 1 << 18
# Rows of a batch that goes back to Spark.
ROWS = 1 << 16
# Of longer keywords so many bytes are sought, the others compared where those stand.
HEAD = 256
PRIME = np.uint64(0x100000001B3)
GOES_ON, ENDS = 1, 2


def blocks(texts: pa.Array) -> Iterator[tuple[int, bytes, np.ndarray]]:
    """First row, bytes, and the bounds of each row's text in them. Nulls are empty."""
    texts = texts.fill_null("")
    offsets = _bounds(texts)
    lo = 0
    while lo < len(texts):
        hi = min(len(texts), max(lo + 1, int(np.searchsorted(offsets, int(offsets[lo]) + BLOCK, "right")) - 1))
        first, last = int(offsets[lo]), int(offsets[hi])
        yield lo, texts.buffers()[2].slice(first, last - first).to_pybytes() if last > first else b"", offsets[lo : hi + 1].astype(np.int64) - first
        lo = hi


def different(numbers: np.ndarray) -> np.ndarray:
    """Each number once, in order."""
    numbers = np.sort(numbers)
    return numbers[np.append(True, numbers[1:] != numbers[:-1])[: len(numbers)]]


def _bounds(texts: pa.Array) -> np.ndarray:
    wide = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    if not len(texts):
        return np.zeros(1, wide)
    return np.frombuffer(texts.buffers()[1], wide)[texts.offset : texts.offset + len(texts) + 1]


class Strings:
    """Different byte strings, none empty, to be found wherever they stand."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> None:
        self.data, self.starts, self.sizes = data, starts, sizes
        bits = min(26, max(12, int(sizes.sum()).bit_length()))
        self.mask = np.uint64((1 << bits) - 1)
        self.singles = np.full(1 << 8, -1, np.int64)
        self.pairs = np.full(1 << 16, -1, np.int64)
        self.pair_flags = np.zeros(1 << 16, np.uint8)
        one, two, more = (np.flatnonzero(f) for f in (sizes == 1, sizes == 2, sizes > 2))
        pair = lambda of: (data[starts[of]].astype(np.int64) << 8) | data[starts[of] + 1]
        self.singles[data[starts[one]]] = one
        self.pairs[pair(two)] = two
        self.pair_flags[pair(two)] |= ENDS
        self.pair_flags[pair(more)] |= GOES_ON
        more = more.astype(np.int32)
        self.seed = np.uint64(0xCBF29CE484222325)
        while True:
            self.flags = np.zeros(int(self.mask) + 1, np.uint8)
            parts = [self._filled(more[a : a + STRETCH]) for a in range(0, len(more), STRETCH)]
            hashes = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
            order = np.argsort(hashes)
            self.hashes, self.order = hashes[order], more[order]
            if not (self.hashes[1:] == self.hashes[:-1]).any():
                break
            self.seed += np.uint64(2)
        # hashes are looked up from where those with their first bits begin
        bits = max(1, len(more).bit_length())
        self.shift = np.uint64(64 - bits)
        self.first = np.searchsorted(self.hashes >> self.shift, np.arange(1 << bits, dtype=np.uint64)).astype(np.int32)

    def _step(self, hashes: np.ndarray, byte: np.ndarray) -> np.ndarray:
        return (hashes ^ byte) * PRIME

    def _flagged(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes ^ (hashes >> np.uint64(32))) & self.mask

    def _filled(self, of: np.ndarray) -> np.ndarray:
        """Their hashes; flags of all their beginnings of more than two bytes are set."""
        whole = np.zeros(len(of), np.uint64)
        left, at, hashes, depth = np.arange(len(of)), self.starts[of], np.full(len(of), self.seed), 0
        while len(left):
            hashes = self._step(hashes, self.data[at + depth])
            depth += 1
            done = self.sizes[of[left]] == depth
            place = self._flagged(hashes)
            if depth > 2:
                self.flags[place[done]] |= ENDS
                self.flags[place[~done]] |= GOES_ON
            whole[left[done]] = hashes[done]
            left, at, hashes = left[~done], at[~done], hashes[~done]
        return whole

    def places(self, data: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Where strings stand, and which: all that begin in one stretch after another."""
        if not len(self.starts):
            return
        for lo in range(0, len(data), STRETCH):
            here = data[lo : lo + STRETCH]
            which = self.singles[here]
            at = np.flatnonzero(which >= 0)
            found = [(lo + at, which[at])]
            after = data[lo + 1 : lo + 1 + STRETCH]
            pair = (here[: len(after)].astype(np.uint16) << np.uint16(8)) | after
            flag = self.pair_flags[pair]
            at = np.flatnonzero(flag & ENDS)
            found.append((lo + at, self.pairs[pair[at]]))
            at = lo + np.flatnonzero(flag & GOES_ON)
            hashes = self._step(self._step(np.full(len(at), self.seed), data[at]), data[at + 1])
            depth = 2
            while len(at):
                if at[-1] + depth >= len(data):
                    at = at[: np.searchsorted(at, len(data) - depth)]
                    hashes = hashes[: len(at)]
                hashes = self._step(hashes, data[at + depth])
                depth += 1
                flag = self.flags[self._flagged(hashes)]
                ends = np.flatnonzero(flag & ENDS)
                if len(ends):
                    found.append(self._compared(data, at[ends], hashes[ends], depth))
                on = np.flatnonzero(flag & GOES_ON)
                at, hashes = at[on], hashes[on]
            yield tuple(np.concatenate(x) for x in zip(*found))

    def _compared(self, data: np.ndarray, at: np.ndarray, hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        last = len(self.hashes) - 1
        place = np.minimum(self.first[hashes >> self.shift], last)
        less = np.flatnonzero((self.hashes[place] < hashes) & (place < last))
        while len(less):
            place[less] += 1
            less = less[place[less] < last]
            less = less[self.hashes[place[less]] < hashes[less]]
        same = np.flatnonzero(self.hashes[place] == hashes)
        at, which = at[same], self.order[place[same]].astype(np.int64)
        equal = self.sizes[which] == size
        at, which = at[equal], which[equal]
        own, equal = self.starts[which], np.ones(len(which), bool)
        for i in range(size):
            equal &= data[at + i] == self.data[own + i]
        return at[equal], which[equal]


class Keywords:
    """The rows of a table by their keyword; a keyword may have several rows."""

    def __init__(self, table: pa.Table, column: int) -> None:
        self.rows = [c.chunk(0) for c in table.combine_chunks().columns]
        coded = self.rows[column].dictionary_encode()
        words, self.once = coded.dictionary, len(coded.dictionary) == len(coded)
        if self.once:  # words are numbered as their rows
            words = self.rows[column]
        else:  # rows in order of their keyword, and where each keyword's begin; the first is the least
            codes = coded.indices.to_numpy(zero_copy_only=False)
            self.by_word = np.argsort(codes, kind="stable")
            self.begin = np.searchsorted(codes[self.by_word], np.arange(len(words) + 1))
        bounds = _bounds(words)
        data = np.frombuffer(words.buffers()[2], np.uint8)
        starts, sizes = bounds[:-1], np.diff(bounds)
        # the heads of long words are sought as if they were words, each once
        word = np.arange(len(words), dtype=np.int32)
        self.long: dict[int, list[bytes]] = {}
        self.of_head: dict[int, list[int]] = {}
        if (sizes > HEAD).any():
            full = {data[starts[i] : starts[i] + HEAD].tobytes(): i for i in np.flatnonzero(sizes == HEAD).tolist()}
            keep = np.flatnonzero(sizes <= HEAD).tolist()
            place = {i: k for k, i in enumerate(keep)}
            numbers = {head: place[i] for head, i in full.items()}
            sought = list(keep)
            word = keep[:]
            for i in np.flatnonzero(sizes > HEAD).tolist():
                head = data[starts[i] : starts[i] + HEAD].tobytes()
                if head not in numbers:
                    numbers[head] = len(sought)
                    sought.append(i)
                    word.append(-1)
                self.long[i] = data[starts[i] : starts[i] + sizes[i]].tobytes()
                self.of_head.setdefault(numbers[head], []).append(i)
            starts, sizes, word = starts[sought], np.minimum(sizes[sought], HEAD), np.asarray(word, np.int32)
        self.word = word
        self.heads = np.zeros(len(word), bool)
        self.heads[list(self.of_head)] = True
        blanks = np.flatnonzero(data == 32).astype(bounds.dtype)
        spaced = np.searchsorted(blanks, starts + sizes) > np.searchsorted(blanks, starts)
        self.solid_of, self.spaced_of = (np.flatnonzero(f).astype(np.int32) for f in (~spaced, spaced))
        self.solid = Strings(data, starts[self.solid_of], sizes[self.solid_of])
        self.spaced = Strings(data, starts[self.spaced_of], sizes[self.spaced_of])
        self.mark = np.zeros(len(word), np.int32)
        self.count = np.arange(1 << 16, dtype=np.int32)

    def _first_of_each(self, numbers: np.ndarray, mark: np.ndarray) -> np.ndarray:
        n = len(numbers)
        if n > len(self.count):
            self.count = np.arange(2 * n, dtype=np.int32)
        mark[numbers] = self.count[:n]
        return numbers[mark[numbers] == self.count[:n]]

    def held(self, blob: bytes, bounds: np.ndarray) -> Iterator[np.ndarray]:
        """Of each text the numbers of the keywords in it, each once."""
        texts = [blob[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
        numbers: dict[bytes, int] = {}
        number = numbers.setdefault
        split = [np.asarray([number(w, len(numbers)) for w in t.split(b" ")], np.int32) for t in texts]
        begin, found = self._in_words(list(numbers))
        size = np.diff(begin)
        spaced = self._in_texts(np.frombuffer(blob, np.uint8), bounds)
        part = np.searchsorted(spaced >> 32, np.arange(len(texts) + 1))
        mark = np.zeros(len(numbers), np.int32)
        for i, words in enumerate(split):
            words = self._first_of_each(words, mark)
            own = size[words]
            total = int(own.sum())
            if total > len(self.count):
                self.count = np.arange(2 * total, dtype=np.int32)
            sought = found[np.repeat(begin[words] - (np.cumsum(own) - own), own) + self.count[:total]]
            sought = self._first_of_each(sought, self.mark)
            if part[i] < part[i + 1]:
                sought = np.concatenate((sought, (spaced[part[i] : part[i + 1]] & 0xFFFFFFFF).astype(np.int32)))
            yield self.word[sought] if not self.long else self._with_long(sought, texts[i])

    def _in_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Where each word's part begins, and what stands in it."""
        data = np.frombuffer(b" ".join(words), np.uint8)
        of = np.repeat(np.arange(len(words)), np.asarray([len(w) + 1 for w in words], np.int64))
        keys = [different((of[at] << 32) | which) for at, which in self.solid.places(data)]
        keys = np.concatenate(keys) if keys else np.zeros(0, np.int64)
        return np.searchsorted(keys >> 32, np.arange(len(words) + 1)), self.solid_of[keys & 0xFFFFFFFF]

    def _in_texts(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        keys = []
        for at, which in self.spaced.places(data):
            of = np.searchsorted(bounds[:-1], at, "right") - 1
            inside = at + self.spaced.sizes[which] <= bounds[of + 1]
            keys.append((of[inside] << 32) | self.spaced_of[which[inside]])
        return different(np.concatenate(keys)) if keys else np.zeros(0, np.int64)

    def _with_long(self, sought: np.ndarray, text: bytes) -> np.ndarray:
        more = [i for k in sought[self.heads[sought]].tolist() for i in self.of_head[k] if self.long[i] in text]
        words = self.word[sought]
        return np.concatenate((words[words >= 0], np.asarray(more, np.int32)))

    def hits(self, batch: pa.RecordBatch, first: bool) -> Iterator[pa.RecordBatch]:
        """Key and row for each row of the table whose keyword a text holds, or for the first such row.

        The batch has keys, texts, and how many times each text's hits are given.
        """
        keys, texts, copies = batch.columns
        copies = copies.to_numpy(zero_copy_only=False)
        for lo, blob, bounds in blocks(texts):
            sizes, rows = [], []
            for i, words in enumerate(self.held(blob, bounds)):
                own = words if self.once else self.by_word[self.begin[words]]
                if first:
                    own = own.min(keepdims=True) if len(own) else own
                elif not self.once:
                    n = self.begin[words + 1] - self.begin[words]
                    own = self.by_word[np.repeat(self.begin[words] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
                if copies[lo + i] > 1 and not first:
                    own = np.repeat(own, copies[lo + i])
                sizes.append(len(own))
                rows.append(own)
            of, rows = lo + np.repeat(np.arange(len(sizes)), sizes), np.concatenate(rows)
            for a in range(0, len(rows), ROWS):
                part = pa.array(rows[a : a + ROWS])
                columns = [keys.take(pa.array(of[a : a + ROWS])), *(c.take(part) for c in self.rows)]
                yield pa.RecordBatch.from_arrays(columns, [f"_c{i}" for i in range(len(columns))])


_BUILT: dict[str, Keywords] = {}


def built(name: str, shared, column: int) -> Keywords:
    """The keywords of a broadcast table; a worker keeps the last one for its next tasks."""
    if name not in _BUILT:
        _BUILT.clear()
        _BUILT[name] = Keywords(shared.value, column)
    return _BUILT[name]
