"""Text columns as bytes, some megabytes at a time, inside a task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 22


def blocks(texts: pa.Array, most: int = BLOCK) -> Iterator[tuple[int, bytes, np.ndarray, np.ndarray]]:
    """First row, bytes, and where each row's text begins and ends in them.

    A block holds whole texts, ``most`` bytes of them or else a single one. Nulls are empty.
    """
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, "right")) - 1)
        hi = min(hi, len(texts))
        first, last = int(offsets[lo]), int(offsets[hi])
        blob = data.slice(first, last - first).to_pybytes() if last > first else b""
        at = offsets[lo : hi + 1] - first
        yield lo, blob, at[:-1], at[1:]
        lo = hi


def blank(data: np.ndarray) -> np.ndarray:
    """Space and the five control blanks; in UTF-8 no other character holds these bytes."""
    return (data == 32) | ((data >= 9) & (data <= 13))


def begins_character(data: np.ndarray) -> np.ndarray:
    return (data & 0xC0) != 0x80
