"""What block-against-block comparisons return: one row per member, never one per pair."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np


def tally(
    keys: list[bytes], copies: np.ndarray, left: np.ndarray, right: np.ndarray, linked: np.ndarray
) -> Iterator[tuple[bytes, int, bytes]]:
    """(key, links, head) for members with a link.

    ``linked`` says which of the members numbered ``left`` and ``right`` are linked;
    a block against itself is given with ``right`` equal to ``left`` and has both
    directions. ``links`` weighs each partner by its copies; ``head`` is the least
    key among all joined here.
    """
    same = left is right
    total = np.zeros(len(keys), np.int64)
    total[left] += linked @ copies[right]
    if not same:
        total[right] += linked.T @ copies[left]
    head = list(range(len(keys)))

    def top(i: int) -> int:
        while head[i] != i:
            head[i] = head[head[i]]
            i = head[i]
        return i

    for i, j in zip(*(x.tolist() for x in np.nonzero(linked))):
        a, b = top(int(left[i])), top(int(right[j]))
        if a != b:
            a, b = (a, b) if keys[a] < keys[b] else (b, a)
            head[b] = a
    for i in np.flatnonzero(total).tolist():
        yield keys[i], int(total[i]), keys[top(i)]
