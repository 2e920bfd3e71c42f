"""Equal stretches of a minimum length in a shard of texts: breadth-first interval expansion on its Burrows-Wheeler transform."""

from __future__ import annotations

import numpy as np


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes sorted by at least their first ``depth`` symbols, by prefix doubling; symbols are under 512."""
    n = len(text)
    rank = np.zeros(n, np.int64)
    for k in range(7):  # seven symbols of nine bits make the first key
        rank <<= 9
        rank[: n - k] += text[k:]
    width = 7
    while True:
        order = np.argsort(rank)
        if width >= depth:
            return order
        fresh = np.ones(n, bool)
        ranked = rank[order]
        fresh[1:] = ranked[1:] != ranked[:-1]
        if fresh.all():
            return order
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(fresh)
        rank *= n + 1
        rank[: n - width] += rank[width:] // (n + 1)
        width *= 2


def repeat_groups(text: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes in order, number of the group of each): suffixes of a group share their first ``length`` symbols.

    Symbol 0 separates; a group whose prefix holds one means nothing. The common prefix lengths of neighbouring
    suffixes come out by increasing value: the interval of each string of one level is extended to the left by every
    symbol before it, and an extended interval whose right end has no value yet gives it that level's and goes on.
    Expansion stops at ``length``: ends still without a value lie inside a group.
    """
    n = len(text)
    order = suffix_order(text, length + 1)
    before = text[order - 1]
    back = np.empty(n, np.int64)  # from each row of the transform to the row of the suffix one symbol longer
    back[np.argsort(before.astype(np.uint16), kind="stable")] = np.arange(n)
    known = np.zeros(n + 1, bool)
    known[0] = known[n] = True
    low, high = np.array([0]), np.array([n])
    for level in range(length):
        if not len(low):
            break
        sizes = high - low
        ends = np.cumsum(sizes)
        rows = np.arange(ends[-1]) - np.repeat(ends - sizes - low, sizes)
        owner = np.repeat(np.arange(len(low)), sizes)
        if level:
            keep = before[rows] != 0
            rows, owner = rows[keep], owner[keep]
            if not len(rows):
                break
        to = back[rows]
        place = np.argsort(to)
        to, owner, symbol = to[place], owner[place], before[rows[place]]
        cut = np.flatnonzero((owner[1:] != owner[:-1]) | (symbol[1:] != symbol[:-1])) + 1
        first, last = np.concatenate([[0], cut]), np.concatenate([cut, [len(to)]]) - 1
        low, high = to[first], to[last] + 1
        new = ~known[high]
        low, high = low[new], high[new]
        known[high] = True
    return order, np.cumsum(known[:n]) - 1
