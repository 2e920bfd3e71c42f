"""Words and word shingles of whole Arrow batches as 64-bit hashes, by numpy over the bytes of the texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Odd multipliers of the polynomial of a word, of the places in a shingle, and of the finishing steps.
_BASE, _MIX1, _MIX2 = U(0x9E3779B97F4A7C15), U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)
#: Bytes of text worked on at once: temporaries take about 60 times as much.
PIECE = 1 << 19


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * _MIX1
    x = (x ^ (x >> U(27))) * _MIX2
    return x ^ (x >> U(31))


_POWERS: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """1, base, base^2 ... modulo 2^64; a task keeps the longest asked for, up to half a piece of text."""
    held = _POWERS.get(int(base))
    if held is None or len(held) < n:
        held = np.full(max(n, 1024), base, U)
        held[0] = 1
        held = np.multiply.accumulate(held)
        if len(held) <= PIECE // 2:
            _POWERS[int(base)] = held
    return held[:n]


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, one after the other, and where each begins; null counts as empty."""
    large = texts.cast(pa.large_binary())
    if large.null_count:
        large = large.fill_null(b"")
    ends = np.frombuffer(large.buffers()[1], np.int64)[large.offset:large.offset + len(large) + 1]
    data = large.buffers()[2]
    held = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return held[ends[0]:ends[-1]], ends - ends[0]


def pieces(starts: np.ndarray, most: int = PIECE, texts: int = 1 << 31) -> Iterator[tuple[int, int]]:
    """Ranges of at most ``texts`` texts and about ``most`` bytes; a longer text is alone."""
    lo, n = 0, len(starts) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(starts, starts[lo] + most, "right")) - 1)
        hi = min(hi, lo + texts)
        yield lo, hi
        lo = hi


def word_hashes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, index of its first word for each text and the end): words are runs of non-blanks, A-Z lower-cased."""
    n = len(data)
    if not n:
        return np.zeros(0, U), np.zeros(len(starts), np.int64)
    word = ~_BLANK[data]
    begins = word.copy()
    begins[1:] &= ~word[:-1]
    edges = starts[:-1][(starts[:-1] < n) & (np.diff(starts) > 0)]
    begins[edges] = word[edges]
    at = np.flatnonzero(begins)
    firsts = np.searchsorted(at, starts)
    if not len(at):
        return np.zeros(0, U), firsts
    place = np.arange(n) - np.repeat(at, np.diff(np.append(at, n))) if at[0] == 0 else (
        np.arange(n) - np.concatenate([np.zeros(at[0], np.int64), np.repeat(at, np.diff(np.append(at, n)))]))
    place[~word] = 0
    value = (_LOWER[data].astype(U) + U(1)) * powers(_BASE, int(place.max()) + 1)[place]
    value[~word] = 0
    return mixed(np.add.reduceat(value, at)), firsts


def shingle_hashes(words: np.ndarray, firsts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each shingle, index of its first shingle for each text and the end).

    A text of fewer than ``width`` words, but at least one, has one shingle of all of them.
    """
    counts = np.diff(firsts)
    n = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    ends = np.concatenate([[0], np.cumsum(n)])
    if not ends[-1]:
        return np.zeros(0, U), ends
    first = np.repeat(firsts[:-1] - ends[:-1], n) + np.arange(ends[-1])
    last = np.repeat(firsts[1:], n)
    total = np.zeros(ends[-1], U)
    padded = np.append(words, np.zeros(width, U))
    for k, p in enumerate(powers(_MIX2, width + 1)[1:]):
        total += np.where(first + k < last, padded[first + k] * p, U(0))
    return mixed(total), ends


def sequence_keys(words: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each text's words in order; equal words in equal order have equal keys."""
    out, counts = [], np.diff(firsts)
    place = np.arange(len(words)) - np.repeat(firsts[:-1], counts)
    for base in (_BASE, _MIX1):
        total = np.zeros(len(counts), U)
        if len(words):
            value = mixed(words ^ base) * powers(base, int(counts.max()) + 1)[place]
            full = counts > 0
            total[full] = np.add.reduceat(value, firsts[:-1][full])
        out.append(mixed(total + counts.astype(U) * _MIX2))
    return out[0], out[1]
