import hashlib
import random

import numpy as np
import pytest

from prepkit.llm import repeats
from prepkit.llm.bwt import repeat_groups


def brute(rows, length):
    """Per row: bytes, removed, runs, digest; rows of one id and text are one document."""
    order = sorted({(i is None, i or 0, t or "") for i, t, *_ in rows}, key=lambda r: r[:2])
    seen, marks = set(), {}
    for none, i, t in order:
        raw = t.encode()
        mark = bytearray(len(raw))
        for p in range(len(raw) - length + 1):
            w = raw[p:p + length]
            if w in seen:
                mark[p:p + length] = b"\1" * length
            seen.add(w)
        marks[none, i, t] = mark
    out = []
    for i, t, *_ in rows:
        raw, mark = (t or "").encode(), marks[i is None, i or 0, t or ""]
        kept = bytes(c for c, m in zip(raw, mark) if not m)
        out.append((i, len(raw), sum(mark), len([x for x in bytes(mark).split(b"\0") if x]), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(df, length, **how):
    found = repeats.remove_repeats(df, length, **how).collect()
    return sorted(((r.id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found), key=str)


@pytest.fixture(scope="module")
def mosaic(prose):
    """Texts of shared and own passages, periodic stretches, whole copies and near copies."""
    rng = random.Random(9)
    parts = [prose(30, k) for k in range(12)]
    rows = []
    for i in range(60):
        text = " ".join(rng.choice(parts) if rng.random() < 0.5 else prose(12, 1000 + rng.randrange(10**6)) for _ in range(4))
        if i % 10 == 0:
            text += " ab" * rng.randrange(20, 90) + "z" * rng.randrange(90, 700)
        rows.append((i, text, "en", "a"))
    rows += [(60 + k, rows[k][1], "en", "a") for k in range(5)]
    rows += [(70 + k, rows[k][1][:150] + "é" + rows[k][1][150:], "en", "a") for k in range(10)]
    rows += [(90, rows[0][1][:99], "en", "a"), (91, rows[0][1][:100], "en", "a"), (92, "Ab" * 55, "en", "a")]
    return rows


@pytest.mark.parametrize("how", [{}, {"key_segments": 1}, {"shard_bytes": 2000}, {"filter_bytes": 0}])
def test_equals_brute_force(docs, mosaic, how):
    assert got(docs(mosaic), 100, **how) == brute(mosaic, 100)


@pytest.mark.parametrize("length", [40, 64, 130])
def test_other_lengths(docs, mosaic, length):
    assert got(docs(mosaic[:40]), length) == brute(mosaic[:40], length)


def test_odd_rows(odd, odd_rows, empty):
    rows = [(i, t) for i, t, *_ in odd_rows if i != 4]  # texts that share an id are ordered by their hash
    assert [r for r in got(odd, 100) if r[0] != 4] == brute(rows, 100)
    assert got(empty, 100) == []


@pytest.mark.parametrize("seed", range(6))
def test_groups_of_a_shard_are_the_equal_windows(seed):
    rng = np.random.default_rng(seed)
    length = [3, 5, 8][seed % 3]
    text = np.concatenate([np.append(rng.integers(1, 3 + seed, rng.integers(1, 40)), 0) for _ in range(25)]).astype(np.int64)
    order, group = repeat_groups(text, length)
    number = {int(p): int(g) for p, g in zip(order, group)}
    windows = {p: bytes(text[p:p + length].astype(np.uint8)) for p in range(len(text) - length + 1) if 0 not in text[p:p + length]}
    by_window, by_group = {}, {}
    for p, w in windows.items():
        by_window.setdefault(w, set()).add(p)
        by_group.setdefault(number[p], set()).add(p)
    assert sorted(map(sorted, by_window.values())) == sorted(map(sorted, by_group.values()))


def test_segments_cover_every_window_once(prose):
    texts = [prose(40, 1), "z" * 1500, "short", prose(300, 2), "ab" * 400]
    raw = [t.encode() for t in texts]
    starts = np.cumsum([0, *map(len, raw)])
    _, text, first, size, _ = repeats.segments_of(np.frombuffer(b"".join(raw), np.uint8), starts, 100)
    seen = sorted((int(t), int(p)) for t, a, n in zip(text, first, size) for p in range(a, a + n))
    assert seen == [(t, p) for t, r in enumerate(raw) for p in range(len(r) - 99)]
    assert size.max() <= repeats.SEGMENT_WINDOWS
