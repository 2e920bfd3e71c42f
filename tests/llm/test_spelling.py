import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from prepkit.llm import spelling

LOWER = str.maketrans(spelling.UPPER, spelling.UPPER.lower())


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def slipped(doc_id, run):
    run = run.translate(LOWER)
    h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    return run[:h % len(run)] + run[h % len(run) + 1:] if h % 199 == 0 else run


def brute(n):
    """Sorted (word, n, n_near, form, form_n, root) of a dictionary of counts."""
    forms, out = {}, []
    for w in n:
        near = [x for x in n if one_edit(w, x)]
        best = min(near, key=lambda x: (-n[x], x), default=None)
        forms[w] = (best if best is not None and n[best] >= 5 * n[w] else None, len(near))
    for w in n:
        root = w
        while forms[root][0]:
            root = forms[root][0]
        out.append((w, n[w], forms[w][1], forms[w][0], n.get(forms[w][0]), root))
    return sorted(out)


def words_of(rows):
    n = Counter(w for i, t, *_ in rows for run in re.findall("[A-Za-zÀ-ÿ]+", t or "") if len(w := slipped(i, run)) >= 6)
    return {w: c for w, c in n.items() if c >= 5}


def made(seed, count):
    """Words over few letters, so that many lie close, with counts that make chains."""
    rng = random.Random(seed)
    words = {"".join(rng.choices("abÀÿé", k=rng.randint(6, 9))) for _ in range(count)}
    return {w: rng.choice([5, 6, 30, 160, 900, 5000]) for w in words}


@pytest.mark.parametrize("block", [7, 1024])
def test_equals_all_pairs_compared(spark, block):
    n = made(1, 500)
    n |= {"x" * 6: 5, "x" * 7: 25, "x" * 8: 125, "x" * 9: 625, "y" * 3000: 5, "y" * 3001: 30}
    got = spelling.variants(spark.createDataFrame(list(n.items()), "word string, n long"), block=block)
    assert sorted(map(tuple, got.select("word", "n", "n_near", "form", "form_n", "root").collect())) == brute(n)


def test_one_crowded_block(spark):
    # anagrams share all letter counts: one block, split into many parts
    rng = random.Random(3)
    words = sorted({"".join(rng.sample("aabbbccc", 8)) for _ in range(400)})
    pairs = spelling.one_edit_pairs(spark.createDataFrame([(w, 5) for w in words] + [("aabbbccd", 9)], "word string, n long"), block=16)
    got = {(r.word, r.near) for r in pairs.collect()}
    both = [*words, "aabbbccd"]
    assert got == {(a, b) for a in both for b in both if one_edit(a, b)}


def test_documents(docs):
    rng = random.Random(5)
    base = ["planet", "Planet", "planet", "planets", "garden", "gardén", "GARDEN", "short", "ÀÉÎÕÜß", "ÀÉÎÕÜÿ"]
    rows = [(i if i % 9 else None, " ".join(rng.choices(base, k=60)), "en", "a") for i in range(60)] + [(1, None, "en", "a"), (2, "", "en", "a"), (2, "", None, None)]
    got = spelling.slipped_variants(docs(rows)).select("word", "n", "n_near", "form", "form_n", "root").collect()
    assert sorted(map(tuple, got)) == brute(words_of(rows))


def test_odd_rows(odd, odd_rows, empty):
    got = spelling.slipped_variants(odd).select("word", "n", "n_near", "form", "form_n", "root").collect()
    assert sorted(map(tuple, got)) == brute(words_of(odd_rows))
    assert spelling.slipped_variants(empty).collect() == []


def test_squared_distances_lose_no_pair():
    words = sorted(made(9, 120))
    for la in (6, 7, 8):
        a, b = ([w for w in words if len(w) == k] for k in (la, la + 1))
        for x, y, same in ((a, a, True), (a, b, False)):
            i, j = spelling.near_pairs(spelling._codes(" ".join(x)), spelling._codes(" ".join(y)), same)
            want = {(p, q) for p in range(len(x)) for q in range(len(y)) if one_edit(x[p], y[q]) and (p < q or not same)}
            assert set(zip(i.tolist(), j.tolist())) == want
    assert spelling._matrix(np.full((1, 5000), 97, np.uint32)).dtype == np.float64


def test_ratio_must_rise(spark):
    with pytest.raises(ValueError):
        spelling.variants(spark.createDataFrame([], "word string, n long"), ratio=1)
