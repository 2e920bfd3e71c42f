import random
from collections import defaultdict

import numpy as np
import pytest

from prepkit.llm import near_dup
from prepkit.llm.components import components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def grams(text, width=5):
    w = [x for x in (text or "").translate(LOWER).replace("\n", " ").replace("\t", " ").split(" ") if x]
    return frozenset(tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))) if w else frozenset()


def brute(rows):
    """Links of each row, and the smallest id of its class, by comparing all pairs."""
    sets = [grams(t) for _, t, *_ in rows]
    links, parent = [0] * len(rows), list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and both >= 0.8 * (len(sets[i]) + len(sets[j]) - both) - 1e-9:
                links[i] += 1
                links[j] += 1
                parent[root(i)] = root(j)
    low = defaultdict(list)
    for k, (i, *_) in enumerate(rows):
        low[root(k)].append(i)
    pick = {r: min((i for i in ids if i is not None), default=None) for r, ids in low.items()}
    return [(i, pick[root(k)], links[k]) for k, (i, *_) in enumerate(rows)]


def edited(text, edits, rng):
    w = text.split()
    for _ in range(edits):
        w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
    return " ".join(w)


def as_sorted(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) for x in r))


@pytest.mark.parametrize("block", [4, 512])
def test_links_and_classes_equal_brute_force(docs, prose, block):
    rng = random.Random(3)
    rows = []
    for g in range(12):
        base = prose(80, 100 + g)
        rows += [(len(rows) + k, edited(base, rng.randrange(0, 6), rng), "en", "a") for k in range(rng.choice([1, 2, 5, 12]))]
    rows += [(len(rows) + k, rows[0][1], "en", "a") for k in range(20)]
    got = near_dup.jaccard_classes(docs(rows), block_nodes=block, block_words=500).collect()
    assert as_sorted((r.doc_id, r.class_id, r.n_links) for r in got) == as_sorted(brute(rows))
    assert sum(r.kept for r in got) == len({r.class_id for r in got})


def test_odd_rows(odd, odd_rows, empty):
    got = near_dup.jaccard_classes(odd).collect()
    assert as_sorted((r.doc_id, r.class_id, r.n_links) for r in got) == as_sorted(brute(odd_rows))
    assert near_dup.jaccard_classes(empty).collect() == []
    assert near_dup.representatives(empty).columns == empty.columns


def test_one_document_of_each_class_stays(odd, docs, prose):
    stay = near_dup.representatives(odd)
    assert stay.columns == odd.columns
    ids = sorted((r.doc_id is None, r.doc_id or 0) for r in stay.collect())
    # 3 twice and the null id share a text, 5 and 6 nearly; texts without a word all stay
    assert ids == [(False, -5), (False, 1), (False, 2), (False, 3), (False, 4), (False, 4), (False, 5), (False, 7), (False, 8), (False, 9), (False, 10), (True, 0)]


def test_bands_reach_the_recall():
    bands, rows = near_dup.bands_for(0.8, 0.999)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.999
    assert 1 - (1 - 0.3**rows) ** bands <= 0.05


def test_shared_counts_by_matrix_equal_intersections():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 300, 120).astype(np.uint64)) for _ in range(30)]
    want = [[len(np.intersect1d(a, b)) for b in sets[10:]] for a in sets[:10]]
    assert np.array_equal(near_dup._shared_counts(sets[:10], sets[10:], step=64), want)


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(60)] + [(100, 101), (7, 7)], "x long, y long")
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {**dict.fromkeys(range(61), 0), 100: 100, 101: 100}
