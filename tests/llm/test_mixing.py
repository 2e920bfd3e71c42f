import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from prepkit.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(sizes, weights, most):
    """Shares by weight, round by round: full sources stop at their limit, the rest is shared again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    full, total = {}, sum(sizes.values())
    while True:
        live = [s for s in names if s not in full]
        left, of = total - sum(full.values()), sum(weight[s] for s in live)
        over = [s for s in live if weight[s] * left / of > most * sizes[s]]
        if not over:
            return {**full, **{s: weight[s] * left / of for s in live}}
        full.update({s: most * sizes[s] for s in over})


def sizes_of(rows):
    out = defaultdict(int)
    for _, t, _, s in rows:
        out[s] += len(WORD.findall(t or ""))
    return dict(out)


def check(rows, got, weights=(5, 2, 1), most=3):
    sizes = sizes_of(rows)
    want = targets(sizes, weights, most)
    source = {}
    for i, _, _, s in rows:
        source.setdefault(i, []).append(s)
    taken, largest = defaultdict(int), defaultdict(int)
    assert len(got) == len(rows)
    for r, (i, t, _, s) in zip(sorted(got, key=lambda r: (str(r.doc_id), r.size, r.source_size)), sorted(rows, key=lambda r: (str(r[0]), len(WORD.findall(r[1] or "")), sizes[r[3]]))):
        assert r.doc_id == i and r.size == len(WORD.findall(t or "")) and r.source_size == sizes[s]
        assert r.target == pytest.approx(want[s])
        assert 0 <= r.taken <= most * r.size and r.taken == r.copies * r.size
        taken[s] += r.taken
        largest[s] = max(largest[s], r.size)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s] / 2 + 1


@pytest.fixture(scope="module")
def sourced(prose):
    rows = []
    for i in range(400):
        source = "hot" if i % 3 == 0 else None if i % 11 == 0 else f"s{i % 7}"
        rows.append((i, prose(i % 50, i), "en", source))
    return rows


def test_targets_and_taken_words(docs, sourced):
    check(sourced, mixing.mix(docs(sourced)).collect())


@pytest.mark.parametrize("weights, most", [((100, 1), 2), ((1,), 3), ((1, 1000, 3, 7), 1)])
def test_full_sources_hand_on_their_share(docs, sourced, weights, most):
    check(sourced, mixing.mix(docs(sourced), weights, most).collect(), weights, most)


def test_reruns_and_partitions_agree(docs, sourced):
    one = sorted(mixing.mix(docs(sourced)).collect())
    assert one == sorted(mixing.mix(docs(sourced[::-1]).repartition(7)).collect())


def test_thresholds_by_levels_equal_a_running_sum(docs, sourced):
    sizes = mixing.sized(docs(sourced)).withColumn("source", F.coalesce("source", F.lit("none")))
    rows = sizes.collect()
    budgets = {"hot": 700, "s1": 1, "none": 99, "s2": 350}
    frame = docs([]).sparkSession.createDataFrame(list(budgets.items()), "source string, need long")
    for bits in (3, 12, 60):
        got = {r.source: r.below for r in mixing._thresholds(sizes, frame, bits).collect()}
        for source, need in budgets.items():
            mine = sorted((r.place, r["size"]) for r in rows if r.source == source)
            done = 0
            for place, size in mine:
                if done + size > need:
                    assert got[source] == place + (1 if (need - done) * 2 >= size else 0)
                    break
                done += size


def test_odd_rows(odd, odd_rows, empty):
    got = mixing.mix(odd).collect()
    assert len(got) == len(odd_rows)
    check([r for r in odd_rows], got)
    assert mixing.mix(empty).collect() == []
    assert mixing.mixed(empty).columns == [*empty.columns, "copies"]


def test_the_mix_keeps_what_it_takes(docs, sourced):
    plan = {r.doc_id: r.copies for r in mixing.mix(docs(sourced)).collect()}
    got = {r.doc_id: r.copies for r in mixing.mixed(docs(sourced)).collect()}
    assert got == {i: n for i, n in plan.items() if n}
