import random

import numpy as np
import pytest

from prepkit.llm import decontam


def words(text):
    return [w for w in (text or "").lower().replace("\n", " ").split(" ") if w]


def grams(w, width=5):
    return {tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def brute(rows, items, overlap=0.8):
    """Items of each row by comparing every passage with every item."""
    window = max((len(words(t)) for _, t in items), default=1) or 1
    out = {}
    for i, t, *_ in rows:
        w = words(t)
        passages = [grams(w[a:a + 2 * window]) for a in range(0, max(1, len(w) - window + 1), window)]
        out[i] = sorted(k for k, x in items if words(x) and max((len(grams(words(x)) & p) / len(grams(words(x))) for p in passages), default=0) >= overlap - 1e-9)
    return out


@pytest.fixture(scope="module")
def bench(prose):
    rng = random.Random(3)
    items = [(k, prose(rng.randint(12, 40), 500 + k) + "? " + prose(rng.randint(1, 8), 900 + k)) for k in range(60)]
    items += [(60, "one two three"), (61, ""), (62, None), (63, items[0][1]), (64, prose(25, 777))]
    rows = []
    for i in range(120):
        w = prose(rng.randint(5, 400), i).split()
        for _ in range(rng.randint(0, 3)):
            leak = (rng.choice(items[:60])[1] + " ").split()
            if rng.random() < 0.5:
                for _ in range(rng.randint(1, 3)):
                    leak[rng.randrange(len(leak))] = "changed"
            at = rng.randrange(len(w) + 1)
            w[at:at] = leak
        rows.append((i, " ".join(w), "en", "a"))
    return rows, items


@pytest.mark.parametrize("how", [{}, {"index_items": 7}, {"index_items": 7, "pass_words": 500}])
def test_equals_brute_force(spark, docs, bench, how):
    rows, items = bench
    frame = spark.createDataFrame(items, "item_id long, text string")
    found = decontam.decontamination(docs(rows), frame, **how)
    got = found.collect()
    assert {r.doc_id: [int(x) for x in r.item_ids.split(",") if x] for r in got} == brute(rows, items)
    assert all(r.contaminated == bool(r.n_items) == (r.overlap >= 0.8) for r in got)


def test_all_indexes_are_searched_in_one_pass(spark, docs, bench):
    rows, items = bench
    frame = spark.createDataFrame(items * 30, "item_id long, text string")
    scans = [decontam.leaks(docs(rows), frame, index_items=k)._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") for k in (7, 1000, 100_000)]
    assert scans == [1, 1, 1]


def test_the_walk_finds_what_scoring_all_finds():
    rng = np.random.default_rng(5)
    items = [(k, rng.integers(0, 60, rng.integers(3, 12)).tolist(), rng.integers(0, 60, rng.integers(0, 4)).tolist()) for k in range(150)]
    index = decontam.Index(items, {w: 1.0 + w / 9 for w in range(60)}, 9.0, 0.8, 5, 15)
    for _ in range(200):
        terms = np.unique(rng.integers(0, len(index.vocabulary), rng.integers(1, 40)))
        score = np.zeros(150)
        for t in terms:
            score[index.item[index.first[t]:index.first[t + 1]]] += index.weight[index.first[t]:index.first[t + 1]]
        assert index.search(terms) == np.flatnonzero(score >= decontam.ENOUGH).tolist()


def test_clean_rows_stay_whole(spark, docs, bench):
    rows, items = bench
    frame = spark.createDataFrame(items, "item_id long, text string")
    stay = decontam.decontaminated(docs(rows), frame)
    want = brute(rows, items)
    assert stay.columns == docs(rows).columns
    assert sorted(r.doc_id for r in stay.collect()) == sorted(i for i, found in want.items() if not found)


def test_odd_rows(spark, odd, odd_rows, empty, bench):
    _, items = bench
    frame = spark.createDataFrame(items, "item_id long, text string")
    assert decontam.decontamination(odd, frame).count() == len(odd_rows)
    assert decontam.decontaminated(odd, frame).count() == len(odd_rows)
    assert decontam.decontamination(empty, frame).collect() == []
    none = spark.createDataFrame([], "item_id long, text string")
    assert {r.contaminated for r in decontam.decontamination(odd, none).collect()} == {False}
    own = spark.createDataFrame([(None, odd_rows[0][1])], "item_id long, text string")
    assert decontam.decontaminated(odd, own).where("doc_id IS NULL AND text IS NOT NULL").count() == 0


def test_items_are_split_into_question_and_answer():
    assert decontam.split_item("What is it? A thing.") == ("What is it? ", "A thing.")
    assert decontam.split_item("One. Two. Three.") == ("One. Two. ", "Three.")
    assert decontam.split_item("only one.") == ("only one.", "")
    assert decontam.split_item("") == ("", "")


def test_short_items_and_sides_are_found_inside_longer_texts(spark, docs, prose):
    items = [(1, "What is 7*8? 56"), (2, "two words"), (3, prose(20, 1) + "? the answer"), (4, "single"), (5, "a b c d")]
    rows = [
        (0, prose(30, 2) + " what is 7*8? 56 " + prose(30, 3), "en", "a"), (1, "What is 7*8? 56", "en", "a"),
        (2, "What is 7*8? " + prose(9, 4) + " 56", "en", "a"), (3, "words two and two more words", "en", "a"),
        (4, prose(200, 5) + "\nTwo  words", "en", "a"), (5, prose(50, 6) + " " + items[2][1] + " " + prose(50, 7), "en", "a"),
        (6, items[2][1].replace("the answer", "the other"), "en", "a"), (7, "a single one", "en", "a"), (8, "a b c", "en", "a"),
        (9, "x a b c d y", "en", "a"), (10, "a b c e d", "en", "a"),
    ]
    want = {0: [1], 1: [1], 2: [], 3: [], 4: [2], 5: [3], 6: [3], 7: [4], 8: [], 9: [5], 10: []}

    def held(short, text):  # the same by comparing runs of as many words
        w, x = words(text), words(short)
        return tuple(x) in {tuple(w[k:k + len(x)]) for k in range(len(w))}

    assert all((k in want[i]) == held(x, t) for i, t, *_ in rows for k, x in items if len(words(x)) < 5)
    frame = spark.createDataFrame(items, "item_id long, text string")
    for index_items in (1000, 1):
        got = decontam.decontamination(docs(rows), frame, index_items=index_items).collect()
        assert {r.doc_id: [int(x) for x in r.item_ids.split(",") if x] for r in got} == want
    shares = {(r.id, r.item): (r.question, r.answer) for r in decontam.leaks(docs(rows), frame).collect()}
    assert shares[0, 1] == (1.0, 1.0)
    assert shares[5, 3] == (1.0, 1.0) and shares[6, 3] == (1.0, 0.0)
    assert sorted(r.doc_id for r in decontam.decontaminated(docs(rows), frame).collect()) == [2, 3, 8, 10]


def test_result_does_not_depend_on_the_size_of_indexes(spark, docs, bench, prose):
    rows, items = bench
    items = [*items, *((100 + k, prose(12, 2000 + k)) for k in range(20))]
    rng = random.Random(4)
    for k in range(40):  # leaks stretched by inserted words, all over a text
        leak = prose(12, 2000 + k % 20).split()
        leak[6:6] = ["in"] * rng.randint(1, 12)
        rows = [*rows, (1000 + k, " ".join([prose(rng.randint(0, 90), 3000 + k), *leak, prose(60, 4000 + k)]), "en", "a")]
    frame = spark.createDataFrame(items, "item_id long, text string")
    how = {"overlap": 0.5}
    want = brute(rows, items, **how)
    for index_items in (1000, 7):
        got = decontam.decontamination(docs(rows), frame, index_items=index_items, **how).collect()
        assert {r.doc_id: [int(x) for x in r.item_ids.split(",") if x] for r in got} == want
