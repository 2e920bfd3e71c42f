import random
import zlib

import pyarrow as pa
import pytest

from prepkit.llm import toxicity
from prepkit.llm.toxicity import Model, Reader, Trie

TERMS = ["grumblark", "snorfing", "vexmord", "plodwit", "bad"]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_the_automaton_accepts_what_is_one_edit_away():
    rng = random.Random(2)
    trie = Trie({t: float(len(t)) for t in TERMS})
    for _ in range(4000):
        word = list(rng.choice(TERMS))
        for _ in range(rng.randint(0, 2)):
            k = rng.randrange(len(word) + 1)
            word[k:k + rng.randint(0, 1)] = rng.choice(["", "a", "r"])
        word = "".join(word)
        near = [t for t in TERMS if distance(word, t) <= (1 if len(t) >= toxicity.FUZZY_FROM else 0)]
        got = trie.match(word)
        assert (got is not None) == bool(near), word
        assert got is None or got[1] == distance(word, got[0])


def test_quotation_counts_less_than_abuse():
    reader = Reader(Model({t: 5.0 for t in TERMS}, {t: 3.0 for t in TERMS}, weights=(2.0, 2.0, 0.0, 0.0, -2.0)))
    plain, quoted, wrong = reader.score("you grumblark"), reader.score('they said "you grumblark" to me'), reader.score("you grumblsrk")
    assert plain > quoted > reader.score("you there") and plain > wrong > 0.5
    assert reader.hits("Grumblark, grumblarks! grumblark") == [(0, "grumblark", 0), (11, "grumblark", 1), (23, "grumblark", 0)]


def test_a_full_memory_loses_no_hit_of_the_text_being_read(monkeypatch):
    model = Model({t: 5.0 for t in TERMS}, {t: 3.0 for t in TERMS}, weights=(2.0, 2.0, 0.0, 0.0, -2.0))
    texts = ["you grumblark, bad plodwit", "one snorfing two vexmord three grumblark four five", "nothing here", "bad bad plodwyt"]
    want = [Reader(model).hits(t) for t in texts]
    assert list(map(len, want)) == [3, 3, 0, 3]
    for bound in (1, 2, 3):
        monkeypatch.setattr(toxicity, "REMEMBERED", bound)
        reader = Reader(model)
        assert [reader.hits(t) for t in texts] == want
        assert len(reader.known) <= bound


def test_batches_score_the_same_whatever_a_task_remembers(monkeypatch):
    model = Model({t: 5.0 for t in TERMS}, {t: 3.0 for t in TERMS}, weights=(2.0, 2.0, 0.0, 0.0, -2.0))
    texts = ["a plodwit and a vexmord", None, "", "all is well", "grumblark b snorfinq c bad d"]
    batches = [pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])] * 3
    want = [Reader(model).score(t or "") for t in texts]
    monkeypatch.setattr(toxicity, "REMEMBERED", 2)
    assert [b.column("score").to_pylist() for b in toxicity._scored(model)(iter(batches))] == [want] * 3


@pytest.fixture(scope="module")
def labelled(spark, docs, prose):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(600):
        words, toxic = prose(40, i).split(), int(i % 6 == 0)
        if toxic:
            for t in rng.sample(TERMS[:4], 2):
                words.insert(rng.randrange(len(words)), t.upper() if i % 12 else t[:3] + t[4:])
        rows.append((i, " ".join(words), "en", "a"))
        labels.append((i, 1, toxic))
    return docs(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), dict((x[0], x[2]) for x in labels)


def test_held_out_accuracy(labelled):
    frame, labels, truth = labelled
    got = toxicity.scored(frame, labels).collect()
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0}
    assert sum(r.predicted == truth[r.doc_id] for r in held) / len(held) >= 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)


def test_held_out_labels_play_no_part(labelled):
    frame, labels, _ = labelled
    flipped = labels.selectExpr("doc_id", "quality", "CASE WHEN crc32(cast(cast(doc_id AS string) AS binary)) % 5 = 0 THEN 1 - toxic ELSE toxic END AS toxic")
    one, two = ({r.doc_id: r.score for r in toxicity.scored(frame, x).collect()} for x in (labels, flipped))
    assert one == two


def test_odd_rows(spark, labelled, odd, odd_rows, empty):
    _, labels, _ = labelled
    got = toxicity.scored(odd, labels).collect()
    assert len(got) == len(odd_rows)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in toxicity.scored(odd, none).collect()} == {0.5}
    nulls = spark.createDataFrame([(None, 1, 1), (3, 1, None), (9, None, 0), (9, 1, 1)], "doc_id long, quality int, toxic int")
    assert toxicity.scored(odd, nulls).count() == len(odd_rows)
    assert toxicity.scored(empty, labels).collect() == []
    assert toxicity.accepted(odd, labels).columns == odd.columns
    assert sorted(map(str, toxicity.accepted(odd, labels).collect())) == sorted(map(str, odd.collect()))
