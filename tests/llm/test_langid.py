import random

import numpy as np
import pyarrow as pa
import pytest

from prepkit.llm import langid

SOUNDS = {
    "aa": ["ka", "lo", "mi", "ret", "sun"], "ab": ["ka", "lo", "mi", "rut", "sen"],
    "zx": ["sch", "ung", "heit", "ber", "zu"], "zy": ["sch", "ung", "keit", "ver", "zu"],
}


def text(lang, n, seed):
    rng = random.Random(f"{lang}{seed}")
    return " ".join("".join(rng.choices(SOUNDS[lang], k=rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def spoken():
    return [(i, text(lang, 30, i), lang, "a") for i in range(400) for lang in [sorted(SOUNDS)[i % 4]]]


def test_held_out_accuracy(docs, spoken):
    truth = {i: g for i, _, g, _ in spoken}
    got = langid.identified(docs(spoken)).collect()
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) >= 0.98
    assert all(0 <= r.score <= 1 for r in got)


def test_families_hold_close_languages(docs, spoken):
    model = langid.learn(docs(spoken))
    assert sorted(sorted(model.languages[k] for k in f) for f in model.families) == [["aa", "ab"], ["zx", "zy"]]
    assert set(model.pairs) == {(0, 1), (2, 3)}


def test_held_out_languages_play_no_part(docs, spoken):
    import zlib
    changed = [(i, t, "other" if zlib.crc32(str(i).encode()) % 5 == 0 else g, s) for i, t, g, s in spoken]
    one, two = (sorted(map(tuple, langid.identified(docs(x)).collect())) for x in (spoken, changed))
    assert one == two


def test_counts_read_whole_texts_and_never_across_them():
    texts = ["ab cd" * 50, "", "xyz", None]
    whole = np.vstack([rows for _, rows in langid.counts(pa.array(texts))])
    alone = np.vstack([rows for t in texts for _, rows in langid.counts(pa.array([t], pa.string()))])
    assert np.array_equal(whole, alone) and not whole[1].any() and not whole[3].any()


def test_odd_rows(odd, odd_rows, empty, docs, spoken):
    got = langid.identified(odd).collect()
    assert len(got) == len(odd_rows)
    unknown = [r for r in got if r.doc_id in (1, 2, 7)]
    assert [(r.lang_pred, r.score) for r in unknown] == [("und", 0.0)] * 3
    assert langid.identified(empty).collect() == []
    assert {r.lang_pred for r in langid.identified(docs([(i, "words here", None, "a") for i in range(9)])).collect()} == {"und"}
    assert {r.lang_pred for r in langid.identified(docs([(i, "words here", "aa", "a") for i in range(9)])).collect()} == {"aa"}


def test_the_sample_holds_the_smallest_hashes(spark):
    from pyspark.sql import functions as F

    from prepkit.llm.shared import may_be_among
    ids = spark.range(20_000).withColumn("hash", F.xxhash64("id"))
    low = ids.where(may_be_among("hash", 500, F.lit(20_000)))
    assert 1_500 < low.count() < 2_500
    assert low.orderBy("hash").limit(500).collect() == ids.orderBy("hash").limit(500).collect()


def test_many_tiny_texts_are_counted_in_bounded_pieces():
    texts = pa.array(["ab", "xyz"] * 6000)
    parts = list(langid.counts(texts))
    assert max(len(rows) for _, rows in parts) <= langid.AT_ONCE and sum(len(rows) for _, rows in parts) == 12000
    assert [lo for lo, _ in parts] == list(range(0, 12000, langid.AT_ONCE))
