import hashlib

import pytest
from pyspark.sql import functions as F

from prepkit.llm import fingerprints as fp


def edits(rows):
    """(characters, digest of the edited text) by id, with each text's next one by descending id."""
    order = sorted(rows, key=lambda r: -r[0])
    out = {}
    for k, (i, t, *_) in enumerate(order):
        t, after = t or "", order[(k + 1) % len(order)][1] or ""
        n = len(t) // 3
        out[i] = (len(t), hashlib.sha256((t[:len(t) - n] + after[:n]).encode()).hexdigest())
    return out


@pytest.mark.parametrize("block", [3, 1000])
def test_edits_equal_brute_force(docs, prose, block):
    rows = [(i * i - 50, None if i == 7 else prose(i % 23, i) + "é漢." * (i % 4) + "\n" + prose(5, i), "en", "a") for i in range(60)]
    got = fp.fingerprint_edits(docs(rows), block_rows=block).collect()
    want = edits(rows)
    assert {r.doc_id: (r.n_chars, r.edited_sha256) for r in got} == want and len(got) == len(rows)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    one = {r.doc_id: tuple(r) for r in got}
    assert one == {r.doc_id: tuple(r) for r in fp.fingerprint_edits(docs(rows[::-1]), block_rows=7).collect()}


def test_order_plays_no_part_and_repeats_count(spark):
    texts = {1: "a b.\nc d.\ne", 2: "e\nc d.\na b.", 3: "a b.\nc d.\ne\ne", 4: "a b. c d.\ne"}
    made = {r.id: r.fingerprint for r in fp.fingerprints(spark.createDataFrame(list(texts.items()), "id long, text string"), ["id"]).collect()}
    assert made[1] == made[2] and len({made[1], made[3], made[4]}) == 3


def test_paragraphs_can_be_put_in_and_taken_out(spark, prose):
    parts = [prose(20, k) + ". " + prose(6, k + 50) + "!" for k in range(30)]
    texts = {1: "\n".join(parts), 2: "\n".join(parts[:11]), 3: "\n".join(parts[11:])}
    made = {r.id: r.fingerprint for r in fp.fingerprints(spark.createDataFrame(list(texts.items()), "id long, text string"), ["id"]).collect()}
    row = spark.createDataFrame([tuple(made[k] for k in (1, 2, 3))], "whole string, head string, tail string")
    got = row.select(fp.combined(F.col("head"), F.col("tail")).alias("put"), fp.combined(F.col("whole"), F.col("tail"), -1).alias("took")).first()
    assert got.put == made[1] and got.took == made[2]


def test_likeness_follows_shared_sentences(spark, prose):
    sentences = [prose(8, k) + "." for k in range(400)]
    texts = [(0, " ".join(sentences[:100])), (1, " ".join(sentences[50:150])), (2, " ".join(sentences[200:300])), (3, " ".join(sentences[:100][::-1]))]
    made = fp.fingerprints(spark.createDataFrame(texts, "id long, text string"), ["id"])
    read = fp.lanes_of(made, "fingerprint", "again")
    assert all(r.lanes == r.again for r in read.collect())
    first = made.where("id = 0").select(F.col("fingerprint").alias("f"), F.col("lanes").alias("l"))
    near = fp.likeness(F.col("fingerprint"), F.col("lanes"), F.col("f"), F.col("l"))
    got = {r.id: r.near for r in made.join(F.broadcast(first)).select("id", near.alias("near")).collect()}
    assert got[0] == 1 and got[1] == pytest.approx(0.5, abs=0.25) and got[2] < 0.25 and got[3] > 0.9


def test_odd_rows(odd, odd_rows, empty):
    got = fp.fingerprint_edits(odd, block_rows=2).collect()
    assert sorted((str(r.doc_id), r.n_chars) for r in got) == sorted((str(i), len(t or "")) for i, t, *_ in odd_rows)
    assert len({r.fingerprint for r in got}) == len({t or "" for _, t, *_ in odd_rows})
    assert fp.fingerprint_edits(empty).collect() == []


def test_rows_without_an_id_fill_many_blocks(docs, prose):
    rows = [(None, prose(4, k), "en", "a") for k in range(1500)] + [(7, prose(4, 5000 + k), "en", "a") for k in range(1500)]
    frame = docs(rows)
    sizes = [r["count"] for r in fp.with_next(frame, block_rows=100).where("lent = 0").groupBy("block").count().collect()]
    assert len(sizes) > 20 and sum(sizes) == 3000 and max(sizes) < 500
    found = fp.with_next(frame, block_rows=100).where("lent = 0").collect()
    # one ring over all rows: every text is the next of just one
    assert sorted(r.next for r in found) == sorted(t for _, t, *_ in rows)
    assert all(r.id is None or r.id == 7 for r in found)
