"""Document fingerprints: homomorphic multiset hashes of paragraphs.

A paragraph is hashed to a wide vector; a document's fingerprint is the sum of its paragraphs' vectors, each entry
modulo 2^32 or 2^16. So the order of paragraphs plays no part, equal multisets are equal, and inserting or deleting a
paragraph adds or subtracts its vector without the rest of the text. The vector has two parts: ``STRONG`` entries from
the hash of the whole paragraph decide equality; ``LANES`` entries sum a fair bit of the hash of each of its sentences,
so that the inner product of two centred vectors estimates how many sentences two documents share.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prepkit.llm.shared import stored, text_of

STRONG, LANES = 8, 128
#: Two lanes a long: their sums never meet, and never overflow, as a text has under 2^31 sentences.
_PAIR = (1 << 32) | 1
PARAGRAPH, SENTENCE = "\n", r"(?<=[.!?])\s+"
#: Rows to a block of neighbours, most blocks (they grow beyond that: 2 GB of texts each at 100 TB), rows sampled for a cut.
BLOCK_ROWS, MOST_BLOCKS, SAMPLED = 1000, 50_000, 10


def _hash(seed: int, col: Column) -> Column:
    return F.xxhash64(F.lit(seed), col)


def _hex(value: Column, digits: int) -> Column:
    return F.lower(F.lpad(F.hex(value), digits, "0"))


def fingerprints(rows: DataFrame, key: list[str], text: str = "text") -> DataFrame:
    """``key``, ``fingerprint`` and ``lanes`` for each ``key``, which must tell rows apart.

    The fingerprint is hex: 16 digits of the sentence count, 8 for each strong entry, 4 for each lane. ``lanes`` holds
    the lanes again, centred, as ``lanes_of`` would read them. Rows already dealt out by (some of) the key aren't
    shuffled again.
    """
    paragraphs = rows.select(*key, F.explode(F.split(text, PARAGRAPH)).alias("paragraph"))
    sentences = paragraphs.select(
        *key, "paragraph", F.posexplode(F.split("paragraph", SENTENCE)).alias("nth", "sentence")
    )
    words = LANES // 64
    hashed = sentences.select(
        *key,
        *[F.when(F.col("nth") == 0, _hash(-1 - i, F.col("paragraph"))).alias(f"p{i}") for i in range(STRONG // 2)],
        *[_hash(i, F.col("sentence")).alias(f"s{i}") for i in range(words)],
    )
    low = (1 << 32) - 1
    sums = [F.count(F.lit(1)).alias("n")]
    for i in range(STRONG // 2):
        sums += [
            F.coalesce(F.sum(F.col(f"p{i}").bitwiseAND(low)), F.lit(0)).alias(f"a{2 * i}"),
            F.coalesce(F.sum(F.shiftrightunsigned(f"p{i}", 32)), F.lit(0)).alias(f"a{2 * i + 1}"),
        ]
    sums += [F.sum(F.shiftright(f"s{i}", k).bitwiseAND(_PAIR)).alias(f"b{i}_{k}") for i in range(words) for k in range(32)]
    total = hashed.groupBy(*key).agg(*sums)
    strong = F.concat(_hex(F.col("n"), 16), *[_hex(F.col(f"a{i}") % (1 << 32), 8) for i in range(STRONG)])
    lanes = F.array(*[half % (1 << 16) for i in range(words) for k in range(32)
                      for half in (F.col(f"b{i}_{k}").bitwiseAND(low), F.shiftrightunsigned(f"b{i}_{k}", 32))])
    packed = total.select(*key, "n", strong.alias("strong"), lanes.alias("raw"))
    fours = F.transform(F.sequence(F.lit(0), F.lit(LANES - 4), F.lit(4)), lambda i: _hex(
        F.shiftleft(F.get("raw", i), 48).bitwiseOR(F.shiftleft(F.get("raw", i + 1), 32))
        .bitwiseOR(F.shiftleft(F.get("raw", i + 2), 16)).bitwiseOR(F.get("raw", i + 3)), 16))
    return packed.select(*key, F.concat("strong", F.array_join(fours, "")).alias("fingerprint"), _centred(F.col("raw"), F.col("n")).alias("lanes"))


def _centred(raw: Column, n: Column) -> Column:
    """Lanes as signed numbers around 0: twice the sum less the count, modulo 2^16."""
    return F.transform(raw, lambda x: (F.pmod(x * 2 - n + 32768, F.lit(65536)) - 32768).cast("double"))


def lanes_of(fingerprints: DataFrame, fingerprint: str, lanes: str) -> DataFrame:
    """The frame with the centred lanes of a column of fingerprints in a further column."""
    at = 17 + STRONG * 8
    raw = F.transform(F.sequence(F.lit(0), F.lit(LANES - 1)), lambda i: F.conv(F.substr(F.col(fingerprint), i * 4 + at, F.lit(4)), 16, 10).cast("long"))
    n = F.conv(F.substring(fingerprint, 1, 16), 16, 10).cast("long")
    read = fingerprints.withColumns({lanes: raw, lanes + "_n": n})  # by itself, so that the count is read once a row
    return read.withColumn(lanes, _centred(F.col(lanes), F.col(lanes + "_n"))).drop(lanes + "_n")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def likeness(a: Column, a_lanes: Column, b: Column, b_lanes: Column) -> Column:
    """0 to 1 from two fingerprints and their lanes: the cosine of the lanes, 1 if the fingerprints are equal.

    Texts with nothing alike stay near 0.
    """
    sizes = F.sqrt(dot(a_lanes, a_lanes) * dot(b_lanes, b_lanes))
    cosine = F.when(sizes > 0, dot(a_lanes, b_lanes) / sizes).otherwise(0.0)
    return F.when(a == b, 1.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), cosine)))


def combined(a: Column, b: Column, sign: int = 1) -> Column:
    """The fingerprint of a document after inserting (``sign`` 1) or deleting (-1) the paragraphs that ``b`` stands for."""
    widths = [16] + [8] * STRONG + [4] * LANES
    out, at = [], 1
    for w in widths:
        part = [F.conv(F.substring(x, at, w), 16, 10).cast("long") for x in (a, b)]
        value = part[0] + part[1] * sign
        out.append(_hex(value if w == 16 else F.pmod(value, F.lit(1 << (4 * w))), w))
        at += w
    return F.concat(*out)


def _block_cuts(rows: DataFrame, block_rows: int, most: int) -> list[tuple[int, int]]:
    """(id, tie) at which a new block of neighbours begins, falling: quantiles of a sample, under ``most`` at any size."""
    n = rows.count()
    blocks = max(1, min(most, n // block_rows))
    if blocks == 1:
        return []
    share = min(1.0, SAMPLED * blocks / n)
    drawn = sorted(((r["id"], r["tie"]) for r in rows.sample(share, seed=11).collect()), reverse=True)
    return sorted({drawn[k * len(drawn) // blocks] for k in range(1, blocks)} if drawn else (), reverse=True)


def _block_of(cuts: list[tuple[int, int]]) -> Column:
    """How many cuts come before the row's (id, tie), both falling: a binary search in constant arrays."""
    if not cuts:
        return F.lit(0)
    ids, ties = (F.split(F.lit(",".join(str(c[k]) for c in cuts)), ",").cast("array<bigint>") for k in (0, 1))
    steps = [1 << k for k in reversed(range(len(cuts).bit_length()))]

    def onward(at: Column, step: Column) -> Column:
        one, other = F.get(ids, at + step - 1), F.get(ties, at + step - 1)
        return F.when((one > F.col("id")) | ((one == F.col("id")) & (other > F.col("tie"))), at + step).otherwise(at)

    return F.aggregate(F.array(*[F.lit(x) for x in steps]), F.lit(0), onward)


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(block, place, lent, id, text, next): each text beside the next one's by descending id, after the last the first.

    Texts are shuffled once, to blocks of neighbours. Each block is lent the first row of the block after it (``lent``
    1, ``next`` null), so that no block looks into another. Rows that share an id stand by the hash of their text, then by
    text; a null id counts as the smallest. Blocks are cut by id and hash, so neither rows without an id nor rows of one
    id meet in one block, however many there are; only rows equal in both id and text do.
    """
    own = F.col(f"`{id_col}`").cast("long")
    rows = docs.select(F.coalesce(own, F.lit(-(1 << 62))).alias("id"), own.isNull().alias("no_id"), text_of(text_col).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    places = rows.select("id", "tie")
    block = _block_of(_block_cuts(places, block_rows, MOST_BLOCKS))
    first = F.max(F.struct("id", "tie")).alias("top")
    tops = stored(places.select("id", "tie", block.alias("block")).groupBy("block").agg(first), "fp-blocks")
    by_block, every = Window.orderBy("block"), Window.partitionBy()
    loans = tops.select(
        F.col("top.id").alias("lender"), F.col("top.tie").alias("lender_tie"),
        F.coalesce(F.lag("block").over(by_block), F.max("block").over(every)).alias("to"),
    )
    dealt = rows.join(F.broadcast(loans), (rows["id"] == loans["lender"]) & (rows["tie"] == loans["lender_tie"]), "left").select(
        "id", "no_id", "tie", "text",
        F.explode(F.array(F.struct(block.alias("block"), F.lit(0).alias("lent")), F.struct(F.col("to").alias("block"), F.lit(1).alias("lent")))).alias("at"),
    ).where("at.block IS NOT NULL").select("at.block", "at.lent", "id", "no_id", "tie", "text")
    order = Window.partitionBy("block").orderBy("lent", F.col("id").desc(), F.col("tie").desc(), "text")
    return dealt.select(
        "block", F.row_number().over(order).alias("place"), "lent",
        F.when(~F.col("no_id"), F.col("id")).alias("id"), "text",
        F.when(F.col("lent") == 0, F.lead("text").over(order)).alias("next"),
    )


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) for each row of ``docs``.

    The edited text has its last third replaced by the start of the next text. A null text counts as empty; an empty
    text is one empty paragraph, so all of them are equal. A single document is its own next one. Rows that share an id
    each keep their row. Other columns are not read.
    """
    n = F.char_length("text")
    third = F.floor(n / 3).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), n - F.col("third")), F.substr("next", F.lit(1), F.col("third")))
    rows = with_next(docs, id_col, text_col, block_rows).withColumn("third", third).withColumn("edited", edited)
    rows = rows.withColumn("sha", F.sha2(F.col("edited").cast("binary"), 256)).withColumn("n_chars", n.cast("long"))
    key = ["block", "place", "lent", "id", "n_chars", "sha"]
    both = F.array(F.struct(F.lit(0).alias("which"), F.col("text")), F.struct(F.lit(1).alias("which"), F.col("edited").alias("text")))
    texts = rows.select(*key, F.explode(both).alias("t")).where("t.text IS NOT NULL").select(*key, "t.which", "t.text")
    made = fingerprints(texts, [*key, "which"]).withColumn("print", F.struct("fingerprint", "lanes"))
    sides = made.groupBy(*key).agg(
        F.first(F.when(F.col("which") == 0, F.col("print")), True).alias("own"),
        F.first(F.when(F.col("which") == 1, F.col("print")), True).alias("edited"),
    )
    order = Window.partitionBy("block").orderBy("place")
    beside = sides.withColumn("after", F.lead("own").over(order)).where("lent = 0")

    def near(other: str) -> Column:
        return likeness(F.col("own.fingerprint"), F.col("own.lanes"), F.col(f"{other}.fingerprint"), F.col(f"{other}.lanes"))

    return beside.select(
        F.col("id").alias("doc_id"), "n_chars", F.col("sha").alias("edited_sha256"), F.col("own.fingerprint").alias("fingerprint"),
        F.col("edited.fingerprint").alias("edited_fingerprint"), near("edited").alias("near_edited"), near("after").alias("near_next"),
    )
