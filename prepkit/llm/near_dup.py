"""N-gram Jaccard join: MinHash bands find candidates, full shingle sets decide.

Equal texts are folded into one node first. The nodes' band hashes are shuffled; what shares a band is compared on its
whole set of shingles, in blocks of bounded size, each pair once. A block reports links per node and a spanning forest
of its links, never the pairs themselves, so a group of thousands of near copies stays a few rows a member.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prepkit.llm.components import components
from prepkit.llm.shared import bounded, stored, text_of
from prepkit.llm.shingles import U, bytes_of, mixed, pieces, powers, sequence_keys, shingle_hashes, word_hashes

WIDTH, SIMILARITY, RECALL = 5, 0.8, 0.999
#: Nodes, and words, to a side of a block.
BLOCK_NODES, BLOCK_WORDS = 512, 1 << 20


def bands_for(similarity: float, recall: float, false_at: float = 0.3, false_rate: float = 0.05) -> tuple[int, int]:
    """(bands, rows): the fewest hashes that find a pair of ``similarity`` with probability ``recall`` at least, and
    one of similarity ``false_at`` with ``false_rate`` at most."""
    for rows in range(1, 33):
        bands = math.ceil(math.log(1 - recall) / math.log1p(-min(similarity**rows, 1 - 1e-12)))
        if 1 - (1 - false_at**rows) ** bands <= false_rate:
            return bands, rows
    return bands, rows


def _signatures(bands: int, rows: int, width: int):
    """Each text's two keys, its count of words, and the hash of each band; texts without a word have no bands."""
    seeds = mixed(np.arange(1, 2 * bands * rows + 1, dtype=U))
    odd, flip = seeds[: bands * rows] | U(1), seeds[bands * rows:]
    places = powers(U(0xD6E8FEB86659FD93), rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, starts = bytes_of(b.column("text"))
            for lo, hi in pieces(starts):
                words, firsts = word_hashes(data[starts[lo]:starts[hi]], starts[lo:hi + 1] - starts[lo])
                one, two = sequence_keys(words, firsts)
                grams, ends = shingle_hashes(words, firsts, width)
                n = np.diff(ends)
                full = n > 0
                where = ends[:-1][full]
                out = np.zeros((full.sum(), bands), U)
                if len(where):
                    for k in range(bands):
                        for r in range(rows):
                            j = k * rows + r
                            out[:, k] += mixed(np.minimum.reduceat((grams ^ flip[j]) * odd[j], where)) * places[r]
                    out = mixed(out + np.arange(1, bands + 1, dtype=U))
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(full * bands)]).astype(np.int32)), pa.array(out.ravel().view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [b.column("id").slice(lo, hi - lo), b.column("mark").slice(lo, hi - lo), pa.array(one.view(np.int64)),
                     pa.array(two.view(np.int64)), pa.array(np.diff(firsts)), lists], ["id", "mark", "node", "check", "n_words", "bands"])

    return run


def _sets(width: int):
    """Each text's key and its sorted distinct shingles as bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, starts = bytes_of(b.column("text"))
            for lo, hi in pieces(starts):
                words, firsts = word_hashes(data[starts[lo]:starts[hi]], starts[lo:hi + 1] - starts[lo])
                grams, ends = shingle_hashes(words, firsts, width)
                sets = [np.unique(grams[ends[i]:ends[i + 1]]).tobytes() for i in range(hi - lo)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sequence_keys(words, firsts)[0].view(np.int64)), pa.array(sets, pa.binary())], ["node", "grams"])

    return run


def _shared_counts(left: list[np.ndarray], right: list[np.ndarray], step: int = 4096) -> np.ndarray:
    """How many shingles each of ``left`` has in common with each of ``right``."""
    if len(left) * len(right) <= 64:
        return np.array([[np.intersect1d(a, b, assume_unique=True).size for b in right] for a in left])
    every = np.concatenate(left + right)
    values, place, n = np.unique(every, return_inverse=True, return_counts=True)
    column = np.full(len(values), -1)
    often = np.flatnonzero(n > 1)
    column[often] = np.arange(len(often))
    place = column[place]
    owner = np.repeat(np.arange(len(left) + len(right)), [len(x) for x in left + right])
    owner, place = owner[place >= 0], place[place >= 0]
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    out = np.zeros((len(left), len(right)), np.float32)
    for lo in range(0, len(often), step):
        a, b = np.searchsorted(place, [lo, lo + step])
        held = np.zeros((len(left) + len(right), step), np.float32)
        held[owner[a:b], place[a:b] - lo] = 1
        out += held[: len(left)] @ held[len(left):].T
    return out


def _forest(x: np.ndarray, y: np.ndarray, n: int) -> list[tuple[int, int]]:
    """Edges that connect what the links (x, y) connect, fewer than ``n``."""
    parent = list(range(n))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    kept = []
    for a, b in zip(x.tolist(), y.tolist()):
        ra, rb = root(a), root(b)
        if ra != rb:
            parent[rb] = ra
            kept.append((a, b))
    return kept


def _verified(similarity: float):
    """Rows sorted by block, one run to a block: links per node (y null, n links) and connecting edges (n null)."""
    def block(rows: list[dict]) -> tuple[list, list, list]:
        band, same = rows[0]["band"], rows[0]["same"]
        left = [r for r in rows if r["side"] == 0]
        right = left if same else [r for r in rows if r["side"] == 1]
        if not left or not right or len(rows) < 2:
            return [], [], []
        sets = {id(r): np.frombuffer(r["grams"], U) for r in rows}
        a, b = [sets[id(r)] for r in left], [sets[id(r)] for r in right]
        todo = np.ones((len(a), len(b)), bool)
        if same:
            todo = np.triu(todo, 1)
        ka, kb = np.array([r["bands"] for r in left]), np.array([r["bands"] for r in right])
        for k in range(band):  # a pair belongs to the first band that both were kept in together
            todo &= ~((ka[:, k][:, None] == kb[:, k][None, :]) & (ka[:, k] != 0)[:, None])
        na, nb = np.array([len(x) for x in a]), np.array([len(x) for x in b])
        todo &= np.minimum(na[:, None], nb[None, :]) >= similarity * np.maximum(na[:, None], nb[None, :]) - 1e-9
        if not todo.any():
            return [], [], []
        use_a, use_b = np.flatnonzero(todo.any(1)), np.flatnonzero(todo.any(0))
        both = np.zeros(todo.shape)
        both[np.ix_(use_a, use_b)] = _shared_counts([a[i] for i in use_a], [b[i] for i in use_b])
        linked = todo & (both >= similarity * (na[:, None] + nb[None, :] - both) - 1e-9)
        i, j = np.nonzero(linked)
        ids = [r["node"] for r in left] + ([] if same else [r["node"] for r in right])
        copies = np.array([r["copies"] for r in left] + ([] if same else [r["copies"] for r in right]))
        j = j if same else j + len(left)
        links = np.bincount(i, copies[j], len(ids)) + np.bincount(j, copies[i], len(ids))
        x, y, n = [], [], []
        for k in np.flatnonzero(links):
            x.append(ids[k]), y.append(None), n.append(int(links[k]))
        for p, q in _forest(i, j, len(ids)):
            x.append(ids[p]), y.append(ids[q]), n.append(None)
        return x, y, n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(rows):
            x, y, n = block(rows)
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64()), pa.array(n, pa.int64())], ["x", "y", "n"])

        held, key = [], None
        for b in batches:
            for r in b.to_pylist():
                now = (r["bucket"], r["one"], r["two"])
                if now != key and held:
                    yield emit(held)
                    held = []
                key = now
                held.append(r)
        if held:
            yield emit(held)

    return run


def jaccard_classes(docs: DataFrame, width: int = WIDTH, similarity: float = SIMILARITY, recall: float = RECALL,
                    id_col: str = "doc_id", text_col: str = "text", block_nodes: int = BLOCK_NODES,
                    block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, class_id, n_links, n_copies, kept, mark) for each row of ``docs``; ``mark`` is xxhash64 of its text.

    Two documents are linked if the Jaccard similarity of their sets of ``width``-word shingles is ``similarity`` or
    more; ``n_links`` counts a document's links, copies of it among them, and ``n_copies`` the rows whose words equal
    its own, itself among them. Classes are what links connect; ``class_id`` is the smallest doc_id in it, and ``kept``
    marks one document of each class: the one with that id, and with the least mark if texts share the id. Words are runs of non-blanks, A-Z lower-cased; a shorter text is
    one shingle. A null text or one without a word is a class of its own with no links. Each row counts, also rows that
    share an id; a null id comes after all others. A link is found with probability ``recall`` or more; nothing is
    capped. Other columns are not read.
    """
    bands, rows = bands_for(similarity, recall)
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), text_of(text_col).alias("text"))
    texts = texts.withColumn("mark", F.xxhash64("text"))
    schema = "id long, mark long, node long, check long, n_words long, bands array<long>"
    signed = stored(texts.mapInArrow(_signatures(bands, rows, width), schema), "minhash")
    one = F.min_by(F.struct("id", "mark", "bands", "n_words"), F.struct(F.col("id").isNull(), "id", "mark"))
    nodes = signed.where("n_words > 0").groupBy("node", "check").agg(one.alias("r"), F.count(F.lit(1)).alias("copies"))
    nodes = stored(nodes.select("node", "check", "copies", "r.id", "r.mark", "r.n_words", "r.bands"), "minhash-nodes")

    spread = nodes.select("node", "n_words", F.posexplode("bands").alias("band", "bucket"))
    mark = F.xxhash64("node")
    buckets = spread.groupBy("band", "bucket").agg(
        F.count(F.lit(1)).alias("n"), F.sum("n_words").alias("words"), F.min("node").alias("low"), F.max("node").alias("high"),
        F.sum(F.shiftright(mark, 24)).alias("sum"), F.bit_xor(mark).alias("xor"),
    ).where("n > 1")
    kept = buckets.groupBy("n", "low", "high", "sum", "xor").agg(F.min(F.struct("band", "bucket", "words")).alias("b"))
    parts = F.greatest(F.ceil(F.col("n") / block_nodes), F.ceil(F.col("b.words") / block_words)).cast("long")
    kept = stored(kept.select("b.band", "b.bucket", parts.alias("parts")), "minhash-buckets")

    shared = spread.join(kept, ["band", "bucket"]).select("node", "band", "bucket", "parts")
    placed = shared.groupBy("node").agg(F.map_from_entries(F.collect_list(F.struct("band", F.struct("bucket", "parts")))).alias("at"))
    listed = F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda k: F.coalesce(F.col("at")[k]["bucket"], F.lit(0).cast("long")))
    placed = stored(placed.join(nodes.select("node", "id", "copies"), "node").select("node", "id", "copies", "at", listed.alias("bands")), "minhash-placed")

    wanted = bounded(placed.select(F.col("id").alias("at")).distinct())
    found = texts.join(wanted, F.col("id").eqNullSafe(F.col("at"))).select("text").mapInArrow(_sets(width), "node long, grams binary")
    sets = placed.join(found, "node").dropDuplicates(["node"])
    member = sets.select("node", "copies", "bands", "grams", F.explode("at").alias("band", "to"))
    part, parts = F.pmod(F.xxhash64("node", F.lit(7)), F.col("parts")), F.col("parts") - 1
    member = member.select("node", "copies", "bands", "grams", "band", "to.bucket", "to.parts").withColumn("part", part)
    lows = F.transform(F.sequence(F.lit(0).cast("long"), parts), lambda o: F.struct(
        F.least(F.col("part"), o).alias("one"), F.greatest(F.col("part"), o).alias("two"), F.when(o < F.col("part"), 1).otherwise(0).alias("side")))
    blocks = member.withColumn("b", F.explode(lows)).select(
        "band", "bucket", "b.one", "b.two", "b.side", (F.col("b.one") == F.col("b.two")).alias("same"), "node", "copies", "bands", "grams")
    dealt = blocks.repartition("bucket", "one", "two").sortWithinPartitions("bucket", "one", "two")
    checked = stored(dealt.mapInArrow(_verified(similarity), "x long, y long, n long"), "minhash-links")

    roots = components(checked.where("y IS NOT NULL").select("x", "y"))
    links = checked.where("n IS NOT NULL").groupBy(F.col("x").alias("node")).agg(F.sum("n").alias("links"))
    named = nodes.select("node", "check", "copies", "id", "mark").join(roots, "node", "left").join(links, "node", "left")
    named = stored(named.select("node", "check", "copies", "id", "mark", F.coalesce("root", "node").alias("root"), F.coalesce("links", F.lit(0)).alias("links")), "minhash-roots")
    first = F.min_by(F.struct("id", "mark"), F.struct(F.col("id").isNull(), "id", "mark"))
    classes = named.join(named.groupBy("root").agg(first.alias("first")), "root").select("node", "check", "copies", "links", "first")
    classes = stored(classes, "minhash-classes")

    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    rest = signed.where("n_words = 0").select(
        F.col("id").alias("doc_id"), F.col("id").alias("class_id"), zero.alias("n_links"), one.alias("n_copies"),
        F.lit(True).alias("kept"), "mark")
    joined = signed.where("n_words > 0").select("id", "mark", "node", "check").join(classes, ["node", "check"])
    kept = F.col("id").eqNullSafe(F.col("first.id")) & (F.col("mark") == F.col("first.mark"))
    return joined.select(
        F.col("id").alias("doc_id"), F.col("first.id").alias("class_id"), (F.col("links") + F.col("copies") - 1).alias("n_links"),
        F.col("copies").alias("n_copies"), kept.alias("kept"), "mark",
    ).unionByName(rest)


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs``, all their columns, that stay when one document of each class does.

    Rows of that document that repeat its id and text go, too. Texts without a word all stay.
    """
    classes = stored(jaccard_classes(docs, id_col=id_col, text_col=text_col, **how).select("doc_id", "mark", "kept", "n_copies"), "classes")
    gone = classes.where(~F.col("kept")).select(F.col("doc_id").alias("gone_id"), F.col("mark").alias("gone_mark")).distinct()
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))

    def same(other: DataFrame, key: str, mark: str):
        return docs[id_col].cast("long").eqNullSafe(other[key]) & (F.xxhash64(text) == other[mark])

    gone = bounded(stored(gone, "gone"))
    stay = docs.join(gone, same(gone, "gone_id", "gone_mark"), "left_anti")
    twice = classes.where(F.col("kept") & (F.col("n_copies") > 1)).groupBy("doc_id", "mark").count().where("count > 1")
    twice = stored(twice.select(F.col("doc_id").alias("twice_id"), F.col("mark").alias("twice_mark")), "twice-kept")
    if not twice.limit(1).count():
        return stay
    again = same(twice, "twice_id", "twice_mark")
    return stay.join(twice, again, "left_anti").unionByName(stay.join(twice, again, "left_semi").dropDuplicates([id_col, text_col]))
