"""Benchmark decontamination: a BM25 index of the test items, searched with every training passage by block-max WAND.

An item's threshold is the least score that a passage holding the asked share of its word shingles can have, so the
search leaves out nothing that the check on shingles would confirm.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prepkit.llm.shared import stored, text_of
from prepkit.llm.shingles import U, bytes_of, pieces, shingle_hashes, word_hashes

K1, B = 1.2, 0.75
WIDTH, OVERLAP = 5, 0.8
#: Items, and words of items, to one index; items to a block of it; words of the indexes that a pass over the texts holds.
INDEX_ITEMS, INDEX_WORDS, BLOCK_ITEMS, PASS_WORDS = 1000, 200_000, 16, 4_000_000
#: A score of 1 reaches an item's threshold; sums of many weights may fall short by rounding.
ENOUGH = 1 - 1e-6


def split_item(text: str) -> tuple[str, str]:
    """(question, answer): what follows the last line break, question mark or end of a sentence is the answer.

    An item of one sentence is all question.
    """
    body = text.rstrip()
    at = max(body.rfind(x, 0, max(0, len(body) - 1)) + len(x) if x in body[:-1] else 0 for x in ("\n", "? ", ". ", "! "))
    return (body[:at], body[at:]) if at else (body, "")


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(item, words of the question, words of the answer)."""
    for b in batches:
        sides = [split_item(t or "") for t in b.column("text").to_pylist()]
        lists = []
        for k in (0, 1):
            words, firsts = word_hashes(*bytes_of(pa.array([s[k] for s in sides], pa.string())))
            lists.append(pa.ListArray.from_arrays(pa.array(firsts.astype(np.int32)), pa.array(words.view(np.int64))))
        yield pa.RecordBatch.from_arrays([b.column("item"), *lists], ["item", "question", "answer"])


class Index:
    """Some of the items: postings with weights in parts of their item's threshold, and their maxima by block of items.

    Postings and maxima are kept by word one after the other, so an index takes room for its postings alone.
    """

    def __init__(self, items: list[tuple[int, list[int], list[int]]], idf: dict[int, float], mean: float, overlap: float, width: int, window: int):
        self.ids = [x[0] for x in items]
        self.overlap, self.width, self.window = overlap, width, window
        self.grams, self.sides = [], []
        word, item, weight = [], [], []
        for k, (_, question, answer) in enumerate(items):
            every = np.array([*question, *answer], np.int64).view(U)
            self.grams.append(self._runs(every))
            self.sides.append((self._runs(np.array(question, np.int64).view(U)), self._runs(np.array(answer, np.int64).view(U))))
            words, n = np.unique(every, return_counts=True)
            w = np.array([idf[x] for x in words.view(np.int64).tolist()]) * n * (K1 + 1) / (n + K1 * (1 - B + B * len(every) / mean))
            missing = int((1 - overlap) * len(self.grams[-1][1]) + 1e-9)  # words a passage may lack, as each takes a shingle along
            least = np.sort(w)[: max(0, len(w) - missing)].sum()
            word.append(words), item.append(np.full(len(words), k)), weight.append(w / max(least, 1e-12))
        word, item, weight = np.concatenate(word), np.concatenate(item), np.concatenate(weight)
        order = np.lexsort((item, word))
        self.item, self.weight, word = item[order], weight[order], word[order]
        self.vocabulary, self.first = np.unique(word, return_index=True)
        self.first = np.append(self.first, len(word))
        self.blocks = -(-len(items) // BLOCK_ITEMS)
        block, head = self.item // BLOCK_ITEMS, np.ones(len(word), bool)
        head[1:] = (word[1:] != word[:-1]) | (block[1:] != block[:-1])
        at = np.flatnonzero(head)
        self.block = block[at]
        self.most = np.maximum.reduceat(self.weight, at) * (1 + 1e-9)  # rounding never lowers a bound
        self.block_first = np.searchsorted(at, self.first)
        self.bound = np.maximum.reduceat(self.most, self.block_first[:-1])

    def _shingles(self, words: np.ndarray, width: int | None = None) -> np.ndarray:
        """Distinct runs of ``width`` words; fewer words than that are one run of them all."""
        return np.unique(shingle_hashes(words, np.array([0, len(words)]), width or self.width)[0])

    def _runs(self, words: np.ndarray) -> tuple[int, np.ndarray]:
        """(words to a run, the distinct runs): fewer words than a shingle's are compared as one run of as many words."""
        width = min(self.width, max(1, len(words)))
        return width, self._shingles(words, width)

    @staticmethod
    def _places(first: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places of all that belongs to the terms, which of the terms each belongs to)."""
        sizes = first[terms + 1] - first[terms]
        owner = np.repeat(np.arange(len(terms)), sizes)
        return np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes - first[terms], sizes), owner

    def search(self, terms: np.ndarray) -> list[int]:
        """Items whose score for these distinct terms (places in the vocabulary) reaches their threshold, by block-max WAND.

        Blocks whose maxima together stay under it are left out at once, which mostly leaves none. Over the others a
        cursor a term walks its items: the first item that the terms at or before it could lift to the threshold is the
        pivot; if the maxima of its block cannot, all cursors go past the block, else it is scored, or the cursors
        before it move up to it.
        """
        at, owner = self._places(self.block_first, terms)
        open_ = np.bincount(self.block[at], self.most[at], minlength=self.blocks) >= ENOUGH
        if not open_.any():
            return []
        kept = open_[self.block[at]]
        top: list[dict[int, float]] = [{} for _ in terms]
        for t, b, m in zip(owner[kept].tolist(), self.block[at[kept]].tolist(), self.most[at[kept]].tolist()):
            top[t][b] = m
        at, owner = self._places(self.first, terms)
        kept = open_[self.item[at] // BLOCK_ITEMS]
        at, owner = at[kept], owner[kept]
        cuts = np.searchsorted(owner, np.arange(len(terms) + 1)).tolist()
        items, weights = self.item[at].tolist(), self.weight[at].tolist()
        bound = [max(x.values(), default=0.0) for x in top]
        cursor, end, out = cuts[:-1], cuts[1:], []
        live = sorted((items[a], t) for t, (a, z) in enumerate(zip(cursor, end)) if a < z)
        while True:
            total, pivot = 0.0, None
            for item, t in live:
                total += bound[t]
                if total >= ENOUGH:
                    pivot = item
                    break
            if pivot is None:
                return out
            n = bisect_left(live, (pivot + 1,))
            upto = [t for _, t in live[:n]]
            if sum(top[t].get(pivot // BLOCK_ITEMS, 0.0) for t in upto) < ENOUGH:
                after = (pivot // BLOCK_ITEMS + 1) * BLOCK_ITEMS
                to = min([after, *[item for item, _ in live[n:n + 1]]])
            elif live[0][0] == pivot:
                if sum(weights[cursor[t]] for t in upto) >= ENOUGH:
                    out.append(pivot)
                to = pivot + 1
            else:
                to = pivot
            moved = []
            for item, t in live[:n]:
                if item < to:
                    cursor[t] = bisect_left(items, to, cursor[t], end[t])
                    if cursor[t] < end[t]:
                        moved.append((items[cursor[t]], t))
                else:
                    moved.append((item, t))
            live = sorted(moved + live[n:])

    def passages(self, words: np.ndarray) -> Iterator[tuple[int, np.ndarray, dict[int, np.ndarray]]]:
        """(item, words of the passage, its runs by their width as far as asked for) over passages of a text, each
        overlapping the next by the longest item; only those whose words' bounds reach a threshold are searched."""
        place = np.searchsorted(self.vocabulary, words)
        place[place == len(self.vocabulary)] = 0
        known = self.vocabulary[place] == words
        upto = np.concatenate([[0.0], np.cumsum(np.where(known, self.bound[place], 0.0))])
        for lo in np.arange(0, max(1, len(words) - self.window + 1), self.window).tolist():
            hi = min(len(words), lo + 2 * self.window)
            if upto[hi] - upto[lo] < ENOUGH:
                continue
            terms = np.unique(place[lo:hi][known[lo:hi]])
            if self.bound[terms].sum() < ENOUGH:
                continue
            runs: dict[int, np.ndarray] = {}
            yield from ((i, words[lo:hi], runs) for i in self.search(terms))

    def share(self, mine: tuple[int, np.ndarray], words: np.ndarray, runs: dict[int, np.ndarray]) -> float:
        """The share of ``mine`` among the passage's runs of as many words."""
        width, grams = mine
        if not len(grams):
            return 0.0
        if width not in runs:
            runs[width] = self._shingles(words, width)
        return float(np.isin(grams, runs[width], assume_unique=True).mean())


def _searched(indexes):
    """(id, mark, item, overlap, question, answer) of confirmed items, the best passage of each, from all indexes at once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every: list[Index] = [x.value for x in indexes]
        for b in batches:
            data, starts = bytes_of(b.column("text"))
            rows, items, shares = [], [], []
            for lo, hi in pieces(starts):
                words, firsts = word_hashes(data[starts[lo]:starts[hi]], starts[lo:hi + 1] - starts[lo])
                for k in range(hi - lo):
                    for ix in every:
                        best: dict[int, tuple[float, float, float]] = {}
                        for i, *passage in ix.passages(words[firsts[k]:firsts[k + 1]]):
                            share = ix.share(ix.grams[i], *passage)
                            if share >= ix.overlap - 1e-9:
                                best[i] = max(best.get(i, (0.0,)), (share, *[ix.share(s, *passage) for s in ix.sides[i]]))
                        rows += [lo + k] * len(best)
                        items += [ix.ids[i] for i in best]
                        shares += best.values()
            columns = [pa.array([s[k] for s in shares], pa.float64()) for k in range(3)]
            yield pa.RecordBatch.from_arrays(
                [b.column("id").take(pa.array(rows, pa.int64())), b.column("mark").take(pa.array(rows, pa.int64())), pa.array(items, pa.int64()), *columns],
                ["id", "mark", "item", "overlap", "question", "answer"])

    return run


def leaks(docs: DataFrame, items: DataFrame, overlap: float = OVERLAP, width: int = WIDTH, id_col: str = "doc_id",
          text_col: str = "text", item_col: str = "item_id", item_text: str = "text", index_items: int = INDEX_ITEMS,
          pass_words: int = PASS_WORDS) -> DataFrame:
    """(id, mark, item, overlap, question, answer): each test item found in each text; ``mark`` is xxhash64 of the text.

    An item is found if a passage of the text holds the share ``overlap`` of its ``width``-word shingles, question and
    answer together; the last columns say how much of each, and decide nothing. Passages are twice the longest item
    long, and every stretch as long as that lies wholly in one. An item, question or answer of n < ``width`` words is compared with the
    passage's runs of n words, so a short item is found wherever its words stand in a row, and an item of one word in
    every text with that word. Items without a word, null or empty ones among them, are never found. Rows with the same
    id and text are found alike; rows that share an item_id are items of their own. Items lie in indexes of bounded size,
    and a pass over the texts searches all indexes of up to ``pass_words`` words together; the longest item is that of all
    indexes, so neither number changes a result.
    """
    spark = docs.sparkSession
    named = items.select(F.col(f"`{item_col}`").cast("long").alias("item"), text_of(item_text).alias("text"))
    listed = stored(named.mapInArrow(_item_words, "item long, question array<long>, answer array<long>"), "items")
    listed = listed.withColumn("words", F.concat("question", "answer")).where(F.size("words") > 0)
    total = listed.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("words")).alias("words"), F.max(F.size("words")).alias("longest")).first()
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), text_of(text_col).alias("text")).withColumn("mark", F.xxhash64("text"))
    schema = docs.select(F.col(f"`{id_col}`").alias("id")).schema["id"].dataType.simpleString()
    out = f"id {schema}, mark long, item long, overlap double, question double, answer double"
    n, words = total["n"], total["words"] or 0
    parts = max(1, -(-n // index_items), -(-words // INDEX_WORDS))
    held = listed.select(F.explode(F.array_distinct("words")).alias("word")).groupBy("word").count()
    idf = F.log(1 + (n - F.col("count") + 0.5) / (F.col("count") + 0.5))
    # rows repeated many times spread like others
    placed = stored(listed.withColumn("nth", F.monotonically_increasing_id()), "items-numbered")
    placed = placed.withColumn("part", F.pmod(F.xxhash64("item", "words", "nth"), F.lit(parts))).drop("nth")
    weights = placed.select("part", F.explode(F.array_distinct("words")).alias("word")).distinct().join(
        held.select("word", idf.alias("idf")), "word")
    weights, placed = stored(weights, "item-weights"), stored(placed, "items-placed")
    sizes = {r["part"]: r["words"] for r in placed.groupBy("part").agg(F.sum(F.size("words")).alias("words")).collect()}
    passes: list[list[int]] = []
    for part, size in sorted(sizes.items()):
        if not passes or sum(sizes[p] for p in passes[-1]) + size > pass_words:
            passes.append([])
        passes[-1].append(part)
    found = None
    for together in passes:
        indexes = []
        for part in together:
            mine = [(r["item"], r["question"], r["answer"]) for r in placed.where(F.col("part") == part).collect()]
            mine.sort(key=lambda x: (x[0] is None, x[0] or 0, x[1], x[2]))
            known = {r["word"]: r["idf"] for r in weights.where(F.col("part") == part).collect()}
            indexes.append(spark.sparkContext.broadcast(Index(mine, known, words / n, overlap, width, total["longest"])))
        hits = texts.select("id", "text", "mark").mapInArrow(_searched(indexes), out)
        found = hits if found is None else found.unionByName(hits)
    return found if found is not None else spark.createDataFrame([], out)


def decontaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs``, all their columns, in which no test item was found."""
    bad = stored(leaks(docs, items, id_col=id_col, text_col=text_col, **how).select(
        F.col("id").alias("leak_id"), F.col("mark").alias("leak_mark")).distinct(), "leaking")
    same = docs[id_col].eqNullSafe(bad["leak_id"]) & (F.xxhash64(F.coalesce(docs[text_col], F.lit(""))) == bad["leak_mark"])
    return docs.join(bad, same, "left_anti")


def decontamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """(doc_id, contaminated, n_items, item_ids, overlap) for each row of ``docs``: the items found in it, rising, and
    the largest share. A null or empty text holds none."""
    hits = leaks(docs, items, id_col=id_col, text_col=text_col, **how).distinct()
    per_doc = stored(hits.groupBy(F.col("id").alias("at"), F.col("mark").alias("at_mark")).agg(
        F.array_sort(F.collect_list("item")).alias("items"), F.max("overlap").alias("most")), "leak-lists")
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(text_of(text_col)).alias("mark"))
    joined = texts.join(per_doc, texts["id"].eqNullSafe(per_doc["at"]) & (texts["mark"] == per_doc["at_mark"]), "left")
    return joined.select(
        F.col("id").alias("doc_id"), F.col("items").isNotNull().alias("contaminated"),
        F.coalesce(F.array_size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.concat_ws(",", F.transform("items", lambda x: x.cast("string"))).alias("item_ids"),
        F.coalesce("most", F.lit(0.0)).alias("overlap"),
    )
