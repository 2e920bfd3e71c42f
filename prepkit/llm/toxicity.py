"""Toxicity: a learned lexicon kept in a trie, met by Levenshtein automata, with hits scored by their context.

Terms are words that tell labelled toxic documents from others. Each word of a text is read by the Levenshtein automaton
of that word running along the trie, so a misspelt term is found as well. A hit inside a quotation counts less than one
outside. A logistic model on the summed hits gives the score.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prepkit.llm.shared import fold_of, may_be_among, packed, stored, text_of, unpacked

WORD = re.compile(r"[^\W_]+")
QUOTES = re.compile(r"[\"“”„«»‹›]")
#: Labelled rows a model is learned from, at most; they bound the lexicon, which holds every word that passes the bars:
#: the toxic rows with it, their share among all with it, and its likelihood ratio.
SAMPLE, BAD_ROWS, BAD_SHARE, GAIN = 20_000, 4, 0.8, 25
#: What a hit counts: plain, or inside a quotation; how far, in characters, a quotation's marks may be.
PLAIN, QUOTED, REACH = 1.0, 0.25, 240
#: Shorter terms are met exactly only. Words whose matches a task remembers.
FUZZY_FROM, REMEMBERED = 5, 400_000


class Trie:
    """The lexicon. ``match`` runs a word's Levenshtein automaton (one edit) along it."""

    def __init__(self, terms: dict[str, float]):
        self.terms, self.root = terms, {}
        self.starts, self.ends = set(), set()
        for term in terms:
            if len(term) < FUZZY_FROM:
                continue
            node = self.root
            for c in term:
                node = node.setdefault(c, {})
            node[""] = term
            self.starts.update(term[:k] for k in range(len(term) + 1))
            self.ends.update(term[k:] for k in range(len(term) + 1))

    def match(self, word: str) -> tuple[str, int] | None:
        """(term, edits) for the heaviest term at the fewest edits, 0 or 1, from ``word``; None if there is none."""
        if word in self.terms:
            return word, 0
        half = len(word) // 2  # an edit spares one half of the word
        if len(word) < FUZZY_FROM - 1 or not (word[:half] in self.starts or word[half:] in self.ends):
            return None
        best, stack, n = None, [(self.root, ((0, 0),))], len(word)
        while stack:
            node, states = stack.pop()
            for c, below in node.items():
                if c == "":
                    if any(n - i + e <= 1 for i, e in states) and (best is None or self.terms[below] > self.terms[best]):
                        best = below
                    continue
                after = set()
                for i, e in states:
                    if i < n and word[i] == c:
                        after.add((i + 1, e))
                    if e == 0:
                        after.add((i, 1))  # a letter of the term is missing from the word
                        if i < n:
                            after.add((i + 1, 1))  # another letter stands in its place
                            if i + 1 < n and word[i + 1] == c:
                                after.add((i + 2, 1))  # the word has one letter more
                if after:
                    stack.append((below, tuple(after)))
        return (best, 1) if best else None


@dataclass
class Model:
    terms: dict[str, float] = field(default_factory=dict)
    #: What a misspelling of each term counts: less where clean documents have words near it.
    close: dict[str, float] = field(default_factory=dict)
    #: Words near a term that clean documents use: they are words of their own.
    apart: frozenset[str] = frozenset()
    #: One weight a feature, and last the bias, which alone scores a text without a hit.
    weights: tuple[float, ...] = (0.0,)


class Reader:
    """Hits of one task: a word's match is found once and remembered, up to a bound."""

    def __init__(self, model: Model):
        self.model, self.trie, self.known = model, Trie(model.terms), {}

    def hits(self, text: str) -> list[tuple[int, str, int]]:
        """(place in code points, term, edits) of each hit."""
        low, known, trie, apart = text.lower(), self.known, self.trie, self.model.apart
        out = []
        found = {}  # this text's own matches: those remembered may go before its last word is read
        for word in set(WORD.findall(low)):
            if word not in known:
                if len(known) >= REMEMBERED:
                    known.clear()
                got = trie.match(word)
                known[word] = None if got and got[1] and word in apart else got
            if known[word]:
                found[word] = known[word]
        if found:
            for m in re.finditer(r"(?<![^\W_])(?:" + "|".join(map(re.escape, sorted(found, key=len, reverse=True))) + r")(?![^\W_])", low):
                out.append((m.start(), *found[m.group()]))
        return out

    def features(self, text: str) -> list[float]:
        hits = self.hits(text)
        if not hits:
            return [0.0] * 4
        marks = [m.start() for m in QUOTES.finditer(text.lower())]
        at = np.searchsorted(marks, [h[0] for h in hits]) if marks else [0] * len(hits)
        exact = close = heaviest = 0.0
        for (place, term, edits), k in zip(hits, at):
            inside = k % 2 == 1 and k < len(marks) and marks[k] - place <= REACH and place - marks[k - 1] <= REACH
            score = (QUOTED if inside else PLAIN) * (self.model.close.get(term, 0.0) if edits else self.model.terms[term])
            heaviest = max(heaviest, score)
            if edits:
                close += score
            else:
                exact += score
        words = max(1, text.count(" ") + 1)
        return [math.log1p(exact), math.log1p(close), heaviest, (exact + close / 2) / math.sqrt(words)]

    def score(self, text: str) -> float:
        *w, bias = self.model.weights
        z = bias + (sum(a * b for a, b in zip(w, self.features(text))) if w else 0.0)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 60) -> tuple[float, ...]:
    """Newton's method with a ridge on all weights but the bias; hits never count against toxicity."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    live = np.ones(x1.shape[1], bool)
    while True:
        w = np.zeros(x1.shape[1])
        penalty = np.diag([ridge] * x.shape[1] + [1e-6])[np.ix_(live, live)]
        xl = x1[:, live]
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(xl @ w[live], -30, 30)))
            step = np.linalg.solve(xl.T * (p * (1 - p)) @ xl + penalty, xl.T @ (y - p) - penalty @ w[live])
            w[live] += np.clip(step, -5, 5)
        wrong = (w < 0) & (np.arange(len(w)) < x.shape[1])
        if not wrong.any():
            return tuple(w.tolist())
        live &= ~wrong


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(toxic, word) for each distinct word of each text."""
    for b in batches:
        toxic, words = [], []
        for t, y in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist()):
            mine = set(WORD.findall(t.lower()))
            words += mine
            toxic += [y] * len(mine)
        yield pa.RecordBatch.from_arrays([pa.array(toxic, pa.int32()), pa.array(words, pa.string())], ["toxic", "word"])


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """A model from labelled rows outside the held-out fold: those with the ``sample`` smallest hashes of their id.

    Rows without a label or an id are left out; an id labelled twice is toxic if either label says so; equal texts
    count once. Without rows of both labels every text scores the share of toxic ones (a half without any).
    """
    chosen = labels.where(f"{id_col} IS NOT NULL AND toxic IS NOT NULL").where(fold_of(id_col) != 0)
    chosen = chosen.groupBy(F.col(id_col).alias("id")).agg(F.max("toxic").cast("int").alias("toxic"))
    chosen = stored(chosen.withColumn("hash", F.xxhash64("id")), "toxic-labels")
    low = chosen.where(may_be_among("hash", sample, F.lit(max(1, chosen.count()))))
    chosen = stored(low.orderBy("hash", "id").limit(sample).select("id", "toxic"), "toxic-sample")
    rows = docs.select(F.col(f"`{id_col}`").alias("at"), text_of(text_col).alias("text"))
    rows = rows.join(F.broadcast(chosen), F.col("at") == F.col("id")).select("toxic", "text").distinct()
    rows = stored(rows, "toxic-texts")
    n = dict((r["toxic"], r["count"]) for r in rows.groupBy("toxic").count().collect())
    bad, good = n.get(1, 0), n.get(0, 0)
    if not bad or not good:
        share = min(0.99, max(0.01, bad / (bad + good))) if bad + good else 0.5
        return Model(weights=(math.log(share / (1 - share)),))
    counted = rows.mapInArrow(_words, "toxic int, word string").groupBy("word").agg(
        F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good"))
    counted = stored(counted, "toxic-words")
    rate = bad / (bad + good)
    b, g = F.col("bad"), F.col("good")
    share = b / (b + g)
    gain = 2 * (b * F.log(share / rate) + F.when(g > 0, g * F.log((1 - share) / (1 - rate))).otherwise(0.0))
    best = counted.where((b >= BAD_ROWS) & (share >= BAD_SHARE)).withColumn("gain", gain).where(F.col("gain") >= GAIN)
    found = best.orderBy(F.col("gain").desc(), "word").collect()  # words of at most ``sample`` texts
    lexicon = {r["word"]: math.log((r["bad"] + 0.5) / (r["good"] + 0.5) * good / bad) for r in found}
    if not lexicon:
        return Model(weights=(math.log(rate / (1 - rate)),))
    model = Model(lexicon)
    near = counted.mapInArrow(_near(model), "word string, term string, bad long, good long").collect()
    model.apart = frozenset(r["word"] for r in near if r["good"])
    all_bad, all_good = sum(r["bad"] for r in near) + 1, sum(r["good"] for r in near) + 1
    by_term: dict[str, list] = {}
    for r in near:
        by_term.setdefault(r["term"], []).append(r)
    for term, weight in lexicon.items():
        mine = by_term.get(term, [])
        b = sum(r["bad"] for r in mine) + all_bad / (all_bad + all_good)
        g = sum(r["good"] for r in mine) + all_good / (all_bad + all_good)
        model.close[term] = min(weight, max(0.0, math.log(b / g * good / bad)))
    seen = rows.mapInArrow(_featured(model), "toxic int, features array<double>").collect()
    x, y = np.array([r["features"] for r in seen]), np.array([r["toxic"] for r in seen], float)
    model.weights = _logistic(x, y)
    return model


def _near(model: Model):
    """(word, term, bad, good) of the words one edit from a term."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(model.terms)
        for b in batches:
            found = [trie.match(w) for w in b.column("word").to_pylist()]
            at = [k for k, got in enumerate(found) if got and got[1]]
            near = b.select(["word", "bad", "good"]).take(pa.array(at, pa.int64()))
            terms = pa.array([found[k][0] for k in at], pa.string())
            yield pa.RecordBatch.from_arrays([near.column(0), terms, near.column(1), near.column(2)], ["word", "term", "bad", "good"])

    return run


def _featured(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model)
        for b in batches:
            rows = [reader.features(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("toxic"), pa.array(rows, pa.list_(pa.float64()))], ["toxic", "features"])

    return run


def _scored(model: Model):
    """The columns given, and the score."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model)
        for b in batches:
            scores = [reader.score(t or "") for t in b.column("text").to_pylist()]
            yield b.append_column("score", pa.array(scores, pa.float64()))

    return run


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, id, text, score): the text of each row of ``docs``, its score, 0 to 1, and its other columns as ``row``.

    A null or empty text scores like one without a hit. No other column is read.
    """
    rows = packed(docs, id_col, text_col)
    return rows.mapInArrow(_scored(model), T.StructType([*rows.schema.fields, T.StructField("score", T.DoubleType())]))


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of ``docs``, by a model learned from the labelled ones."""
    found = score(docs.select("doc_id", "text"), learn(docs, labels))
    return found.select(
        F.col("id").alias("doc_id"), (fold_of("id") == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, all their columns, that score under a half."""
    return unpacked(score(docs, learn(docs, labels)).where("score < 0.5"), docs.columns, "text")
