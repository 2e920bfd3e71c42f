"""Language identification in two steps: the family first, then one linear machine for each pair within it.

Texts become hashed counts of letter pairs and triples over their whole length. Families are learned: languages whose
mean counts are close stand together. One-versus-rest machines choose the family, and one-versus-one machines, trained
on the two languages alone, tell its closely related members apart.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from prepkit.llm.shared import bounded, fold_of, may_be_among, packed, stored, text_of
from prepkit.llm.shingles import U, bytes_of, mixed, pieces

#: Rows learned from, for each language and in all; size of the hashed counts.
PER_LANGUAGE, SAMPLE, SIZE = 800, 8_000, 2048
#: Texts whose counts a task holds at once, however short they are: 16 MB of them.
AT_ONCE = 1000
UNKNOWN = "und"

#: Bytes that are no letters: blanks, signs and digits of ASCII; they separate words. Other bytes belong to letters.
_LETTER = np.ones(256, bool)
_LETTER[:128] = [chr(c).isalpha() for c in range(128)]
_CODE = np.arange(256, dtype=np.uint8)
_CODE[65:91] += 32
_CODE[~_LETTER] = 32


def counts(texts: pa.Array, size: int = SIZE) -> Iterator[tuple[int, np.ndarray]]:
    """(first text, rows of counts) by pieces: square roots of the counts of letter pairs and triples, of length 1."""
    data, starts = bytes_of(texts)
    for lo, hi in pieces(starts, texts=AT_ONCE):
        code = _CODE[data[starts[lo]:starts[hi]]].astype(U)
        owner = np.repeat(np.arange(hi - lo), np.diff(starts[lo:hi + 1]))
        out = np.zeros((hi - lo) * size)
        letter = code != U(32)
        for width in (2, 3):
            if len(code) < width:
                continue
            n = len(code) - width + 1
            gram = np.zeros(n, U)
            held = np.zeros(n, bool)
            for k in range(width):
                gram = gram * U(256) + code[k:k + n]
                held |= letter[k:k + n]
            held &= owner[:n] == owner[width - 1:]
            place = (mixed(gram[held] + U(width << 40)) % U(size)).astype(np.int64)
            out += np.bincount(owner[:n][held] * size + place, minlength=len(out))
        rows = np.sqrt(out.reshape(hi - lo, size))
        norm = np.sqrt((rows * rows).sum(1, keepdims=True))
        yield lo, (rows / np.where(norm > 0, norm, 1)).astype(np.float32)


def _machine(x: np.ndarray, y: np.ndarray, steps: int = 60, cost: float = 20.0) -> np.ndarray:
    """A linear machine of squared hinge loss, classes weighed alike, by Newton steps in conjugate gradients; bias last."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)]).astype(np.float64)
    c = np.where(y > 0, 1 / max(1, (y > 0).sum()), 1 / max(1, (y < 0).sum())) * cost
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        margin = 1 - y * (x @ w)
        on = margin > 0
        grad = w - x[on].T @ (2 * c[on] * y[on] * margin[on])
        if np.linalg.norm(grad) < 1e-4:
            break
        xo, co = x[on], 2 * c[on]
        step, r = np.zeros_like(w), -grad
        p, rr = r.copy(), r @ r
        for _ in range(30):
            hp = p + xo.T @ (co * (xo @ p))
            a = rr / (p @ hp)
            step += a * p
            r = r - a * hp
            new = r @ r
            if new < 1e-10:
                break
            p, rr = r + new / rr * p, new
        value, size = 0.5 * w @ w + (c * np.maximum(0, margin) ** 2).sum(), 1.0
        while size > 1e-4:
            t = w + size * step
            if 0.5 * t @ t + (c * np.maximum(0, 1 - y * (x @ t)) ** 2).sum() <= value + 1e-4 * size * (grad @ step):
                break
            size /= 2
        w = w + size * step
    return w


def _families(means: np.ndarray) -> list[list[int]]:
    """Languages by average linkage of the cosines of their centred means, into about the root of their number."""
    n = len(means)
    centred = means - means.mean(0)
    centred /= np.maximum(1e-12, np.linalg.norm(centred, axis=1, keepdims=True))
    close = centred @ centred.T
    groups = [[i] for i in range(n)]
    while len(groups) > max(1, math.ceil(math.sqrt(n))):
        pairs = [(close[np.ix_(a, b)].mean(), i, j) for i, a in enumerate(groups) for j, b in enumerate(groups) if i < j]
        _, i, j = max(pairs)
        groups[i] += groups.pop(j)
    return groups


@dataclass
class Model:
    languages: list[str] = field(default_factory=list)
    families: list[list[int]] = field(default_factory=list)
    #: One row of weights a family, and one a pair of a family's languages.
    family: np.ndarray | None = None
    pairs: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)

    def predict(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(language, score) for each row of counts: the family of the largest margin, then the votes of its pairs."""
        n = len(rows)
        x = np.hstack([rows, np.ones((n, 1), np.float32)])
        lang, score = np.zeros(n, int), np.ones(n)
        squash = lambda m: 1 / (1 + np.exp(-np.clip(4 * m, -30, 30)))
        if len(self.families) > 1:
            margins = x @ self.family.T
            chosen = margins.argmax(1)
            best = np.sort(margins, 1)
            score *= squash((best[:, -1] - best[:, -2]) / 2)
        else:
            chosen = np.zeros(n, int)
        for f, members in enumerate(self.families):
            mine = np.flatnonzero(chosen == f)
            if not len(mine):
                continue
            votes = np.zeros((len(mine), len(members)))
            for i, a in enumerate(members):
                for j, b in enumerate(members[i + 1:], i + 1):
                    p = squash(x[mine] @ self.pairs[a, b])
                    votes[:, i] += p
                    votes[:, j] += 1 - p
            lang[mine] = np.array(members)[votes.argmax(1)]
            if len(members) > 1:
                score[mine] *= votes.max(1) / (len(members) - 1)
        return lang, score


def fit(x: np.ndarray, langs: list[str]) -> Model:
    names = sorted(set(langs))
    y = np.array([names.index(v) for v in langs])
    model = Model(names, [list(range(len(names)))] if names else [])
    if len(names) < 2:
        return model
    model.families = [sorted(g) for g in _families(np.array([x[y == k].mean(0) for k in range(len(names))]))]
    home = np.zeros(len(names), int)
    for f, members in enumerate(model.families):
        home[members] = f
    if len(model.families) > 1:
        model.family = np.array([_machine(x, np.where(home[y] == f, 1.0, -1.0)) for f in range(len(model.families))])
    for members in model.families:
        for i, a in enumerate(members):
            for b in members[i + 1:]:
                two = (y == a) | (y == b)
                model.pairs[a, b] = _machine(x[two], np.where(y[two] == a, 1.0, -1.0))
    return model


def _counted(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, rows in counts(b.column("text"), size):
                yield pa.RecordBatch.from_arrays(
                    [b.column("lang").slice(lo, len(rows)), pa.array([r.tobytes() for r in rows], pa.binary())], ["lang", "counts"])

    return run


def learn(docs: DataFrame, per_language: int = PER_LANGUAGE, sample: int = SAMPLE, id_col: str = "doc_id",
          text_col: str = "text", lang_col: str = "lang") -> Model:
    """A model from rows outside the held-out fold whose language is known.

    It is fitted on the rows with the smallest hashes of their id: ``per_language`` of each language, the first
    ``sample`` in all, so that no language may go short of another. Rows that share an id are chosen together. Texts
    without a letter teach nothing.
    """
    known = docs.where(F.col(f"`{lang_col}`").isNotNull() & F.col(f"`{id_col}`").isNotNull()).where(fold_of(id_col) != 0)
    ids = known.select(F.col(f"`{id_col}`").alias("at"), F.col(f"`{lang_col}`").cast("string").alias("lang"))
    ids = ids.withColumn("hash", F.xxhash64("at"))
    sizes = stored(ids.groupBy(F.col("lang").alias("of")).agg(F.count(F.lit(1)).alias("n")), "lang-sizes")
    low = ids.join(bounded(sizes, "of"), F.col("lang") == F.col("of")).where(may_be_among("hash", per_language, F.col("n")))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("hash", "at"))
    chosen = low.withColumn("rank", rank).where(F.col("rank") <= per_language).orderBy("rank", "hash", "at").limit(sample)
    chosen = stored(chosen.select("at", "lang").distinct(), "lang-sample")
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{lang_col}`").cast("string").alias("lang"), text_of(text_col).alias("text"))
    rows = texts.join(F.broadcast(chosen.withColumnRenamed("lang", "of")), (F.col("id") == F.col("at")) & (F.col("lang") == F.col("of")))
    found = rows.select("lang", "text").where(F.col("text").rlike(r"\p{L}")).mapInArrow(_counted(SIZE), "lang string, counts binary").collect()
    found.sort(key=lambda r: (r["lang"], r["counts"]))
    if not found:
        return Model()
    x = np.array([np.frombuffer(r["counts"], np.float32) for r in found])
    return fit(x, [r["lang"] for r in found])


def _identified(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, rows in counts(b.column("text")):
                mine = b.slice(lo, len(rows))
                empty = np.array([not any(map(str.isalpha, t or "")) for t in mine.column("text").to_pylist()], bool)
                if model.languages:
                    lang, score = model.predict(rows)
                    names = [UNKNOWN if e else model.languages[k] for e, k in zip(empty, lang)]
                else:
                    names, score = [UNKNOWN] * len(rows), np.zeros(len(rows))
                score = np.where(empty, 0.0, score)
                yield pa.RecordBatch.from_arrays(
                    [mine.column("row"), pa.array(names, pa.string()), pa.array(score, pa.float64())], ["row", "lang_pred", "score"])

    return run


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, lang_pred, score): each row of ``docs`` with the language of its whole text, and 0 to 1.

    A null text or one without a letter is ``und`` with score 0, and so is every text if nothing could be learned; a
    single learned language is always chosen. No other column is read; all are carried along in ``row``.
    """
    rows = packed(docs, id_col, text_col).select("row", "text")
    return rows.mapInArrow(_identified(model), "row " + rows.schema["row"].dataType.simpleString() + ", lang_pred string, score double")


def identified(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for each row of ``docs``, by a model learned from them."""
    found = identify(docs.select("doc_id", "text"), learn(docs))
    found = found.select(F.col("row.doc_id").alias("doc_id"), "lang_pred", "score")
    return found.select("doc_id", (fold_of("doc_id") == 0).alias("held_out"), "lang_pred", "score")
