"""Spelling variants: pairs of words one edit apart, found by products of letter-count matrices, and what they lead to.

One inserted, deleted or replaced code point changes a word's letter counts by a squared distance of at most two. Words
are kept in blocks by length and, within a length, by how many of their letters fall into each of five classes; one edit
adds one to a class, or takes one from a class and adds it to another or the same, so only such neighbouring blocks can
hold a pair. A task multiplies the count matrices of two blocks, which gives all squared distances at once, keeps the
pairs at two or less, and verifies the edit on the words themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prepkit.llm.shared import bounded, stored

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Classes of letters, by code point; columns of a count matrix, by code point too.
CLASSES, COLUMNS = 5, 64
#: Most words of a block, most code points of one, distances a task works out, candidates verified at once.
BLOCK, CELLS, WORK, AT_ONCE = 1024, 1 << 20, 1 << 28, 1 << 16


def lowered(word: Column) -> Column:
    """A-Z lower-cased and no other letter; words without capitals, most of them, are not touched."""
    return F.when(F.lower(word) == word, word).otherwise(F.translate(word, UPPER, UPPER.lower()))


def slipped(word: Column, key: Column, one_in: int) -> Column:
    """The word, or if ``one_in`` divides the key's unsigned crc32, the word without its code point crc32 % length."""
    h = F.crc32(key.cast("binary"))
    at = (h % F.char_length(word)).cast("int")
    return F.when(h % one_in != 0, word).otherwise(F.concat(F.substr(word, F.lit(1), at), F.substr(word, at + 2, F.char_length(word))))


def vocabulary(docs: DataFrame, min_chars: int = 6, min_count: int = 5, one_in: int | None = None, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """(word, n): the lower-cased runs of letters of all texts, of at least ``min_chars`` and ``min_count`` occurrences.

    With ``one_in``, one run in that many, by the hash of its row's id and itself, loses a letter first: made
    misspellings, the same at any run. A null id counts as empty there; a null or empty text has no words.
    """
    runs = docs.select(
        F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("id"),
        # only the runs that are long enough: a shorter one never matches
        F.explode(F.regexp_extract_all(F.col(f"`{text_col}`").cast("string"), F.lit(f"[A-Za-zÀ-ÿ]{{{min_chars},}}"), F.lit(0))).alias("run"),
    ).select("id", lowered(F.col("run")).alias("word"))
    if one_in:
        runs = runs.select(slipped(F.col("word"), F.concat("id", F.lit(":"), "word"), one_in).alias("word"))
    counted = runs.where(F.char_length("word") >= min_chars).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= min_count)


def _class_counts(word: Column) -> Column:
    """How many letters of each class: their code points' remainders."""
    codes = F.transform(F.split(word, ""), lambda c: F.ascii(c) % CLASSES)

    def count(k: int) -> Column:
        return F.size(F.filter(codes, lambda c: c == k))

    return F.array(*map(count, range(CLASSES)))


def _neighbours(counts: Column) -> Column:
    """Class counts one edit away, itself included; of each two that are, only one lists the other."""
    def moved(less: int | None, more: int) -> Column:
        return F.transform(counts, lambda x, i: x + F.when(i == more, 1).when(i == (-1 if less is None else less), -1).otherwise(0))

    grown = [moved(None, k) for k in range(CLASSES)]
    shifted = [F.when(F.get(counts, F.lit(i)) > 0, moved(i, j)) for i in range(CLASSES) for j in range(i + 1, CLASSES)]
    return F.array_compact(F.array(counts, *grown, *shifted))


def _codes(words: str) -> np.ndarray:
    """Code points of words of one length, a word a row."""
    listed = words.split(" ")
    return np.array(listed).view(np.uint32).reshape(len(listed), -1)


def _matrix(codes: np.ndarray) -> np.ndarray:
    """Letters counted by code point modulo COLUMNS; letters that share a column can only bring words closer."""
    n, width = codes.shape
    at = np.arange(n)[:, None] * COLUMNS + codes % COLUMNS
    exact = np.float32 if width < 4000 else np.float64  # squares stay whole numbers
    return np.bincount(at.ravel(), minlength=n * COLUMNS).reshape(n, COLUMNS).astype(exact)


def near_pairs(a: np.ndarray, b: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Rows of two blocks of code points that are one edit apart; ``b`` is as long as ``a`` or one longer."""
    x, y = _matrix(a), _matrix(b)
    both = np.flatnonzero(x.any(0) & y.any(0))
    distance = (x * x).sum(1)[:, None] + (y * y).sum(1)[None] - 2 * (x[:, both] @ y[:, both].T)
    left, right = np.nonzero(distance <= 2)
    if same:
        left, right = left[left < right], right[left < right]
    good = []
    for at in range(0, len(left), AT_ONCE):
        u, v = a[left[at:at + AT_ONCE]], b[right[at:at + AT_ONCE]]
        width = u.shape[1]
        if v.shape[1] == width:
            good.append((u != v).sum(1) == 1)
        else:  # what agrees from the front and from the back covers the shorter word
            front = np.logical_and.accumulate(u == v[:, :width], 1).sum(1)
            back = np.logical_and.accumulate((u == v[:, 1:])[:, ::-1], 1).sum(1)
            good.append(front + back >= width)
    keep = np.concatenate(good) if good else np.zeros(0, bool)
    return left[keep], right[keep]


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(words, ns, words2, ns2, same) to (word, near, near_n), each pair in both directions."""
    for batch in batches:
        for words, ns, words2, ns2, same in zip(*(c.to_pylist() for c in batch.columns)):
            i, j = near_pairs(_codes(words), _codes(words2), same)
            if len(i):
                a, b = np.array(words.split(" "), object), np.array(words2.split(" "), object)
                n, m = np.array(ns), np.array(ns2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([a[i], b[j]]), pa.string()), pa.array(np.concatenate([b[j], a[i]]), pa.string()),
                     pa.array(np.concatenate([m[j], n[i]]), pa.int64())],
                    ["word", "near", "near_n"],
                )


def one_edit_pairs(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """(word, near, near_n): every two of ``words`` (word, n; distinct, no blanks) one edit apart, in both directions.

    A crowded block is split by hash into parts of about ``block`` words, and each two parts that can hold a pair are
    compared in one row; no group of words ever meets in one task. An empty table has no pairs.
    """
    keyed = words.select("word", "n", _class_counts(F.col("word")).alias("counts"))
    most = F.greatest(F.lit(1), F.least(F.lit(block), F.floor(F.lit(CELLS) / F.max(F.char_length("word")))))
    sizes = stored(keyed.groupBy("counts").agg(F.count(F.lit(1)).alias("size"), F.ceil(F.count(F.lit(1)) / most).alias("parts")), "spelling-sizes")
    split = bounded(sizes.select("counts", "parts"))
    parts = keyed.join(split, "counts").withColumn("part", F.pmod(F.xxhash64("word"), F.col("parts")))
    listed = F.array_sort(F.collect_list(F.struct("word", "n")))
    blocks = parts.groupBy("counts", "part").agg(listed.alias("listed")).select(
        "counts", "part", F.array_join("listed.word", " ").alias("words"), F.col("listed.n").alias("ns")
    )
    blocks = stored(blocks, "spelling-blocks")

    other = sizes.select(F.col("counts").alias("counts2"), F.col("size").alias("size2"), F.col("parts").alias("parts2"))
    met = stored(sizes.withColumn("counts2", F.explode(_neighbours(F.col("counts")))).join(bounded(other), "counts2"), "spelling-met")
    work = met.agg(F.coalesce(F.sum(F.col("size").cast("double") * F.col("size2")), F.lit(0.0))).first()[0]
    each = met.select("counts", "counts2", "parts2", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
    each = each.select("counts", "counts2", "part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts2") - 1)).alias("part2"))
    each = each.withColumn("own", F.col("counts") == F.col("counts2")).where(~F.col("own") | (F.col("part") <= F.col("part2")))
    there = bounded(blocks, "words")
    beside = there.select(F.col("counts").alias("counts2"), F.col("part").alias("part2"), F.col("words").alias("words2"), F.col("ns").alias("ns2"))
    both = each.join(there, ["counts", "part"]).join(beside, ["counts2", "part2"])
    both = both.withColumn("same", F.col("own") & (F.col("part") == F.col("part2")))
    tasks = max(1, int(work // WORK), int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = both.repartition(tasks, "counts", "part", "counts2", "part2")
    return dealt.select("words", "ns", "words2", "ns2", "same").mapInArrow(_pairs, "word string, near string, near_n long")


def _roots(links: DataFrame) -> DataFrame:
    """(word, root) from (word, form): each link is joined to where it leads, twice as far every time, until none leads on.

    Counts rise fivefold along a link, so there is no circle, and chains are as long as a logarithm of the counts.
    """
    far = stored(links.select("word", F.col("form").alias("root")), "spelling-links")
    while True:
        on = far.select(F.col("word").alias("at"), F.col("root").alias("further"))
        joined = far.join(on, far["root"] == on["at"], "left")
        found = stored(joined.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "spelling-roots")
        far = found.select("word", "root")
        if found.where("moved").isEmpty():
            return far


def variants(words: DataFrame, ratio: int = 5, block: int = BLOCK) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for each of ``words`` (word, n; distinct, no blanks).

    ``n_near`` counts the words one inserted, deleted or replaced code point away. ``form`` is the one of them with the
    largest n, the smallest in code-point order of ties, if that is at least ``ratio`` times the word's; else null.
    ``root`` is where the forms lead, the word itself if it has none. An empty table has no rows.
    """
    if ratio < 2:
        raise ValueError("ratio must be 2 or more, so that forms lead upwards and end")
    near = one_edit_pairs(words, block).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    )
    better = -F.col("best.less") >= F.col("n") * ratio
    found = stored(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(better, F.col("best.near")).alias("form"),
        F.when(better, -F.col("best.less")).alias("form_n"),
    ), "spelling-forms")
    roots = _roots(found.where("form IS NOT NULL").select("word", "form"))
    return found.join(roots, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


def slipped_variants(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """The words of all documents, one run in 199 misspelt, with what each is a variant of."""
    return variants(stored(vocabulary(docs, one_in=199), "spelling-words"), block=block)


SQL = """
WITH RECURSIVE
steps AS (
  SELECT list(c ORDER BY b) AS t FROM (
    SELECT b, list_reduce(list_concat([b], range(1, 9)), lambda c, k: xor(c >> 1, 3988292384 * (c & 1))) AS c
    FROM range(256) r(b))),
runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\\x{00C0}-\\x{00FF}]+')) AS run FROM documents)
  WHERE length(run) >= 6 GROUP BY ALL),
keyed AS (SELECT run, n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS h FROM runs),
hashed AS (
  SELECT run, n, xor(list_reduce(list_concat([4294967295], list_transform(range(0, length(h) // 2),
                                                                         lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT)),
                                 lambda a, b: xor(a >> 8, t[1 + (xor(a, b) & 255)])), 4294967295) AS crc
  FROM keyed, steps),
words AS (
  SELECT CASE WHEN crc % 199 = 0 THEN left(run, crc % length(run)) || substr(run, crc % length(run) + 2) ELSE run END AS word,
         sum(n)::BIGINT AS n
  FROM hashed GROUP BY 1 HAVING length(word) >= 6 AND sum(n) >= 5),
holes AS (
  SELECT word, n, gap, left(word, gap - 1) || substr(word, gap + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS gap FROM words)),
pairs AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM holes a JOIN holes b ON a.gap = b.gap AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT h.word, w.word, w.n FROM holes h JOIN words w ON w.word = h.rest
  UNION SELECT w.word, h.word, h.n FROM holes h JOIN words w ON w.word = h.rest),
best AS (
  SELECT word, count(*) AS n_near, min({'less': -near_n, 'near': near}) AS top FROM pairs GROUP BY word),
forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
         CASE WHEN -top.less >= 5 * w.n THEN top.near END AS form, CASE WHEN -top.less >= 5 * w.n THEN -top.less END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word),
walk AS (
  SELECT word, word AS root, form AS onward FROM forms
  UNION ALL
  SELECT k.word, f.word, f.form FROM walk k JOIN forms f ON f.word = k.onward)
SELECT f.word, f.form, k.root, f.n, f.n_near, f.form_n
FROM forms f JOIN walk k ON k.word = f.word AND k.onward IS NULL
"""
