"""Line deduplication: two Bloom filters choose the suspected repeats, and only those are shuffled and confirmed."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prepkit.llm.shared import bounded, packed, stored, unpacked
from prepkit.llm.twice import MOST_BYTES, Repeats

BLANKS = " \t\n\x0b\x0c\r"
_BLANK_BYTES = BLANKS.encode()
#: Texts a task holds as Python strings at once.
AT_ONCE = 500


def line_key(line: Column) -> Column:
    """The line without blanks at its ends, A-Z lower-cased."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.btrim(line, F.lit(BLANKS)), upper, upper.lower())


def _lines(text: str) -> Column:
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)


def _cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, text, all, first): lines whose key is in ``all`` go; of those in ``first`` one line stays."""
    for whole in batches:
        for at in range(0, whole.num_rows, AT_ONCE):
            b = whole.slice(at, AT_ONCE)
            kept, n, gone, sha = [], [], [], []
            for text, drop, first in zip(*(b.column(c).to_pylist() for c in ("text", "all", "first"))):
                lines = (text or "").encode().split(b"\n")
                stay = lines
                if drop:
                    drop, once, stay = {x.encode() for x in drop}, {x.encode() for x in first or ()}, []
                    for line in lines:
                        key = line.strip(_BLANK_BYTES).lower()
                        if key not in drop or key in once:
                            once.discard(key)
                            stay.append(line)
                out = b"\n".join(stay)
                kept.append(None if text is None else out.decode())
                n.append(len(lines))
                gone.append(len(lines) - len(stay))
                sha.append(hashlib.sha256(out).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), pa.array(kept, pa.string()), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha, pa.string())],
                ["row", "kept", "n_lines", "n_dropped", "kept_sha256"],
            )


def repeated_keys(rows: DataFrame, min_docs: int, min_chars: int, most_bytes: int = MOST_BYTES) -> tuple[DataFrame, DataFrame]:
    """((id, key) of the suspected lines, (key, n_docs, first_id) of the keys in at least ``min_docs`` documents).
    """
    keys = F.filter(F.array_distinct(F.transform(_lines("text"), line_key)), lambda k: F.char_length(k) >= min_chars)
    listed = rows.select("id", F.explode(keys).alias("key")).withColumn("hash", F.xxhash64("key"))
    n = rows.agg(F.coalesce(F.sum(F.size(_lines("text")).cast("long")), F.lit(0))).first()[0]
    suspects = stored(Repeats(listed.select("hash"), n, most_bytes=most_bytes).suspected(listed, "hash").select("id", "key"), "line-suspects")
    docs = suspects.groupBy("key", "id").agg(F.lit(1).alias("one"))
    found = docs.groupBy("key").agg(F.count("one").alias("n_docs"), F.min("id").alias("first_id"))
    return suspects, stored(found.where(F.col("n_docs") >= min_docs), "line-keys")


def line_dedup(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, keep: str = "none", id_col: str = "doc_id",
               text_col: str = "text", most_bytes: int = MOST_BYTES) -> DataFrame:
    """(row, kept, n_lines, n_dropped, kept_sha256) for each row of ``docs``; ``row`` holds its columns but the text.

    Lines whose key occurs in at least ``min_docs`` documents are dropped: all of them (``keep`` "none"), or all but the
    first in the document of the smallest id (``keep`` "first"). A null or empty text is one empty line; a null one
    stays null. Repeats
    within a document count once; rows that share an id count as one document, and a null id as one more. Ends of
    line are \\n alone; the others stay as they are. Columns with any other names are carried along untouched.
    """
    if keep not in ("none", "first"):
        raise ValueError(f"keep must be 'none' or 'first', not {keep!r}")
    if min_docs < 2:
        raise ValueError("the filters find what occurs twice: min_docs must be 2 or more")
    rows = packed(docs, id_col, text_col)
    known = F.struct(F.coalesce(F.col("id").cast("long"), F.lit(0)).alias("n"), F.col("id").isNull().alias("no_id"))
    suspects, found = repeated_keys(rows.select(known.alias("id"), "text"), min_docs, min_chars, most_bytes)
    last = found.select("key", "first_id")
    marks = suspects.join(bounded(last, "key"), "key").groupBy("id").agg(
        F.collect_set("key").alias("all"),
        F.collect_set(F.when((F.col("id") == F.col("first_id")) & F.lit(keep == "first"), F.col("key"))).alias("first"),
    ).withColumnRenamed("id", "at")
    # always a shuffle of the texts, so that the plan is the same at any size of the marks
    marks = stored(marks, "line-marks").hint("merge")
    joined = rows.withColumn("known", known).join(marks, F.col("known") == F.col("at"), "left")
    schema = joined.select("row").schema
    out = "row " + schema["row"].dataType.simpleString() + ", kept string, n_lines long, n_dropped long, kept_sha256 string"
    return joined.select("row", "text", "all", "first").mapInArrow(_cleaned, out)


def cleaned(docs: DataFrame, n_chars: str = "n_chars", text_col: str = "text", **how) -> DataFrame:
    """``docs``, all columns, with the repeated lines taken out of the text and the count of characters, if any, renewed."""
    return unpacked(line_dedup(docs, text_col=text_col, **how), docs.columns, text_col, "kept", n_chars)


SQL = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS line_key
  FROM lines),
common AS (
  SELECT line_key FROM keyed WHERE length(line_key) >= 1 GROUP BY line_key HAVING count(DISTINCT doc_id) >= 10),
marked AS (
  SELECT k.*, c.line_key IS NOT NULL AS gone FROM keyed k LEFT JOIN common c ON k.line_key = c.line_key)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
