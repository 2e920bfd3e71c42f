"""Small helpers: written tables in the shared folder, whole rows carried through, sizes checked before a broadcast."""

from __future__ import annotations

import gc

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prepkit.sources.frozen import frozen

#: Rows and bytes up to which a measured table may be broadcast.
SMALL_ROWS, SMALL_BYTES = 200_000, 32 << 20


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: cuts lineage and survives lost executors."""
    return frozen(df, name)


def sweep(spark: SparkSession) -> None:
    """Let Spark's cleaner remove the shuffle files of steps whose results are stored.

    It removes what the driver no longer refers to, which it learns when it collects garbage.
    """
    gc.collect()
    spark._jvm.System.gc()


def measured(df: DataFrame, *texts: str) -> tuple[int, int]:
    """Rows, and bytes of the named text or binary columns plus 16 a row, by one aggregate."""
    size = F.lit(16)
    for c in texts:
        size = size + F.coalesce(F.octet_length(c), F.lit(0))
    r = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(size.cast("long")), F.lit(0)).alias("b")).first()
    return r["n"], r["b"]


def bounded(df: DataFrame, *texts: str, rows: int = SMALL_ROWS, size: int = SMALL_BYTES) -> DataFrame:
    """``df`` marked for broadcast if it was measured to be small, else as it is, so that the join shuffles."""
    n, b = measured(df, *texts)
    return F.broadcast(df) if n <= rows and b <= size else df


def may_be_among(hash_col: str, wanted: int, total: Column) -> Column:
    """Whether a 64-bit hash can be one of the ``wanted`` smallest of ``total``: a test that passes about four times as
    many, so that sorting them takes the same whatever ``total`` is. Fewer than ``wanted`` pass only by a chance of
    under 1 in 10^100 for hundreds wanted."""
    return F.col(hash_col).cast("double") / 2.0**64 + 0.5 <= 4.0 * wanted / total


def text_of(col: str) -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(F.col(f"`{col}`").cast("string"), F.lit(""))


def fold_of(id_col: str) -> Column:
    """crc32 of the id as text, modulo 5; 0 is held out."""
    return F.crc32(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).cast("binary")) % 5


def packed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(row, id, text): all columns but the text as one struct, so that no other name can clash; a null text stays null."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text_col] or [F.lit(None).cast("int").alias("none")]
    return docs.select(F.struct(*rest).alias("row"), F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))


def unpacked(df: DataFrame, columns: list[str], text_col: str, text: str = "text", n_chars: str | None = None) -> DataFrame:
    """The columns of the packed table again, the text from ``text``; a column ``n_chars`` is counted anew."""
    out = []
    for c in columns:
        if c == text_col:
            out.append(F.col(text).alias(c))
        elif c == n_chars:
            out.append(F.char_length(text).cast("long").alias(c))
        else:
            out.append(F.col("row").getField(c).alias(c))
    return df.select(*out)
