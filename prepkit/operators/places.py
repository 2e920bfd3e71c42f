"""Rows by place: consecutive numbers without a window over all rows, tables side by side, the first rows of files.

Numbers come from counts: of the ranges that a sort leaves, or of the splits that files are read in. Only these counts
are summed up in one place; a row's number is its part's start plus its place there.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from prepkit.operators.lookup import bounded
from prepkit.sources.frozen import frozen

# The columns giving the reading order of a file's rows, as `readers.ingest_folder` and `readers.read_placed` add them.
READING_ORDER = ("src_rank", "src_file", "src_block", "src_row")


def _starts(parts: DataFrame, order: Sequence[str]) -> DataFrame:
    """Parts (one row each, with ``_size``) with ``_start``, the rows of the parts before."""
    earlier = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return parts.withColumn("_start", F.coalesce(F.sum("_size").over(earlier), F.lit(0)))


def numbered(df: DataFrame, order: str | Sequence[str], name: str = "place") -> DataFrame:
    """Add ``name``, 0, 1, 2 and so on in the order of the columns, NULL first.

    Rows are sorted in ranges and written with the range they fell in; of the ranges only sizes are summed. Rows that tie
    are numbered in any order, once for all, and spread over ranges like others, so a common value fills no task.
    """
    keys = [order] if isinstance(order, str) else list(order)
    tied = frozen(df.withColumn("_tie", F.monotonically_increasing_id()), "ties")
    ranged = tied.repartitionByRange(*keys, "_tie").sortWithinPartitions(*keys, "_tie").drop("_tie")
    # the number's high bits are those of the range, its low ones the place there
    kept = frozen(ranged.withColumn("_at", F.monotonically_increasing_id()), "numbered").withColumn("_range", F.shiftright("_at", 33))
    sizes = kept.groupBy(F.col("_range").alias("_in")).agg(F.count("*").alias("_size"))
    starts = bounded(_starts(sizes, ["_in"]))
    inside = F.col("_at") - F.shiftleft(F.col("_range"), 33)
    return kept.join(starts, kept["_range"] == starts["_in"]).withColumn(name, F.col("_start") + inside).select(*df.columns, name)


def read_places(df: DataFrame, name: str = "place") -> DataFrame:
    """Add ``name``, the place of each row in the files read: format, file name, place of the split, place in the split.

    ``df`` holds the columns of READING_ORDER as they were read. Splits are counted and their sizes summed; no row is
    shuffled unless there are very many splits. Files are read twice; should Spark cut them otherwise the second time,
    as it may after losing cores, the job fails and numbers nothing wrong.
    """
    split = [c for c in READING_ORDER if c != "src_row"]
    sizes = df.groupBy(*[F.col(c).alias(f"_{c}") for c in split]).agg(F.count("*").alias("_size"), F.min("src_row").alias("_first"))
    starts = bounded(_starts(sizes, [f"_{c}" for c in split]))
    joined = df.join(starts, [df[c] == starts[f"_{c}"] for c in split], "left")
    cut = F.raise_error(F.lit("files were cut into other splits between two reads")).cast("bigint")
    inside = F.col("src_row") - F.col("_first")
    good = (inside >= 0) & (inside < F.col("_size"))
    return joined.withColumn(name, F.when(good, F.col("_start") + inside).otherwise(cut)).select(*df.columns, name)


def side_by_side(left: DataFrame, right: DataFrame, left_order: str | Sequence[str], right_order: str | Sequence[str],
                 name: str = "place", suffix: str | None = None) -> DataFrame:
    """``name`` and the columns of two tables, the first row beside the first, the second beside the second and so on.

    Each is numbered by its own order. The longer table's last rows stand beside missing cells. Of a name both have, the
    left column is kept, and with ``suffix`` the right one too, under its name with the suffix.
    """
    shared = set(left.columns)
    named = {c: c if c not in shared else None if suffix is None else c + suffix for c in right.columns}
    one = numbered(left, left_order, "_left")
    other = numbered(right, right_order, "_right").select("_right", *[F.col(c).alias(n) for c, n in named.items() if n])
    joined = one.join(other, one["_left"] == other["_right"], "full_outer")
    return joined.select(F.coalesce("_left", "_right").alias(name), *left.columns, *[n for n in named.values() if n])


def first_read(df: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows of the files read, in any order; ``df`` holds the columns of READING_ORDER, which go."""
    placed = read_places(df, "_place")
    return placed.where(F.col("_place") < n).drop("_place", *READING_ORDER)


def reading_order(rank: int = 0) -> list[Column]:
    """The columns of READING_ORDER for a frame that has the hidden ``_metadata`` of its files."""
    return [
        F.lit(rank).alias("src_rank"), F.col("_metadata.file_path").alias("src_file"),
        F.col("_metadata.file_block_start").alias("src_block"), F.monotonically_increasing_id().alias("src_row"),
    ]
