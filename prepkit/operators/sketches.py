"""Figures that need not read old data again: sketches stored by part, and merged.

A part is a day's files, a source, a load. Its sketch is a row for each column: exact counts, sums and extremes, a
HyperLogLog sketch of the distinct values and a KLL sketch of the quantiles. Sketches of parts merge into that of all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prepkit.operators.columns import nan_to_null

#: Sizes of the sketches, as powers and numbers their functions take. Distinct counts are off by about
#: 1.04 / sqrt(2^HLL_BITS); the rank of a quantile by under 1 %, nearly always.
HLL_BITS, KLL_SIZE = 12, 400
DISTINCT_ERROR, RANK_ERROR = 0.05, 0.01


def sketched(df: DataFrame, columns: Sequence[str], part: Column | str = "") -> DataFrame:
    """``part, column, n, n_missing, total, least, most, distinct, quantiles`` of number columns; one pass.

    ``part`` names the part, or is a column that holds it. Missing cells (NULL and NaN) are counted and left out; a column
    without values has sketches of nothing, and an empty table a row for each column only if ``part`` is a name.
    """
    chosen = F.lit(part) if isinstance(part, str) else part
    cells = nan_to_null(df.select(chosen.cast("string").alias("_part"), *[F.col(c).cast("double").alias(c) for c in columns]))
    figures = []
    for c in columns:
        figures.append(F.struct(
            F.lit(c).alias("column"), F.count(c).alias("n"), F.count_if(F.col(c).isNull()).alias("n_missing"), F.sum(c).alias("total"),
            F.min(c).alias("least"), F.max(c).alias("most"),
            # a long that tells doubles apart, as this sketch takes no doubles
            F.hll_sketch_agg(F.when(F.col(c).isNotNull(), F.xxhash64(F.col(c) + 0.0)), HLL_BITS).alias("distinct"),
            F.kll_sketch_agg_double(F.col(c), F.lit(KLL_SIZE)).alias("quantiles"),
        ))
    every = F.array(*figures).alias("f")
    grouped = cells.agg(F.lit(part).alias("_part"), every) if isinstance(part, str) else cells.groupBy("_part").agg(every)
    return grouped.select(F.col("_part").alias("part"), F.inline("f"))


def merged(sketches: DataFrame, name: str = "") -> DataFrame:
    """The sketches of all parts as those of one part ``name``; merging merged ones again changes nothing but the name."""
    return sketches.groupBy("column").agg(
        F.sum("n").alias("n"), F.sum("n_missing").alias("n_missing"), F.sum("total").alias("total"), F.min("least").alias("least"),
        F.max("most").alias("most"), F.hll_union_agg("distinct").alias("distinct"), F.kll_merge_agg_double("quantiles").alias("quantiles"),
    ).select(F.lit(name).alias("part"), "column", "n", "n_missing", "total", "least", "most", "distinct", "quantiles")


def estimates(sketches: DataFrame, probs: Sequence[float]) -> DataFrame:
    """``part, column, n, n_missing, mean, least, most, n_distinct`` and ``quantiles``, an array of (prob, value).

    Counts, means and extremes are exact; distinct values and quantiles are within the errors named above.
    """
    asked = [float(p) for p in probs]
    quantile = F.arrays_zip(F.lit(asked).alias("prob"), F.kll_sketch_get_quantile_double("quantiles", F.lit(asked)).alias("value"))
    return sketches.select(
        "part", "column", "n", "n_missing", F.try_divide("total", "n").alias("mean"), "least", "most",
        F.hll_sketch_estimate("distinct").alias("n_distinct"), F.when(F.col("n") > 0, quantile).alias("quantiles"),
    )


def rank_share(sketches: DataFrame, value: Column) -> DataFrame:
    """``part, column, share``: about which share of the values is at most ``value``."""
    return sketches.select("part", "column", F.when(F.col("n") > 0, F.kll_sketch_get_rank_double("quantiles", value)).alias("share"))
