"""Correlations of very many columns, gaps and all, from one pass of matrix products.

With a mask of the cells that are there, the counts, sums and products of every pair over the rows where both are there
are four products of matrices. A task multiplies batches of rows and keeps one square of sums; squares are added up pair
by pair. One expression for each pair, as for a few columns, would stop compiling at some hundred columns.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prepkit.operators.columns import nan_to_null

#: Rows looked at for a number to take off each column, so that sums of squares stay small beside the spread.
PEEK = 1000
SUMS = ("n", "sx", "sy", "sxx", "syy", "sxy")


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    """The batch's columns as doubles, NaN where a cell is missing."""
    return np.column_stack([c.to_numpy(zero_copy_only=False).astype(np.float64) for c in batch.columns])


def _sums(shift: list[float]):
    off = np.array(shift)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = len(off)
        total = np.zeros((4, c, c))
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch) - off
            there = (~np.isnan(x)).astype(np.float64)
            x = np.nan_to_num(x, nan=0.0, posinf=np.inf, neginf=-np.inf)
            total += (there.T @ there, x.T @ there, (x * x).T @ there, x.T @ x)
        i, j = np.triu_indices(c, 1)
        n, s, q, p = total
        columns = [i.astype(np.int32), j.astype(np.int32), n[i, j], s[i, j], s[j, i], q[i, j], q[j, i], p[i, j]]
        yield pa.RecordBatch.from_arrays([pa.array(v) for v in columns], ["i", "j", *SUMS])

    return run


def gram_correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``col_a, col_b, r, n`` for each two of the columns, over the rows where neither is missing (NULL or NaN).

    ``r`` is NULL without two such rows or without spread. What a task hands on is sized by the columns alone.
    """
    cells = nan_to_null(df.select(*[F.col(c).cast("double").alias(c) for c in columns]))
    peek = cells.limit(PEEK).agg(*[F.avg(c) for c in columns]).first()
    kinds = "i int, j int, " + ", ".join(f"{c} double" for c in SUMS)
    sums = cells.mapInArrow(_sums([v or 0.0 for v in peek]), kinds).groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in SUMS])
    left = F.col("n") * F.col("sxx") - F.col("sx") * F.col("sx")
    right = F.col("n") * F.col("syy") - F.col("sy") * F.col("sy")
    both = F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy")
    # spread that is only the rounding of sums is none
    some = (left > 1e-12 * F.col("n") * F.col("sxx")) & (right > 1e-12 * F.col("n") * F.col("syy"))
    r = F.when(some, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.try_divide(both, F.sqrt(left) * F.sqrt(right)))))
    names = F.lit(list(columns))
    return sums.select(
        F.get(names, F.col("i")).alias("col_a"), F.get(names, F.col("j")).alias("col_b"), r.alias("r"), F.col("n").cast("bigint").alias("n")
    )
