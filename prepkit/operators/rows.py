"""Keeping, masking, deduplicating and sampling rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prepkit.functions.cells import inside, missing_share
from prepkit.functions.chance import unit
from prepkit.operators.columns import columns_of, nan_to_null
from prepkit.operators.lookup import bounded
from prepkit.operators.profile import missing_totals, quantiles
from prepkit.operators.ranking import smallest_marked

Range = tuple[float | None, float | None]


def in_ranges(df: DataFrame, ranges: Mapping[str, Range]) -> DataFrame:
    """Rows whose cells lie in all given ranges, ends included."""
    return df.where(reduce(lambda a, b: a & b, [inside(c, lo, hi) for c, (lo, hi) in ranges.items()]))


def matching(df: DataFrame, **values: Any) -> DataFrame:
    """Rows whose cells equal all given values."""
    return df.where(reduce(lambda a, b: a & b, [F.col(c) == F.lit(v) for c, v in values.items()]))


def split_by_null_pattern(
    df: DataFrame, first: str, second: str, names: tuple[str, str, str], name: str = "type", fill: float = 0.0
) -> DataFrame:
    """Tag rows by which of two cells they have (both, only first, only second) and fill the gap.

    Rows with neither are left out.
    """
    df = nan_to_null(df)
    both, only_first, only_second = names
    label = (
        F.when(F.col(first).isNotNull() & F.col(second).isNotNull(), both)
        .when(F.col(first).isNotNull(), only_first)
        .when(F.col(second).isNotNull(), only_second)
    )
    kept = df.withColumn(name, label).where(F.col(name).isNotNull())
    return kept.fillna(fill, [first, second])


def drop_sparse_rows(df: DataFrame, threshold: float = 0.9, inclusive: bool = False) -> DataFrame:
    """Rows whose share of missing cells is below the threshold, or at it when ``inclusive``."""
    df = nan_to_null(df)
    share = missing_share(df.columns, columns_of(df, "float"))
    return df.where(share <= threshold if inclusive else share < threshold)


def drop_nulls(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.dropna(subset=list(subset) if subset else None)


def drop_null_columns(df: DataFrame) -> DataFrame:
    """Drop every column that holds a missing cell; one job finds them all."""
    gaps = missing_totals(df)
    return df.drop(*[c for c, n in gaps.items() if n])


def mask(df: DataFrame, columns: Sequence[str], test: Callable[[Column], Column]) -> DataFrame:
    """Cells failing the test become NULL, NaN too; the rows stay."""
    df = nan_to_null(df)
    chosen = set(columns)
    return df.select(*[F.when(test(F.col(c)), F.col(c)).alias(c) if c in chosen else F.col(c) for c in df.columns])


def fit_iqr(df: DataFrame, columns: Sequence[str], k: float = 1.5) -> dict[str, tuple[float, float]]:
    """Per column the fences Q1 - k*IQR and Q3 + k*IQR."""
    found = quantiles(df, columns, [0.25, 0.75])
    return {c: (q1 - k * (q3 - q1), q3 + k * (q3 - q1)) for c, (q1, q3) in found.items() if q1 is not None}


def iqr_mask(df: DataFrame, columns: Sequence[str], k: float = 1.5) -> DataFrame:
    """Cells outside the column's fences become NULL, NaN too."""
    df = nan_to_null(df)
    fences = fit_iqr(df, columns, k)
    masked = [F.when(F.col(c).between(*fences[c]), F.col(c)).alias(c) if c in fences else F.col(c) for c in df.columns]
    return df.select(*masked)


def zscore_filter(
    df: DataFrame, columns: Sequence[str], k: float = 3.0, tolerance: float = 0.01, mode: str = "simultaneous"
) -> DataFrame:
    """Rows within ``k`` sample deviations of the mean, columns of no spread skipped; a missing cell is within none.

    ``simultaneous`` takes all figures from the given rows in one job. ``sequential``
    takes those of a column from the rows the columns before it left, one job each; the
    earlier filters are literals, so each job is a pruned scan and nothing is cached.
    """

    def passing(frame: DataFrame, chosen: Sequence[str]) -> DataFrame:
        figures = frame.agg(
            *[F.avg(c).alias(f"{c} mean") for c in chosen], *[F.stddev_samp(c).alias(f"{c} std") for c in chosen]
        ).first()
        for c in chosen:
            mean, std = figures[f"{c} mean"], figures[f"{c} std"]
            if std:
                frame = frame.where(F.abs(F.col(c) - F.lit(mean)) / F.lit(std) - F.lit(float(k)) < F.lit(tolerance))
        return frame

    df = nan_to_null(df)
    if mode == "simultaneous":
        return passing(df, columns)
    if mode != "sequential":
        raise ValueError(f"unknown mode: {mode}")
    return reduce(lambda frame, c: passing(frame, [c]), columns, df)


def group_sizes(df: DataFrame, by: Sequence[str], at_least: int = 1) -> DataFrame:
    """Group columns and ``n`` for groups of at least that many rows."""
    return df.groupBy(*by).agg(F.count("*").alias("n")).where(F.col("n") >= at_least)


def rows_in_large_groups(df: DataFrame, by: Sequence[str], at_least: int) -> DataFrame:
    """Rows of the groups that have at least that many."""
    large = bounded(group_sizes(df, by, at_least).select(*[F.col(c).alias(f"_{c}") for c in by]))
    same = reduce(lambda a, b: a & b, [df[c].eqNullSafe(large[f"_{c}"]) for c in by])
    return df.join(large, same, "left_semi")


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()


def first_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Per key the row that comes first in ``order``.

    An aggregate, not a window: each task keeps one row per key before the shuffle, so a
    key holding a large part of the rows sends one row per task.
    """
    rest = [c for c in df.columns if c not in key]
    first = df.groupBy(*key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return first.select(*key, "_row.*").select(*df.columns)


def sample_fraction(df: DataFrame, fraction: float, key: str | Sequence[str], seed: int = 42) -> DataFrame:
    """About that share of the rows, the same ones on every run."""
    return df.where(unit(key, f"sample {seed}") < F.lit(fraction))


def sample_per_group(df: DataFrame, by: Sequence[str], n: int, key: str | Sequence[str], seed: int = 42) -> DataFrame:
    """``n`` rows of each group (all of a smaller one), the same ones on every run."""
    return smallest_marked(df, by, F.lit(n), key, f"sample {seed}", name="_picked").where("_picked").drop("_picked")


def union_by_name(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All rows of all tables; columns a table lacks are NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), others, first)


def top_rows(df: DataFrame, order: str, n: int = 1, tie: Sequence[str] = ()) -> DataFrame:
    """The ``n`` rows with the largest ``order`` value, a missing one last, ties settled by ``tie`` ascending."""
    return nan_to_null(df).orderBy(F.col(order).desc_nulls_last(), *tie).limit(n)


def first_rows(df: DataFrame, n: int, order: Sequence[str] = ()) -> DataFrame:
    """A preview of ``n`` rows, repeatable when ``order`` names a key."""
    return (df.orderBy(*order) if order else df).limit(n)
