"""Reproducible splits and folds.

Samples, splits, folds and imputations draw under names of their own, so that taking one
after another with the same seed keeps them independent. Splitting a part again needs
another seed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prepkit.functions.chance import unit
from prepkit.operators.ranking import hash_blocks, smallest_marked


def random_split(
    df: DataFrame, weights: Sequence[float], key: str | Sequence[str], seed: int = 42
) -> list[DataFrame]:
    """Disjoint parts of about the given shares; a row's part depends on its key only."""
    total = float(sum(weights))
    draw = unit(key, f"split {seed}")
    parts, start = [], 0.0
    for i, w in enumerate(weights):
        end = start + w / total
        test = draw >= F.lit(start)
        parts.append(df.where(test if i == len(weights) - 1 else test & (draw < F.lit(end))))
        start = end
    return parts


def with_part(
    df: DataFrame, label: str, key: str | Sequence[str], fraction: float = 0.1, seed: int = 42, name: str = "part"
) -> DataFrame:
    """Add ``part``: exactly round-half-even(n * fraction) rows of each label are ``test``, the others ``train``."""
    quota = F.bround(F.col("n") * F.lit(float(fraction)), 0)
    marked = smallest_marked(df, [label], quota, key, f"split {seed}", name="_test")
    return marked.withColumn(name, F.when(F.col("_test"), "test").otherwise("train")).drop("_test")


def stratified_split(
    df: DataFrame, label: str, key: str | Sequence[str], fraction: float = 0.1, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Train and test part with the labels in equal shares."""
    marked = with_part(df, label, key, fraction, seed, name="_part")
    return marked.where("_part = 'train'").drop("_part"), marked.where("_part = 'test'").drop("_part")


def with_folds(
    df: DataFrame, key: str | Sequence[str], folds: int = 5, label: str | None = None, seed: int = 42,
    name: str = "fold",
) -> DataFrame:
    """Add a fold number from 0; with a label, folds differ by at most one row of each label."""
    if label is None:
        return df.withColumn(name, F.floor(unit(key, f"fold {seed}") * folds).cast("int"))
    ends = [F.ceil(F.col("n") * i / folds) for i in range(1, folds)]
    return hash_blocks(df, [label], ends, key, f"fold {seed}", name)
