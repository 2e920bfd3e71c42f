"""Filling gaps. A fit returns plain values, one per column; applying them is a projection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.ml import Pipeline
from pyspark.ml.feature import Imputer, StringIndexer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prepkit.functions.cells import Bracket, bracket, column, valid_cell
from prepkit.functions.chance import unit
from prepkit.operators.columns import nan_to_null
from prepkit.operators.profile import mean_std, modes
from prepkit.operators.ranking import smallest_marked

Values = dict[str, Any]


def _typed(df: DataFrame, c: str, text: str) -> Any:
    """A mode carried as text, back in its column's type."""
    kind = df.schema[c].dataType
    if isinstance(kind, T.IntegralType):
        return int(text)
    if isinstance(kind, T.DecimalType):
        return F.lit(text).cast(kind)
    if isinstance(kind, T.NumericType):
        return float(text)
    return text


def fit_means(df: DataFrame, columns: Sequence[str], ranges: Mapping[str, Any] | None = None) -> Values:
    """Mean per column, over the valid cells where a range is given; one job."""
    found = mean_std(df, columns, ranges).collect()
    return {r["column"]: r["mean"] for r in found if r["mean"] is not None}


def fit_modes(df: DataFrame, columns: Sequence[str], ranges: Mapping[str, Any] | None = None) -> Values:
    """Mode per column (non-null, the smallest on a tie), over valid cells where a range is given."""
    return {r["column"]: _typed(df, r["column"], r["mode"]) for r in modes(df, columns, ranges).collect()}


def fill(df: DataFrame, values: Mapping[str, Any]) -> DataFrame:
    """Put the column's value into its gaps, NaN among them; integer columns filled by a mean become double."""
    cells = nan_to_null(df)
    return cells.select(*[
        F.coalesce(F.col(c), F.lit(values[c])).alias(c) if c in values else F.col(c) for c in df.columns
    ])


def repair(df: DataFrame, values: Mapping[str, Any], ranges: Mapping[str, Any]) -> DataFrame:
    """Put the column's value into its gaps and over cells outside the column's range."""
    return nan_to_null(df).select(*[
        F.coalesce(valid_cell(c, ranges), F.lit(values[c])).alias(c) if c in values else F.col(c) for c in df.columns
    ])


def mean_fill(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return fill(df, fit_means(df, columns))


def mode_fill(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return fill(df, fit_modes(df, columns))


def guarded_mean_repair(df: DataFrame, ranges: Mapping[str, Any]) -> DataFrame:
    """Gaps and out-of-range cells take the mean of the in-range ones."""
    return repair(df, fit_means(df, list(ranges), ranges), ranges)


def guarded_mode_repair(df: DataFrame, ranges: Mapping[str, Any]) -> DataFrame:
    """Gaps and out-of-range cells take the mode of the in-range ones."""
    return repair(df, fit_modes(df, list(ranges), ranges), ranges)


def smoking_chance(
    sex: str | Column,
    age: str | Column,
    coarse: Sequence[Bracket],
    coarse_rates: Mapping[str, float],
    fine: Sequence[Bracket],
    fine_rates: Mapping[str, float],
    sex_rates: Mapping[str, float],
    male: Any = "male",
    fallback: float = 0.0,
) -> Column:
    """Chance from two rate sources, the larger one counting.

    The coarse source is scaled by the male to female ratio for men. A missing bracket
    counts 0 in its source; a missing age takes ``fallback``.
    """
    def rate(brackets: Sequence[Bracket], rates: Mapping[str, float]) -> Column:
        return F.coalesce(bracket(age, [(lo, hi, float(rates.get(b, 0.0))) for lo, hi, b in brackets]), F.lit(0.0))

    ratio = sex_rates.get("male", 0.0) / sex_rates.get("female", 1.0)
    scaled = rate(coarse, coarse_rates) * F.when(column(sex) == F.lit(male), F.lit(ratio)).otherwise(F.lit(1.0))
    chance = F.greatest(scaled, rate(fine, fine_rates))
    return F.when(column(age).isNull(), F.lit(float(fallback))).otherwise(chance)


def bernoulli_impute(
    df: DataFrame, target: str, chance: Column, key: str | Sequence[str], seed: int = 42
) -> DataFrame:
    """Gaps become 1 with the row's chance, else 0; the draw is fixed by the row's key."""
    df = nan_to_null(df)
    drawn = (unit(key, f"impute {seed}") < chance).cast("int").cast(df.schema[target].dataType)
    return df.withColumn(target, F.coalesce(F.col(target), drawn, F.lit(0).cast(df.schema[target].dataType)))


def quota_impute(
    df: DataFrame, target: str, by: Sequence[str], chance: str, key: str | Sequence[str], seed: int = 42
) -> DataFrame:
    """Of a group's gaps exactly round-half-even(gaps * chance) become 1, the others 0.

    ``chance`` is a column constant within a group. A group without a chance (no
    bracket) keeps its gaps. Which gaps become 1 is drawn by the row's key.
    """
    df = nan_to_null(df)
    open_ = F.col(target).isNull() & F.col(chance).isNotNull()
    kind = df.schema[target].dataType
    quota = F.bround(F.col("n") * F.col(chance), 0)
    drawn = smallest_marked(df.where(open_), [*by, chance], quota, key, f"impute {seed}", name="_one")
    filled = drawn.withColumn(target, F.col("_one").cast("int").cast(kind)).drop("_one")
    return df.where(~open_).unionByName(filled)


def rate_by_bracket(value: str | Column, brackets: Sequence[Bracket], rates: Mapping[str, float],
                    factor: Column | float = 1.0) -> Column:
    """A rate per bracket label as a column, NULL outside all brackets, times ``factor``."""
    plain = bracket(value, [(lo, hi, float(rates[b])) for lo, hi, b in brackets if b in rates])
    return plain * (factor if isinstance(factor, Column) else F.lit(float(factor)))


def wide_columns(df: DataFrame, strings: Sequence[str], limit: int = 10_000) -> list[str]:
    """The string columns with more values than an index that the driver and the model hold should have.

    One approximate pass over all columns; within its error, a column near the limit may go either way. Such columns are
    for ``scale.frequency_index``, which holds no list of values anywhere.
    """
    if not strings:
        return []
    found = df.agg(*[F.approx_count_distinct(c).alias(c) for c in strings]).first()
    return [c for c in strings if found[c] > limit]


def index_and_impute(numeric: Sequence[str], strings: Sequence[str]) -> Pipeline:
    """ML stages: mean-filled numbers as ``Imputed{c}``, mode-filled indexes as ``Imputed{c}Index``.

    Indexing keeps missing and unseen strings as an extra category; ``KeptIndexImputer``
    then puts the most frequent index in its place.
    """
    from prepkit.plans.stages import KeptIndexImputer

    stages: list[Any] = []
    if strings:
        indexed = [f"{c}Index" for c in strings]
        stages.append(StringIndexer(inputCols=list(strings), outputCols=indexed, handleInvalid="keep"))
        stages.append(KeptIndexImputer(inputCols=indexed, outputCols=[f"Imputed{c}" for c in indexed]))
    if numeric:
        stages.append(Imputer(inputCols=list(numeric), outputCols=[f"Imputed{c}" for c in numeric], strategy="mean"))
    return Pipeline(stages=stages)
