"""Accuracy of scaled, feature-engineered models, plain and under perturbed inputs."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from statistics import NormalDist

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prepkit.functions.chance import gaussian
from prepkit.operators.columns import with_pairwise_max, with_pairwise_products
from prepkit.operators.scale import Scaling, apply_minmax, assemble, fit_minmax
from prepkit.operators.split import random_split
from prepkit.sources.frozen import frozen

VARIANTS = ("plain", "product", "max")


def engineered(df: DataFrame, columns: Sequence[str], variant: str) -> DataFrame:
    """Features of a variant, made from raw columns: none, pair products, or pair maxima."""
    if variant == "product":
        return with_pairwise_products(df, columns, joiner="*")
    if variant == "max":
        return with_pairwise_max(df, columns)
    return df


@dataclass(frozen=True)
class ScaledModel:
    """A classifier with the variant and the scaling its features need."""

    columns: tuple[str, ...]
    variant: str
    label: str
    scalings: tuple[Scaling, ...]
    model: LogisticRegressionModel

    def predict(self, df: DataFrame) -> DataFrame:
        """Derive from raw columns, scale with the training parameters, predict."""
        scaled = apply_minmax(engineered(df, self.columns, self.variant), self.scalings)
        return self.model.transform(assemble([s.name for s in self.scalings]).transform(scaled))


def train_variant(df: DataFrame, columns: Sequence[str], label: str, variant: str = "plain") -> ScaledModel:
    """Derive features from raw columns, fit the scaling on these rows, train."""
    made = engineered(df, columns, variant)
    names = [*columns, *[c for c in made.columns if c not in df.columns]]
    scalings = fit_minmax(made, names)
    vectors = assemble([s.name for s in scalings]).transform(apply_minmax(made, scalings))
    rows = frozen(vectors.select("features", label), "training")
    # a penalty of half the squared weights against the summed loss, on the scaled features as they are
    penalty = 1.0 / max(rows.count(), 1)
    estimator = LogisticRegression(featuresCol="features", labelCol=label, regParam=penalty, standardization=False)
    model = estimator.fit(rows)
    return ScaledModel(tuple(columns), variant, label, tuple(scalings), model)


def accuracy(model: ScaledModel, df: DataFrame) -> float | None:
    hit = (F.col("prediction") == F.col(model.label)).cast("double")
    return model.predict(df).agg(F.avg(hit)).first()[0]


def validation_accuracy(
    df: DataFrame, columns: Sequence[str], label: str, key: str | Sequence[str], variant: str = "plain",
    ratio: float = 0.2, seed: int = 42,
) -> float | None:
    """Accuracy on a held-out share, the scaling fitted on the rest only."""
    # one seed further than the caller's, whose rows may be a part drawn with that seed
    fit_part, held = random_split(df, [1.0 - ratio, ratio], key, seed + 1)
    return accuracy(train_variant(fit_part, columns, label, variant), held)


def perturbed(df: DataFrame, columns: Sequence[str], key: str, std: float, trials: int, seed: int = 42) -> DataFrame:
    """Every row once per trial with N(0, std) noise on its columns; the noise is fixed by key, trial and column."""
    numbered = df.withColumn("trial", F.explode(F.sequence(F.lit(1), F.lit(trials))))
    chosen = set(columns)
    return numbered.select(*[
        (F.col(c) + gaussian([key, "trial"], f"{seed}{c}", std)).alias(c) if c in chosen else F.col(c)
        for c in numbered.columns
    ])


def robustness(
    model: ScaledModel, df: DataFrame, key: str, std: float = 1.2, trials: int = 50, confidence: float = 0.95,
    seed: int = 42,
) -> DataFrame:
    """``trials, plain_accuracy, mean_accuracy, ci_lo, ci_hi`` over perturbed copies of the rows.

    All trials are one job, and only counts are shuffled.
    """
    noisy = model.predict(perturbed(df, model.columns, key, std, trials, seed))
    hit = (F.col("prediction") == F.col(model.label)).cast("double")
    per_trial = noisy.groupBy("trial").agg(F.avg(hit).alias("accuracy"))
    z = NormalDist().inv_cdf(0.5 + confidence / 2.0)
    row = per_trial.agg(
        F.count("*").cast("int").alias("trials"), F.avg("accuracy").alias("mean_accuracy"),
        F.stddev_pop("accuracy").alias("_std"),
    )
    half = F.lit(z) * F.col("_std") / F.lit(math.sqrt(trials))
    return row.select(
        "trials",
        F.lit(accuracy(model, df)).alias("plain_accuracy"),
        "mean_accuracy",
        (F.col("mean_accuracy") - half).alias("ci_lo"),
        (F.col("mean_accuracy") + half).alias("ci_hi"),
    )
