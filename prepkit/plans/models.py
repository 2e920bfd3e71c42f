"""Training and choosing classifiers with ``pyspark.ml``.

Scalers and imputers are pipeline stages, so cross-validation fits them on the training
folds only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from itertools import combinations
from typing import Any

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import StandardScaler
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prepkit.operators.impute import index_and_impute
from prepkit.operators.lookup import bounded
from prepkit.operators.rows import union_by_name
from prepkit.operators.scale import assemble
from prepkit.operators.split import with_folds
from prepkit.plans.scoring import classification_scores, metrics_table
from prepkit.plans.stages import FourierFeatures, PairwiseMax, PairwiseProduct, SquareProduct, scale_gamma
from prepkit.sources.frozen import frozen

# The parameter grids of the heart-disease and passenger models.
GRIDS: dict[str, dict[str, list[Any]]] = {
    "Random Forest": {"maxDepth": [5, 10], "numTrees": [20, 50]},
    "Logistic Regression": {"regParam": [0.01, 0.1], "elasticNetParam": [0.0, 0.5, 1.0]},
    "Decision Tree": {"maxDepth": [5, 10]},
    "Gradient Boosting": {"maxDepth": [5, 10], "maxIter": [10, 20]},
}
WIDE_GRIDS: dict[str, dict[str, list[Any]]] = {
    "Random Forest": {"numTrees": [100, 300, 500], "maxDepth": [5, 10, 30]},
    "Logistic Regression": {"inverse_penalty": [0.01, 0.1, 1.0, 10.0]},
    "Decision Tree": {"impurity": ["gini", "entropy"], "maxDepth": [30, 2, 5, 10], "minInstancesPerNode": [1, 2, 5]},
    "Gradient Boosting": {"maxIter": [100, 200], "stepSize": [0.01, 0.1], "maxDepth": [3, 5]},
}
FOREST_GRID: dict[str, list[Any]] = {"maxDepth": [2, 4, 6, 8, 10], "numTrees": [10, 20, 30, 50, 80]}


def wide_grid(name: str, n_rows: int) -> dict[str, list[Any]]:
    """A wide grid in Spark's parameters; an inverse penalty C on summed losses is regParam 1 / (C * rows)."""
    grid = dict(WIDE_GRIDS[name])
    inverse = grid.pop("inverse_penalty", None)
    return grid if inverse is None else {**grid, "regParam": [1.0 / (c * n_rows) for c in inverse]}


def classifier(name: str, label: str, features: str = "features", seed: int = 42, **params: Any) -> Estimator:
    """A classifier by its report name."""
    columns = {"labelCol": label, "featuresCol": features}
    if name == "Logistic Regression":
        return LogisticRegression(**columns, **{"maxIter": 100, **params})
    if name == "Linear SVM":
        return LinearSVC(**columns, **{"maxIter": 100, **params})
    if name == "Decision Tree":
        return DecisionTreeClassifier(**columns, **{"seed": seed, **params})
    if name == "Random Forest":
        return RandomForestClassifier(**columns, **{"seed": seed, **params})
    if name == "Gradient Boosting":
        return GBTClassifier(**columns, **{"seed": seed, **params})
    raise ValueError(f"unknown classifier: {name}")


def with_balance(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Add weights that give every class the same total: rows / (classes * class rows)."""
    counts = df.groupBy(label).agg(F.count("*").alias("_n"))
    whole = counts.agg(F.sum("_n").alias("rows"), F.count("*").alias("classes")).first()
    side = bounded(counts).withColumnRenamed(label, "_label")
    joined = df.join(side, df[label] == side["_label"])
    weight = F.lit(float(whole["rows"])) / (F.lit(float(whole["classes"])) * F.col("_n"))
    return joined.withColumn(name, weight).drop("_label", "_n")


def derived_names(columns: Sequence[str], squares: bool, products: bool, maxima: bool) -> list[str]:
    names = [f"{c}_2" for c in columns] if squares else []
    pairs = list(combinations(columns, 2))
    names += [f"{a}_{b}" for a, b in pairs] if products else []
    return names + ([f"max_{a}_{b}" for a, b in pairs] if maxima else [])


def feature_stages(
    columns: Sequence[str], squares: bool = False, products: bool = False, maxima: bool = False,
    scale: bool = True, centre: bool = False, extra: Sequence[str] = (),
) -> list[Any]:
    """Derived columns, one vector of all of them, and standardising; output ``features``."""
    flat = [c for pair in combinations(columns, 2) for c in pair]
    stages: list[Any] = []
    if squares:
        stages.append(SquareProduct(inputCols=list(columns), outputCols=derived_names(columns, True, False, False)))
    if products and flat:
        stages.append(PairwiseProduct(inputCols=flat, outputCols=derived_names(columns, False, True, False)))
    if maxima and flat:
        stages.append(PairwiseMax(inputCols=flat, outputCols=derived_names(columns, False, False, True)))
    chosen = [*derived_names(columns, squares, products, maxima), *columns, *extra]
    if not scale:
        return [*stages, assemble(chosen)]
    scaler = StandardScaler(inputCol="raw_features", outputCol="features", withStd=True, withMean=centre)
    return [*stages, assemble(chosen, "raw_features"), scaler]


def kernel_stages(columns: Sequence[str], gamma: float, n_features: int = 256, seed: int = 42) -> list[Any]:
    """Features under which a linear machine is one with a Gaussian kernel; ``stages.scale_gamma`` proposes a gamma."""
    return [FourierFeatures(inputCols=list(columns), outputCol="features", numFeatures=n_features, gamma=gamma, seed=seed)]


def fitted_kernel_stages(df: DataFrame, columns: Sequence[str], squares: bool = False, n_features: int = 256) -> list[Any]:
    """Kernel features of the columns, and of their squares, with the gamma that fits their spread in ``df``."""
    names = [*derived_names(columns, squares, False, False), *columns]
    made = [SquareProduct(inputCols=list(columns), outputCols=derived_names(columns, True, False, False))] if squares else []
    whole = made[0].transform(df) if made else df
    return [*made, *kernel_stages(names, scale_gamma(whole, names), n_features)]


def passenger_stages(numeric: Sequence[str], strings: Sequence[str]) -> list[Any]:
    """Index, impute, multiply and square, then assemble everything made."""
    filled = [f"Imputed{c}" for c in numeric]
    coded = [f"Imputed{c}Index" for c in strings]
    prepared = index_and_impute(numeric, strings).getStages()
    return [*prepared, *feature_stages(filled, squares=True, products=True, scale=False, extra=coded)]


def train(df: DataFrame, stages: Sequence[Any], model: Estimator) -> PipelineModel:
    return Pipeline(stages=[*stages, model]).fit(df)


def grid_of(model: Estimator, grid: Mapping[str, Sequence[Any]]) -> list[dict]:
    builder = ParamGridBuilder()
    for param, values in grid.items():
        builder = builder.addGrid(model.getParam(param), list(values))
    return builder.build()


@dataclass(frozen=True)
class Search:
    """What a grid search found."""

    model: CrossValidatorModel
    params: dict[str, Any]
    score: float

    def transform(self, df: DataFrame) -> DataFrame:
        return self.model.transform(df)


def grid_search(
    df: DataFrame,
    stages: Sequence[Any],
    model: Estimator,
    grid: Mapping[str, Sequence[Any]],
    key: str | Sequence[str],
    metric: str = "f1",
    folds: int = 5,
    stratify: bool = True,
    parallelism: int = 4,
    seed: int = 42,
) -> Search:
    """Cross-validate a grid, refit the best setting on all rows.

    ``metric`` is areaUnderROC, positive_f1 (that of class 1), or one of the multiclass
    evaluator's. Folds depend on the rows' keys, balanced by label when ``stratify``.
    """
    label = model.getLabelCol()
    if metric == "areaUnderROC":
        evaluator: Any = BinaryClassificationEvaluator(labelCol=label, metricName=metric, numBins=0)
    elif metric == "positive_f1":
        evaluator = MulticlassClassificationEvaluator(labelCol=label, metricName="fMeasureByLabel", metricLabel=1.0)
    else:
        evaluator = MulticlassClassificationEvaluator(labelCol=label, metricName=metric)
    # every fold of every setting reads these rows
    foldable = frozen(with_folds(df, key, folds, label if stratify else None, seed, name="_fold"), "folds")
    search = CrossValidator(
        estimator=Pipeline(stages=[*stages, model]),
        estimatorParamMaps=grid_of(model, grid),
        evaluator=evaluator,
        numFolds=folds,
        foldCol="_fold",
        parallelism=parallelism,
        seed=seed,
    )
    found = search.fit(foldable)
    better = max if evaluator.isLargerBetter() else min
    score = better(found.avgMetrics)
    best = search.getEstimatorParamMaps()[found.avgMetrics.index(score)]
    return Search(found, {p.name: v for p, v in best.items()}, score)


def best_parameter(search: Search, name: str) -> Any:
    """A parameter of the refitted classifier, e.g. the chosen maxDepth."""
    last = search.model.bestModel.stages[-1]
    return last.getOrDefault(last.getParam(name))


def fold_scores(
    df: DataFrame, stages: Sequence[Any], model: Estimator, key: str | Sequence[str], folds: int = 5, seed: int = 42,
    name: str = "model",
) -> DataFrame:
    """``model, fold`` and the four scores of a model trained on the other folds."""
    label = model.getLabelCol()
    foldable = frozen(with_folds(df, key, folds, label, seed, name="fold"), "folds")
    parts = []
    for fold in range(folds):
        fitted = train(foldable.where(F.col("fold") != fold), stages, model)
        parts.append(fitted.transform(foldable.where(F.col("fold") == fold)).select("fold", label, "prediction"))
    scored = classification_scores(union_by_name(*parts), label, "prediction", ["fold"])
    return scored.withColumn("model", F.lit(name))


def compare_models(
    train_df: DataFrame, test_df: DataFrame, entries: Mapping[str, tuple[Sequence[Any], Estimator]]
) -> DataFrame:
    """Train every entry, score it on the test part; one metrics row per model in list order."""
    rows = []
    for rank, (name, (stages, model)) in enumerate(entries.items()):
        predictions = train(train_df, stages, model).transform(test_df)
        s = classification_scores(predictions, model.getLabelCol(), "prediction").first()
        rows.append((rank, name, s["accuracy"], s["precision"], s["recall"], s["f1"]))
    return metrics_table(train_df.sparkSession, rows)
