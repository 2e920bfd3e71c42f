"""One search, many scores: all settings' predictions on held-out folds, scored by one aggregate, and one refit."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prepkit.operators.rows import union_by_name
from prepkit.operators.split import with_folds
from prepkit.plans.models import grid_of, train
from prepkit.plans.scoring import class_scores, confusion, cv_summary
from prepkit.sources.frozen import frozen

#: Scores of a setting on a fold: over all classes, weighted by support, and of the positive class alone.
MEASURES = ("accuracy", "precision", "recall", "f1", "positive_precision", "positive_recall", "positive_f1")


@dataclass(frozen=True)
class ScoredSearch:
    """What a search over several scores found; settings are numbered in the grid's order.

    ``predictions`` holds ``setting, fold``, the key, ``label`` and ``prediction`` of every row under every setting, by a
    model that has not seen the row; ``scores`` the measures by setting and fold; ``model`` is refitted on all rows.
    """

    predictions: DataFrame
    scores: DataFrame
    settings: list[dict[str, Any]]
    best: int
    model: PipelineModel | None

    def summary(self) -> DataFrame:
        """``setting, measure, mean, spread`` over the folds."""
        return cv_summary(self.scores, MEASURES, ("setting",))

    @property
    def params(self) -> dict[str, Any]:
        return self.settings[self.best]


def scores_by(predictions: DataFrame, by: Sequence[str], positive: float = 1.0) -> DataFrame:
    """The ``by`` columns, MEASURES and ``n`` of predictions (``label``, ``prediction``), from one confusion aggregate."""
    scored = class_scores(confusion(predictions, "label", "prediction", by), by)

    def weighted(c: str):
        return F.try_divide(F.sum(F.col(c) * F.col("support")), F.sum("support")).alias(c)

    def alone(c: str):
        return F.coalesce(F.max(F.when(F.col("class") == positive, F.col(c))), F.lit(0.0)).alias(f"positive_{c}")

    accuracy = F.try_divide(F.sum("hits"), F.sum("support")).alias("accuracy")
    each = ("precision", "recall", "f1")
    return scored.groupBy(*by).agg(accuracy, *map(weighted, each), *map(alone, each), F.sum("support").alias("n"))


def score_search(
    df: DataFrame, stages: Sequence[Any], model: Estimator, grid: Mapping[str, Sequence[Any]], key: str | Sequence[str],
    refit: str | None = "f1", folds: int = 5, stratify: bool = True, positive: float = 1.0, seed: int = 42,
) -> ScoredSearch:
    """Cross-validate a grid under all measures at once; refit the setting of the best mean ``refit`` (None: refit none).

    The feature stages are fitted once a fold, on its training rows, and what they make is written once, whatever the
    number of settings. On a tie the setting listed first wins. Rows of one key share a fold when not stratified.
    """
    if refit is not None and refit not in MEASURES:
        raise ValueError(f"refit is one of {MEASURES} or None, not {refit!r}")
    keys = [key] if isinstance(key, str) else list(key)
    label, settings = model.getLabelCol(), grid_of(model, grid)
    foldable = frozen(with_folds(df, keys, folds, label if stratify else None, seed, name="_fold"), "folds")
    parts = []
    for fold in range(folds):
        made = Pipeline(stages=list(stages)).fit(foldable.where(F.col("_fold") != fold)).transform(foldable) if stages else foldable
        ready = frozen(made.select(*keys, "_fold", label, model.getFeaturesCol(), *_weight(model)), "prepared")
        seen, held = ready.where(F.col("_fold") != fold), ready.where(F.col("_fold") == fold)
        for at, fitted in model.fitMultiple(seen, settings):
            told = fitted.transform(held).select(
                F.lit(int(at)).alias("setting"), F.lit(fold).alias("fold"), *keys, F.col(label).cast("double").alias("label"), "prediction")
            parts.append(told)
    predictions = frozen(union_by_name(*parts), "predictions")
    scores = frozen(scores_by(predictions, ["setting", "fold"], positive), "scores")
    best, chosen = 0, None
    if refit is not None:
        mean = scores.groupBy("setting").agg(F.avg(refit).alias("m")).orderBy(F.round("m", 12).desc(), "setting").first()
        best = mean["setting"] if mean else 0
        chosen = train(foldable.drop("_fold"), stages, model.copy(settings[best]))
    return ScoredSearch(predictions, scores, [{p.name: v for p, v in s.items()} for s in settings], best, chosen)


def _weight(model: Estimator) -> list[str]:
    return [model.getOrDefault("weightCol")] if model.hasParam("weightCol") and model.isDefined("weightCol") and model.getOrDefault("weightCol") else []
