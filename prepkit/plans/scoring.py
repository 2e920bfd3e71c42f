"""Scores of classifiers and the decisions taken on them.

All scores of a prediction set come from one confusion aggregate, and so agree with
each other; after it only (classes x classes) rows are left.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prepkit.operators.profile import best_row
from prepkit.operators.ranking import running_totals


def confusion(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """``label, prediction, n`` (per group when ``by`` is given)."""
    cells = [F.col(label).cast("double").alias("label"), F.col(prediction).cast("double").alias("prediction")]
    return df.select(*by, *cells).groupBy(*by, "label", "prediction").agg(F.count("*").alias("n"))


def class_scores(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``class, support, predicted, hits, precision, recall, f1`` from a confusion table."""
    sides = F.array(
        F.struct(F.col("label").alias("class"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("predicted"),
                 F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).alias("hits")),
        F.struct(F.col("prediction").alias("class"), F.lit(0).cast("bigint").alias("support"),
                 F.col("n").alias("predicted"), F.lit(0).cast("bigint").alias("hits")),
    )
    split = counts.select(*by, F.inline(sides))
    summed = split.groupBy(*by, "class").agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])
    precision = F.coalesce(F.try_divide(F.col("hits"), F.col("predicted")), F.lit(0.0))
    recall = F.coalesce(F.try_divide(F.col("hits"), F.col("support")), F.lit(0.0))
    scored = summed.withColumn("precision", precision).withColumn("recall", recall)
    both = F.col("precision") + F.col("recall")
    f1 = F.coalesce(F.try_divide(2.0 * F.col("precision") * F.col("recall"), both), F.lit(0.0))
    return scored.withColumn("f1", f1)


def classification_scores(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """``accuracy, precision, recall, f1, n``, the last three weighted by class support."""
    scored = class_scores(confusion(df, label, prediction, by), by)

    def weighted(c: str):
        return F.try_divide(F.sum(F.col(c) * F.col("support")), F.sum("support")).alias(c)

    accuracy = F.try_divide(F.sum("hits"), F.sum("support")).alias("accuracy")
    figures = [accuracy, weighted("precision"), weighted("recall"), weighted("f1"), F.sum("support").alias("n")]
    return scored.groupBy(*by).agg(*figures) if by else scored.agg(*figures)


def binary_scores(df: DataFrame, label: str, prediction: str, positive: float = 1.0) -> DataFrame:
    """``precision, recall, f1`` of the positive class."""
    hit = F.count_if((F.col(label) == positive) & (F.col(prediction) == positive))
    said, held = F.count_if(F.col(prediction) == positive), F.count_if(F.col(label) == positive)
    row = df.agg(hit.alias("hits"), said.alias("said"), held.alias("held"))

    def ratio(a, b):
        return F.coalesce(F.try_divide(a, b), F.lit(0.0))

    return row.select(
        ratio(F.col("hits"), F.col("said")).alias("precision"),
        ratio(F.col("hits"), F.col("held")).alias("recall"),
        ratio(2.0 * F.col("hits"), F.col("said") + F.col("held")).alias("f1"),
    )


def roc_auc(df: DataFrame, label: str, score: str, positive: float = 1.0) -> DataFrame:
    """``auc``: chance that a positive scores above a negative, ties counting half.

    Rows are counted per distinct score on the map side; running totals over the scores
    are taken in slices. NULL when one of the classes is missing.
    """
    counted = df.groupBy(F.col(score).cast("double").alias("_score")).agg(
        F.count_if(F.col(label) == positive).alias("_pos"), F.count("*").alias("_all")
    )
    both = counted.withColumn("_neg", F.col("_all") - F.col("_pos"))
    ranked = running_totals(both, "_score", "_neg")
    wins = F.sum(F.col("_pos").cast("double") * (F.col("before") + F.col("_neg") / 2.0))
    pairs = F.sum("_pos").cast("double") * F.sum("_neg").cast("double")
    return ranked.agg(F.try_divide(wins, pairs).alias("auc"))


def cv_summary(folds: DataFrame, measures: Sequence[str], by: Sequence[str] = ("model",)) -> DataFrame:
    """Per model and measure ``mean`` and ``spread``, two population deviations over the folds."""
    long = folds.unpivot(list(by), list(measures), "measure", "value")
    return long.groupBy(*by, "measure").agg(F.avg("value").alias("mean"), (2.0 * F.stddev_pop("value")).alias("spread"))


def metrics_table(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    """One row per model: its place in the list, name, and four scores."""
    return spark.createDataFrame(list(rows), "rank int, model string, accuracy double, precision double, recall double, f1 double")


def leaderboard(metrics: DataFrame) -> DataFrame:
    """The models by accuracy, the best first; ``best`` marks the winner."""
    winner = best_row(metrics, "accuracy", "rank").select(F.col("rank").alias("_rank"))
    joined = metrics.join(F.broadcast(winner), metrics["rank"] == F.col("_rank"), "left")
    return joined.select(*metrics.columns, F.col("_rank").isNotNull().alias("best"))


def best_model(metrics: DataFrame) -> DataFrame:
    """``best_model, best_accuracy``; on a tie the model listed first."""
    return best_row(metrics, "accuracy", "rank").select(
        F.col("model").alias("best_model"), F.col("accuracy").alias("best_accuracy")
    )


def choose_challenger(
    champion: float, challengers: Mapping[str, float], tolerance: float = 0.01, strict: bool = False
) -> str:
    """Name of the challenger to evaluate, or ``keep`` for the champion.

    The champion stays when the best challenger is worse by more than the tolerance, or,
    when ``strict``, unless it is better. On a tie the challenger listed last wins.
    """
    best = max(challengers.values())
    if (best <= champion) if strict else (best - champion < -tolerance):
        return "keep"
    return [name for name, value in challengers.items() if value == best][-1]


def champion_decision(metrics: DataFrame, champion: str, tolerance: float = 0.01, strict: bool = False) -> DataFrame:
    """``decision, champion_accuracy, best_accuracy`` from a table of model accuracies.

    Ties between challengers go to the one with the larger ``rank``.
    """
    held = F.max(F.when(F.col("model") == champion, F.col("accuracy")))
    rival = F.when(F.col("model") != champion, F.struct("accuracy", "rank", "model"))
    row = metrics.agg(held.alias("champion_accuracy"), F.max(rival).alias("top"))
    gap = F.col("top.accuracy") - F.col("champion_accuracy")
    stays = gap <= 0 if strict else gap < -tolerance
    return row.select(
        F.when(stays, "keep").otherwise(F.col("top.model")).alias("decision"),
        "champion_accuracy",
        F.col("top.accuracy").alias("best_accuracy"),
    )


def text_report(metrics: DataFrame) -> DataFrame:
    """``result``: per model its name and four scores with three decimals, in list order, as one text."""
    lines = F.format_string(
        "Model: %s\nAccuracy: %.3f\nPrecision: %.3f\nRecall: %.3f\nF1: %.3f\n", "model", "accuracy", "precision", "recall", "f1"
    )
    ordered = F.sort_array(F.collect_list(F.struct("rank", lines.alias("text"))))
    return metrics.agg(F.array_join(F.transform(ordered, lambda r: r["text"]), "\n").alias("result"))
