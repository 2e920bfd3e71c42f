"""Scores and decisions, on the predictions of simple length rules for the labelled documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prepkit.operators.lookup import join_keep_left
from prepkit.plans import scoring
from prepkit.queries.registry import query, rounded, table

# Names and thresholds of the rules: a document longer than the threshold is called good.
RULES = (("short", 100), ("medium", 400), ("long", 1000))

LABELLED = "WITH d AS (SELECT doc_id, n_chars, quality FROM documents JOIN labels USING (doc_id))\n"
RULED = LABELLED + """, p AS (SELECT rank, model, quality, (n_chars > t)::int AS prediction FROM d,
  (VALUES (0, 'short', 100), (1, 'medium', 400), (2, 'long', 1000)) m(rank, model, t)),
c AS (SELECT rank, model, k, count(*) FILTER (quality = k) AS support, count(*) FILTER (prediction = k) AS predicted,
  count(*) FILTER (quality = k AND prediction = k) AS hits FROM p, (VALUES (0), (1)) v(k) GROUP BY 1, 2, 3),
s AS (SELECT *, coalesce(hits / nullif(predicted, 0)::double, 0) AS pr, coalesce(hits / nullif(support, 0)::double, 0) AS re FROM c),
f AS (SELECT *, coalesce(2 * pr * re / nullif(pr + re, 0), 0) AS f1 FROM s),
w AS (SELECT rank, model, sum(hits) / sum(support)::double AS accuracy, sum(pr * support) / sum(support) AS precision,
  sum(re * support) / sum(support) AS recall, sum(f1 * support) / sum(support) AS f1, sum(support)::bigint AS n FROM f GROUP BY 1, 2)
"""
SCORES = ("accuracy", "precision", "recall", "f1")


def labelled(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "n_chars")
    return join_keep_left(documents, table(spark, folder, "labels").select("doc_id", "quality"), "doc_id")


def ruled(spark: SparkSession, folder: str) -> DataFrame:
    """Every labelled document with the call of each rule."""
    calls = F.array(*[
        F.struct(F.lit(i).alias("rank"), F.lit(name).alias("model"), (F.col("n_chars") > t).cast("int").alias("prediction"))
        for i, (name, t) in enumerate(RULES)
    ])
    return labelled(spark, folder).select("quality", F.inline(calls))


def metrics(spark: SparkSession, folder: str) -> DataFrame:
    return scoring.classification_scores(ruled(spark, folder), "quality", "prediction", ["rank", "model"])


@query(RULED + "SELECT model, quality::double AS label, prediction::double AS prediction, count(*) AS n FROM p GROUP BY 1, 2, 3")
def confusion(spark: SparkSession, folder: str) -> DataFrame:
    return scoring.confusion(ruled(spark, folder), "quality", "prediction", ["model"])


@query(RULED + """SELECT model, k::double AS class, support, predicted, hits, round(pr, 6) AS precision, round(re, 6) AS recall,
  round(f1, 6) AS f1 FROM f WHERE support + predicted > 0""")
def class_scores(spark: SparkSession, folder: str) -> DataFrame:
    counts = scoring.confusion(ruled(spark, folder), "quality", "prediction", ["model"])
    return rounded(scoring.class_scores(counts, ["model"]), 6, "precision", "recall", "f1")


@query(RULED + """SELECT rank, model, round(accuracy, 6) AS accuracy, round(precision, 6) AS precision, round(recall, 6) AS recall,
  round(f1, 6) AS f1, n FROM w""")
def classification_scores(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(metrics(spark, folder), 6, *SCORES)


@query(RULED + "SELECT round(pr, 6) AS precision, round(re, 6) AS recall, round(f1, 6) AS f1 FROM f WHERE model = 'medium' AND k = 1")
def binary_scores(spark: SparkSession, folder: str) -> DataFrame:
    called = ruled(spark, folder).where("model = 'medium'")
    return rounded(scoring.binary_scores(called, "quality", "prediction"), 6, "precision", "recall", "f1")


AUC_SQL = """, g AS (SELECT n_chars AS s, count(*) FILTER (quality = 1) AS pos, count(*) FILTER (quality = 0) AS neg FROM d GROUP BY 1),
r AS (SELECT pos, neg, sum(neg) OVER (ORDER BY s) - neg / 2.0::double AS below FROM g)
SELECT round((sum(pos * below) / (sum(pos) * sum(neg)))::double, 6) AS auc FROM r"""


@query(LABELLED + AUC_SQL)
def roc_auc(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(scoring.roc_auc(labelled(spark, folder), "quality", "n_chars"), 6, "auc")


@query("""
WITH g AS (SELECT value AS s, count(*) FILTER (event_type = 'error') AS pos, count(*) FILTER (event_type <> 'error') AS neg
  FROM events GROUP BY 1),
r AS (SELECT pos, neg, sum(neg) OVER (ORDER BY s) - neg / 2.0::double AS below FROM g)
SELECT round((sum(pos * below) / (sum(pos)::double * sum(neg)::double))::double, 6) AS auc FROM r
""")
def roc_auc_events(spark: SparkSession, folder: str) -> DataFrame:
    """How well the value tells errors from other events: very many distinct scores."""
    events = table(spark, folder, "events").select((F.col("event_type") == "error").cast("int").alias("label"), "value")
    return rounded(scoring.roc_auc(events, "label", "value"), 6, "auc")


@query("""
WITH d AS (SELECT doc_id % 5 AS fold, quality, (n_chars > 400)::int AS prediction FROM documents JOIN labels USING (doc_id)),
a AS (SELECT fold, avg((quality = prediction)::int) AS accuracy FROM d GROUP BY 1)
SELECT 'medium' AS model, 'accuracy' AS measure, round(avg(accuracy), 6) AS mean, round(2 * stddev_pop(accuracy), 6) AS spread FROM a
""")
def cv_summary(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "n_chars")
    joined = join_keep_left(documents, table(spark, folder, "labels").select("doc_id", "quality"), "doc_id")
    called = joined.select((F.col("doc_id") % 5).alias("fold"), "quality", (F.col("n_chars") > 400).cast("int").alias("prediction"))
    folds = scoring.classification_scores(called, "quality", "prediction", ["fold"]).withColumn("model", F.lit("medium"))
    return rounded(scoring.cv_summary(folds, ["accuracy"]), 6, "mean", "spread")


@query(RULED + """SELECT rank, model, round(accuracy, 6) AS accuracy,
  rank = (SELECT rank FROM w ORDER BY accuracy DESC, rank LIMIT 1) AS best FROM w""")
def leaderboard(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(scoring.leaderboard(metrics(spark, folder)).select("rank", "model", "accuracy", "best"), 6, "accuracy")


@query(RULED + "SELECT model AS best_model, round(accuracy, 6) AS best_accuracy FROM w ORDER BY accuracy DESC, rank LIMIT 1")
def best_model(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(scoring.best_model(metrics(spark, folder)), 6, "best_accuracy")


@query(RULED + """, h AS (SELECT accuracy AS held FROM w WHERE model = 'short'),
t AS (SELECT model, accuracy FROM w WHERE model <> 'short' ORDER BY accuracy DESC, rank DESC LIMIT 1)
SELECT CASE WHEN accuracy - held < -0.01 THEN 'keep' ELSE model END AS decision, round(held, 6) AS champion_accuracy,
  round(accuracy, 6) AS best_accuracy FROM h, t""")
def champion_decision(spark: SparkSession, folder: str) -> DataFrame:
    decided = scoring.champion_decision(metrics(spark, folder), "short")
    return rounded(decided, 6, "champion_accuracy", "best_accuracy")


@query(RULED + """SELECT string_agg(printf('Model: %s\nAccuracy: %.3f\nPrecision: %.3f\nRecall: %.3f\nF1: %.3f\n',
  model, accuracy, precision, recall, f1), chr(10) ORDER BY rank) AS result FROM w""")
def text_report(spark: SparkSession, folder: str) -> DataFrame:
    return scoring.text_report(metrics(spark, folder))
