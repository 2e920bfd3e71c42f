"""Training, cross-validation, grid search, perturbed scoring; SQL twins only where nothing is trained."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prepkit.operators.lookup import join_keep_left
from prepkit.operators.scale import fit_minmax, load_scalings, scaling_table
from prepkit.operators.split import random_split, with_part
from prepkit.plans import jobs, models, robustness, scoring
from prepkit.queries.registry import dirty, query, rounded, table, unit_sql
from prepkit.session import scratch_path
from prepkit.sources.frozen import frozen
from prepkit.sources.readers import read_parquet
from prepkit.sources.writers import write_parquet

FEATURES = ["n_chars", "n_tokens", "n_lines", "n_digits"]


def labelled_features(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled documents with a few counts over their whole texts."""
    text = F.col("text")
    documents = table(spark, folder, "documents").select(
        "doc_id",
        "lang",
        F.col("n_chars").cast("double").alias("n_chars"),
        F.size(F.split(text, " ")).cast("double").alias("n_tokens"),
        F.size(F.split(text, "\n")).cast("double").alias("n_lines"),
        F.length(F.regexp_replace(text, "[^0-9]", "")).cast("double").alias("n_digits"),
    )
    labels = table(spark, folder, "labels").select("doc_id", F.col("quality").cast("double").alias("quality"))
    return join_keep_left(documents, labels, "doc_id")


def parts(data: DataFrame, label: str = "quality", key: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """A train and a test part, put aside for training."""
    marked = frozen(with_part(data, label, key, 0.2), "parts")
    return marked.where("part = 'train'").drop("part"), marked.where("part = 'test'").drop("part")


def _scores(spark: SparkSession, folder: str, name: str, **params: object) -> DataFrame:
    data = labelled_features(spark, folder).drop("lang")
    train, test = parts(data)
    stages = models.feature_stages(FEATURES)
    return models.compare_models(train, test, {name: (stages, models.classifier(name, "quality", **params))})


@query()
def train_logistic_regression(spark: SparkSession, folder: str) -> DataFrame:
    return _scores(spark, folder, "Logistic Regression", maxIter=50)


@query()
def train_decision_tree(spark: SparkSession, folder: str) -> DataFrame:
    return _scores(spark, folder, "Decision Tree", maxDepth=5)


@query()
def train_random_forest(spark: SparkSession, folder: str) -> DataFrame:
    return _scores(spark, folder, "Random Forest", maxDepth=5, numTrees=20)


@query()
def train_gradient_boosting(spark: SparkSession, folder: str) -> DataFrame:
    return _scores(spark, folder, "Gradient Boosting", maxDepth=3, maxIter=5)


@query()
def train_linear_svm(spark: SparkSession, folder: str) -> DataFrame:
    return _scores(spark, folder, "Linear SVM", maxIter=20)


@query()
def train_expanded_svm(spark: SparkSession, folder: str) -> DataFrame:
    """A linear SVM on squares and products too, in place of a kernel."""
    data = labelled_features(spark, folder).drop("lang")
    train, test = parts(data)
    stages = models.feature_stages(FEATURES, squares=True, products=True)
    return models.compare_models(train, test, {"SVM": (stages, models.classifier("Linear SVM", "quality", maxIter=20))})


@query()
def train_balanced(spark: SparkSession, folder: str) -> DataFrame:
    """Logistic regression with class weights; centred scaling."""
    data = models.with_balance(labelled_features(spark, folder).drop("lang"), "quality")
    train, test = parts(data)
    model = models.classifier("Logistic Regression", "quality", maxIter=50, weightCol="weight")
    return models.compare_models(train, test, {"balanced": (models.feature_stages(FEATURES, centre=True), model)})


@query()
def train_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    """Ten-class logistic regression on the embedding vectors."""
    from pyspark.ml.functions import array_to_vector

    vectors = table(spark, folder, "embeddings").select(
        "vec_id", array_to_vector(F.transform("embedding", lambda x: x.cast("double"))).alias("features"),
        F.col("label").cast("double").alias("label"),
    )
    train, test = parts(vectors, "label", "vec_id")
    model = models.classifier("Logistic Regression", "label", maxIter=10, regParam=0.1)
    return models.compare_models(train, test, {"embeddings": ([], model)})


@query()
def grid_search(spark: SparkSession, folder: str) -> DataFrame:
    """Tree depth chosen by F1 over three folds: ``max_depth, score``."""
    data = labelled_features(spark, folder).drop("lang")
    found = models.grid_search(data, models.feature_stages(FEATURES), models.classifier("Decision Tree", "quality"),
                               {"maxDepth": [2, 5]}, "doc_id", "f1", 3)
    return spark.createDataFrame([(found.params["maxDepth"], float(found.score))], "max_depth int, score double")


@query()
def cross_validation(spark: SparkSession, folder: str) -> DataFrame:
    """Mean and spread of the four scores over three folds."""
    data = labelled_features(spark, folder).drop("lang")
    folds = models.fold_scores(data, models.feature_stages(FEATURES), models.classifier("Decision Tree", "quality"),
                               "doc_id", 3, name="Decision Tree")
    return scoring.cv_summary(folds, ["accuracy", "precision", "recall", "f1"])


@query()
def heart_report(spark: SparkSession, folder: str) -> DataFrame:
    """The heart report on labelled documents: grids of two classifiers searched, the best of each scored on held-out rows."""
    grids = {"Decision Tree": {"maxDepth": [2, 5]}, "Logistic Regression": {"regParam": [0.01, 0.1], "elasticNetParam": [0.0]}}
    metrics, _ = jobs.heart_report(labelled_features(spark, folder).drop("lang"), "doc_id", "quality", grids, folds=2)
    return metrics


@query()
def heart_comparison(spark: SparkSession, folder: str) -> DataFrame:
    """Six models on labelled documents, three of them kernel machines."""
    data = labelled_features(spark, folder).drop("lang").withColumn("smoke", F.col("doc_id") % 2 * 1.0)
    return jobs.heart_comparison(data, "doc_id", "quality")


@query()
def passenger_search(spark: SparkSession, folder: str) -> DataFrame:
    """The passenger job on labelled documents with gaps: ``auc, max_depth``."""
    data = labelled_features(spark, folder).select(
        "doc_id", "quality", "n_tokens", F.when(F.col("doc_id") % 7 != 0, F.col("n_chars")).alias("n_chars"),
        F.when(F.col("doc_id") % 5 != 0, F.col("lang")).alias("lang"),
    )
    _, result = jobs.passengers(data, "quality", "doc_id", (), {"maxDepth": [2, 4], "numTrees": [10]}, folds=2)
    return result


@query()
def validation_variants(spark: SparkSession, folder: str) -> DataFrame:
    """Validation accuracy of the plain, product and maximum features: ``variant, accuracy``."""
    data = frozen(labelled_features(spark, folder).drop("lang"), "labelled")
    found = [(v, robustness.validation_accuracy(data, FEATURES, "quality", "doc_id", v)) for v in robustness.VARIANTS]
    return spark.createDataFrame(found, "variant string, accuracy double")


@query()
def perturbed_accuracy(spark: SparkSession, folder: str) -> DataFrame:
    """Accuracy under noise on the inputs, with its confidence interval."""
    data = labelled_features(spark, folder).drop("lang")
    train, test = parts(data)
    model = robustness.train_variant(train, FEATURES, "quality", "product")
    return robustness.robustness(model, test, "doc_id", trials=10)


@query()
def predicted_auc(spark: SparkSession, folder: str) -> DataFrame:
    """AUC of a fitted model's probabilities: ``auc``."""
    data = frozen(labelled_features(spark, folder).drop("lang"), "labelled")
    fitted = models.train(data, models.feature_stages(FEATURES), models.classifier("Logistic Regression", "quality", maxIter=20))
    scored = fitted.transform(data).select("quality", F.get(vector_to_array("probability"), F.lit(1)).alias("score"))
    return scoring.roc_auc(scored, "quality", "score")


@query()
def wine_job(spark: SparkSession, folder: str) -> DataFrame:
    """The wine job on the events with gaps, as ``variant, accuracy``."""
    data = dirty(spark, folder).select(
        "event_id", F.col("value"), F.col("age").cast("double").alias("age"), F.col("user_id").cast("double").alias("user"),
        (F.col("event_type") == "error").cast("double").alias("label"),
    )
    return jobs.wines(data, "event_id", "label", trials=5, mode="simultaneous").accuracies


NOISE_SQL = """sqrt(-2 * ln(greatest({a}, 1 / 4503599627370496.0::double))) * cos(2 * pi() * {b})""".format(
    a="('0x' || substr(h, 1, 13))::bigint / 4503599627370496.0::double",
    b="('0x' || substr(h, 14, 13))::bigint / 4503599627370496.0::double",
)


@query(f"""
WITH t AS (SELECT event_id, value, trial, md5(event_id || '|' || trial || '#42value') AS h
  FROM events, (SELECT unnest([1, 2, 3]) AS trial))
SELECT event_id, trial::int AS trial, round(value + 1.2::double * {NOISE_SQL}, 5) AS value FROM t
""")
def perturbed_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Every event three times with noise on its value."""
    events = table(spark, folder, "events").select("event_id", "value")
    return rounded(robustness.perturbed(events, ["value"], "event_id", 1.2, 3), 5, "value").select("event_id", "trial", "value")


@query(f"""
WITH t AS (SELECT p_size::double AS a, p_retailprice AS b FROM part WHERE {unit_sql('p_partkey', 'split 42')} < 0.8::double),
u AS (SELECT 'p_size' AS name, min(a) AS lo, max(a) AS hi FROM t UNION ALL SELECT 'p_retailprice', min(b), max(b) FROM t
  UNION ALL SELECT 'p_size*p_retailprice', min(a * b), max(a * b) FROM t
  UNION ALL SELECT 'max_p_size_p_retailprice', min(greatest(a, b)), max(greatest(a, b)) FROM t)
SELECT name, round(lo, 4) AS data_min, round(hi, 4) AS data_max, round(1 / (hi - lo), 8) AS scale, round(-lo / (hi - lo), 8) AS min FROM u
""")
def engineered_scalings(spark: SparkSession, folder: str) -> DataFrame:
    """Scaling of raw, product and maximum features, fitted on the train part only."""
    names = ["p_size", "p_retailprice"]
    part = table(spark, folder, "part").select("p_partkey", F.col("p_size").cast("double").alias("p_size"), "p_retailprice")
    train, _ = random_split(part, [0.8, 0.2], "p_partkey")
    made = robustness.engineered(robustness.engineered(train, names, "product"), names, "max").drop("p_partkey")
    found = scaling_table(spark, fit_minmax(made, made.columns))
    return rounded(rounded(found, 4, "data_min", "data_max"), 8, "scale", "min")


@query("""
WITH t AS (SELECT p_size::double AS a, p_retailprice AS b FROM part),
u AS (SELECT 'p_size' AS name, min(a) AS lo, max(a) AS hi FROM t UNION ALL SELECT 'p_retailprice', min(b), max(b) FROM t
  UNION ALL SELECT 'p_size*p_retailprice', min(a * b), max(a * b) FROM t)
SELECT name, round(lo, 4) AS data_min, round(hi, 4) AS data_max, round(1 / (hi - lo), 8) AS scale, round(-lo / (hi - lo), 8) AS min FROM u
""")
def appended_scalings(spark: SparkSession, folder: str) -> DataFrame:
    """Scalings of the raw columns stored as a table, those of the products appended to it, all read again."""
    names = ["p_size", "p_retailprice"]
    part = table(spark, folder, "part").select(F.col("p_size").cast("double").alias("p_size"), "p_retailprice")
    path = scratch_path(spark, "scalings")
    write_parquet(scaling_table(spark, fit_minmax(part, names)), path)
    made = robustness.engineered(part, names, "product")
    write_parquet(scaling_table(spark, fit_minmax(made, [c for c in made.columns if c not in names])), path, mode="append")
    stored = scaling_table(spark, load_scalings(read_parquet(spark, path)))
    return rounded(rounded(stored, 4, "data_min", "data_max"), 8, "scale", "min")


@query("""
SELECT quality::double AS quality, count(*) AS n, round((SELECT count(*) FROM labels JOIN documents USING (doc_id)) /
  (2.0::double * count(*)), 6) AS weight FROM labels JOIN documents USING (doc_id) GROUP BY 1
""")
def balanced_weights(spark: SparkSession, folder: str) -> DataFrame:
    data = models.with_balance(labelled_features(spark, folder), "quality")
    return rounded(data.groupBy("quality").agg(F.count("*").alias("n"), F.max("weight").alias("weight")), 6, "weight")


@query("""
SELECT p_partkey, p_size * p_size * 1.0::double AS p_size_2, round(p_retailprice * p_retailprice, 4) AS p_retailprice_2,
  round(p_size * p_retailprice, 4) AS p_size_p_retailprice, greatest(p_size, p_retailprice) AS max_p_size_p_retailprice FROM part
""")
def stage_features(spark: SparkSession, folder: str) -> DataFrame:
    """Squares, products and maxima made by the pipeline stages."""
    names = ["p_size", "p_retailprice"]
    part = table(spark, folder, "part").select("p_partkey", F.col("p_size").cast("double").alias("p_size"), "p_retailprice")
    made = Pipeline(stages=models.feature_stages(names, True, True, True, scale=False)).fit(part).transform(part)
    derived = models.derived_names(names, True, True, True)
    return rounded(made.select("p_partkey", *derived), 4, *derived)
