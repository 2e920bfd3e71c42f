import numpy as np
import pandas as pd
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from prepkit.operators import impute, scale
from prepkit.plans import jobs, models, robustness, scoring, stages


@pytest.fixture(scope="module")
def heart(spark):
    """A table of the heart-disease shape with gaps, bad values and sparse rows."""
    rng = np.random.default_rng(8)
    n = 400
    target = rng.integers(0, 2, n)
    data = {c: (target + rng.normal(0, 1, n)) for c in ("thaldur", "thalach")}
    data |= {c: rng.integers(0, 2, n).astype(float) for c in ("sex", "painloc", "painexer", "smoke", "fbs", "prop", "nitr", "pro", "diuretic", "exang")}
    data |= {"age": rng.integers(18, 90, n).astype(float), "cp": rng.integers(1, 5, n).astype(float),
             "slope": rng.integers(1, 4, n).astype(float), "trestbps": 110 + 20 * target + rng.normal(0, 9, n),
             "oldpeak": rng.uniform(0, 3.9, n)}
    pdf = pd.DataFrame(data).round(3)
    pdf["target"] = target.astype(float)
    pdf.loc[pdf.index % 3 == 0, "smoke"] = np.nan
    pdf.loc[pdf.index % 11 == 0, ["trestbps", "fbs"]] = [20.0, 5.0]
    pdf.loc[pdf.index % 13 == 0, ["oldpeak", "cp", "thalach"]] = np.nan
    pdf["id"] = range(n)
    pdf.loc[n] = [np.nan] * len(pdf.columns)
    pdf.loc[n, "id"] = n
    from prepkit.operators.columns import nan_to_null

    return nan_to_null(spark.createDataFrame(pdf))


@pytest.fixture(scope="module")
def clean(heart):
    return jobs.heart_fill_smoke(jobs.heart_clean(heart, "id"), "id").persist()


def test_cleaning_leaves_no_gaps(heart, clean):
    assert clean.count() == 400
    assert clean.dropna().count() == 400
    row = clean.agg(F.min("trestbps"), F.max("oldpeak"), F.max("fbs"), F.max("smoke")).first()
    assert row[0] >= 100 and row[1] <= 4 and row[2] <= 1 and row[3] == 1
    quota = jobs.heart_fill_smoke(jobs.heart_clean(heart, "id"), "id", how="quota")
    assert quota.dropna().count() == 400
    with pytest.raises(ValueError):
        jobs.heart_fill_smoke(clean, "id", how="other")


def test_report_of_searched_models(clean):
    grids = {"Logistic Regression": {"regParam": [0.01, 0.1]}, "Decision Tree": {"maxDepth": [2, 3]}}
    metrics, report = jobs.heart_report(clean, "id", grids=grids, folds=3, fraction=0.2)
    found = {r["model"]: r for r in metrics.collect()}
    assert set(found) == set(grids)
    for r in found.values():
        assert r["accuracy"] == pytest.approx(r["recall"]) and r["accuracy"] > 0.6
    text = report.first()["result"].splitlines()
    assert text[0] == "Model: Logistic Regression" and text[1] == f"Accuracy: {found['Logistic Regression']['accuracy']:.3f}"
    assert text[6] == "Model: Decision Tree"


def test_comparison_of_six_models(clean):
    metrics = jobs.heart_comparison(clean, "id", fraction=0.3)
    board = scoring.leaderboard(metrics).orderBy("rank").collect()
    assert [r["model"] for r in board] == ["lr1", "lr2", "lr3", "svm1", "svm2", "svm3"]
    top = max(r["accuracy"] for r in board)
    want = next(r["model"] for r in board if r["accuracy"] == top)
    assert [r["model"] for r in board if r["best"]] == [want]
    assert scoring.best_model(metrics).first()["best_model"] == want


def test_search_takes_the_best_average(clean):
    found = models.grid_search(clean, models.feature_stages(["trestbps", "thaldur"]), models.classifier("Decision Tree", "target"),
                               {"maxDepth": [0, 3]}, "id", "f1", 2)
    assert found.params == {"maxDepth": 3} and models.best_parameter(found, "maxDepth") == 3
    assert found.score == max(found.model.avgMetrics)


def test_search_by_the_positive_class_and_wide_grids(clean):
    grid = models.wide_grid("Logistic Regression", 400)
    assert grid == {"regParam": [0.25, 0.025, 0.0025, 0.00025]} and models.wide_grid("Random Forest", 1) == models.WIDE_GRIDS["Random Forest"]
    found = models.grid_search(clean, models.feature_stages(["trestbps"]), models.classifier("Logistic Regression", "target"),
                               {"regParam": grid["regParam"][1:3]}, "id", "positive_f1", 2)
    assert 0.5 < found.score <= 1 and found.params["regParam"] in grid["regParam"]


def test_fold_scores_and_summary(clean):
    folds = models.fold_scores(clean, models.feature_stages(["trestbps"]), models.classifier("Logistic Regression", "target"), "id", 3)
    got = folds.toPandas()
    assert sorted(got["fold"]) == [0, 1, 2] and got["n"].sum() == 400
    summary = {r["measure"]: r for r in scoring.cv_summary(folds, ["accuracy"]).collect()}["accuracy"]
    assert summary["mean"] == pytest.approx(got["accuracy"].mean())
    assert summary["spread"] == pytest.approx(2 * got["accuracy"].std(ddof=0))


def test_scores_equal_the_evaluators(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator

    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"label": rng.integers(0, 3, 500).astype(float), "prediction": rng.integers(0, 3, 500).astype(float)})
    df = spark.createDataFrame(pdf)
    ours = scoring.classification_scores(df, "label", "prediction").first()
    for name, metric in {"accuracy": "accuracy", "precision": "weightedPrecision", "recall": "weightedRecall", "f1": "f1"}.items():
        assert ours[name] == pytest.approx(MulticlassClassificationEvaluator(labelCol="label", metricName=metric).evaluate(df))
    pdf = pd.DataFrame({"label": rng.integers(0, 2, 3000).astype(float), "rawPrediction": rng.integers(0, 40, 3000) / 40.0})
    df = spark.createDataFrame(pdf)
    wanted = BinaryClassificationEvaluator(labelCol="label", metricName="areaUnderROC", numBins=0).evaluate(df)
    assert scoring.roc_auc(df, "label", "rawPrediction").first()["auc"] == pytest.approx(wanted)


def test_auc_by_brute_force_and_without_a_class(spark):
    rng = np.random.default_rng(6)
    label, score = rng.integers(0, 2, 300), rng.normal(0, 1, 300).round(1)
    pos, neg = score[label == 1], score[label == 0]
    want = np.mean([(p > q) + 0.5 * (p == q) for p in pos for q in neg])
    df = spark.createDataFrame(pd.DataFrame({"label": label, "score": score}))
    assert scoring.roc_auc(df, "label", "score").first()["auc"] == pytest.approx(want)
    assert scoring.roc_auc(df.where("label = 1"), "label", "score").first()["auc"] is None


def test_never_predicted_and_never_seen_classes(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 0.0), (0.0, 2.0)], "label double, prediction double")
    per_class = {r["class"]: (r["precision"], r["recall"]) for r in scoring.class_scores(scoring.confusion(df, "label", "prediction")).collect()}
    assert per_class == {0.0: (0.5, 0.5), 1.0: (0.0, 0.0), 2.0: (0.0, 0.0)}
    r = scoring.binary_scores(df, "label", "prediction").first()
    assert tuple(r) == (0.0, 0.0, 0.0)


@pytest.mark.parametrize("champion, rivals, strict, wanted", [
    (0.80, {"max": 0.78, "product": 0.77}, False, "keep"),
    (0.80, {"max": 0.795, "product": 0.77}, False, "max"),
    (0.80, {"max": 0.795, "product": 0.77}, True, "keep"),
    (0.80, {"max": 0.90, "product": 0.90}, False, "product"),
    (0.80, {"max": 0.80, "product": 0.70}, True, "keep"),
])
def test_champion_and_challengers(spark, champion, rivals, strict, wanted):
    assert scoring.choose_challenger(champion, rivals, strict=strict) == wanted
    listed = [(0, "plain", champion, 0.0, 0.0, 0.0), *[(i + 1, n, a, 0.0, 0.0, 0.0) for i, (n, a) in enumerate(rivals.items())]]
    decided = scoring.champion_decision(scoring.metrics_table(spark, listed), "plain", strict=strict).first()
    assert decided["decision"] == wanted and decided["champion_accuracy"] == champion


def test_stages_save_and_load(spark, tmp_path):
    df = spark.createDataFrame([(1.0, 2.0, "a"), (3.0, 4.0, None), (5.0, None, "a"), (7.0, 8.0, "b")], "x double, y double, s string")
    made = Pipeline(stages=[
        *impute.index_and_impute(["x", "y"], ["s"]).getStages(),
        stages.SquareProduct(inputCols=["Imputedx"], outputCols=["x2"]),
        stages.PairwiseProduct(inputCols=["Imputedx", "Imputedy"], outputCols=["xy"]),
        stages.PairwiseMax(inputCols=["Imputedx", "Imputedy"], outputCols=["m"]),
    ]).fit(df)
    out = made.transform(df).orderBy("x").collect()
    assert [r["ImputedsIndex"] for r in out] == [0.0, 0.0, 0.0, 1.0]
    assert [r["x2"] for r in out] == [1.0, 9.0, 25.0, 49.0]
    assert out[2]["Imputedy"] == pytest.approx(14 / 3) and out[2]["xy"] == pytest.approx(70 / 3) and out[2]["m"] == 5.0
    made.write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m")).transform(df).orderBy("x").collect()
    assert again == out


def test_passenger_job(spark):
    rng = np.random.default_rng(3)
    n = 300
    sex = rng.choice(["male", "female"], n)
    pdf = pd.DataFrame({"PassengerId": range(n), "Survived": ((sex == "female") ^ (rng.random(n) < 0.15)).astype(int),
                        "Name": [f"n{i}" for i in range(n)], "Age": rng.uniform(1, 80, n).round(1), "Fare": rng.gamma(2, 10, n).round(2),
                        "Sex": sex, "Embarked": rng.choice(["S", "C", "Q"], n)})
    df = spark.createDataFrame(pdf).withColumn("Age", F.when(F.col("PassengerId") % 6 != 0, F.col("Age"))).withColumn(
        "Embarked", F.when(F.col("PassengerId") % 50 != 0, F.col("Embarked")))
    search, result = jobs.passengers(df, grid={"maxDepth": [2, 4], "numTrees": [10]}, folds=2)
    r = result.first()
    assert r["auc"] > 0.7 and r["max_depth"] in (2, 4)
    assembler = next(s for s in search.model.bestModel.stages if s.__class__.__name__ == "VectorAssembler")
    assert set(assembler.getInputCols()) == {"ImputedAge", "ImputedFare", "ImputedAge_2", "ImputedFare_2", "ImputedAge_ImputedFare",
                                             "ImputedSexIndex", "ImputedEmbarkedIndex"}


def test_balanced_weights(spark):
    df = spark.createDataFrame([(0.0,)] * 9 + [(1.0,)], "label double")
    got = models.with_balance(df, "label").groupBy("label").agg(F.sum("weight").alias("w")).collect()
    assert [r["w"] for r in got] == pytest.approx([5.0, 5.0])


def test_heart_comparison_passes_over_written_rows(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(jobs.rows, "drop_null_columns", lambda df: seen.append(df) or df)
    monkeypatch.setattr(models, "fitted_kernel_stages", lambda df, *_: [])
    monkeypatch.setattr(models, "compare_models", lambda train, test, entries: seen.extend([train, test]) or entries)
    df = spark.range(40).select("id", (F.col("id") % 5 * 1.0).alias("x"), (F.col("id") % 2 * 1.0).alias("smoke"), (F.col("id") % 3 * 1.0).alias("target"))
    assert set(jobs.heart_comparison(df, "id")) == {"lr1", "lr2", "lr3", "svm1", "svm2", "svm3"}
    # one copy serves the search for gaps and all trainings, its rows on all cores
    assert len({tuple(d.inputFiles()) for d in seen}) == 1 and seen[0].inputFiles()
    assert {d.rdd.getNumPartitions() for d in seen[1:]} == {spark.sparkContext.defaultParallelism}


def test_wine_job(spark):
    rng = np.random.default_rng(9)
    n = 400
    label = rng.integers(0, 2, n)
    pdf = pd.DataFrame({"id": range(n), "alcohol": 12 + 4 * label + rng.normal(0, 0.7, n), "ash": rng.normal(2, 0.3, n),
                        "region": rng.choice(["n", "s"], n), "Wine": label})
    pdf.loc[3, "ash"] = 900.0
    done = jobs.wines(spark.createDataFrame(pdf), "id", trials=4)
    assert done.clean.count() == n - 1 and "region_encoded" in done.clean.columns
    accuracies = {r["variant"]: r["accuracy"] for r in done.accuracies.collect()}
    assert set(accuracies) == {"plain", "product", "max"} and min(accuracies.values()) > 0.9
    names = {r["name"] for r in done.scalings.collect()}
    assert {"alcohol", "ash", "region_encoded", "alcohol*ash", "max_ash_region_encoded"} <= names and len(names) == 9
    assert done.decision in ("max", "product")
    r = done.robustness.first()
    assert r["trials"] == 4 and r["ci_lo"] <= r["mean_accuracy"] <= r["ci_hi"] and r["mean_accuracy"] < r["plain_accuracy"]


def test_wine_job_without_strings(spark):
    rng = np.random.default_rng(9)
    label = rng.integers(0, 2, 200)
    df = spark.createDataFrame(pd.DataFrame({"id": range(200), "alcohol": 12 + 4 * label + rng.normal(0, 0.7, 200),
                                             "ash": rng.normal(2, 0.3, 200), "Wine": label}))
    assert scale.label_encode(df, []).collect() == df.collect()
    accuracies = {r["variant"]: r["accuracy"] for r in jobs.wines(df, "id", trials=2).accuracies.collect()}
    assert set(accuracies) == {"plain", "product", "max"} and min(accuracies.values()) > 0.9


def test_noise_is_fixed_by_key_and_trial(spark):
    df = spark.range(50).withColumn("x", F.lit(0.0))
    one = sorted(map(tuple, robustness.perturbed(df.repartition(1), ["x"], "id", 1.2, 3).collect()))
    assert one == sorted(map(tuple, robustness.perturbed(df.repartition(5), ["x"], "id", 1.2, 3).collect()))
    assert len({r[1] for r in one}) == 150 or len({r for r in one}) == 150


def test_flight_job(spark):
    rng = np.random.default_rng(2)
    n = 1500
    dep = rng.normal(5, 20, n).round()
    pdf = pd.DataFrame({"FlightId": range(n), "DepDelay": dep, "ArrDelay": dep + rng.normal(0, 5, n).round(),
                        "Distance": rng.integers(60, 400, n).astype(float)})
    for c in jobs.DELAYS[2:]:
        pdf[c] = np.where(pdf["ArrDelay"] > 15, rng.integers(0, 30, n), np.nan)
    pdf["AirTime"] = pdf["Distance"] / 8 + rng.normal(0, 2, n)
    from prepkit.operators.columns import nan_to_null

    df = nan_to_null(spark.createDataFrame(pd.concat([pdf, pdf.head(10)])))
    done = jobs.flights(df)
    assert done["distinct"].count() == n
    assert done["distance_air_time"].first()["r"] == pytest.approx(pdf["Distance"].corr(pdf["AirTime"]), abs=1e-6)
    bins = pd.cut(pdf["Distance"], bins=range(0, int(pdf["Distance"].max()) + 50, 50))
    want = pdf.groupby(bins, observed=True)["AirTime"].agg(["mean", "median", "count"])
    got = done["by_distance"].orderBy("bin").collect()
    assert [r["n"] for r in got] == list(want["count"])
    assert [r["median"] for r in got] == pytest.approx(list(want["median"]))
    assert done["pattern"].groupBy("type").count().count() == 2
    assert {r["column"]: r["q1"] >= 0 for r in done["positive_boxes"].collect()}["DepDelay"]


def test_columns_of_too_many_values_are_not_indexed(spark):
    from prepkit.operators.impute import wide_columns

    df = spark.range(2000).select(F.col("id").cast("string").alias("wide"), (F.col("id") % 3).cast("string").alias("narrow"))
    assert wide_columns(df, ["narrow"], 100) == [] == wide_columns(df, [])
    assert wide_columns(df, ["wide", "narrow"], 100) == ["wide"]
