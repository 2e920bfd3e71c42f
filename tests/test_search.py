import math
import random

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from prepkit.plans import models, searching
from prepkit.plans.stages import FourierFeatures, scale_gamma
from prepkit.sources import stage, writers


@pytest.fixture(scope="module")
def noisy(spark):
    rng = random.Random(3)
    rows = []
    for i in range(240):
        x, y = rng.uniform(-1, 1), rng.uniform(-1, 1)
        rows.append((i, x, y, float((x + y > 0) != (rng.random() < 0.1))))
    return spark.createDataFrame(rows, "id int, x double, y double, label double")


def brute(pairs):
    """Scores of (label, prediction) pairs by their definitions."""
    n, out = len(pairs), {}
    classes = sorted({a for a, _ in pairs} | {b for _, b in pairs})
    parts = {}
    for k in classes:
        hits, said, held = (sum(t) for t in zip(*[((a == b == k), b == k, a == k) for a, b in pairs]))
        p, r = hits / said if said else 0.0, hits / held if held else 0.0
        parts[k] = (held, p, r, 2 * p * r / (p + r) if p + r else 0.0)
    out["accuracy"] = sum(a == b for a, b in pairs) / n
    for j, name in ((1, "precision"), (2, "recall"), (3, "f1")):
        out[name] = sum(v[0] * v[j] for v in parts.values()) / n
        out[f"positive_{name}"] = parts.get(1.0, (0, 0.0, 0.0, 0.0))[j]
    return out


def test_all_scores_of_all_settings_from_stored_predictions(spark, noisy):
    found = searching.score_search(
        noisy, models.feature_stages(["x", "y"]), models.classifier("Decision Tree", "label"), {"maxDepth": [0, 2, 4]}, "id", "positive_f1", 3)
    told = found.predictions.collect()
    assert sorted((r.setting, r.id) for r in told) == [(s, i) for s in range(3) for i in range(240)]
    got = {(r.setting, r.fold): r for r in found.scores.collect()}
    assert len(got) == 9
    for (s, f), r in got.items():
        want = brute([(t.label, t.prediction) for t in told if (t.setting, t.fold) == (s, f)])
        assert {m: r[m] for m in searching.MEASURES} == pytest.approx(want)
    means = {(r.setting, r.measure): r["mean"] for r in found.summary().collect()}
    assert found.best == max(range(3), key=lambda s: (means[s, "positive_f1"], -s)) and found.params == {"maxDepth": [0, 2, 4][found.best]}
    assert found.model.stages[-1].getOrDefault("maxDepth") == found.params["maxDepth"]
    # no row's prediction comes from a model that saw it: the folds are the same for every setting
    assert {r.id: r.fold for r in told if r.setting == 0} == {r.id: r.fold for r in told if r.setting == 2}


def test_ties_weights_and_no_refit(spark, noisy):
    weighted = models.with_balance(noisy, "label")
    model = models.classifier("Logistic Regression", "label", maxIter=5, weightCol="weight")
    found = searching.score_search(weighted, models.feature_stages(["x", "y"]), model, {"regParam": [0.1, 0.1]}, ["id"], None, 2)
    assert found.model is None and found.scores.count() == 4
    tied = searching.score_search(noisy, models.feature_stages(["x"]), models.classifier("Decision Tree", "label"), {"maxDepth": [0, 0]}, "id", "accuracy", 2)
    assert tied.best == 0
    with pytest.raises(ValueError):
        searching.score_search(noisy, [], model, {}, "id", "loss")


def test_kernel_features_are_near_the_kernel_and_persist(spark, tmp_path):
    rng = np.random.default_rng(0)
    points = rng.normal(size=(30, 3))
    df = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(points)], "id int, a double, b double, c double")
    n, gamma = 3000, 0.3
    made = Pipeline(stages=models.kernel_stages(["a", "b", "c"], gamma, n, seed=5)).fit(df)
    made.write().overwrite().save(str(tmp_path / "kernel"))
    for stages in (made, PipelineModel.load(str(tmp_path / "kernel"))):
        z = np.array([r.z for r in stages.transform(df).orderBy("id").select(vector_to_array("features").alias("z")).collect()])
        want = np.exp(-gamma * ((points[:, None] - points[None]) ** 2).sum(-1))
        assert np.abs(z @ z.T - want).max() < 5 / math.sqrt(n)
    assert FourierFeatures(inputCols=["a"], seed=1).draws() == FourierFeatures(inputCols=["a"], seed=1).draws()
    assert scale_gamma(df, ["a", "b", "c"]) == pytest.approx(1 / (3 * points.var()))
    assert scale_gamma(df.select(F.lit(2.0).alias("a")), ["a"]) == 1.0
    with pytest.raises(Exception, match="missing cell"):
        FourierFeatures(inputCols=["a"], numFeatures=2).transform(spark.createDataFrame([(None,)], "a double")).collect()


def test_a_kernel_machine_separates_what_a_line_cannot(spark):
    rng = random.Random(1)
    rows = []
    for i in range(400):
        angle, far = rng.uniform(0, 2 * math.pi), rng.choice([0.3, 1.0])
        rows.append((i, far * math.cos(angle), far * math.sin(angle), float(far < 0.5)))
    df = spark.createDataFrame(rows, "id int, x double, y double, label double")
    machine = models.classifier("Linear SVM", "label", regParam=1e-3, maxIter=25)
    right = {}
    for name, stages in (("line", models.feature_stages(["x", "y"])), ("kernel", models.kernel_stages(["x", "y"], scale_gamma(df, ["x", "y"]), 64))):
        right[name] = models.train(df, stages, machine).transform(df).where("prediction = label").count()
    assert right["kernel"] == 400 > right["line"] + 100


@pytest.fixture
def schema(spark, tmp_path):
    name = f"published_{random.randrange(10**9)}"
    writers.reset_schema(spark, name, str(tmp_path / name))
    yield name
    spark.sql(f"DROP SCHEMA {name} CASCADE")


def test_a_failed_step_changes_nothing(spark, schema):
    a, b = f"{schema}.a", f"{schema}.b"
    stage.publish(spark, {a: spark.range(5), b: spark.range(3)})
    before = stage.version_of(spark, a), stage.version_of(spark, b)
    tables = {t.name for t in spark.catalog.listTables(schema)}
    broken = spark.range(4).select(F.when(F.col("id") < 3, F.col("id")).otherwise(F.raise_error(F.lit("midway"))).alias("id"))
    with pytest.raises(Exception, match="midway"):
        stage.stage_published(spark, a, lambda df: {a: df.limit(1), b: broken})
    with pytest.raises(ValueError, match="check"):
        stage.stage_published(spark, [a, b], lambda dfs: {b: dfs[0], a: dfs[1]}, {a: lambda df: df.count() > 4})
    assert (stage.version_of(spark, a), stage.version_of(spark, b)) == before
    assert {t.name for t in spark.catalog.listTables(schema)} == tables  # nothing is left lying about
    assert spark.table(a).count() == 5 and spark.table(b).count() == 3


def test_readers_of_the_last_version_finish(spark, schema):
    name = f"{schema}.kept"
    stage.publish(spark, {name: spark.range(5)})
    reading = spark.table(name)
    stage.stage_published(spark, name, lambda df: {name: df.where("id > 2")})
    assert reading.count() == 5 and spark.table(name).count() == 2
    stage.stage_published(spark, name, lambda df: {name: df.withColumn("x y", F.lit(1))})
    assert spark.table(name).columns == ["id", "x y"] and len(spark.catalog.listTables(schema)) == 3
    stage.publish(spark, {name: spark.range(1)}, keep_last=False)
    assert len(spark.catalog.listTables(schema)) == 2 and spark.table(name).count() == 1


def test_a_plain_table_is_not_published_over(spark, schema):
    writers.write_table(spark.range(2), f"{schema}.plain")
    with pytest.raises(ValueError, match="plain"):
        stage.publish(spark, {f"{schema}.plain": spark.range(1)})
    assert stage.version_of(spark, f"{schema}.plain") is None and stage.version_of(spark, f"{schema}.none") is None


def test_kernel_features_are_made_in_parts(spark, monkeypatch):
    from prepkit.plans import stages

    monkeypatch.setattr(stages, "FEATURE_CELLS", 12)
    df = spark.range(50).select("id", (F.col("id") / 7).alias("a"), (10 - F.col("id")).cast("int").alias("b")).repartition(3)
    stage = FourierFeatures(inputCols=["a", "b"], outputCol="z", numFeatures=5, gamma=0.2, seed=3)
    for r in stage.transform(df).collect():
        want = [math.sqrt(2 / 5) * math.cos(u * r.a + v * r.b + w) for u, v, w in stage.draws()]
        assert list(r.z) == pytest.approx(want, abs=1e-12)


def test_kernel_features_are_made_after_the_join(spark, tmp_path):
    from prepkit.queries.closed_forms import kernel_of_neighbours

    rows = [(i, i % 5, 100.0 * (i % 7)) for i in range(40) if i != 20] + [(3, 1, 50.0)]
    spark.createDataFrame(rows, "c_custkey long, c_nationkey int, c_acctbal double").write.parquet(str(tmp_path / "customer.parquet"))
    found = kernel_of_neighbours(spark, str(tmp_path))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    # no vector is below the join, so none is shuffled or broadcast
    above, below = plan.split("Join Inner", 1)
    assert "UDF" in above and "UDF" not in below
    want = [(i, round(math.exp(-0.5 * (((u - v) / 5000) ** 2 + ((m - n) / 10) ** 2)), 6), True)
            for i, m, u in rows for j, n, v in rows if j == i + 1]
    assert sorted(map(tuple, found.collect())) == sorted(want)
