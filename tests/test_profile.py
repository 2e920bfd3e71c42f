import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from prepkit.operators import profile
from prepkit.operators.columns import nan_to_null

PROBS = [0.0, 0.25, 0.5, 0.9, 1.0]


def by_column(df):
    return {r["column"]: r.asDict() for r in df.collect()}


def test_missing_counts_include_nan_of_floats_only(spark):
    df = spark.createDataFrame([(1.0, "NaN"), (float("nan"), None), (None, "x")], "a double, b string")
    assert {c: r["n_missing"] for c, r in by_column(profile.missing_counts(df)).items()} == {"a": 2, "b": 1}


def test_modes_ignore_nulls_and_take_the_smallest_of_ties(spark):
    data = [(None, 10, "b"), (None, 9, "a"), (None, 10, "a"), (3.0, 9, "b"), (None, 2, None)]
    df = spark.createDataFrame(data, "a double, b int, c string")
    assert {c: r["mode"] for c, r in by_column(profile.modes(df, ["a", "b", "c"])).items()} == {"a": "3.0", "b": "9", "c": "a"}


def test_modes_of_an_empty_column_are_absent(spark):
    df = spark.createDataFrame([(None, 1)], "a int, b int")
    assert set(by_column(profile.modes(df, ["a", "b"]))) == {"b"}


def test_quantiles_of_empty_and_constant_columns(spark):
    df = spark.createDataFrame([(None, 5.0), (None, 5.0)], "a double, b double")
    assert profile.quantiles(df, ["a", "b"], [0.5]) == {"a": [None], "b": [5.0]}


def test_narrowed_quantiles_are_exact_with_a_hot_value(spark):
    rng = np.random.default_rng(3)
    xs = np.concatenate([np.full(4000, 7.0), rng.normal(7, 3, 8000).round(3), rng.lognormal(0, 2, 500)])
    df = spark.createDataFrame(pd.DataFrame({"x": rng.permutation(xs)}))
    found = profile.quantiles(df, ["x"], PROBS, buffer_values=5, gathered_values=20, accuracy=50)["x"]
    assert found == pytest.approx(list(np.quantile(xs, PROBS)), abs=1e-12)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-5, 5).map(float) | st.floats(-1e6, 1e6), min_size=1, max_size=60), st.floats(0, 1))
def test_narrowed_quantiles_equal_numpy(spark, xs, p):
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    found = profile.quantiles(df, ["x"], [p], buffer_values=1, gathered_values=3, accuracy=10)["x"][0]
    assert found == pytest.approx(float(np.quantile(xs, p)), rel=1e-9, abs=1e-9)


def test_group_quantiles_agree_on_both_ways(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"g": rng.choice(["hot", "b", None], 6000, p=[0.7, 0.2, 0.1]), "x": rng.normal(0, 1, 6000).round(2)})
    df = spark.createDataFrame(pdf)
    small = {(r["g"], r["prob"]): r["value"] for r in profile.group_quantiles(df, ["g"], "x", PROBS).collect()}
    for limit in (5, 320):
        large = {(r["g"], r["prob"]): r["value"] for r in profile.group_quantiles(df, ["g"], "x", PROBS, limit).collect()}
        assert small.keys() == large.keys() and len(small) == 15
        assert all(large[k] == pytest.approx(v, abs=1e-12) for k, v in small.items())


def test_approximate_figures_are_near(spark):
    df = spark.range(10_000).select((F.col("id") % 1000).cast("double").alias("x"))
    got = {r["prob"]: r["value"] for r in profile.quantile_table(df, ["x"], [0.1, 0.5], approximate=True).collect()}
    assert got[0.1] == pytest.approx(100, abs=3) and got[0.5] == pytest.approx(500, abs=3)
    assert abs(profile.count_distinct(df, ["x"], approximate=True).first()["n_distinct"] - 1000) < 200


def test_describe_equals_pandas(spark):
    pdf = pd.DataFrame({"a": [1.0, 2.0, 4.0, 8.0, None], "b": [3, 1, 2, 5, 9]})
    found = by_column(profile.describe(nan_to_null(spark.createDataFrame(pdf)), ["a", "b"]))
    for c in ("a", "b"):
        want = pdf[c].describe()
        got = found[c]
        names = {"n": "count", "mean": "mean", "std": "std", "min": "min", "q25": "25%", "q50": "50%", "q75": "75%", "max": "max"}
        assert {k: got[k] for k in names} == pytest.approx({k: want[v] for k, v in names.items()})


def test_corr_matrix_is_pairwise_complete(spark):
    pdf = pd.DataFrame({"a": [1.0, 2, 3, None, 9], "b": [2.0, 1, None, 4, 7], "c": [1.0, 0, -1, 2, 5]})
    found = {(r["col_a"], r["col_b"]): r["r"] for r in profile.corr_matrix(nan_to_null(spark.createDataFrame(pdf)), list("abc")).collect()}
    want = pdf.corr()
    assert found == pytest.approx({(a, b): want.loc[a, b] for a, b in (("a", "b"), ("a", "c"), ("b", "c"))})


def test_binned_stats_equal_pandas(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"g": rng.integers(0, 4, 400), "x": rng.gamma(2.0, 2.0, 400)})
    pdf.loc[len(pdf)] = [99, 1.0]
    found = {r["g"]: r for r in profile.binned_stats(spark.createDataFrame(pdf), ["g"], "x").collect()}
    want = pdf.groupby("g")["x"].agg(["mean", "median", "std", "skew", "count"])
    for g, w in want.iterrows():
        assert found[g]["n"] == w["count"] and found[g]["mean"] == pytest.approx(w["mean"])
        assert found[g]["median"] == pytest.approx(w["median"])
        if w["count"] > 2:
            assert found[g]["std"] == pytest.approx(w["std"]) and found[g]["skew"] == pytest.approx(w["skew"])
        else:
            assert found[g]["skew"] is None


def test_histogram_counts_every_value_and_closes_the_last_bin(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (9.99,), (10.0,), (None,)], "x double")
    found = {r["bin"]: r["n"] for r in profile.histogram(df, "x", 10).collect()}
    assert found == {**dict.fromkeys(range(10), 0), 0: 1, 1: 1, 9: 2}
    flat = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    assert {r["bin"]: r["n"] for r in profile.histogram(flat, "x", 10).collect()} == {**dict.fromkeys(range(10), 0), 0: 2}
    assert profile.histogram(df.where("x > 99"), "x").collect() == []


def test_infinities_and_negative_zero(spark):
    ends = spark.createDataFrame([(float("inf"),), (float("inf"),), (float("-inf"),), (1.0,)], "x double")
    want = ends.agg(F.percentile("x", F.array(*[F.lit(p) for p in (0.0, 0.2, 0.5, 0.9, 1.0)]))).first()[0]
    for ways in ({}, {"buffer_values": 0, "gathered_values": 0}):
        assert profile.quantiles(ends, ["x"], [0.0, 0.2, 0.5, 0.9, 1.0], **ways)["x"] == want
    zeros = spark.createDataFrame([(0.0,), (-0.0,), (1.0,)], "x double")
    assert profile.count_distinct(zeros, ["x"]).first()["n_distinct"] == 2
    assert profile.value_counts(zeros, ["x"]).count() == 2


def test_density_integrates_to_about_one(spark):
    df = spark.range(4000).select((F.col("id") % 97).cast("double").alias("x"))
    found = sorted((r["x"], r["density"]) for r in profile.density(df, "x", points=80).collect())
    xs, ys = zip(*found)
    assert 0.85 < np.trapezoid(ys, xs) < 1.01


def test_box_summary_whiskers_and_outliers(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 3, 4, 5, 100]], "x double")
    r = profile.box_summary(df, ["x"]).first()
    assert (r["q1"], r["median"], r["q3"]) == (2.25, 3.5, 4.75)
    assert (r["whisker_lo"], r["whisker_hi"], r["n_outliers"]) == (1.0, 5.0, 1)
    g = profile.box_by_group(df.withColumn("g", F.lit("a")), ["g"], "x").first()
    assert (g["q1"], g["whisker_hi"], g["n_outliers"]) == (2.25, 5.0, 1)


def test_normality_tells_bell_from_flat(spark):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({"g": ["bell"] * 800 + ["skewed"] * 800 + ["few"] * 10,
                        "x": np.concatenate([rng.normal(0, 1, 800), rng.exponential(1, 800), np.ones(10)])})
    found = {r["g"]: r["normal"] for r in profile.normality(spark.createDataFrame(pdf), ["g"], "x").collect()}
    assert found == {"bell": True, "skewed": False}


def test_word_counts_keep_empty_tokens(spark):
    df = spark.createDataFrame([("to be or not",), ("to be  be",)], "line string")
    assert {r["token"]: r["n"] for r in profile.word_counts(df, "line", 2).collect()} == {"to": 2, "be": 3}


def test_empty_table(spark):
    df = spark.createDataFrame([], "a double, b string")
    assert [r["n_missing"] for r in profile.missing_counts(df).collect()] == [0, 0]
    assert profile.value_counts(df, ["b"]).collect() == []
    assert profile.describe(df, ["a"]).first()["n"] == 0


def test_figures_of_groups_are_counted_and_read_from_a_copy(spark, monkeypatch):
    from prepkit.operators import shapes

    sides = []
    for module in (profile, shapes):
        monkeypatch.setattr(module, "bounded", lambda df, *_: sides.append(df) or df)
    df = spark.range(3000).select((F.col("id") % 3).alias("g"), (F.col("id") * 7 % 1000 * 1.0).alias("v"))
    assert profile.box_by_group(df, ["g"], "v").count() == 3
    assert shapes.rank_normality(df, ["g"], "v").count() == 3
    assert shapes.density_by_group(df, ["g"], "v", points=5).count() == 15
    # what decides on broadcasting does not work the groups out a second time
    assert len(sides) == 4 and all(s.inputFiles() and "Aggregate" not in s._jdf.queryExecution().optimizedPlan().toString() for s in sides)
