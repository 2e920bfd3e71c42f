from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from prepkit.functions.cells import AGE_BRACKETS_COARSE, AGE_BRACKETS_FINE, bracket
from prepkit.operators import impute, scale
from prepkit.plans.rates import AGE_RATES_COARSE, AGE_RATES_FINE, SEX_RATES


def test_fits_skip_columns_without_values(spark):
    df = spark.createDataFrame([(None, 1.0), (None, None)], "a double, b double")
    assert impute.fit_means(df, ["a", "b"]) == {"b": 1.0}
    assert [tuple(r) for r in impute.mean_fill(df, ["a", "b"]).collect()] == [(None, 1.0), (None, 1.0)]


def test_mode_fill_keeps_types(spark):
    df = spark.createDataFrame([(1, "x", 2.5), (1, "x", 2.5), (None, None, None)], "a long, b string, c double")
    got = impute.mode_fill(df, ["a", "b", "c"])
    assert got.dtypes == df.dtypes and tuple(got.collect()[2]) == (1, "x", 2.5)


def test_guarded_repairs(spark):
    df = spark.createDataFrame([(120.0, 0.0), (80.0, 1.0), (None, 7.0), (140.0, None), (130.0, 1.0)], "t double, f double")
    got = impute.guarded_mean_repair(df, {"t": (100.0, None)})
    assert [r["t"] for r in got.collect()] == [120.0, 130.0, 130.0, 140.0, 130.0]
    got = impute.guarded_mode_repair(df, {"f": (None, 1.0)})
    assert [r["f"] for r in got.collect()] == [0.0, 1.0, 1.0, 1.0, 1.0]


def people(spark, n=4000):
    return spark.range(n).select(
        "id", F.lit(None).cast("double").alias("smoke"), (F.col("id") % 2).cast("double").alias("sex"),
        (F.lit(10) + F.col("id") % 80).cast("double").alias("age"),
    )


def test_chance_takes_the_larger_source_and_scales_men(spark):
    df = spark.createDataFrame([("male", 30.0), ("female", 30.0), ("male", 16.0), ("male", 10.0), ("male", None)], "sex string, age double")
    chance = impute.smoking_chance("sex", "age", AGE_BRACKETS_COARSE, AGE_RATES_COARSE, AGE_BRACKETS_FINE, AGE_RATES_FINE,
                                   SEX_RATES, fallback=0.2)
    got = [r[0] for r in df.select(chance).collect()]
    assert got == pytest.approx([0.126 * 0.131 / 0.101, 0.126, 0.016, 0.0, 0.2])


def test_bernoulli_draws_match_the_chance_and_survive_repartitioning(spark):
    df = people(spark)
    one = impute.bernoulli_impute(df.repartition(1), "smoke", F.lit(0.25), "id")
    two = impute.bernoulli_impute(df.repartition(7), "smoke", F.lit(0.25), "id")
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))
    assert abs(one.agg(F.avg("smoke")).first()[0] - 0.25) < 0.03
    assert one.schema["smoke"].dataType.simpleString() == "double"


def test_quota_is_exact_and_skips_rows_without_a_bracket(spark):
    df = people(spark).withColumn("b", bracket("age", AGE_BRACKETS_FINE)).withColumn(
        "p", impute.rate_by_bracket("age", AGE_BRACKETS_FINE, AGE_RATES_FINE))
    got = impute.quota_impute(df, "smoke", ["sex", "b"], "p", "id")
    assert got.count() == 4000
    by = got.groupBy("sex", "b", "p").agg(F.count("*").alias("n"), F.sum("smoke").alias("s"), F.count("smoke").alias("f")).collect()
    for r in by:
        if r["b"] is None:
            assert r["f"] == 0
        else:
            assert r["f"] == r["n"] and r["s"] == round(r["n"] * r["p"])


def test_minmax_constant_inverse_and_table(spark):
    df = spark.createDataFrame([(2.0, 5.0), (4.0, 5.0), (None, 5.0)], "a double, b double")
    fitted = scale.fit_minmax(df, ["a", "b"])
    assert scale.load_scalings(scale.scaling_table(spark, fitted)) == fitted
    scaled = scale.apply_minmax(df, fitted)
    assert [tuple(r) for r in scaled.collect()] == [(0.0, 0.0), (1.0, 0.0), (None, 0.0)]
    assert [tuple(r) for r in scale.invert_minmax(scaled, fitted).collect()] == [(2.0, 5.0), (4.0, 5.0), (None, 5.0)]


def test_label_codes_and_unseen(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",)], "s string")
    assert [r["s_encoded"] for r in scale.label_encode(df, ["s"]).orderBy("s").collect()] == [None, 0, 1, 1]
    many = spark.range(3000).select(F.format_string("v%05d", "id").alias("s"))
    codes = {r["value"]: r["code"] for r in scale.label_codes(many, "s").collect()}
    assert codes == {f"v{i:05d}": i for i in range(3000)}


def test_label_codes_put_nan_last(spark):
    df = spark.createDataFrame([(3.0,), (float("nan"),), (1.0,), (2.0,)], "x double")
    assert [r["x_encoded"] for r in scale.label_encode(df, ["x"]).collect()] == [2, 3, 0, 1]


def test_nan_is_a_gap_and_decimals_stay_decimals(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (3.0,)], "x double")
    assert [r["x"] for r in impute.guarded_mean_repair(df, {"x": (0, None)}).collect()] == [1.0, 2.0, 2.0, 3.0]
    assert [r["x"] for r in impute.mean_fill(df, ["x"]).collect()] == [1.0, 2.0, 2.0, 3.0]
    big = Decimal("12345678901234567.89")
    money = impute.mode_fill(spark.createDataFrame([(big,), (big,), (None,)], "m decimal(20,2)"), ["m"])
    assert [r["m"] for r in money.collect()] == [big] * 3 and money.dtypes == [("m", "decimal(20,2)")]


def test_frequency_index_equals_the_indexer(spark):
    from pyspark.ml.feature import StringIndexer

    df = spark.createDataFrame([(x,) for x in ["c", "a", "b", "b", None, "a", "d"]], "s string")
    ours = {r["s"]: r["i"] for r in scale.frequency_index(df, "s", "i").collect()}
    theirs = StringIndexer(inputCol="s", outputCol="i", handleInvalid="keep").fit(df).transform(df)
    assert ours == {r["s"]: r["i"] for r in theirs.collect()}


def test_standardise_without_spread(spark):
    df = spark.createDataFrame([(1.0, 3.0), (3.0, 3.0)], "a double, b double")
    got = scale.standardise(df, ["a", "b"], centre=True, population=True).collect()
    assert [tuple(r) for r in got] == [(-1.0, 0.0), (1.0, 0.0)]
