import pytest
from pyspark.sql import functions as F

from prepkit.operators import impute, profile, rows, scale

NAN = float("nan")


@pytest.fixture(scope="module")
def both(spark):
    """The same rows with NaN and with NULL in their gaps."""
    made = [(i, "ab"[i % 2], float(i * i % 17), NAN if i % 4 == 0 else float(i % 5), float(i % 3) if i % 6 else NAN) for i in range(120)]
    null = [tuple(None if x != x else x for x in r) for r in made]
    names = "id int, g string, full double, x double, y double"
    return spark.createDataFrame(made, names), spark.createDataFrame(null, names)


def columns(df):
    return df.select("full", "x", "y")


WORK = {
    "value_counts": lambda df: profile.value_counts(df, ["x", "y"]),
    "count_distinct": lambda df: profile.count_distinct(df, ["x", "y"]),
    "approximate": lambda df: profile.count_distinct(df, ["x", "y"], approximate=True),
    "group_mean": lambda df: profile.group_mean(df, ["g"], "x", "m"),
    "grouped_by_gaps": lambda df: profile.group_mean(df, ["y"], "x", "m"),
    "group_modes": lambda df: profile.group_modes(df, ["g"], "x"),
    "approximate_quantiles": lambda df: profile.quantile_table(df, ["x"], [0.5], approximate=True),
    "corr_matrix": lambda df: profile.corr_matrix(df, ["full", "x", "y"]),
    "corr_above": lambda df: profile.corr_matrix(df, ["full", "x"], above=0.0),
    "skew_kurtosis": lambda df: profile.skew_kurtosis(df, ["x", "y"]),
    "binned_stats": lambda df: profile.binned_stats(df, ["g"], "x"),
    "normality": lambda df: profile.normality(df, ["g"], "x", more_than=10),
    "density": lambda df: profile.density(df, "x", points=5),
    "histogram": lambda df: profile.histogram(df, "x", 5),
    "box_summary": lambda df: profile.box_summary(df, ["x", "y"]),
    "box_positive": lambda df: profile.box_summary(df, ["x", "y"], positive_only=True),
    "box_by_group": lambda df: profile.box_by_group(df, ["g"], "x"),
    "best_row": lambda df: profile.best_row(df, "x", "id"),
    "top_rows": lambda df: rows.top_rows(df, "x", 3, ["id"]),
    "split_by_null_pattern": lambda df: rows.split_by_null_pattern(df, "x", "y", ("b", "x", "y")),
    "zscore_filter": lambda df: rows.zscore_filter(df, ["x", "y"], 1.0),
    "zscore_sequential": lambda df: rows.zscore_filter(df, ["x", "y"], 1.0, mode="sequential"),
    "iqr_mask": lambda df: rows.iqr_mask(df, ["x"], 0.1),
    "mask": lambda df: rows.mask(df, ["x"], lambda c: c > 1),
    "drop_nulls": lambda df: rows.drop_nulls(df),
    "sparse": lambda df: rows.drop_sparse_rows(df, 0.4),
    "minmax": lambda df: scale.apply_minmax(df, scale.fit_minmax(df, ["x", "y"])),
    "standardise": lambda df: scale.standardise(df, ["x"], centre=True),
    "frequency_index": lambda df: scale.frequency_index(df, "x", "place"),
    "bernoulli": lambda df: impute.bernoulli_impute(df, "x", F.lit(0.5), "id"),
    "quota": lambda df: impute.quota_impute(df.withColumn("c", F.lit(0.5)), "x", ["g"], "c", "id"),
    "mean_fill": lambda df: impute.mean_fill(df, ["x", "y"]),
    "mode_fill": lambda df: impute.mode_fill(df, ["x"]),
}


@pytest.mark.parametrize("name", WORK)
def test_nan_counts_as_null(both, name):
    nan, null = (sorted(map(tuple, WORK[name](df).collect()), key=str) for df in both)
    assert nan == null and not any(v != v for r in nan for v in r)


def test_gaps_do_not_spoil_figures(both):
    nan, _ = both
    assert rows.zscore_filter(nan, ["x"]).count() == 90
    assert scale.fit_minmax(nan, ["x"])[0].data_max == 4.0
    assert profile.normality(nan, ["g"], "x", more_than=10).where("p IS NULL").count() == 0


@pytest.mark.parametrize("few", [True, False])
def test_labels_of_several_types_in_one_pass(spark, monkeypatch, few):
    monkeypatch.setattr(scale, "BROADCAST_ROWS", 50_000 if few else 0)
    df = spark.createDataFrame([(i % 4, "dcba"[i % 4], float(i % 3), None if i % 2 else "z") for i in range(40)], "a int, b string, c double, d string")
    got = scale.label_encode(df, ["b", "a", "c", "d"]).distinct().collect()
    assert all(r.a_encoded == r.a and r.b_encoded == "abcd".index(r.b) and r.c_encoded == r.c and r.d_encoded == (0 if r.d else None) for r in got)
    assert scale.label_encode(df.limit(0), ["a", "b"]).collect() == []
