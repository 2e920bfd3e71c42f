import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from prepkit.functions.chance import unit
from prepkit.operators import columns, lookup, ranking, rows, split


def skewed(spark, n=5000):
    """Two thirds of the rows in one group, and a NULL group."""
    group = F.when(F.col("id") % 3 != 0, "hot").when(F.col("id") % 5 == 0, None).otherwise((F.col("id") % 7).cast("string"))
    return spark.range(n).withColumn("g", group)


@pytest.mark.parametrize("reach", [0.0, 0.3, 8.0])
def test_blocks_equal_the_plain_window(spark, reach):
    df = skewed(spark)
    w = Window.partitionBy("g")
    k = F.floor((F.row_number().over(w.orderBy(unit("id", 9), "id")) - 1) * 4 / F.count("*").over(w))
    want = {r["id"]: r["k"] for r in df.withColumn("k", k).collect()}
    ends = [F.ceil(F.col("n") * i / 4) for i in (1, 2, 3)]
    assert {r["id"]: r["block"] for r in ranking.hash_blocks(df, ["g"], ends, "id", 9, reach=reach).collect()} == want


def test_smallest_marked_equals_the_plain_window(spark):
    df = skewed(spark)
    w = Window.partitionBy("g")
    picked = F.row_number().over(w.orderBy(unit("id", 9), "id")) <= F.bround(F.count("*").over(w) * 0.13, 0)
    want = {r["id"]: r["k"] for r in df.withColumn("k", picked).collect()}
    for reach in (0.0, 0.5, 8.0):
        got = ranking.smallest_marked(df, ["g"], F.bround(F.col("n") * 0.13, 0), "id", 9, reach=reach)
        assert {r["id"]: r["picked"] for r in got.collect()} == want


def test_blocks_of_more_groups_than_are_broadcast(spark, monkeypatch):
    """The bands are joined instead, and nothing else changes; a column named n is kept."""
    df = skewed(spark).withColumn("n", F.col("id") * 2)
    ends = [F.ceil(F.col("n") * i / 3) for i in (1, 2)]
    want = {r["id"]: (r["n"], r["block"]) for r in ranking.hash_blocks(df, ["g"], ends, "id", 9).collect()}
    monkeypatch.setattr(ranking, "bounded", lambda df: df)
    got = ranking.hash_blocks(df, ["g"], ends, "id", 9)
    assert got.columns == ["id", "g", "n", "block"]
    assert {r["id"]: (r["n"], r["block"]) for r in got.collect()} == want


def test_missing_keys_lose_no_rows(spark):
    """Rows without a key are drawn, split and sampled like the others."""
    df = spark.range(1000).withColumn("k", F.when(F.col("id") % 10 != 0, F.col("id"))).withColumn("g", F.col("id") % 3)
    parts = split.random_split(df, [0.8, 0.2], "k")
    assert sum(p.count() for p in parts) == 1000
    assert split.with_part(df, "g", "k").count() == 1000
    assert split.with_folds(df, "k").where("fold IS NULL").count() == 0
    assert split.with_folds(df, "k", label="g").groupBy("fold").count().count() == 5
    assert rows.sample_per_group(df, ["g"], 400, "k").count() == 1000
    both = split.with_folds(df, ["k", "g"]).where("k IS NULL").select("fold").distinct().count()
    assert both > 1


def test_running_totals_equal_the_plain_window(spark):
    df = skewed(spark).withColumn("v", (F.col("id") * 37 % 1013)).groupBy("g", "v").agg(F.count("*").alias("n"))
    w = Window.partitionBy("g")
    plain = df.withColumn("b", F.sum("n").over(w.orderBy("v")) - F.col("n")).withColumn("t", F.sum("n").over(w))
    want = {(r["g"], r["v"]): (r["b"], r["t"]) for r in plain.collect()}
    got = ranking.running_totals(df, "v", "n", ["g"])
    assert {(r["g"], r["v"]): (r["before"], r["whole"]) for r in got.collect()} == want


def test_sequential_zscore_uses_the_rows_left(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"a": rng.normal(0, 1, 300), "b": rng.normal(0, 1, 300), "c": 1.0})
    pdf.loc[0, ["a", "b"]] = [50.0, 40.0]
    pdf.loc[1, "b"] = 6.0
    want = pdf
    for c in ("a", "b"):
        want = want[(want[c] - want[c].mean()).abs() / want[c].std() - 3 < 0.01]
    df = spark.createDataFrame(pdf)
    got = rows.zscore_filter(df, ["a", "b", "c"], mode="sequential").toPandas()
    assert sorted(got["a"]) == pytest.approx(sorted(want["a"]))
    both = pdf[((pdf.a - pdf.a.mean()).abs() / pdf.a.std() - 3 < 0.01) & ((pdf.b - pdf.b.mean()).abs() / pdf.b.std() - 3 < 0.01)]
    assert rows.zscore_filter(df, ["a", "b", "c"]).count() == len(both)
    with pytest.raises(ValueError):
        rows.zscore_filter(df, ["a"], mode="other")


def test_iqr_mask_keeps_rows_and_nulls(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,), (100.0,), (None,)], "x double")
    assert sorted(r["x"] or 0 for r in rows.iqr_mask(df, ["x"]).collect()) == [0, 0, 1, 2, 3, 4]


def test_sparse_rows_at_the_threshold(spark):
    df = spark.createDataFrame([(1, None, None), (1, 2, None), (None, None, None)], "a int, b int, c int")
    assert rows.drop_sparse_rows(df, 2 / 3).count() == 1
    assert rows.drop_sparse_rows(df, 2 / 3, inclusive=True).count() == 2


def test_null_columns_and_null_patterns(spark):
    df = spark.createDataFrame([(1, 1.0, None), (2, None, 3.0), (3, None, None)], "k int, a double, b double")
    assert rows.drop_null_columns(df).columns == ["k"]
    got = rows.split_by_null_pattern(df, "a", "b", ("both", "a", "b"))
    assert sorted(map(tuple, got.collect())) == [(1, 1.0, 0.0, "a"), (2, 0.0, 3.0, "b")]


def test_first_per_key_follows_the_order(spark):
    df = spark.createDataFrame([("a", 2, None), ("a", 1, "x"), ("b", 5, "y"), (None, 1, "z")], "k string, o int, v string")
    got = rows.first_per_key(df.repartition(3), ["k"], ["o"])
    assert {r["k"]: (r["o"], r["v"]) for r in got.collect()} == {"a": (1, "x"), "b": (5, "y"), None: (1, "z")}


def test_samples_survive_repartitioning(spark):
    df = skewed(spark)
    one = {r["id"] for r in rows.sample_fraction(df.repartition(1), 0.1, "id").collect()}
    assert one == {r["id"] for r in rows.sample_fraction(df.repartition(7), 0.1, "id").collect()} and 380 < len(one) < 620
    sizes = {r["g"]: r["n"] for r in rows.sample_per_group(df, ["g"], 50, "id").groupBy("g").agg(F.count("*").alias("n")).collect()}
    whole = {r["g"]: r["n"] for r in df.groupBy("g").agg(F.count("*").alias("n")).collect()}
    assert sizes == {g: min(n, 50) for g, n in whole.items()}


def test_large_groups(spark):
    df = skewed(spark, 300)
    assert {r["g"] for r in rows.rows_in_large_groups(df, ["g"], 100).collect()} == {"hot"}


def test_union_fills_missing_columns(spark):
    got = rows.union_by_name(spark.createDataFrame([(1, "a")], "x int, y string"), spark.createDataFrame([(2,)], "x int"))
    assert sorted(map(tuple, got.collect())) == [(1, "a"), (2, None)]


def test_top_rows_settle_ties(spark):
    df = spark.createDataFrame([("b", 3.0), ("a", 3.0), ("c", None)], "k string, v double")
    assert rows.top_rows(df, "v", 1, ["k"]).first()["k"] == "a"


@pytest.mark.parametrize("limit", [1, 1000])
def test_outer_join_keeps_both_sides(spark, monkeypatch, limit):
    whole = lookup.bounded
    monkeypatch.setattr(lookup, "bounded", lambda df, **kw: whole(df, limit, **kw))
    left = spark.createDataFrame([(1, "a"), (2, "a"), (3, "z"), (4, None)], "id int, k string")
    ref = spark.createDataFrame([("a", 1.0), ("q", 2.0), (None, 3.0)], "r string, v double")
    got = lookup.outer_join_reference(left, ref, "k", "r")
    want = left.join(ref, left.k == ref.r, "outer")
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_size_check_counts_rows_and_bytes(spark):
    df = spark.range(10).withColumn("t", F.repeat(F.lit("x"), 1000))
    assert lookup.small(df, 9) is None and lookup.small(df, 10).count() == 10
    assert lookup.small(df, 10, 5_000) is None and lookup.small(df, 10, 50_000).count() == 10


def test_join_keep_left_and_lookup_default(spark):
    left = spark.createDataFrame([(1, "l"), (2, "l")], "id int, v string")
    right = spark.createDataFrame([(1, "r", 9)], "id int, v string, w int")
    assert [tuple(r) for r in lookup.join_keep_left(left, right, "id").collect()] == [(1, "l", 9)]
    got = lookup.lookup_default(left, right, "id", "id", "w", "w", 0)
    assert {r["id"]: r["w"] for r in got.collect()} == {1: 9, 2: 0}


def test_attach_scalars_needs_one_row(spark):
    df = spark.range(3)
    one = spark.createDataFrame([(1.5, None)], "m double, s string")
    got = lookup.attach_scalars(df, one)
    assert got.schema["s"].dataType.simpleString() == "string" and {r["m"] for r in got.collect()} == {1.5}
    with pytest.raises(ValueError):
        lookup.attach_scalars(df, df)


def test_columns_by_kind_and_roles(spark):
    df = spark.createDataFrame([(1, 2.0, "x", 3, True)], "id long, a double, s string, y int, flag boolean")
    assert columns.columns_of(df, "numeric", ["id"]) == ["a", "y"]
    assert columns.columns_of(df, "float") == ["a"] and columns.columns_of(df, "integer") == ["id", "y"]
    assert columns.Roles.of(df, "y", ["id"]).features == ["a", "s"]


def test_products_do_not_overflow(spark):
    df = spark.createDataFrame([(2_000_000_000, 3)], "a int, b int")
    r = columns.with_pairwise_products(df, ["a", "b"], with_self=True).first()
    assert r["a_x_a"] == 4e18 and r["a_x_b"] == 6e9 and r["b_x_b"] == 9.0


def test_names_casts_and_strict_drop(spark):
    df = spark.createDataFrame([(-1.9, " x ", float("nan"))], '`"a"` double, s string, n double')
    clean = columns.clean_names(df)
    assert clean.columns == ["a", "s", "n"]
    assert columns.nan_to_null(clean).first()["n"] is None
    got = columns.trim_strings(columns.cast_columns(clean.drop("n"), "float", "int")).first()
    assert tuple(got) == (-1, "x")
    assert columns.drop_if_present(clean, ["s", "absent"]).columns == ["a", "n"]
    with pytest.raises(ValueError):
        columns.drop_if_present(clean, ["absent"], strict=True)


def test_surrogate_keys_stay_the_same(spark):
    keyed = columns.add_key(spark.range(100).repartition(5))
    assert sorted(map(tuple, keyed.collect())) == sorted(map(tuple, keyed.collect()))
    assert keyed.select("id").distinct().count() == 100


def test_splits_are_disjoint_and_complete(spark):
    df = skewed(spark)
    parts = split.random_split(df, [0.6, 0.3, 0.1], "id")
    ids = [{r["id"] for r in p.collect()} for p in parts]
    assert sum(map(len, ids)) == 5000 and len(set().union(*ids)) == 5000
    again = split.random_split(parts[0], [0.5, 0.5], "id", seed=43)
    assert all(p.count() > 1000 for p in again)


def test_stratified_parts_are_exact(spark):
    df = skewed(spark)
    got = split.with_part(df, "g", "id", 0.1).groupBy("g").agg(F.count("*").alias("n"), F.count_if(F.col("part") == "test").alias("t"))
    assert all(r["t"] == round(r["n"] * 0.1) for r in got.collect())


def test_empty_tables_split_into_empty_parts(spark):
    df = skewed(spark).where("id < 0")
    assert split.with_part(df, "g", "id").count() == 0 and split.with_folds(df, "id", 3, "g").count() == 0
    assert rows.sample_per_group(df, ["g"], 5, "id").count() == 0


def test_folds_are_balanced_per_label(spark):
    got = split.with_folds(skewed(spark).repartition(7), "id", 5, "g").groupBy("g", "fold").count().toPandas()
    for _, counts in got.groupby("g", dropna=False)["count"]:
        assert counts.max() - counts.min() <= 1
