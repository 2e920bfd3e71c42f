import math
import random
from statistics import NormalDist

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from prepkit.operators import gram, profile, shapes, sketches
from prepkit.sources.frozen import frozen


@pytest.fixture(scope="module")
def gapped(spark):
    """Columns far from zero, each with gaps of its own, NULL or NaN; one constant, one empty, one of two values."""
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({f"c{k}": 1e7 + rng.normal(size=400) * (k + 1) + (np.arange(400) % 7) * (k % 3) for k in range(9)})
    for k in range(9):
        pdf.loc[pdf.index % (k + 4) == 0, f"c{k}"] = np.nan
    pdf["same"], pdf["none"], pdf["two"] = 5.0, np.nan, [1.0, 2.0] + [np.nan] * 398
    return pdf, spark.createDataFrame(pdf.astype(object).where(pdf.notna() | (pdf.index % 2 == 0).reshape(-1, 1), None).values.tolist(),
                                      ", ".join(f"{c} double" for c in pdf.columns))


def test_gram_equals_pairwise_correlations(gapped):
    pdf, df = gapped
    want = pdf.corr()
    got = {(r.col_a, r.col_b): r for r in gram.gram_correlations(df.repartition(5), list(pdf.columns)).collect()}
    assert len(got) == 12 * 11 // 2
    plain = {(r.col_a, r.col_b): r for r in profile.corr_matrix(df, list(pdf.columns)).collect()}
    for (a, b), r in got.items():
        n = (pdf[a].notna() & pdf[b].notna()).sum()
        assert r.n == n == plain[a, b].n
        if {a, b} & {"same", "none"}:
            assert r.r is None
        elif n > 1:
            assert r.r == pytest.approx(want.loc[a, b], abs=1e-6) == pytest.approx(plain[a, b].r, abs=1e-6)


def test_five_hundred_columns_in_one_pass(spark):
    names = [f"v{k}" for k in range(500)]
    df = spark.range(120).select(*[F.when((F.col("id") + k) % 11 > 0, F.sin(F.col("id") * (k + 1))).alias(c) for k, c in enumerate(names)])
    found = profile.corr_matrix(df, names)
    assert found._jdf.queryExecution().executedPlan().toString().count("MapInArrow") >= 1
    got = {(r.col_a, r.col_b): r.r for r in found.collect()}
    want = df.toPandas().corr()
    assert len(got) == 500 * 499 // 2
    assert all(abs(got[names[i], names[i + 7]] - want.iloc[i, i + 7]) < 1e-9 for i in range(0, 490, 30))
    assert all(r.r is None and r.n == 0 for r in gram.gram_correlations(df.limit(0), names[:3]).collect())


def test_merged_sketches_equal_the_whole_within_their_error(spark):
    rng = random.Random(2)
    rows = [(f"p{i % 5}", rng.gauss(10, 3) if i % 9 else None, float(i % 700) if i % 4 else float("nan")) for i in range(8000)]
    df = spark.createDataFrame(rows, "p string, x double, y double")
    parts = frozen(sketches.sketched(df, ["x", "y"], F.col("p")), "parts")
    late = sketches.sketched(spark.createDataFrame([("new", 99.0, None)], df.schema), ["x", "y"], "new")
    whole = sketches.merged(parts.unionByName(late), "all")
    again = sketches.merged(sketches.merged(parts).unionByName(late), "all")
    for found in (whole, again):
        for r in sketches.estimates(found, [0.0, 0.25, 0.5, 1.0]).collect():
            values = sorted(v[1 if r.column == "x" else 2] for v in [*rows, ("", 99.0, None)] if (u := v[1 if r.column == "x" else 2]) is not None and u == u)
            assert (r.part, r.n, r.n_missing) == ("all", len(values), 8001 - len(values))
            assert r["mean"] == pytest.approx(sum(values) / len(values)) and (r.least, r.most) == (values[0], values[-1])
            assert abs(r.n_distinct - len(set(values))) <= sketches.DISTINCT_ERROR * len(set(values))
            for q in r.quantiles:
                low, high = sum(v < q.value for v in values) / len(values), sum(v <= q.value for v in values) / len(values)
                assert low - sketches.RANK_ERROR <= q.prob <= high + sketches.RANK_ERROR
    assert parts.count() == 10


def test_sketches_of_nothing(spark):
    empty = spark.createDataFrame([], "x double")
    none = sketches.sketched(empty, ["x"], "none")
    (r,) = sketches.estimates(none, [0.5]).collect()
    assert (r.n, r.n_distinct, r["mean"], r.quantiles) == (0, 0, None, None)
    both = sketches.merged(none.unionByName(sketches.sketched(spark.createDataFrame([(3.0,)], "x double"), ["x"], "one")))
    (r,) = sketches.estimates(both, [0.5]).collect()
    assert (r.n, r.n_distinct, r.quantiles[0].value) == (1, 1, 3.0)
    assert sketches.rank_share(both, F.lit(3.0)).first().share == 1.0


def test_normal_quantile(spark):
    probs = [1e-9, 1e-4, 0.01, 0.02425, 0.1, 0.5, 0.9, 0.99, 1 - 1e-6]
    got = spark.createDataFrame([(p,) for p in [*probs, 0.0, 1.0]], "p double").select(shapes.normal_quantile(F.col("p")).alias("q")).collect()
    assert [r.q for r in got[:-2]] == pytest.approx([NormalDist().inv_cdf(p) for p in probs], abs=1e-7)
    assert got[-1].q is None and got[-2].q is None


def test_normal_and_skewed_groups(spark):
    rng = random.Random(4)
    rows = [("normal", 1e6 + rng.gauss(0, 1)) for _ in range(900)] + [("skewed", rng.expovariate(1)) for _ in range(900)]
    rows += [("same", 2.0)] * 600 + [("few", float(i)) for i in range(20)] + [("normal", None), ("normal", float("nan")), (None, 1.0)]
    found = shapes.rank_normality(spark.createDataFrame(rows, "g string, x double"), ["g"], "x")
    got = {r.g: r for r in found.collect()}
    assert set(got) == {"normal", "skewed", "same"}
    assert got["normal"].normal and not got["skewed"].normal and got["same"].normal is None and got["normal"].n == 900
    values = sorted(v for g, v in rows if g == "skewed")
    scores = [NormalDist().inv_cdf((i + 0.625) / 900.25) for i in range(900)]
    assert got["skewed"].w == pytest.approx(np.corrcoef(values, scores)[0, 1] ** 2, abs=1e-7)


def test_tied_values_share_a_rank(spark):
    rows = [(float(i % 7),) for i in range(700)]
    (r,) = shapes.rank_normality(spark.createDataFrame(rows, "x double").withColumn("g", F.lit(1)), ["g"], "x").collect()
    scores = {v: NormalDist().inv_cdf((v * 100 + 50.5 - 0.375) / 700.25) for v in range(7)}
    assert r.w == pytest.approx(np.corrcoef([v for (v,) in rows], [scores[int(v)] for (v,) in rows])[0, 1] ** 2, abs=1e-7)


def test_curves_of_groups_equal_those_of_one(spark):
    rng = random.Random(6)
    rows = [("a", rng.gauss(0, 1)) for _ in range(300)] + [("b", rng.gauss(50, 9)) for _ in range(200)] + [("c", 1.0)] * 9 + [("a", float("nan")), (None, 3.0)]
    df = spark.createDataFrame(rows, "g string, x double")
    curves = shapes.density_by_group(df, ["g"], "x", points=20).collect()
    assert {r.g for r in curves} == {"a", "b"}
    for g in "ab":
        one = sorted((r.x, r.density) for r in profile.density(df.where(F.col("g") == g), "x", points=20).collect())
        got = sorted((r.x, r.density) for r in curves if r.g == g)
        assert got == [pytest.approx(p) for p in one]
        assert math.isclose(sum(d for _, d in got) * (got[1][0] - got[0][0]), 1.0, abs_tol=0.1)
    assert shapes.density_by_group(df.limit(0), ["g"], "x").collect() == []
