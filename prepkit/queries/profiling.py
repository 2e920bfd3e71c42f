"""Figures about tables and distributions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prepkit.functions import cells
from prepkit.operators import profile
from prepkit.queries.registry import DIRTY, dirty, query, rounded, table

MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _union(template: str, names: list[str]) -> str:
    return "\nUNION ALL ".join(template.replace("{c}", c) for c in names)


@query("SELECT count(*) AS n_rows, 11 AS n_columns FROM lineitem")
def shape(spark: SparkSession, folder: str) -> DataFrame:
    return profile.shape(table(spark, folder, "lineitem"))


@query(_union("""SELECT '{c}' AS "column", {c}::varchar AS value, count(*) AS n FROM lineitem GROUP BY 2""",
              ["l_returnflag", "l_linestatus", "l_linenumber"]))
def value_counts(spark: SparkSession, folder: str) -> DataFrame:
    return profile.value_counts(table(spark, folder, "lineitem"), ["l_returnflag", "l_linestatus", "l_linenumber"])


@query(_union("""SELECT '{c}' AS "column", count(DISTINCT {c}) AS n_distinct FROM part""", ["p_name", "p_brand", "p_type"]))
def count_distinct(spark: SparkSession, folder: str) -> DataFrame:
    return profile.count_distinct(table(spark, folder, "part"), ["p_name", "p_brand", "p_type"])


@query("""
SELECT c_mktsegment, round(avg(o_totalprice), 4) AS average_price
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1
""")
def group_mean(spark: SparkSession, folder: str) -> DataFrame:
    """Mean order price by segment; prices are summed per customer before the join moves any row."""
    orders = table(spark, folder, "orders").groupBy("o_custkey").agg(
        F.sum("o_totalprice").alias("price"), F.count("*").alias("n")
    )
    joined = orders.join(table(spark, folder, "customer").select("c_custkey", "c_mktsegment"), F.expr("o_custkey = c_custkey"))
    mean = F.sum("price") / F.sum("n")
    return joined.groupBy("c_mktsegment").agg(F.round(mean, 4).alias("average_price"))


@query(DIRTY + "SELECT event_type, round(avg(value), 6) AS mean FROM dirty GROUP BY 1")
def mean_by_type(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(profile.group_mean(dirty(spark, folder), ["event_type"], "value", "mean"), 6, "mean")


@query(DIRTY + """
SELECT 'value' AS "column", round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std FROM dirty WHERE value >= 0
UNION ALL SELECT 'flag', round(avg(flag), 6), round(stddev_samp(flag), 6) FROM dirty WHERE flag BETWEEN 0 AND 1
""")
def guarded_mean_std(spark: SparkSession, folder: str) -> DataFrame:
    found = profile.mean_std(dirty(spark, folder), ["value", "flag"], {"value": (0.0, None), "flag": [0, 1]})
    return rounded(found, 6, "mean", "std")


@query("""
SELECT 'l_returnflag' AS "column", l_returnflag AS mode, count(*) AS n FROM lineitem GROUP BY 2 QUALIFY row_number() OVER (ORDER BY count(*) DESC, l_returnflag) = 1
UNION ALL SELECT 'l_linenumber', l_linenumber::varchar, count(*) FROM lineitem GROUP BY l_linenumber QUALIFY row_number() OVER (ORDER BY count(*) DESC, l_linenumber) = 1
UNION ALL SELECT 'l_suppkey', l_suppkey::varchar, count(*) FROM lineitem GROUP BY l_suppkey QUALIFY row_number() OVER (ORDER BY count(*) DESC, l_suppkey) = 1
""")
def modes(spark: SparkSession, folder: str) -> DataFrame:
    return profile.modes(table(spark, folder, "lineitem"), ["l_returnflag", "l_linenumber", "l_suppkey"])


@query("""
SELECT l_partkey, l_returnflag AS mode, count(*) AS n FROM lineitem GROUP BY 1, 2
QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY count(*) DESC, l_returnflag) = 1
""")
def mode_by_group(spark: SparkSession, folder: str) -> DataFrame:
    return profile.group_modes(table(spark, folder, "lineitem"), ["l_partkey"], "l_returnflag")


@query(_union("""SELECT '{c}' AS "column", p AS prob, round(quantile_cont({c}, p), 6) AS value
FROM lineitem, (SELECT unnest([0.01, 0.25, 0.5, 0.75, 0.99]::double[]) AS p) GROUP BY p""".replace(
    "quantile_cont({c}, p)",
    "CASE p WHEN 0.01 THEN quantile_cont({c}, 0.01) WHEN 0.25 THEN quantile_cont({c}, 0.25) "
    "WHEN 0.5 THEN quantile_cont({c}, 0.5) WHEN 0.75 THEN quantile_cont({c}, 0.75) ELSE quantile_cont({c}, 0.99) END"),
    MEASURES[:3]))
def quantiles(spark: SparkSession, folder: str) -> DataFrame:
    found = profile.quantile_table(table(spark, folder, "lineitem"), MEASURES[:3], [0.01, 0.25, 0.5, 0.75, 0.99])
    return rounded(found, 6, "value")


@query(_union("""SELECT '{c}' AS "column", p AS prob, round(CASE p WHEN 0.05 THEN quantile_cont({c}, 0.05)
  ELSE quantile_cont({c}, 0.5) END, 6) AS value
FROM orders, (SELECT unnest([0.05, 0.5]::double[]) AS p) GROUP BY p""", ["o_totalprice", "o_custkey"]))
def quantiles_narrowed(spark: SparkSession, folder: str) -> DataFrame:
    """The way taken for columns of very many values, forced by small limits."""
    found = profile.quantiles(table(spark, folder, "orders"), ["o_totalprice", "o_custkey"], [0.05, 0.5], 10, 100, 100)
    pairs = [(c, p, v) for c, vs in found.items() for p, v in zip((0.05, 0.5), vs)]
    return rounded(spark.createDataFrame(pairs, "column string, prob double, value double"), 6, "value")


@query(_union("""SELECT '{c}' AS "column", count({c}) AS n, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
  min({c}) + 0.0::double AS min, round(quantile_cont({c}, 0.25), 4) AS q25, round(quantile_cont({c}, 0.5), 4) AS q50,
  round(quantile_cont({c}, 0.75), 4) AS q75, max({c}) + 0.0::double AS max FROM lineitem""", MEASURES))
def describe(spark: SparkSession, folder: str) -> DataFrame:
    found = profile.describe(table(spark, folder, "lineitem"), MEASURES)
    return rounded(found, 4, "mean", "std", "min", "q25", "q50", "q75", "max")


def _corr_sql(cell: str) -> str:
    pairs = [(a, b) for i, a in enumerate(MEASURES) for b in MEASURES[i + 1:]]
    chosen = ", ".join(f"{cell.replace('{c}', c)} AS {c}" for c in MEASURES)
    return f"WITH t AS (SELECT {chosen} FROM lineitem)\n" + "\nUNION ALL ".join(
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) AS r, count(*) FILTER ({a} IS NOT NULL AND {b} IS NOT NULL) AS n FROM t"
        for a, b in pairs
    )


@query(_corr_sql("{c}"))
def corr_matrix(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(profile.corr_matrix(table(spark, folder, "lineitem"), MEASURES), 6, "r")


@query(_corr_sql("CASE WHEN {c} > 0 THEN {c} END"))
def corr_matrix_positive(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(profile.corr_matrix(table(spark, folder, "lineitem"), MEASURES, above=0.0), 6, "r")


@query("""
SELECT 'c_acctbal' AS col_a, 'c_nationkey' AS col_b,
  round(corr(CASE WHEN c_acctbal >= 0 THEN c_acctbal END, c_nationkey::double), 6) AS r,
  count(*) FILTER (c_acctbal >= 0) AS n FROM customer
""")
def corr_nonnegative(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(profile.corr_matrix(table(spark, folder, "customer"), ["c_acctbal", "c_nationkey"], at_least=0.0), 6, "r")


@query("""
SELECT 'value' AS "column", round(skewness(value) * (count(*) - 2) / sqrt(count(*) * (count(*) - 1.0)), 6) AS skew,
  round(kurtosis_pop(value), 6) AS kurtosis FROM events
UNION ALL SELECT 'user_id', round(skewness(user_id) * (count(*) - 2) / sqrt(count(*) * (count(*) - 1.0)), 6),
  round(kurtosis_pop(user_id), 6) FROM events
""")
def skew_kurtosis(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(profile.skew_kurtosis(table(spark, folder, "events"), ["value", "user_id"]), 6, "skew", "kurtosis")


BIN_SQL = "CASE WHEN l_quantity > 0 AND ceil(l_quantity / 5.0::double) - 1 < 10 THEN (ceil(l_quantity / 5.0::double) - 1)::int END"


@query(f"""
SELECT {BIN_SQL} AS bin, round(avg(l_extendedprice), 4) AS mean, round(stddev_samp(l_extendedprice), 4) AS std,
  round(skewness(l_extendedprice), 5) AS skew, count(*) AS n, round(quantile_cont(l_extendedprice, 0.5), 4) AS median
FROM lineitem GROUP BY 1
""")
def binned_stats(spark: SparkSession, folder: str) -> DataFrame:
    items = table(spark, folder, "lineitem").select(cells.fixed_bin("l_quantity", 5, 10).alias("bin"), "l_extendedprice")
    found = profile.binned_stats(items, ["bin"], "l_extendedprice")
    return rounded(rounded(found, 4, "mean", "std", "median"), 5, "skew")


@query(f"""
WITH g AS (SELECT {BIN_SQL} AS bin, count(*) AS n,
  skewness(l_extendedprice) * (count(*) - 2) / sqrt(count(*) * (count(*) - 1.0::double)) AS g, kurtosis_pop(l_extendedprice) AS k
  FROM lineitem GROUP BY 1 HAVING count(*) > 500)
SELECT bin, n, round(n / 6.0::double * (g * g + k * k / 4.0::double), 4) AS jb,
  round(exp(-(n / 6.0::double * (g * g + k * k / 4.0::double)) / 2.0::double), 6) AS p,
  exp(-(n / 6.0::double * (g * g + k * k / 4.0::double)) / 2.0::double) > 0.05 AS normal FROM g
""")
def normality_by_bin(spark: SparkSession, folder: str) -> DataFrame:
    items = table(spark, folder, "lineitem").select(cells.fixed_bin("l_quantity", 5, 10).alias("bin"), "l_extendedprice")
    return rounded(rounded(profile.normality(items, ["bin"], "l_extendedprice"), 4, "jb"), 6, "p")


@query("""
WITH m AS (SELECT min(value) AS lo, max(value) AS hi FROM events),
b AS (SELECT least(floor((value - lo) / ((hi - lo) / 30))::int, 29) AS bin FROM events, m),
g AS (SELECT unnest(range(30))::int AS bin)
SELECT g.bin, round(lo + g.bin * ((hi - lo) / 30), 6) AS lo, round(lo + g.bin * ((hi - lo) / 30) + (hi - lo) / 30, 6) AS hi, count(b.bin) AS n
FROM g CROSS JOIN m LEFT JOIN b ON b.bin = g.bin GROUP BY g.bin, lo, hi
""")
def histogram(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(profile.histogram(table(spark, folder, "events"), "value", 30), 6, "lo", "hi")


def _box_sql(names: list[str], source: str, by: str | None = None) -> str:
    def one(c: str) -> str:
        key = by or f"'{c}'"
        name = by or '"column"'
        return f"""SELECT {key} AS {name}, round(max(q1), 4) AS q1, round(max(q2), 4) AS median, round(max(q3), 4) AS q3,
  round(max(q3 - q1), 4) AS iqr,
  round(min(v) FILTER (v >= q1 - 1.5::double * (q3 - q1) AND v <= q3 + 1.5::double * (q3 - q1)), 4) + 0.0::double AS whisker_lo,
  round(max(v) FILTER (v >= q1 - 1.5::double * (q3 - q1) AND v <= q3 + 1.5::double * (q3 - q1)), 4) + 0.0::double AS whisker_hi,
  count(*) FILTER (v < q1 - 1.5::double * (q3 - q1) OR v > q3 + 1.5::double * (q3 - q1)) AS n_outliers
FROM (SELECT {c} AS v{", " + by if by else ""}, quantile_cont({c}, 0.25) OVER w AS q1, quantile_cont({c}, 0.5) OVER w AS q2,
  quantile_cont({c}, 0.75) OVER w AS q3 FROM {source} WINDOW w AS ({"PARTITION BY " + by if by else ""})) GROUP BY 1"""
    return "\nUNION ALL ".join(one(c) for c in names)


BOX = ("q1", "median", "q3", "iqr", "whisker_lo", "whisker_hi")


@query(_box_sql(["l_extendedprice", "l_quantity"], "lineitem"))
def box_summary(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(profile.box_summary(table(spark, folder, "lineitem"), ["l_extendedprice", "l_quantity"]), 4, *BOX)


@query(_box_sql(["c_acctbal"], "(SELECT c_acctbal FROM customer WHERE c_acctbal > 0)"))
def box_summary_positive(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(profile.box_summary(table(spark, folder, "customer"), ["c_acctbal"], positive_only=True), 4, *BOX)


@query(_box_sql(["value"], "events", "event_type"))
def box_by_group(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(profile.box_by_group(table(spark, folder, "events"), ["event_type"], "value"), 4, *BOX)


@query("""
SELECT event_type, p AS prob, round(CASE p WHEN 0.1 THEN a ELSE b END, 6) AS value
FROM (SELECT event_type, quantile_cont(value, 0.1) AS a, quantile_cont(value, 0.9) AS b FROM events GROUP BY 1),
  (SELECT unnest([0.1, 0.9]::double[]) AS p)
""")
def group_quantiles_sliced(spark: SparkSession, folder: str) -> DataFrame:
    """The way taken for groups of very many values, forced by a small limit."""
    found = profile.group_quantiles(table(spark, folder, "events"), ["event_type"], "value", [0.1, 0.9], buffer_values=10)
    return rounded(found, 6, "value")


@query("""
WITH s AS (SELECT count(*) AS n, stddev_samp(value) AS sd, min(value) AS lo, max(value) AS hi FROM events),
b AS (SELECT least(floor((value - lo) / ((hi - lo) / 512))::int, 511) AS bin, count(*) AS c FROM events, s GROUP BY 1),
g AS (SELECT i, lo + i * ((hi - lo) / 49) AS x, n, lo, hi, sd * pow(n, -0.2) AS h FROM s, (SELECT unnest(range(50)) AS i))
SELECT round(x, 6) AS x, round(sum(c * exp(-pow((x - (lo + (bin + 0.5) * ((hi - lo) / 512))) / h, 2) / 2)) / (max(n) * max(h) * sqrt(2 * pi())), 6) AS density
FROM g, b GROUP BY i, x
""")
def density(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(profile.density(table(spark, folder, "events"), "value"), 6, "x", "density")


@query("""
SELECT c_mktsegment, round(avg(c_acctbal), 4) AS mean, 1 AS place FROM customer GROUP BY 1 ORDER BY avg(c_acctbal) DESC, 1 LIMIT 1
""")
def best_segment(spark: SparkSession, folder: str) -> DataFrame:
    """The segment with the largest mean balance."""
    means = profile.group_mean(table(spark, folder, "customer"), ["c_mktsegment"], "c_acctbal", "mean")
    return rounded(profile.best_row(means, "mean", "c_mktsegment"), 4, "mean").withColumn("place", F.lit(1))
