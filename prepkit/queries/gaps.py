"""NaN is missing: figures, scalings, filters and fills over events some of whose numbers are NaN.

The SQL twins read the same events with NULL in these cells.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prepkit.operators import impute, profile, rows, scale
from prepkit.queries.registry import query, rounded, table

GAPPY = """
WITH gappy AS (
  SELECT event_id, event_type, CASE WHEN event_id % 5 = 0 THEN NULL ELSE value END AS value,
         CASE WHEN event_id % 7 = 0 THEN NULL ELSE value * value + event_id % 10 END AS other
  FROM events)
"""


def gappy(spark: SparkSession, folder: str) -> DataFrame:
    """Events whose ``value`` and ``other`` are NaN in some rows."""
    return table(spark, folder, "events").selectExpr(
        "event_id", "event_type", "CASE WHEN event_id % 5 = 0 THEN double('NaN') ELSE value END AS value",
        "CASE WHEN event_id % 7 = 0 THEN double('NaN') ELSE value * value + event_id % 10 END AS other",
    )


def _shape_sql(c: str) -> str:
    return f"""
SELECT 'shape' AS figure, '{c}' AS name, round(avg(power({c} - m, 3)) / power(max(v), 1.5), 6) AS a,
       round(avg(power({c} - m, 4)) / power(max(v), 2) - 3, 6) AS b
FROM gappy, (SELECT avg({c}) AS m, var_pop({c}) AS v FROM gappy)"""


@query(GAPPY + f"""
SELECT 'corr' AS figure, 'value' AS name, round(corr(value, other), 6) AS a,
       (count(*) FILTER (value IS NOT NULL AND other IS NOT NULL))::double AS b FROM gappy
UNION ALL {_shape_sql('value')} UNION ALL {_shape_sql('other')}
UNION ALL SELECT 'mean', event_type, round(avg(value), 6), NULL FROM gappy GROUP BY event_type
UNION ALL SELECT 'binned', event_type, round(avg(other), 6), round(median(other), 6) FROM gappy GROUP BY event_type
""")
def nan_moments(spark: SparkSession, folder: str) -> DataFrame:
    df = gappy(spark, folder)
    corr = profile.corr_matrix(df, ["value", "other"]).select(F.lit("corr"), "col_a", "r", F.col("n").cast("double"))
    shape = profile.skew_kurtosis(df, ["value", "other"]).select(F.lit("shape"), "column", "skew", "kurtosis")
    mean = profile.group_mean(df, ["event_type"], "value", "m").select(F.lit("mean"), "event_type", "m", F.lit(None).cast("double"))
    binned = profile.binned_stats(df, ["event_type"], "other").select(F.lit("binned"), "event_type", "mean", "median")
    return rounded(corr.union(shape).union(mean).union(binned).toDF("figure", "name", "a", "b"), 6, "a", "b")


@query(GAPPY + """
SELECT 'missing' AS figure, 'value' AS name, count(*) FILTER (value IS NULL) AS n, NULL::double AS x FROM gappy
UNION ALL SELECT 'distinct', 'value', count(DISTINCT value), NULL FROM gappy
UNION ALL SELECT 'distinct', 'other', count(DISTINCT other), NULL FROM gappy
UNION ALL SELECT 'values', 'value', count(value), NULL FROM gappy
UNION ALL SELECT 'mode', event_type, n, value FROM (
  SELECT event_type, value, count(*) AS n FROM gappy WHERE value IS NOT NULL GROUP BY 1, 2
  QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY count(*) DESC, value) = 1)
UNION ALL SELECT 'largest', 'value', event_id, value FROM (SELECT * FROM gappy ORDER BY value DESC NULLS LAST, event_id LIMIT 1)
""")
def nan_counts(spark: SparkSession, folder: str) -> DataFrame:
    df = gappy(spark, folder)
    none = F.lit(None).cast("double")
    parts = [
        profile.missing_counts(df, ["value"]).select(F.lit("missing"), "column", "n_missing", none),
        profile.count_distinct(df, ["value", "other"]).select(F.lit("distinct"), "column", "n_distinct", none),
        profile.value_counts(df, ["value"]).groupBy("column").agg(F.sum("n").alias("n")).select(F.lit("values"), "column", "n", none),
        profile.group_modes(df, ["event_type"], "value").select(F.lit("mode"), "event_type", "n", "mode"),
        rows.top_rows(df, "value", 1, ["event_id"]).select(F.lit("largest"), F.lit("value"), "event_id", "value"),
    ]
    whole = parts[0].toDF("figure", "name", "n", "x")
    for part in parts[1:]:
        whole = whole.union(part)
    return whole


@query(GAPPY + """
SELECT event_id, round((value - lo) / (hi - lo), 6) AS value, round((other - m) / s, 6) AS other, place
FROM gappy, (SELECT min(value) AS lo, max(value) AS hi, avg(other) AS m, stddev_samp(other) AS s FROM gappy)
JOIN (SELECT event_id AS id, coalesce(p, (SELECT count(DISTINCT value) FROM gappy))::double AS place FROM gappy LEFT JOIN
  (SELECT value AS v, row_number() OVER (ORDER BY count(*) DESC, value) - 1 AS p FROM gappy WHERE value IS NOT NULL GROUP BY value) ON v = value)
  ON id = event_id
""")
def nan_scaling(spark: SparkSession, folder: str) -> DataFrame:
    df = scale.frequency_index(gappy(spark, folder).drop("event_type"), "value", "place")
    scaled = scale.apply_minmax(df, scale.fit_minmax(df, ["value"]))
    return rounded(scale.standardise(scaled, ["other"], centre=True), 6, "value", "other")


@query(GAPPY + """
SELECT event_id, round(value, 6) AS value, round(other, 6) AS other, type FROM (
  SELECT event_id, coalesce(value, 0) AS value, coalesce(other, 0) AS other, 'pattern ' ||
         CASE WHEN value IS NOT NULL AND other IS NOT NULL THEN 'both' WHEN value IS NOT NULL THEN 'value' ELSE 'other' END AS type
  FROM gappy WHERE value IS NOT NULL OR other IS NOT NULL
  UNION ALL SELECT event_id, value, other, 'near' FROM gappy, (SELECT avg(value) AS m, stddev_samp(value) AS s FROM gappy)
  WHERE abs(value - m) / s - 1.5 < 0.01)
""")
def nan_filters(spark: SparkSession, folder: str) -> DataFrame:
    df = gappy(spark, folder).drop("event_type")
    pattern = rows.split_by_null_pattern(df, "value", "other", ("pattern both", "pattern value", "pattern other"))
    near = rows.zscore_filter(df, ["value"], 1.5).withColumn("type", F.lit("near"))
    return rounded(pattern.unionByName(near), 6, "value", "other")


@query(GAPPY + """
SELECT event_id, coalesce(value, 1) AS drawn, round(coalesce(other, (SELECT avg(other) FROM gappy)), 4) AS other,
       coalesce(value, 0) AS quota
FROM gappy
""")
def nan_imputation(spark: SparkSession, folder: str) -> DataFrame:
    """Draws of chance 1, means, and quotas of chance 0."""
    df = gappy(spark, folder).withColumn("quota", F.col("value")).withColumn("chance", F.lit(0.0))
    drawn = impute.bernoulli_impute(df, "value", F.lit(1.0), "event_id").withColumnRenamed("value", "drawn")
    filled = impute.quota_impute(impute.mean_fill(drawn, ["other"]), "quota", ["event_type"], "chance", "event_id")
    return rounded(filled, 4, "other").select("event_id", "drawn", "other", "quota")
