"""Missing cells, masks, outliers, duplicates, samples, imputation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prepkit.functions.cells import AGE_BRACKETS_COARSE, AGE_BRACKETS_FINE, bracket
from prepkit.operators import impute, profile, rows
from prepkit.plans.rates import AGE_RATES_COARSE, AGE_RATES_FINE, SEX_RATES
from prepkit.queries.registry import DIRTY, dirty, query, rounded, table, unit_sql

GAPPY = ["event_type", "value", "flag"]


@query(DIRTY + """
SELECT 'event_type' AS "column", count(*) - count(event_type) AS n_missing FROM dirty
UNION ALL SELECT 'value', count(*) - count(value) FROM dirty
UNION ALL SELECT 'flag', count(*) - count(flag) FROM dirty
UNION ALL SELECT 'age', count(*) - count(age) FROM dirty
""")
def missing_counts(spark: SparkSession, folder: str) -> DataFrame:
    return profile.missing_counts(dirty(spark, folder), [*GAPPY, "age"])


SHARE = "((event_type IS NULL)::int + (value IS NULL)::int + (flag IS NULL)::int) / 4.0::double"


@query(DIRTY + f"SELECT event_id, {SHARE} AS share FROM dirty")
def missing_fraction(spark: SparkSession, folder: str) -> DataFrame:
    from prepkit.functions.cells import missing_share

    return dirty(spark, folder).select("event_id", missing_share(["event_id", *GAPPY]).alias("share"))


@query(DIRTY + f"SELECT event_id, event_type, value, flag FROM dirty WHERE {SHARE} < 0.5")
def drop_sparse_rows(spark: SparkSession, folder: str) -> DataFrame:
    return rows.drop_sparse_rows(dirty(spark, folder).select("event_id", *GAPPY), 0.5)


@query(DIRTY + f"SELECT event_id, event_type, value, flag FROM dirty WHERE {SHARE} <= 0.5")
def drop_sparse_rows_inclusive(spark: SparkSession, folder: str) -> DataFrame:
    return rows.drop_sparse_rows(dirty(spark, folder).select("event_id", *GAPPY), 0.5, inclusive=True)


@query(DIRTY + """
SELECT event_id, event_type, value, flag FROM dirty
WHERE event_type IS NOT NULL AND value IS NOT NULL AND flag IS NOT NULL
""")
def drop_nulls(spark: SparkSession, folder: str) -> DataFrame:
    return rows.drop_nulls(dirty(spark, folder).select("event_id", *GAPPY))


@query(DIRTY + "SELECT event_id, sex, age FROM dirty")
def drop_null_columns(spark: SparkSession, folder: str) -> DataFrame:
    return rows.drop_null_columns(dirty(spark, folder).select("event_id", *GAPPY, "sex", "age"))


@query(DIRTY + "SELECT event_id, coalesce(value, 0.0::double) AS value, coalesce(flag, 0) AS flag FROM dirty")
def constant_fill(spark: SparkSession, folder: str) -> DataFrame:
    return impute.fill(dirty(spark, folder).select("event_id", "value", "flag"), {"value": 0.0, "flag": 0})


@query(DIRTY + """
SELECT event_id, round(coalesce(value, (SELECT avg(value) FROM dirty)), 6) AS value FROM dirty
""")
def mean_fill(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(impute.mean_fill(dirty(spark, folder).select("event_id", "value"), ["value"]), 6, "value")


@query(DIRTY + """
SELECT event_id,
  coalesce(event_type, (SELECT event_type FROM dirty WHERE event_type IS NOT NULL
                        GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS event_type,
  coalesce(flag, (SELECT flag FROM dirty WHERE flag IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS flag
FROM dirty
""")
def mode_fill(spark: SparkSession, folder: str) -> DataFrame:
    return impute.mode_fill(dirty(spark, folder).select("event_id", "event_type", "flag"), ["event_type", "flag"])


@query(DIRTY + """
, m AS (SELECT avg(value) AS m FROM dirty WHERE value >= 0)
SELECT event_id, round(CASE WHEN value IS NULL OR value < 0 THEN m ELSE value END, 6) AS value FROM dirty, m
""")
def guarded_mean(spark: SparkSession, folder: str) -> DataFrame:
    df = dirty(spark, folder).select("event_id", "value")
    return rounded(impute.guarded_mean_repair(df, {"value": (0.0, None)}), 6, "value")


@query(DIRTY + """
, m AS (SELECT flag AS m FROM dirty WHERE flag <= 1 GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
SELECT event_id, CASE WHEN flag IS NULL OR flag > 1 THEN m ELSE flag END AS flag FROM dirty, m
""")
def guarded_mode(spark: SparkSession, folder: str) -> DataFrame:
    return impute.guarded_mode_repair(dirty(spark, folder).select("event_id", "flag"), {"flag": [0, 1]})


@query(DIRTY + """
, m AS (SELECT avg(value) FILTER (value >= 0) AS mv, avg(flag) FILTER (flag <= 1) AS mf FROM dirty)
SELECT event_id,
  round(CASE WHEN value IS NULL OR value < 0 THEN mv ELSE value END, 6) AS value,
  round(CASE WHEN flag IS NULL OR flag > 1 THEN mf ELSE flag END, 6) AS flag
FROM dirty, m
""")
def ranged_means(spark: SparkSession, folder: str) -> DataFrame:
    """Several columns repaired at once, each with its own range."""
    df = dirty(spark, folder).select("event_id", "value", F.col("flag").cast("double").alias("flag"))
    return rounded(impute.guarded_mean_repair(df, {"value": (0.0, None), "flag": (0.0, 1.0)}), 6, "value", "flag")


@query(DIRTY + """
, k AS (SELECT event_type, row_number() OVER (ORDER BY count(*) DESC, event_type) - 1 AS i
        FROM dirty WHERE event_type IS NOT NULL GROUP BY 1)
SELECT event_id, round(coalesce(value, (SELECT avg(value) FROM dirty)), 6) AS value_filled,
  coalesce(i, 0)::double AS type_index
FROM dirty LEFT JOIN k USING (event_type)
""")
def estimator_imputer(spark: SparkSession, folder: str) -> DataFrame:
    """The ML stages: mean for numbers, index of the most frequent string for missing ones."""
    df = dirty(spark, folder).select("event_id", "value", "event_type")
    made = impute.index_and_impute(["value"], ["event_type"]).fit(df).transform(df)
    out = made.select("event_id", F.col("Imputedvalue").alias("value_filled"),
                      F.col("Imputedevent_typeIndex").alias("type_index"))
    return rounded(out, 6, "value_filled")


COARSE_SQL = """CASE WHEN age BETWEEN 18 AND 24 THEN 0.053 WHEN age BETWEEN 25 AND 44 THEN 0.126
  WHEN age BETWEEN 45 AND 64 THEN 0.149 WHEN age >= 65 THEN 0.083 ELSE 0 END::double"""
FINE_SQL = """CASE WHEN age BETWEEN 15 AND 17 THEN 0.016 WHEN age BETWEEN 18 AND 24 THEN 0.073
  WHEN age BETWEEN 25 AND 34 THEN 0.109 WHEN age BETWEEN 35 AND 44 THEN 0.109 WHEN age BETWEEN 45 AND 54 THEN 0.138
  WHEN age BETWEEN 55 AND 64 THEN 0.149 WHEN age BETWEEN 65 AND 74 THEN 0.087 WHEN age >= 75 THEN 0.029
  ELSE 0 END::double"""
BRACKET_SQL = """CASE WHEN age BETWEEN 15 AND 17 THEN '15-17' WHEN age BETWEEN 18 AND 24 THEN '18-24'
  WHEN age BETWEEN 25 AND 34 THEN '25-34' WHEN age BETWEEN 35 AND 44 THEN '35-44' WHEN age BETWEEN 45 AND 54 THEN '45-54'
  WHEN age BETWEEN 55 AND 64 THEN '55-64' WHEN age BETWEEN 65 AND 74 THEN '65-74' WHEN age >= 75 THEN '75+' END"""


@query(DIRTY + f"""
SELECT event_id, coalesce(flag, CASE WHEN {unit_sql('event_id', 'impute 42')} <
  greatest({COARSE_SQL} * CASE WHEN sex = 'male' THEN 0.131::double / 0.101::double ELSE 1.0::double END, {FINE_SQL})
  THEN 1 ELSE 0 END) AS flag
FROM dirty
""")
def bernoulli_impute(spark: SparkSession, folder: str) -> DataFrame:
    df = dirty(spark, folder)
    chance = impute.smoking_chance(
        "sex", "age", AGE_BRACKETS_COARSE, AGE_RATES_COARSE, AGE_BRACKETS_FINE, AGE_RATES_FINE, SEX_RATES
    )
    return impute.bernoulli_impute(df, "flag", chance, "event_id").select("event_id", "flag")


@query(DIRTY + f"""
, g AS (SELECT event_id, sex, {BRACKET_SQL} AS b,
    {FINE_SQL} * CASE WHEN sex = 'male' THEN 0.131::double / 0.101::double ELSE 1.0::double END AS p
  FROM dirty WHERE flag IS NULL),
r AS (SELECT event_id, row_number() OVER (PARTITION BY sex, b ORDER BY {unit_sql('event_id', 'impute 42')}, event_id) AS k,
    count(*) OVER (PARTITION BY sex, b) AS n, p FROM g)
SELECT event_id, CASE WHEN flag IS NOT NULL THEN flag WHEN k <= round_even(n * p, 0) THEN 1 ELSE 0 END AS flag
FROM dirty LEFT JOIN r USING (event_id)
""")
def quota_impute(spark: SparkSession, folder: str) -> DataFrame:
    ratio = F.when(F.col("sex") == "male", SEX_RATES["male"] / SEX_RATES["female"]).otherwise(1.0)
    df = dirty(spark, folder).select(
        "event_id", "flag", "sex", bracket("age", AGE_BRACKETS_FINE).alias("bracket"),
        impute.rate_by_bracket("age", AGE_BRACKETS_FINE, AGE_RATES_FINE, ratio).alias("chance"),
    )
    return impute.quota_impute(df, "flag", ["sex", "bracket"], "chance", "event_id").select("event_id", "flag")


@query(DIRTY + f"""
SELECT {BRACKET_SQL} AS bracket, count(*) AS n_missing FROM dirty WHERE flag IS NULL GROUP BY 1
""")
def missing_by_bracket(spark: SparkSession, folder: str) -> DataFrame:
    return profile.missing_by_bracket(dirty(spark, folder), "flag", "age", AGE_BRACKETS_FINE)


@query(DIRTY + """
SELECT event_id, CASE WHEN value > 0 THEN value END AS value, CASE WHEN flag > 0 THEN flag END AS flag FROM dirty
""")
def mask_cells(spark: SparkSession, folder: str) -> DataFrame:
    return rows.mask(dirty(spark, folder).select("event_id", "value", "flag"), ["value", "flag"], lambda c: c > 0)


@query("""
WITH q AS (SELECT quantile_cont(l_extendedprice, 0.25) AS p1, quantile_cont(l_extendedprice, 0.75) AS p3,
    quantile_cont(l_quantity, 0.25) AS q1, quantile_cont(l_quantity, 0.75) AS q3 FROM lineitem),
m AS (SELECT l_orderkey,
    CASE WHEN l_extendedprice BETWEEN p1 - 0.5::double * (p3 - p1) AND p3 + 0.5::double * (p3 - p1) THEN l_extendedprice END AS price,
    CASE WHEN l_quantity BETWEEN q1 - 0.5::double * (q3 - q1) AND q3 + 0.5::double * (q3 - q1) THEN l_quantity END AS quantity
  FROM lineitem, q)
SELECT l_orderkey, count(price) AS prices, count(quantity) AS quantities, round(sum(price), 2) AS total FROM m GROUP BY 1
""")
def iqr_mask(spark: SparkSession, folder: str) -> DataFrame:
    items = table(spark, folder, "lineitem").select("l_orderkey", "l_extendedprice", "l_quantity")
    masked = rows.iqr_mask(items, ["l_extendedprice", "l_quantity"], k=0.5)
    return masked.groupBy("l_orderkey").agg(
        F.count("l_extendedprice").alias("prices"),
        F.count("l_quantity").alias("quantities"),
        F.round(F.sum("l_extendedprice"), 2).alias("total"),
    )


@query("""
SELECT event_id, value FROM events, (SELECT avg(value) AS m, stddev_samp(value) AS s FROM events)
WHERE abs(value - m) / s - 3.0::double < 0.01::double
""")
def zscore_filter(spark: SparkSession, folder: str) -> DataFrame:
    return rows.zscore_filter(table(spark, folder, "events").select("event_id", "value"), ["value"])


@query("""
WITH a AS (SELECT l_orderkey, l_quantity AS q, l_extendedprice AS p, l_discount AS d FROM lineitem),
b AS (SELECT a.* FROM a, (SELECT avg(q) AS m, stddev_samp(q) AS s FROM a) WHERE abs(q - m) / s - 1.5::double < 0.01::double),
c AS (SELECT b.* FROM b, (SELECT avg(p) AS m, stddev_samp(p) AS s FROM b) WHERE abs(p - m) / s - 1.5::double < 0.01::double),
e AS (SELECT c.* FROM c, (SELECT avg(d) AS m, stddev_samp(d) AS s FROM c) WHERE abs(d - m) / s - 1.5::double < 0.01::double)
SELECT l_orderkey, count(*) AS n, round(sum(p), 2) AS total FROM e GROUP BY 1
""")
def zscore_filter_sequential(spark: SparkSession, folder: str) -> DataFrame:
    items = table(spark, folder, "lineitem").select("l_orderkey", "l_quantity", "l_extendedprice", "l_discount")
    left = rows.zscore_filter(items, ["l_quantity", "l_extendedprice", "l_discount"], k=1.5, mode="sequential")
    return left.groupBy("l_orderkey").agg(F.count("*").alias("n"), F.round(F.sum("l_extendedprice"), 2).alias("total"))


@query(DIRTY + """
SELECT event_id, coalesce(value, 0.0::double) AS value, coalesce(flag, 0) AS flag,
  CASE WHEN value IS NULL THEN 'only flag' WHEN flag IS NULL THEN 'only value' ELSE 'both' END AS type
FROM dirty WHERE value IS NOT NULL OR flag IS NOT NULL
""")
def null_pattern_split(spark: SparkSession, folder: str) -> DataFrame:
    df = dirty(spark, folder).select("event_id", "value", "flag")
    return rows.split_by_null_pattern(df, "value", "flag", ("both", "only value", "only flag"))


@query("SELECT DISTINCT sha256(text) AS digest, lang FROM documents")
def distinct_rows(spark: SparkSession, folder: str) -> DataFrame:
    return rows.distinct_rows(table(spark, folder, "documents").select(F.sha2("text", 256).alias("digest"), "lang"))


@query("""
SELECT digest, doc_id, source, n_chars FROM (
  SELECT sha256(text) AS digest, doc_id, source, n_chars,
    row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) AS k FROM documents) WHERE k = 1
""")
def first_per_key(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select(F.sha2("text", 256).alias("digest"), "doc_id", "source", "n_chars")
    return rows.first_per_key(docs, ["digest"], ["doc_id"])


@query(f"SELECT event_id, value FROM events WHERE {unit_sql('event_id', 'sample 42')} < 0.01::double")
def hash_sample(spark: SparkSession, folder: str) -> DataFrame:
    return rows.sample_fraction(table(spark, folder, "events").select("event_id", "value"), 0.01, "event_id")


@query(f"""
SELECT event_type, event_id, value FROM (
  SELECT event_type, event_id, value,
    row_number() OVER (PARTITION BY event_type ORDER BY {unit_sql('event_id', 'sample 42')}, event_id) AS k FROM events)
WHERE k <= 500
""")
def sample_per_group(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("event_type", "event_id", "value")
    return rows.sample_per_group(events, ["event_type"], 500, "event_id")


@query("""
SELECT o_orderkey, o_custkey FROM orders
WHERE o_custkey IN (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) >= 15)
""")
def large_group_rows(spark: SparkSession, folder: str) -> DataFrame:
    return rows.rows_in_large_groups(table(spark, folder, "orders").select("o_orderkey", "o_custkey"), ["o_custkey"], 15)


@query("SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) >= 30")
def group_size_filter(spark: SparkSession, folder: str) -> DataFrame:
    return rows.group_sizes(table(spark, folder, "lineitem"), ["l_partkey"], 30)


@query("""
SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice BETWEEN 100000 AND 300000 AND o_custkey >= 100
""")
def range_filter(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    kept = rows.in_ranges(orders, {"o_totalprice": (100000, 300000), "o_custkey": (100, None)})
    return kept.select("o_orderkey", "o_totalprice")


@query("SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING'")
def equality_filter(spark: SparkSession, folder: str) -> DataFrame:
    return rows.matching(table(spark, folder, "customer"), c_mktsegment="BUILDING").select("c_custkey", "c_name")
