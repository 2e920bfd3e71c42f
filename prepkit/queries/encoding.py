"""Scaling, encoding, binning."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prepkit.functions import cells
from prepkit.operators import columns, scale
from prepkit.queries.cleaning import BRACKET_SQL
from prepkit.queries.registry import DIRTY, dirty, query, rounded, table


@query("""
SELECT o_orderkey, dense_rank() OVER (ORDER BY o_orderpriority)::int - 1 AS o_orderpriority_encoded,
  dense_rank() OVER (ORDER BY o_orderstatus)::int - 1 AS o_orderstatus_encoded FROM orders
""")
def label_encode(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    encoded = scale.label_encode(orders, ["o_orderpriority", "o_orderstatus"])
    return encoded.drop("o_orderpriority", "o_orderstatus")


@query("""
SELECT c_name AS value, (row_number() OVER (ORDER BY c_name) - 1)::int AS code FROM customer GROUP BY c_name
""")
def label_codes_sliced(spark: SparkSession, folder: str) -> DataFrame:
    """Values ranked in slices across the cluster."""
    return scale.label_codes(table(spark, folder, "customer"), "c_name")


@query(DIRTY + """
, k AS (SELECT event_type, row_number() OVER (ORDER BY count(*) DESC, event_type) - 1 AS i
        FROM dirty WHERE event_type IS NOT NULL GROUP BY 1)
SELECT event_id, coalesce(i, (SELECT count(*) FROM k))::double AS type_index FROM dirty LEFT JOIN k USING (event_type)
""")
def frequency_index(spark: SparkSession, folder: str) -> DataFrame:
    df = dirty(spark, folder).select("event_id", "event_type")
    return scale.frequency_index(df, "event_type", "type_index").drop("event_type")


MINMAX_SQL = """
WITH u AS (SELECT 'l_quantity' AS name, min(l_quantity) AS a, max(l_quantity) AS b FROM lineitem
  UNION ALL SELECT 'l_tax', min(l_tax), max(l_tax) FROM lineitem
  UNION ALL SELECT 'l_extendedprice', min(l_extendedprice), max(l_extendedprice) FROM lineitem)
"""


@query(MINMAX_SQL + """
SELECT name, round(a, 6) + 0.0::double AS data_min, round(b, 6) + 0.0::double AS data_max, round(1.0::double / (b - a), 8) AS scale,
  round(-a / (b - a), 6) + 0.0::double AS min FROM u
""")
def minmax_fit(spark: SparkSession, folder: str) -> DataFrame:
    fitted = scale.fit_minmax(table(spark, folder, "lineitem"), ["l_quantity", "l_tax", "l_extendedprice"])
    return rounded(rounded(scale.scaling_table(spark, fitted), 6, "data_min", "data_max", "min"), 8, "scale")


@query(MINMAX_SQL + """
SELECT l_orderkey, l_linenumber,
  round((l_quantity - (SELECT a FROM u WHERE name = 'l_quantity')) / (SELECT b - a FROM u WHERE name = 'l_quantity'), 6) + 0.0::double AS l_quantity,
  round((l_tax - (SELECT a FROM u WHERE name = 'l_tax')) / (SELECT b - a FROM u WHERE name = 'l_tax'), 6) + 0.0::double AS l_tax,
  round((l_extendedprice - (SELECT a FROM u WHERE name = 'l_extendedprice')) / (SELECT b - a FROM u WHERE name = 'l_extendedprice'), 6) + 0.0::double AS l_extendedprice
FROM lineitem
""")
def minmax_apply(spark: SparkSession, folder: str) -> DataFrame:
    names = ["l_quantity", "l_tax", "l_extendedprice"]
    items = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", *names)
    return rounded(scale.apply_minmax(items, scale.fit_minmax(items, names)), 6, *names)


@query("SELECT o_orderkey, round(o_totalprice, 4) AS o_totalprice, 1.0::double AS constant FROM orders")
def minmax_inverse(spark: SparkSession, folder: str) -> DataFrame:
    """Scaled and brought back through the stored parameters; the constant column survives."""
    orders = columns.tag(table(spark, folder, "orders").select("o_orderkey", "o_totalprice"), constant=1.0)
    stored = scale.scaling_table(spark, scale.fit_minmax(orders, ["o_totalprice", "constant"]))
    fitted = scale.load_scalings(stored)
    return rounded(scale.invert_minmax(scale.apply_minmax(orders, fitted), fitted), 4, "o_totalprice")


@query("""
SELECT c_custkey, round(c_acctbal / (SELECT stddev_samp(c_acctbal) FROM customer), 6) + 0.0::double AS c_acctbal FROM customer
""")
def standardise(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer").select("c_custkey", "c_acctbal")
    return rounded(scale.standardise(customer, ["c_acctbal"]), 6, "c_acctbal")


@query("""
SELECT event_id, round((value - m) / s, 6) + 0.0::double AS value FROM events,
  (SELECT avg(value) AS m, stddev_pop(value) AS s FROM events)
""")
def standardise_centred(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("event_id", "value")
    return rounded(scale.standardise(events, ["value"], centre=True, population=True), 6, "value")


@query("""
SELECT event_id, CASE WHEN value > 0 AND ceil(value / 50.0::double) - 1 < 8 THEN (ceil(value / 50.0::double) - 1)::int END AS bin
FROM events
""")
def fixed_bins(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select("event_id", cells.fixed_bin("value", 50, 8).alias("bin"))


@query(DIRTY + f"SELECT {BRACKET_SQL} AS bracket, count(*) AS n, sum(flag)::bigint AS flags FROM dirty GROUP BY 1")
def age_bins(spark: SparkSession, folder: str) -> DataFrame:
    df = dirty(spark, folder).select(cells.bracket("age", cells.AGE_BRACKETS_FINE).alias("bracket"), "flag")
    return df.groupBy("bracket").agg(F.count("*").alias("n"), F.sum("flag").alias("flags"))


@query("""
SELECT l_returnflag, count(*) AS n, round(sum(l_quantity + l_extendedprice + l_discount), 2) AS total FROM lineitem GROUP BY 1
""")
def assembled_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Columns put into one vector; their sum shows that all arrived."""
    from pyspark.ml.functions import vector_to_array

    names = ["l_quantity", "l_extendedprice", "l_discount"]
    vectors = scale.assemble(names).transform(table(spark, folder, "lineitem").select("l_returnflag", *names))
    total = F.aggregate(vector_to_array("features"), F.lit(0.0), lambda a, x: a + x)
    return vectors.groupBy("l_returnflag").agg(F.count("*").alias("n"), F.round(F.sum(total), 2).alias("total"))
