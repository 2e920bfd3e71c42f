"""Reference tables, lookups, and tables put side by side."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prepkit.functions.cells import AGE_BRACKETS_FINE
from prepkit.operators import lookup, places, ranges
from prepkit.plans.rates import AGE_RATES_FINE
from prepkit.queries.cleaning import BRACKET_SQL, FINE_SQL
from prepkit.queries.registry import DIRTY, dirty, query, rounded, table


@query("""
SELECT c_custkey, c_mktsegment, segment, rate_a, rate_b FROM customer FULL OUTER JOIN
  (VALUES ('BUILDING', 47.35::double, 41.81::double), ('MACHINERY', 67.54::double, 68.33::double),
          ('HOUSEHOLD', 3.58::double, 11.61::double), ('UNKNOWN', 10.82::double, 15.09::double)) r(segment, rate_a, rate_b)
  ON c_mktsegment = segment
""")
def outer_join_reference(spark: SparkSession, folder: str) -> DataFrame:
    rates = lookup.inline_table(
        spark,
        [("BUILDING", 47.35, 41.81), ("MACHINERY", 67.54, 68.33), ("HOUSEHOLD", 3.58, 11.61), ("UNKNOWN", 10.82, 15.09)],
        "segment string, rate_a double, rate_b double",
    )
    customer = table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    return lookup.outer_join_reference(customer, rates, "c_mktsegment", "segment")


@query("""
SELECT o_orderkey, o_custkey, o_orderstatus, l_linenumber, l_quantity FROM orders JOIN lineitem ON o_orderkey = l_orderkey
""")
def inner_join_dedup_cols(spark: SparkSession, folder: str) -> DataFrame:
    """Both sides carry a status; the left one stays."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    items = table(spark, folder, "lineitem").selectExpr(
        "l_orderkey AS o_orderkey", "l_linenumber", "l_quantity", "l_linestatus AS o_orderstatus"
    )
    return lookup.join_keep_left(orders, items, "o_orderkey")


@query("""
SELECT c_custkey, coalesce(n_name, 'unknown') AS nation FROM customer
LEFT JOIN nation ON n_nationkey = CASE WHEN c_nationkey % 6 = 0 THEN -1 ELSE c_nationkey END
""")
def lookup_default(spark: SparkSession, folder: str) -> DataFrame:
    key = F.when(F.col("c_nationkey") % 6 == 0, -1).otherwise(F.col("c_nationkey"))
    customer = table(spark, folder, "customer").select("c_custkey", key.alias("k"))
    nation = table(spark, folder, "nation")
    return lookup.lookup_default(customer, nation, "k", "n_nationkey", "n_name", "nation", "unknown").drop("k")


@query(DIRTY + f"SELECT event_id, {BRACKET_SQL} AS rate_bracket, {FINE_SQL} AS rate FROM dirty")
def bracket_lookup(spark: SparkSession, folder: str) -> DataFrame:
    rates = lookup.inline_table(spark, list(AGE_RATES_FINE.items()), "age_range string, percentage double")
    df = dirty(spark, folder).select("event_id", "age")
    return lookup.bracket_lookup(df, "age", AGE_BRACKETS_FINE, rates, "age_range", "percentage", "rate").drop("age")


@query("""
SELECT event_id, round(value - m, 6) AS gap, n FROM events, (SELECT avg(value) AS m, count(*) AS n FROM events)
""")
def scalar_broadcast(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("event_id", "value")
    scalars = events.agg(F.avg("value").alias("m"), F.count("*").alias("n"))
    joined = lookup.attach_scalars(events, scalars).select("event_id", (F.col("value") - F.col("m")).alias("gap"), "n")
    return rounded(joined, 6, "gap")


@query("""
SELECT doc_id, lang, n_chars, quality, toxic FROM (SELECT * FROM documents WHERE lang <> 'es') FULL JOIN labels USING (doc_id)
""")
def align_by_key(spark: SparkSession, folder: str) -> DataFrame:
    """Documents and labels side by side, rows of one side only among them."""
    documents = table(spark, folder, "documents").where("lang <> 'es'").select("doc_id", "lang", "n_chars")
    return lookup.align_by_key(documents, table(spark, folder, "labels"), "doc_id")


@query("""
SELECT coalesce(c.place, o.place) AS place, c_custkey, c_name, o_orderkey, o_totalprice
FROM (SELECT c_custkey, c_name, row_number() OVER (ORDER BY c_custkey) - 1 AS place FROM customer) c
FULL JOIN (SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS place FROM orders) o
  ON c.place = o.place
""")
def side_by_side(spark: SparkSession, folder: str) -> DataFrame:
    """Customers by key beside orders by price; the longer table's rest stands alone."""
    customer = table(spark, folder, "customer").select("c_custkey", "c_name")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return places.side_by_side(customer, orders, "c_custkey", ["o_totalprice", "o_orderkey"])


BANDS_SQL = """
bands AS (
  SELECT o_orderkey, CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_totalprice END AS low,
         CASE WHEN o_orderkey % 89 = 0 THEN NULL ELSE o_totalprice + (o_orderkey % 7) * (o_orderkey % 11) * 25 END AS high
  FROM orders)
"""


def _bands(spark: SparkSession, folder: str) -> DataFrame:
    """A range of prices for each order: of many lengths, some a single price, some open on a side, most overlapping."""
    return table(spark, folder, "orders").selectExpr(
        "o_orderkey", "CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_totalprice END AS low",
        "CASE WHEN o_orderkey % 89 = 0 THEN NULL ELSE o_totalprice + (o_orderkey % 7) * (o_orderkey % 11) * 25 END AS high",
    )


@query("WITH" + BANDS_SQL + """
SELECT o_orderkey, count(*) AS n, round(min(l_extendedprice), 2) AS least, round(max(l_extendedprice), 2) AS most
FROM bands JOIN lineitem ON (low IS NULL OR l_extendedprice >= low) AND (high IS NULL OR l_extendedprice <= high)
GROUP BY o_orderkey
""")
def range_join(spark: SparkSession, folder: str) -> DataFrame:
    """As many ranges as there are orders, over all items; what each meets is counted without making the pairs."""
    items = table(spark, folder, "lineitem").select("l_extendedprice")
    met = ranges.range_join(items, "l_extendedprice", _bands(spark, folder), "low", "high", how="totals")
    found = met.groupBy("o_orderkey").agg(F.sum("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most"))
    return rounded(found, 2, "least", "most")


@query("""
WITH steps AS (
  SELECT min(p_size) AS low, max(p_size) AS high, p_brand AS brand FROM part GROUP BY p_brand, p_partkey % 3)
SELECT l_orderkey, l_linenumber, (SELECT min(brand) FROM steps WHERE l_quantity >= low AND l_quantity < high) AS brand FROM lineitem
""")
def range_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """Brackets read from a table, overlapping, open at their upper end; items outside all have none."""
    steps = table(spark, folder, "part").groupBy("p_brand", F.col("p_partkey") % 3).agg(F.min("p_size").alias("low"), F.max("p_size").alias("high"))
    items = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    found = ranges.range_lookup(items, "l_quantity", steps.withColumnRenamed("p_brand", "brand"), "low", "high", ["brand"], closed="left")
    return found.drop("l_quantity")
