"""Choosing, casting and deriving columns; unions and top rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prepkit.functions import cells
from prepkit.operators import columns, rows
from prepkit.queries.registry import DIRTY, dirty, query, rounded, table


@query("""
SELECT c_custkey, c_name AS name, c_acctbal AS balance FROM customer
""")
def keep_rename(spark: SparkSession, folder: str) -> DataFrame:
    """Quotes taken off the names, columns kept, dropped and renamed."""
    customer = table(spark, folder, "customer")
    quoted = customer.toDF(*[f'"{c}"' for c in customer.columns])
    chosen = columns.keep(columns.clean_names(quoted), ["c_custkey", "c_name", "c_acctbal", "c_nationkey"])
    return columns.rename(columns.drop_if_present(chosen, ["c_nationkey", "absent"]),
                          {"c_name": "name", "c_acctbal": "balance", "absent": "x"})


@query("""
SELECT l_orderkey, l_linenumber, trunc(l_quantity)::int AS l_quantity, trunc(l_extendedprice)::int AS l_extendedprice,
  trunc(l_discount)::int AS l_discount FROM lineitem
""")
def cast_columns(spark: SparkSession, folder: str) -> DataFrame:
    items = table(spark, folder, "lineitem")
    chosen = items.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount")
    return columns.cast_columns(chosen, "float", "int")


@query("SELECT p_partkey, trim('  ' || p_name || ' ') AS p_name, trim(' ' || p_brand) AS p_brand FROM part")
def trim_strings(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part")
    padded = part.select("p_partkey", F.concat(F.lit("  "), "p_name", F.lit(" ")).alias("p_name"),
                         F.concat(F.lit(" "), "p_brand").alias("p_brand"))
    return columns.trim_strings(padded)


@query("""
SELECT p_partkey, try_cast(CASE WHEN p_size % 5 = 0 THEN 'n/a' ELSE p_size::varchar || '.5' END AS double) AS size
FROM part
""")
def to_numeric(spark: SparkSession, folder: str) -> DataFrame:
    text = F.when(F.col("p_size") % 5 == 0, "n/a").otherwise(F.concat(F.col("p_size").cast("string"), F.lit(".5")))
    return table(spark, folder, "part").select("p_partkey", cells.to_number(text).alias("size"))


@query("SELECT l_orderkey, l_linenumber, round_even(l_quantity / 8.0::double, 2) AS eighth FROM lineitem")
def round_half_even(spark: SparkSession, folder: str) -> DataFrame:
    items = table(spark, folder, "lineitem")
    return items.select("l_orderkey", "l_linenumber", cells.half_even(F.col("l_quantity") / 8.0, 2).alias("eighth"))


@query("""
WITH p AS (SELECT p_partkey, CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE p_size::double END AS proto FROM part)
SELECT p_partkey, CASE WHEN proto IS NULL THEN 0 WHEN proto <= 6 THEN proto WHEN proto = 7 THEN 12
  WHEN proto BETWEEN 8 AND 12 THEN 13 - proto WHEN proto IN (25, 50) THEN proto / 25 + 5 ELSE proto END AS proto
FROM p
""")
def recode(spark: SparkSession, folder: str) -> DataFrame:
    proto = F.when(F.col("p_partkey") % 9 != 0, F.col("p_size").cast("double"))
    part = table(spark, folder, "part").select("p_partkey", proto.alias("proto"))
    return part.select("p_partkey", cells.recode("proto", cells.PROTOCOL_RULES).alias("proto"))


@query(DIRTY + "SELECT event_id, CASE WHEN value < 0 THEN 0 ELSE value END AS value FROM dirty")
def case_replace(spark: SparkSession, folder: str) -> DataFrame:
    return dirty(spark, folder).select("event_id", cells.replace_where("value", F.col("value") < 0, 0.0).alias("value"))


@query("""
SELECT p_partkey, round(p_size::double * p_size, 4) AS p_size_squared,
  round(p_retailprice * p_retailprice, 4) AS p_retailprice_squared FROM part
""")
def square(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part").select("p_partkey", "p_size", "p_retailprice")
    made = columns.with_squares(part, ["p_size", "p_retailprice"]).drop("p_size", "p_retailprice")
    return rounded(made, 4, "p_size_squared", "p_retailprice_squared")


@query("""
SELECT l_orderkey, round(sum(l_quantity * l_extendedprice), 4) AS l_quantity_x_l_extendedprice,
  round(sum(l_quantity * l_discount), 4) AS l_quantity_x_l_discount,
  round(sum(l_extendedprice * l_discount), 4) AS l_extendedprice_x_l_discount
FROM lineitem GROUP BY 1
""")
def pairwise_product(spark: SparkSession, folder: str) -> DataFrame:
    features = ["l_quantity", "l_extendedprice", "l_discount"]
    made = columns.with_pairwise_products(table(spark, folder, "lineitem").select("l_orderkey", *features), features)
    return made.groupBy("l_orderkey").agg(
        F.round(F.sum("l_quantity_x_l_extendedprice"), 4).alias("l_quantity_x_l_extendedprice"),
        F.round(F.sum("l_quantity_x_l_discount"), 4).alias("l_quantity_x_l_discount"),
        F.round(F.sum("l_extendedprice_x_l_discount"), 4).alias("l_extendedprice_x_l_discount"),
    )


@query("""
SELECT o_orderkey, o_custkey::double * o_custkey AS o_custkey_x_o_custkey,
  o_custkey::double * o_orderkey AS o_custkey_x_o_orderkey, o_orderkey::double * o_orderkey AS o_orderkey_x_o_orderkey
FROM orders
""")
def pairwise_product_self(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return columns.with_pairwise_products(orders, ["o_custkey", "o_orderkey"], with_self=True).drop("o_custkey")


@query(DIRTY + """
SELECT event_id, greatest(value, flag::double) AS max_value_flag, greatest(value, age::double) AS max_value_age,
  greatest(flag::double, age::double) AS max_flag_age FROM dirty
""")
def pairwise_max(spark: SparkSession, folder: str) -> DataFrame:
    df = dirty(spark, folder).select(
        "event_id", "value", F.col("flag").cast("double").alias("flag"), F.col("age").cast("double").alias("age")
    )
    return columns.with_pairwise_max(df, ["value", "flag", "age"]).drop("value", "flag", "age")


@query("SELECT count(*) AS n, count(*) AS n_keys FROM customer")
def surrogate_key(spark: SparkSession, folder: str) -> DataFrame:
    keyed = columns.add_key(table(spark, folder, "customer").select("c_custkey"))
    return keyed.agg(F.count("*").alias("n"), F.count_distinct("id").alias("n_keys"))


@query("""
SELECT c_custkey, c_acctbal, 'customer' AS side FROM customer WHERE c_acctbal >= 0
UNION ALL SELECT c_custkey, c_acctbal, 'debtor' FROM customer WHERE c_acctbal < 0
""")
def tag_rows(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer").select("c_custkey", "c_acctbal")
    good = columns.tag(customer.where("c_acctbal >= 0"), side="customer")
    return rows.union_by_name(good, columns.tag(customer.where("c_acctbal < 0"), side="debtor"))


@query("""
SELECT 'c' || c_custkey AS id, c_nationkey AS nation, c_mktsegment AS segment FROM customer
UNION ALL SELECT 's' || s_suppkey, s_nationkey, NULL FROM supplier
""")
def union_by_name(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer").selectExpr("'c' || c_custkey AS id", "c_nationkey AS nation", "c_mktsegment AS segment")
    supplier = table(spark, folder, "supplier").selectExpr("s_nationkey AS nation", "'s' || s_suppkey AS id")
    return rows.union_by_name(customer, supplier)


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 1")
def top1(spark: SparkSession, folder: str) -> DataFrame:
    return rows.top_rows(table(spark, folder, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", 1, ["o_orderkey"])


@query("SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 5")
def preview(spark: SparkSession, folder: str) -> DataFrame:
    return rows.first_rows(table(spark, folder, "orders").select("o_orderkey", "o_custkey"), 5, ["o_orderkey"])


@query("""
SELECT 'numeric' AS kind, unnest(['p_partkey', 'p_size', 'p_retailprice']) AS "column", count(*) AS n FROM part
UNION ALL SELECT 'string', unnest(['p_name', 'p_type']), count(*) FROM part
""")
def columns_by_type(spark: SparkSession, folder: str) -> DataFrame:
    """Column lists read off the schema, leaving the brand out."""
    part = table(spark, folder, "part")
    kinds = [F.struct(F.lit(kind).alias("kind"), F.lit(c).alias("column"), F.count("*").alias("n"))
             for kind in ("numeric", "string") for c in columns.columns_of(part, kind, ["p_brand"])]
    return part.agg(F.array(*kinds).alias("r")).select(F.inline("r"))
