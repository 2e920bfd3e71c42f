"""Splits and folds, repeatable row for row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prepkit.operators import columns, rows, split
from prepkit.queries.registry import query, table, unit_sql


@query(f"SELECT o_orderkey, CASE WHEN {unit_sql('o_orderkey', 'split 42')} < 0.9::double THEN 'train' ELSE 'test' END AS part FROM orders")
def random_split(spark: SparkSession, folder: str) -> DataFrame:
    train, test = split.random_split(table(spark, folder, "orders").select("o_orderkey"), [0.9, 0.1], "o_orderkey")
    return rows.union_by_name(columns.tag(train, part="train"), columns.tag(test, part="test"))


@query(f"""
WITH r AS (SELECT o_orderkey, o_orderstatus, count(*) OVER (PARTITION BY o_orderstatus) AS n,
  row_number() OVER (PARTITION BY o_orderstatus ORDER BY {unit_sql('o_orderkey', 'split 42')}, o_orderkey) AS k FROM orders)
SELECT o_orderkey, o_orderstatus, CASE WHEN k <= round_even(n * 0.1::double, 0) THEN 'test' ELSE 'train' END AS part FROM r
""")
def stratified_split(spark: SparkSession, folder: str) -> DataFrame:
    return split.with_part(table(spark, folder, "orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus", "o_orderkey")


@query(f"""
SELECT event_id, event_type, ((row_number() OVER (PARTITION BY event_type ORDER BY {unit_sql('event_id', 'fold 42')}, event_id) - 1) * 5
  // count(*) OVER (PARTITION BY event_type))::int AS fold FROM events
""")
def stratified_folds(spark: SparkSession, folder: str) -> DataFrame:
    return split.with_folds(table(spark, folder, "events").select("event_id", "event_type"), "event_id", 5, "event_type")


@query(f"""
SELECT fold, count(*) AS n, sum(event_id)::bigint AS ids FROM
  (SELECT floor({unit_sql('event_id', 'fold 7')} * 3)::int AS fold, event_id FROM events) GROUP BY 1
""")
def plain_folds(spark: SparkSession, folder: str) -> DataFrame:
    folded = split.with_folds(table(spark, folder, "events").select("event_id"), "event_id", 3, seed=7)
    return folded.groupBy("fold").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))
