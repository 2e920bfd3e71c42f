"""Sources and sinks: tables written in every format and read back whole.

Files go to the shared folder of the session, a new path each time.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prepkit.operators import profile, rows
from prepkit.operators.lookup import attach_scalars
from prepkit.queries.registry import query, rounded, table
from prepkit.session import scratch_path
from prepkit.sources import readers, writers
from prepkit.sources.stage import stage, stage_published, version_of
from prepkit.streaming import files as streaming

ORDERS = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double"
ORDERS_SQL = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders"


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


@query(ORDERS_SQL)
def csv_with_schema(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "orders-csv")
    writers.write_csv(_orders(spark, folder), path, header=False)
    return readers.read_csv(spark, path, schema=ORDERS, header=False)


@query("SELECT o_orderkey::int AS o_orderkey, o_custkey::int AS o_custkey, o_orderstatus, o_totalprice FROM orders")
def csv_inferred(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "orders-csv")
    writers.write_csv(_orders(spark, folder), path)
    return readers.read_csv(spark, path, infer=True)


@query("SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2")
def csv_single_file(spark: SparkSession, folder: str) -> DataFrame:
    """A report over all items, written as one file."""
    path = scratch_path(spark, "report-csv")
    report = rows.group_sizes(table(spark, folder, "lineitem"), ["l_returnflag", "l_linestatus"])
    writers.write_single_csv(report, path)
    return readers.read_csv(spark, path, schema="l_returnflag string, l_linestatus string, n bigint")


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus <> 'P'")
def csv_malformed_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The lines of pending orders spoilt; the reader keeps the well-formed ones."""
    path = scratch_path(spark, "orders-text")
    line = F.concat_ws(",", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    spoilt = F.when(F.col("o_orderstatus") == "P", F.concat(line, F.lit(",too,long"))).otherwise(line)
    writers.write_text(_orders(spark, folder).select(spoilt.alias("value")), path)
    good, _ = readers.read_csv_checked(spark, path, ORDERS, header=False)
    return good


@query(ORDERS_SQL)
def jsonl_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "orders-json")
    writers.write_jsonl(_orders(spark, folder), path)
    return readers.read_jsonl(spark, path, ORDERS)


@query("SELECT p_partkey, p_name, p_size, p_retailprice FROM part")
def xml_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "part-xml")
    writers.write_xml(table(spark, folder, "part").select("p_partkey", "p_name", "p_size", "p_retailprice"), path)
    return readers.read_xml(spark, path, "p_partkey bigint, p_name string, p_size int, p_retailprice double")


@query(ORDERS_SQL)
def parquet_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "orders-parquet")
    writers.write_parquet(_orders(spark, folder), path, partition_by=("o_orderstatus",))
    return readers.read_parquet(spark, path).select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


@query("""
SELECT token, count(*) AS n FROM (SELECT unnest(string_split(replace(text, chr(10), ' '), ' ')) AS token FROM benchmark)
GROUP BY 1
""")
def text_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Passages written as lines, read back and counted."""
    path = scratch_path(spark, "benchmark-text")
    writers.write_text(table(spark, folder, "benchmark").select("text"), path)
    return profile.word_counts(readers.read_text(spark, path), "value")


@query("SELECT 1 AS n_files, true AS any_bytes, count(*) AS n_rows FROM orders")
def listed_inputs(spark: SparkSession, folder: str) -> DataFrame:
    """The files of the data folder that hold the orders, picked by name."""
    found = readers.list_inputs(spark, folder, "orders*.parquet")
    paths = [r["path"] for r in found.select("path").collect()]
    n_rows = readers.read_parquet(spark, paths).agg(F.count("*").alias("n_rows"))
    listed = found.agg(F.count("*").cast("int").alias("n_files"), (F.sum("length") > 0).alias("any_bytes"))
    return attach_scalars(listed, n_rows)


@query("""
SELECT p_name, count(*) AS n, min(p_size) AS smallest, max(p_size) AS largest FROM part GROUP BY 1
""")
def ingested_folder(spark: SparkSession, folder: str) -> DataFrame:
    """Parts spread over CSV, JSON Lines and XML files, read as one table again."""
    path = scratch_path(spark, "mixed")
    part = table(spark, folder, "part").select("p_name", "p_size", "p_partkey")
    writers.write_csv(part.where("p_size <= 16"), f"{path}/a")
    writers.write_jsonl(part.where("p_size BETWEEN 17 AND 33"), f"{path}/b")
    writers.write_xml(part.where("p_size > 33"), f"{path}/c")
    whole = readers.ingest_folder(spark, path, "p_name string, p_size int, p_partkey bigint")
    return whole.groupBy("p_name").agg(F.count("*").alias("n"), F.min("p_size").alias("smallest"), F.max("p_size").alias("largest"))


@query("""
SELECT p_name, p_partkey FROM part QUALIFY row_number() OVER (PARTITION BY p_name ORDER BY p_size > 25, p_partkey) = 1
""")
def ingested_first_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The first row of each name over CSV and then JSON Lines, each file in sorted order."""
    path = scratch_path(spark, "ordered")
    part = table(spark, folder, "part").select("p_name", "p_partkey", "p_size")
    writers.write_csv(part.where("p_size <= 25").orderBy("p_partkey"), f"{path}/a")
    writers.write_jsonl(part.where("p_size > 25").orderBy("p_partkey"), f"{path}/b")
    whole = readers.ingest_folder(spark, path, "p_name string, p_partkey bigint")
    return rows.first_per_key(whole, ["p_name"], readers.READING_ORDER).select("p_name", "p_partkey")


@query(ORDERS_SQL + " ORDER BY o_orderkey LIMIT 899")
def first_rows_of_files(spark: SparkSession, folder: str) -> DataFrame:
    """Orders written in order to several files; the first 899 lines of them all."""
    path = scratch_path(spark, "orders-csv")
    writers.write_csv(_orders(spark, folder).repartitionByRange(7, "o_orderkey").sortWithinPartitions("o_orderkey"), path)
    return readers.read_csv(spark, path, schema=ORDERS, max_rows=899)


@query("""
SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders WHERE o_totalprice >= 1000 GROUP BY 1
""")
def staged_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Two steps between catalog tables, the second taking the place of the first's result."""
    schema = f"steps_{uuid.uuid4().hex[:12]}"
    writers.reset_schema(spark, schema, scratch_path(spark, schema))
    writers.write_table(_orders(spark, folder), f"{schema}.original")
    stage(spark, f"{schema}.original", lambda df: {f"{schema}.clean": df.where("o_totalprice >= 1000")}, f"{schema}.original")
    stage(spark, [f"{schema}.clean"], lambda dfs: {f"{schema}.clean": dfs[0].drop("o_custkey")})
    by_status = readers.read_table(spark, f"{schema}.clean").groupBy("o_orderstatus")
    return by_status.agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("""
SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total, true AS unchanged FROM orders
WHERE o_totalprice >= 1000 GROUP BY 1
""")
def published_tables(spark: SparkSession, folder: str) -> DataFrame:
    """A table replaced by what was made of it; steps that a check refuses, the second table's too, leave it as it was."""
    schema = f"published_{uuid.uuid4().hex[:12]}"
    writers.reset_schema(spark, schema, scratch_path(spark, schema))
    name = f"{schema}.clean"
    writers.write_table(_orders(spark, folder), f"{schema}.original")
    stage_published(spark, f"{schema}.original", lambda df: {name: df})
    made = stage_published(spark, name, lambda df: {name: df.where("o_totalprice >= 1000").drop("o_custkey")}, {name: lambda df: not df.isEmpty()})
    for work, checked in (
        (lambda df: {name: df.limit(1), f"{schema}.other": df.limit(0)}, f"{schema}.other"),
        (lambda df: {name: df.limit(0)}, name),
    ):
        try:
            stage_published(spark, name, work, {checked: lambda df: not df.isEmpty()})
        except ValueError:  # as meant
            continue
        raise AssertionError("the step should have failed")
    unchanged = version_of(spark, name) == made[name]
    by_status = readers.read_table(spark, name).groupBy("o_orderstatus")
    return by_status.agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")).withColumn("unchanged", F.lit(unchanged))


@query("SELECT 16 AS partitions, count(*) AS n, count(*) FILTER (o_totalprice > 200000) AS n_large FROM orders")
def redistributed(spark: SparkSession, folder: str) -> DataFrame:
    """Rows spread over a given number of partitions, and counted."""
    spread = readers.redistribute(_orders(spark, folder), 16, "o_orderkey")
    counted = profile.count_where(spread, F.col("o_totalprice") > 200000, "n_large")
    sizes = profile.shape(spread).select(F.lit(profile.partition_count(spread)).alias("partitions"), F.col("n_rows").alias("n"))
    return attach_scalars(sizes, counted)


@query("""
SELECT event_type, count(*) AS n, round(sum(CASE WHEN value > 400 THEN 0 ELSE value END), 4) AS total FROM events GROUP BY 1
""")
def cleaned_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Event files taken as a stream, repaired with literals, appended and read back."""
    path = scratch_path(spark, "stream")
    events = table(spark, folder, "events").select("event_id", "event_type", "value")
    writers.write_csv(events, f"{path}/in")
    stream = streaming.arriving_files(spark, f"{path}/in", "event_id bigint, event_type string, value double", header="true")
    query_ = streaming.clean_arriving(
        stream, lambda df: df.withColumn("value", F.when(F.col("value") > 400, 0.0).otherwise(F.col("value"))),
        f"{path}/out", f"{path}/progress",
    )
    query_.awaitTermination()
    done = readers.read_parquet(spark, f"{path}/out")
    return rounded(done.groupBy("event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")), 4, "total")
