"""Tokens, figures, lists and embedded data in whole texts and pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prepkit.functions import markup
from prepkit.operators import profile
from prepkit.queries.registry import query, rounded, table


@query("""
SELECT token, count(*) AS n FROM (SELECT unnest(string_split(replace(text, chr(10), ' '), ' ')) AS token FROM documents)
GROUP BY 1 HAVING count(*) >= 3
""")
def word_count(spark: SparkSession, folder: str) -> DataFrame:
    return profile.word_counts(table(spark, folder, "documents"), "text", at_least=3)


@query("""
SELECT doc_id, length(t) - length(replace(replace(t, ' ', ''), chr(10), '')) + 1 AS n_tokens FROM
  (SELECT doc_id, text AS t FROM documents)
""")
def tokens_per_document(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return documents.select("doc_id", F.size(markup.tokens("text")).cast("bigint").alias("n_tokens"))


@query("""
SELECT l_orderkey, l_linenumber, round(round(l_discount * 100)::int / 100.0::double, 4) AS rate FROM lineitem
""")
def extract_percent(spark: SparkSession, folder: str) -> DataFrame:
    figure = F.round(F.col("l_discount") * 100).cast("int").cast("string")
    text = F.concat(F.lit("rate ("), figure, F.lit("%) of the price"))
    items = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", markup.percent(text).alias("rate"))
    return rounded(items, 4, "rate")


@query(r"""
WITH u AS (SELECT page_id, regexp_extract_all(html, '(?s)<ul[^>]*>(.*?)</ul>', 1)[1] AS body FROM pages),
l AS (SELECT page_id, regexp_extract_all(body, '(?s)<li[^>]*>(.*?)</li>', 1) AS li FROM u WHERE body IS NOT NULL)
SELECT page_id, (generate_subscripts(li, 1) - 1)::int AS pos, trim(regexp_replace(unnest(li), '<[^>]*>', '', 'g')) AS item FROM l
""")
def html_list_items(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    return pages.select("page_id", F.posexplode(markup.list_items("html", 0)).alias("pos", "item"))


@query("""
SELECT o_orderkey, CASE WHEN contains(o_orderpriority, 'URGENT') THEN 'URGENT' WHEN contains(o_orderpriority, 'HIGH') THEN 'HIGH'
  WHEN contains(o_orderpriority, 'LOW') THEN 'LOW' END AS label FROM orders
""")
def label_match(spark: SparkSession, folder: str) -> DataFrame:
    """The label a text holds; the labels are literals, so the match needs no join."""
    label = markup.matched_label("o_orderpriority", ["URGENT", "HIGH", "LOW"])
    return table(spark, folder, "orders").select("o_orderkey", label.alias("label"))


@query("SELECT event_id, json_extract_string(props, '$.k')::double AS k FROM events")
def embedded_json(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select("event_id", markup.json_number("props", "$.k").alias("k"))


@query("""
SELECT event_id, i::int AS place, (json_extract_string(props, '$.k')::double + i) / 100.0::double AS share FROM events, (SELECT unnest([0, 1]) AS i)
""")
def chart_series(spark: SparkSession, folder: str) -> DataFrame:
    """A chart block built round each event's figure, and read back by its caption."""
    k = F.get_json_object("props", "$.k")
    page = F.concat(
        F.lit('<div class="chart-data-wrapper"><pre class="chart-caption">Other</pre><pre class="chart-data">[["x"],[[1]]]</pre></div>'),
        F.lit('<div class="chart-data-wrapper"><pre class="chart-caption">Share by age, 2022</pre><pre class="chart-data">[["a","b"],[['),
        k, F.lit("],["), (k.cast("int") + 1).cast("string"), F.lit("]]]</pre></div>"),
    )
    series = markup.captioned_series(page, "Share by age", 1)
    return table(spark, folder, "events").select("event_id", F.posexplode(series).alias("place", "share"))
