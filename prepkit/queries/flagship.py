"""Gaps counted, values and types repaired, and the repaired values summed up by type."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prepkit.operators import impute
from prepkit.queries.registry import DIRTY, dirty, query, rounded


@query(DIRTY + """
, m AS (SELECT avg(value) FILTER (value >= 0) AS m FROM dirty),
k AS (SELECT event_type AS k FROM dirty WHERE event_type IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
SELECT coalesce(event_type, k) AS event_type, count(*) AS n, count(*) FILTER (value IS NULL) AS n_missing,
  round(avg(CASE WHEN value IS NULL OR value < 0 THEN m ELSE value END), 6) AS mean_value
FROM dirty, m, k GROUP BY 1
""")
def repaired_by_type(spark: SparkSession, folder: str) -> DataFrame:
    df = dirty(spark, folder).select("event_type", "value", F.col("value").isNull().alias("gap"))
    repaired = impute.mode_fill(impute.guarded_mean_repair(df, {"value": (0.0, None)}), ["event_type"])
    by_type = repaired.groupBy("event_type").agg(
        F.count("*").alias("n"), F.count_if("gap").alias("n_missing"), F.avg("value").alias("mean_value")
    )
    return rounded(by_type, 6, "mean_value")
