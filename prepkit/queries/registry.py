"""Where queries are entered, and the tables they read.

The given tables hold no gaps, so ``dirty`` derives a version of ``events`` that does;
``DIRTY`` is the same in SQL.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    run: Query
    sql: str | None


REGISTRY: dict[str, Entry] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Enter a function under its name, with its SQL twin when SQL can say it."""

    def enter(run: Query) -> Query:
        REGISTRY[run.__name__] = Entry(run, sql)
        return run

    return enter


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def rounded(df: DataFrame, places: int, *columns: str) -> DataFrame:
    """Round columns; adding 0.0 turns a negative zero into a plain one."""
    chosen = set(columns)
    return df.select(*[(F.round(c, places) + F.lit(0.0)).alias(c) if c in chosen else F.col(c) for c in df.columns])


DIRTY = """
WITH dirty AS (
  SELECT event_id, ts, user_id, props,
    CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_type END AS event_type,
    CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 13 = 0 THEN -1.0::double ELSE value END AS value,
    CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 19 = 0 THEN 9 ELSE (event_id % 2)::int END AS flag,
    CASE WHEN user_id % 2 = 0 THEN 'male' ELSE 'female' END AS sex,
    (15 + event_id % 70)::int AS age
  FROM events)
"""


def dirty(spark: SparkSession, folder: str) -> DataFrame:
    """``events`` with gaps, out-of-range values and codes, and made-up sex and age."""
    return table(spark, folder, "events").selectExpr(
        "event_id",
        "ts",
        "user_id",
        "props",
        "CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_type END AS event_type",
        "CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 13 = 0 THEN -1.0D ELSE value END AS value",
        "CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 19 = 0 THEN 9 ELSE cast(event_id % 2 as int) END AS flag",
        "CASE WHEN user_id % 2 = 0 THEN 'male' ELSE 'female' END AS sex",
        "cast(15 + event_id % 70 as int) AS age",
    )


def unit_sql(key: str, seed: int | str) -> str:
    """The uniform draw of ``functions.chance.unit`` in SQL."""
    return f"(('0x' || substr(md5({key}::varchar || '#{seed}'), 1, 13))::bigint / 4503599627370496.0::double)"
