"""Exact cuts of a group and running totals without putting a whole group into one task.

A window partitioned by a hot group would sort that group in a single task. Here rows are
placed by counts that aggregate on the map side, and only the few near a cut, or those of
one slice, are ever sorted together. Results equal the plain window's.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from prepkit.functions.chance import unit
from prepkit.operators.lookup import bounded
from prepkit.sources.frozen import frozen


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _grouped(group: Sequence[str]) -> Column:
    # A struct is never NULL itself, so groups holding NULL join and count like any other.
    return F.struct(*[F.col(g) for g in group])


def _all(tests: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def hash_blocks(
    df: DataFrame,
    group: Sequence[str],
    quotas: Sequence[Column],
    key: str | Sequence[str],
    seed: int | str,
    name: str = "block",
    reach: float = 8.0,
) -> DataFrame:
    """Cut each group's hash order at the quotas: add how many quotas a row lies beyond.

    The key must tell rows apart. Quotas rise; they may use ``n``, the group's row count,
    and the group columns. Draws are uniform, so a cut stands near quota / n: within a
    band of ``reach`` deviations, whose share of a group shrinks as the group grows. Rows
    between bands follow from their draw alone. Rows below a band are counted, only rows
    inside one are ranked and shuffled. A group whose bands overlap, as those of small
    groups do, or whose counts show that a band misses its cut, is ranked whole.
    The bands are broadcast while they are few; else they are joined by group.
    """
    keys, each = _keys(key), range(len(quotas))
    counts = df.groupBy(*group).agg(F.count("*").alias("n"))
    for i in each:
        share = F.col(f"_q{i}") / F.col("n")
        spread = F.lit(reach) * (F.sqrt(share * (1.0 - share) / F.col("n")) + 1.0 / F.col("n"))
        counts = (
            counts.withColumn(f"_q{i}", F.least(F.greatest(quotas[i].cast("bigint"), F.lit(0)), F.col("n")))
            .withColumn(f"_lo{i}", share - spread)
            .withColumn(f"_hi{i}", share + spread)
        )
    apart = _all([F.col(f"_hi{i}") < F.col(f"_lo{i + 1}") for i in each[:-1]])
    names = [f"{part}{i}" for part in ("_q", "_lo", "_hi") for i in each]
    bands = bounded(counts.select(_grouped(group).alias("_of"), apart.alias("_apart"), *names))
    tagged = df.select("*", _grouped(group).alias("_group"), unit(keys, seed).alias("_u"))
    found = tagged.join(bands, tagged["_group"] == bands["_of"]).groupBy("_of", "_apart", *names).agg(
        *[F.count_if(F.col("_u") < F.col(f"_lo{i}")).alias(f"_below{i}") for i in each],
        *[F.count_if(F.col("_u").between(F.col(f"_lo{i}"), F.col(f"_hi{i}"))).alias(f"_inside{i}") for i in each],
    )
    met = F.col("_apart") & _all(
        [F.col(f"_q{i}").between(F.col(f"_below{i}"), F.col(f"_below{i}") + F.col(f"_inside{i}")) for i in each]
    )

    # A group ranked whole has one band over all draws; its other bands lie beyond them.
    whole = {"_lo": (0.0, 2.0), "_hi": (1.0, 2.0), "_below": (0, 0)}
    cuts = bounded(
        found.select(
            "_of",
            *[F.col(f"_q{i}") for i in each],
            *[
                F.when(met, F.col(f"{part}{i}")).otherwise(F.lit(instead[min(i, 1)])).alias(f"{part}{i}")
                for part, instead in whole.items()
                for i in each
            ],
        )
    )
    placed = tagged.join(cuts, tagged["_group"] == cuts["_of"])
    passed = [(F.col("_u") > F.col(f"_hi{i}")).cast("int") for i in each]
    placed = placed.withColumn("_band", reduce(lambda a, b: a + b, passed))
    near = reduce(lambda a, b: a | b, [F.col("_u").between(F.col(f"_lo{i}"), F.col(f"_hi{i}")) for i in each])
    settled = placed.where(~near).withColumn(name, F.col("_band"))
    order = Window.partitionBy("_group", "_band").orderBy("_u", *keys)
    start = F.coalesce(*[F.when(F.col("_band") == i, F.col(f"_below{i}")) for i in each])
    edge = placed.where(near).withColumn("_rank", start + F.row_number().over(order))
    beyond = [(F.col("_rank") > F.col(f"_q{i}")).cast("int") for i in each]
    edge = edge.withColumn(name, reduce(lambda a, b: a + b, beyond))
    return settled.select(*df.columns, name).unionByName(edge.select(*df.columns, name))


def smallest_marked(
    df: DataFrame,
    group: Sequence[str],
    quota: Column,
    key: str | Sequence[str],
    seed: int | str,
    name: str = "picked",
    reach: float = 8.0,
) -> DataFrame:
    """Mark, per group, the first ``quota`` rows in hash order."""
    cut = hash_blocks(df, group, [quota], key, seed, "_block", reach)
    return cut.withColumn(name, F.col("_block") == 0).drop("_block")


def running_totals(df: DataFrame, order: str, total: str, group: Sequence[str] = ()) -> DataFrame:
    """Add ``before``, the sum of ``total`` over smaller ``order`` values, and ``whole``, over all, per group.

    ``df`` holds each (group, order) once. It is range-partitioned on both, so slices come
    out even however the groups are sized, and written down with its slice numbers, since
    Spark samples the borders and they must not change between the two passes that follow.
    """
    numbered = df.repartitionByRange(*group, order).withColumn("_slice", F.spark_partition_id())
    # A struct is never NULL itself, so groups holding NULL join like any other.
    key = F.struct(*[F.col(g) for g in group]) if group else F.struct(F.lit(0))
    sliced = frozen(numbered, "slices").withColumn("_group", key)
    sums = sliced.groupBy("_group", "_slice").agg(F.sum(total).alias("_sum"))
    whole = Window.partitionBy("_group")
    earlier = whole.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        "_group",
        "_slice",
        F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_start"),
        F.sum("_sum").over(whole).alias("whole"),
    )
    within = Window.partitionBy("_group", "_slice").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    run = sliced.withColumn("_run", F.coalesce(F.sum(total).over(within), F.lit(0)))
    joined = run.join(starts, ["_group", "_slice"])
    return joined.withColumn("before", F.col("_start") + F.col("_run")).select(*df.columns, "before", "whole")
