"""Joins against reference tables, and the size check that decides on broadcasting."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prepkit.functions.cells import Bracket, bracket

# Rows and bytes a side may have to be broadcast; beyond them the join shuffles.
BROADCAST_ROWS = 50_000
BROADCAST_BYTES = 64 * 2**20


def inline_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A literal reference table, with its schema as DDL."""
    return spark.createDataFrame(list(rows), schema)


def small(df: DataFrame, limit: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame | None:
    """``df`` ready to broadcast when it has at most ``limit`` rows and ``max_bytes`` of them, else None.

    Rows and bytes are counted before any row reaches the driver. The table is kept as
    read, so the join does not compute it again.
    """
    n, size = df.agg(F.count("*"), F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()
    if n > limit or (size or 0) > max_bytes:
        return None
    return F.broadcast(df.sparkSession.createDataFrame(df.collect(), df.schema))


def bounded(df: DataFrame, limit: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` ready to broadcast when it is small, unchanged otherwise.

    A large table stays a plain shuffled join side, where adaptive execution splits skewed
    partitions.
    """
    found = small(df, limit, max_bytes)
    return df if found is None else found


def outer_join_reference(df: DataFrame, reference: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Full outer join on differently named keys; both key columns stay, and of other shared names both columns.

    A full outer join cannot split a hot key, so it is put together from a left join,
    which broadcasts a small reference, and the reference rows no key of ``df`` meets.
    Of the keys only those the reference has are compared, deduplicated on the map side.
    """
    apart = [f"_ref{i}" for i in range(len(reference.columns))]
    renamed = reference.toDF(*apart)
    other = apart[reference.columns.index(right_key)]
    side = bounded(renamed)
    matched = df.join(side, df[left_key] == side[other], "left")
    known = side.select(F.col(other).alias("_known"))
    used = df.select(F.col(left_key).alias("_used")).join(known, F.col("_used") == F.col("_known"), "left_semi").distinct()
    unmet = renamed.join(used, renamed[other] == used["_used"], "left_anti")
    return matched.unionByName(unmet, allowMissingColumns=True).toDF(*df.columns, *reference.columns)


def join_keep_left(left: DataFrame, right: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Inner join; where both sides have a column of one name, the left one is kept."""
    keys = [key] if isinstance(key, str) else list(key)
    repeated = [c for c in right.columns if c in left.columns and c not in keys]
    return left.join(right.drop(*repeated), keys, "inner")


def lookup_default(
    df: DataFrame, reference: DataFrame, on: str | Column, ref_key: str, ref_value: str, name: str, default: Any
) -> DataFrame:
    """Add ``name``: the reference value of the key, or ``default`` where there is none.

    Where the reference holds a key more than once, its smallest value counts, so rows stay as many as they were.
    """
    pairs = reference.groupBy(F.col(ref_key).alias("_key")).agg(F.min(ref_value).alias("_value"))
    side = bounded(pairs)
    key = df[on] if isinstance(on, str) else on
    joined = df.join(side, key == side["_key"], "left")
    return joined.withColumn(name, F.coalesce("_value", F.lit(default))).drop("_key", "_value")


def bracket_lookup(
    df: DataFrame, value: str, brackets: Sequence[Bracket], rates: DataFrame, rate_key: str, rate: str, name: str,
    default: Any = 0.0,
) -> DataFrame:
    """Add ``{name}_bracket`` and ``name``, the rate of the bracket ``value`` falls in.

    The ranges are literals, so the range part needs no join; the rates are then an
    equi-join on the bracket label.
    """
    labelled = df.withColumn(f"{name}_bracket", bracket(value, brackets))
    return lookup_default(labelled, rates, f"{name}_bracket", rate_key, rate, name, default)


def attach_scalars(df: DataFrame, scalars: DataFrame) -> DataFrame:
    """Add the columns of a one-row table to every row, as literals and so without a join."""
    rows = scalars.limit(2).collect()
    if len(rows) != 1:
        raise ValueError("attach_scalars needs a table of exactly one row")
    types = {f.name: f.dataType for f in scalars.schema.fields}
    return df.select("*", *[F.lit(v).cast(types[c]).alias(c) for c, v in rows[0].asDict().items()])


def align_by_key(left: DataFrame, right: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Put the columns of two tables side by side, matched by key instead of by position.

    Rows of either side that the other lacks stay, with its columns missing; of a name
    both sides have, the left column is kept. A row without a key, or a part of it, stays
    alone: any number of them on either side add up and never multiply. To match by position,
    see ``places.side_by_side``.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in right.columns if c not in left.columns]
    side = right.select(*[F.col(c).alias(f"_{c}") for c in keys], *rest, F.lit(True).alias("_right"))
    same = reduce(lambda a, b: a & b, [(left[c] == side[f"_{c}"]) for c in keys])
    joined = left.withColumn("_left", F.lit(True)).join(side, same, "full_outer")
    own = [F.when(F.col("_left"), left[c]).otherwise(side[f"_{c}"]).alias(c) if c in keys else left[c] for c in left.columns]
    return joined.select(*own, *rest)
