"""Scaling with saved parameters, encoding and binning."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import astuple, dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from prepkit.operators.columns import nan_to_null
from prepkit.operators.lookup import BROADCAST_ROWS, bounded
from prepkit.operators.ranking import running_totals
from prepkit.sources.frozen import frozen

SCALING_SCHEMA = "name string, data_min double, data_max double, scale double, min double"


@dataclass(frozen=True)
class Scaling:
    """How one column maps onto [0, 1]: ``x * scale + min``."""

    name: str
    data_min: float
    data_max: float
    scale: float
    min: float


def fit_minmax(df: DataFrame, columns: Sequence[str]) -> list[Scaling]:
    """One job for all columns; a constant column gets scale 1, and so maps to 0."""
    cells = [F.col(c).cast("double") for c in columns]
    row = nan_to_null(df.select(*[F.col(c) for c in columns])).agg(*[F.min(c).alias(f"a{i}") for i, c in enumerate(cells)],
                 *[F.max(c).alias(f"b{i}") for i, c in enumerate(cells)]).first()
    out = []
    for i, c in enumerate(columns):
        lo, hi = row[f"a{i}"], row[f"b{i}"]
        if lo is None:
            continue
        # + 0.0 turns a negative zero into a plain one
        scale = 1.0 / (hi - lo) if hi > lo else 1.0
        out.append(Scaling(c, lo + 0.0, hi + 0.0, scale, -lo * scale + 0.0))
    return out


def scaling_table(spark: SparkSession, scalings: Sequence[Scaling]) -> DataFrame:
    """The parameters as a table to store, one row per column."""
    return spark.createDataFrame([astuple(s) for s in scalings], SCALING_SCHEMA)


def load_scalings(table: DataFrame) -> list[Scaling]:
    """Stored parameters; one row per column of the data they were fitted on."""
    rows = table.select("name", "data_min", "data_max", "scale", "min").collect()
    return [Scaling(*r) for r in rows]


def apply_minmax(df: DataFrame, scalings: Sequence[Scaling]) -> DataFrame:
    by_name = {s.name: s for s in scalings}
    return nan_to_null(df).select(*[
        (F.col(c) * F.lit(by_name[c].scale) + F.lit(by_name[c].min)).alias(c) if c in by_name else F.col(c)
        for c in df.columns
    ])


def invert_minmax(df: DataFrame, scalings: Sequence[Scaling]) -> DataFrame:
    by_name = {s.name: s for s in scalings}
    return df.select(*[
        ((F.col(c) - F.lit(by_name[c].min)) / F.lit(by_name[c].scale)).alias(c) if c in by_name else F.col(c)
        for c in df.columns
    ])


def standardise(df: DataFrame, columns: Sequence[str], centre: bool = False, population: bool = False) -> DataFrame:
    """Divide by the deviation (sample, or population), after taking off the mean when ``centre``.

    A column without spread becomes 0 when centred and is left alone otherwise.
    """
    df = nan_to_null(df)
    spread = F.stddev_pop if population else F.stddev_samp
    row = df.agg(*[F.avg(c).alias(f"{c} mean") for c in columns], *[spread(c).alias(f"{c} std") for c in columns]).first()
    chosen = set(columns)

    def scaled(c: str):
        std = row[f"{c} std"] or 1.0
        cell = F.col(c) - F.lit(row[f"{c} mean"]) if centre else F.col(c)
        return (cell / F.lit(std)).alias(c)

    return df.select(*[scaled(c) if c in chosen else F.col(c) for c in df.columns])


def label_codes(df: DataFrame, column: str) -> DataFrame:
    """``value, code``: the distinct non-null values numbered in Spark's order from 0, NaN last.

    Values are ranked in slices, so their number is not bounded by a task or the driver.
    """
    values = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.lit(1).alias("one"))
    return running_totals(values, "value", "one").select("value", F.col("before").cast("int").alias("code"))


def label_encode(df: DataFrame, columns: Sequence[str], suffix: str = "_encoded") -> DataFrame:
    """Add ``{c}_encoded``, the position of the value among the column's sorted values, NaN last; NULL stays NULL.

    One pass finds the values of all columns, whatever their types, and one ranking numbers them: by a window where they
    are few, in slices where they are many. Without columns, the rows stay as they are.
    """
    if not columns:
        return df
    kinds = {c: df.schema[c].dataType.simpleString() for c in columns}
    fields = {k: f"v{i}" for i, k in enumerate(dict.fromkeys(kinds.values()))}

    def cell(c: str) -> Column:
        value = F.struct(*[(F.col(c) if kinds[c] == k else F.lit(None).cast(k)).alias(f) for k, f in fields.items()])
        return F.when(F.col(c).isNotNull(), F.struct(F.lit(c).alias("_of"), value.alias("_value")))

    cells = df.select(F.explode(F.array_compact(F.array(*map(cell, columns)))).alias("_cell")).select("_cell.*")
    values = frozen(cells.groupBy("_of", "_value").agg(F.lit(1).alias("_one")), "labels")
    few = values.count() <= BROADCAST_ROWS
    if few:
        ranked = values.withColumn("before", F.row_number().over(Window.partitionBy("_of").orderBy("_value")) - 1)
    else:
        ranked = running_totals(values, "_value", "_one", ["_of"])
    for c in columns:
        codes = ranked.where(F.col("_of") == c).select(F.col(f"_value.{fields[kinds[c]]}").alias("_value"), F.col("before").cast("int").alias(f"{c}{suffix}"))
        side = F.broadcast(codes) if few else bounded(codes)
        df = df.join(side, df[c] == side["_value"], "left").drop("_value")
    return df.select(*[c for c in df.columns if not c.endswith(suffix) or c[: -len(suffix)] not in columns],
                     *[f"{c}{suffix}" for c in columns])


def frequency_index(df: DataFrame, column: str, name: str) -> DataFrame:
    """Add the position of the value by falling frequency (ties by value); missing gets the next one."""
    df = nan_to_null(df)
    counted = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("_value")).agg(F.count("*").alias("_n"))
    # The order key is the count and the value in one column, so that slices can be cut on it.
    keyed = counted.select(F.struct((-F.col("_n")).alias("n"), "_value").alias("_order"), F.lit(1).alias("_one"))
    ranked = running_totals(keyed, "_order", "_one")
    places = bounded(ranked.select(F.col("_order._value").alias("_value"), "before", "whole"))
    total = counted.count()
    joined = df.join(places, df[column] == places["_value"], "left")
    return joined.withColumn(name, F.coalesce(F.col("before"), F.lit(total)).cast("double")).drop("_value", "before", "whole")


def assemble(columns: Sequence[str], output: str = "features") -> VectorAssembler:
    """The chosen columns as one vector; a missing cell is an error, not a silent drop."""
    return VectorAssembler(inputCols=list(columns), outputCol=output, handleInvalid="error")
