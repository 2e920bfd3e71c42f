"""Choosing, casting and deriving columns; each operator is one projection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from itertools import combinations, combinations_with_replacement

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prepkit.session import ready_checkpoints


@dataclass(frozen=True)
class Roles:
    """Which column plays which part."""

    numerical: tuple[str, ...] = ()
    categorical: tuple[str, ...] = ()
    binary: tuple[str, ...] = ()
    label: str | None = None
    ids: tuple[str, ...] = ()
    dropped: tuple[str, ...] = field(default=())

    @property
    def features(self) -> list[str]:
        """Columns a model may see: neither label, ids nor dropped ones."""
        barred = {self.label, *self.ids, *self.dropped}
        return [c for c in (*self.numerical, *self.categorical, *self.binary) if c not in barred]

    @classmethod
    def of(cls, df: DataFrame, label: str | None = None, ids: Sequence[str] = ()) -> Roles:
        """Roles read off the schema: numbers are numerical, strings categorical."""
        barred = [label, *ids]
        return cls(
            numerical=tuple(columns_of(df, "numeric", barred)),
            categorical=tuple(columns_of(df, "string", barred)),
            label=label,
            ids=tuple(ids),
        )


def columns_of(df: DataFrame, kind: str, exclude: Sequence[str | None] = ()) -> list[str]:
    """Column names of a kind: ``numeric``, ``integer``, ``float`` or ``string``."""
    kinds = {
        "numeric": T.NumericType,
        "integer": (T.ByteType, T.ShortType, T.IntegerType, T.LongType),
        "float": (T.FloatType, T.DoubleType),
        "string": T.StringType,
    }
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds[kind]) and f.name not in exclude]


def keep(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns)


def drop_if_present(df: DataFrame, columns: Sequence[str], strict: bool = False) -> DataFrame:
    """Drop columns; names the table does not have are ignored unless ``strict``."""
    unknown = [c for c in columns if c not in df.columns]
    if strict and unknown:
        raise ValueError(f"no such columns: {unknown}")
    return df.drop(*columns)


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename the columns that are present."""
    return df.withColumnsRenamed(dict(names))


def clean_names(df: DataFrame) -> DataFrame:
    """Remove quote characters from column names."""
    return df.toDF(*[c.replace('"', "") for c in df.columns])


def cast_columns(df: DataFrame, from_kind: str, to: str) -> DataFrame:
    """Cast every column of a kind, e.g. all floats to int (truncating)."""
    chosen = set(columns_of(df, from_kind))
    return df.select(*[F.col(c).cast(to).alias(c) if c in chosen else F.col(c) for c in df.columns])


def trim_strings(df: DataFrame) -> DataFrame:
    """Trim all string columns."""
    chosen = set(columns_of(df, "string"))
    return df.select(*[F.trim(c).alias(c) if c in chosen else F.col(c) for c in df.columns])


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN in floating-point columns becomes NULL, so that one test finds all missing cells."""
    chosen = set(columns_of(df, "float"))
    # nanvl names the cell once, so that plans stay small when many of these are stacked
    return df.select(*[
        F.nanvl(F.col(c), F.lit(None).cast(df.schema[c].dataType)).alias(c) if c in chosen else F.col(c) for c in df.columns
    ])


def add_key(df: DataFrame, name: str = "id") -> DataFrame:
    """Add a surrogate key, fixed by a reliable checkpoint.

    The numbering depends on the partitions, so it is written out before anything joins
    on it; a task run again would otherwise number its rows anew. Prefer a natural key.
    """
    ready_checkpoints(df.sparkSession)
    return df.withColumn(name, F.monotonically_increasing_id()).checkpoint()


def tag(df: DataFrame, **values: object) -> DataFrame:
    """Add constant columns."""
    return df.select("*", *[F.lit(v).alias(c) for c, v in values.items()])


def with_squares(df: DataFrame, columns: Sequence[str], suffix: str = "_squared") -> DataFrame:
    """Add the square of each column, in double."""
    squares = [(F.col(c).cast("double") * F.col(c).cast("double")).alias(f"{c}{suffix}") for c in columns]
    return df.select("*", *squares)


def with_pairwise_products(
    df: DataFrame, columns: Sequence[str], with_self: bool = False, joiner: str = "_x_"
) -> DataFrame:
    """Add the product of each pair, in double since integer products overflow."""
    pairs = combinations_with_replacement(columns, 2) if with_self else combinations(columns, 2)
    products = [(F.col(a).cast("double") * F.col(b).cast("double")).alias(f"{a}{joiner}{b}") for a, b in pairs]
    return df.select("*", *products)


def with_pairwise_max(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add the larger of each pair as ``max_a_b``; a NULL yields the other one."""
    return df.select("*", *[F.greatest(a, b).alias(f"max_{a}_{b}") for a, b in combinations(columns, 2)])
