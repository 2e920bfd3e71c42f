"""Figures about a table: missing cells, frequencies, moments, quantiles, distributions.

A figure over many columns is one aggregate, whatever their number. Where Spark's own
aggregate keeps every value of a column in one buffer (``mode``, ``percentile``), values
are either counted through a shuffle or narrowed down first, so no buffer grows with the data.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prepkit.functions.cells import Bracket, bracket, missing, valid_cell
from prepkit.functions.markup import tokens
from prepkit.operators.columns import columns_of, nan_to_null
from prepkit.operators.gram import gram_correlations
from prepkit.operators.lookup import bounded
from prepkit.operators.ranking import running_totals
from prepkit.sources.frozen import frozen

# Distinct values a single exact-percentile buffer may hold.
BUFFER_VALUES = 200_000
# Columns whose pairs are each an expression of one aggregate.
PAIRED_COLUMNS = 16
# Values of one column gathered to finish a narrowed quantile.
GATHERED_VALUES = 50_000


def _long(records: Sequence[Mapping[str, Column]], df: DataFrame) -> DataFrame:
    """One aggregate row turned into one row per record."""
    rows = F.array(*[F.struct(*[v.alias(k) for k, v in r.items()]) for r in records])
    return df.agg(rows.alias("_rows")).select(F.inline("_rows"))


# --- missing cells, counts ----------------------------------------------------------


def _gap_count(df: DataFrame, c: str) -> Column:
    floats = columns_of(df, "float")
    return F.count_if(missing(c, c in floats))


def missing_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``column, n_missing``: NULL cells, and NaN in floating-point columns."""
    chosen = columns or df.columns
    return _long([{"column": F.lit(c), "n_missing": _gap_count(df, c)} for c in chosen], df)


def missing_totals(df: DataFrame) -> dict[str, int]:
    """Missing cells per column, for choosing columns."""
    return {r["column"]: r["n_missing"] for r in missing_counts(df).collect()}


def shape(df: DataFrame) -> DataFrame:
    """``n_rows, n_columns``."""
    return df.agg(F.count("*").alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def count_where(df: DataFrame, condition: Column, name: str = "n") -> DataFrame:
    """How many rows meet a condition, as one row."""
    return df.agg(F.count_if(condition).alias(name))


def partition_count(df: DataFrame) -> int:
    """Partitions that hold rows."""
    return df.select(F.spark_partition_id().alias("p")).distinct().count()


def _value_pairs(df: DataFrame, columns: Sequence[str], cast: str) -> DataFrame:
    """Non-missing cells as ``column, value`` rows of one type; 0.0 and -0.0 are one value, NaN is none."""
    df = nan_to_null(df.select(*[F.col(c) for c in columns]))
    floats = columns_of(df, "float")
    casted = df.select(*[(F.col(c) + F.lit(0.0) if c in floats else F.col(c)).cast(df.schema[c].dataType).cast(cast).alias(c)
                         for c in columns])
    return casted.unpivot([], list(columns), "column", "value").where("value IS NOT NULL")


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column, value, n`` of the non-null values, as text."""
    return _value_pairs(df, columns, "string").groupBy("column", "value").agg(F.count("*").alias("n"))


def count_distinct(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """``column, n_distinct`` of the non-null values."""
    if approximate:
        cells = nan_to_null(df.select(*[F.col(c) for c in columns]))
        return _long([{"column": F.lit(c), "n_distinct": F.approx_count_distinct(c)} for c in columns], cells)
    pairs = _value_pairs(df, columns, "string").distinct()
    found = pairs.groupBy("column").agg(F.count("*").alias("n_distinct"))
    names = df.sparkSession.createDataFrame([(c,) for c in columns], "column string")
    return names.join(found, "column", "left").fillna(0, ["n_distinct"])


def group_mean(df: DataFrame, by: Sequence[str], column: str, name: str) -> DataFrame:
    return nan_to_null(df).groupBy(*by).agg(F.avg(column).alias(name))


def missing_by_bracket(df: DataFrame, target: str, value: str, brackets: Sequence[Bracket]) -> DataFrame:
    """``bracket, n_missing``: rows lacking ``target``, by the bracket of ``value``."""
    gaps = df.where(missing(target, target in columns_of(df, "float"))).select(bracket(value, brackets).alias("bracket"))
    return gaps.where("bracket IS NOT NULL").groupBy("bracket").agg(F.count("*").alias("n_missing"))


# --- means and modes ----------------------------------------------------------------


def mean_std(df: DataFrame, columns: Sequence[str], ranges: Mapping[str, Any] | None = None) -> DataFrame:
    """``column, mean, std`` (sample), over valid cells only where a range is given."""
    cells = {c: valid_cell(c, ranges or {}) for c in columns}
    return _long([{"column": F.lit(c), "mean": F.avg(v), "std": F.stddev_samp(v)} for c, v in cells.items()], nan_to_null(df))


def modes(df: DataFrame, columns: Sequence[str], ranges: Mapping[str, Any] | None = None) -> DataFrame:
    """``column, mode, n``: the most frequent non-null value as text, the smallest on a tie.

    Counting goes through a shuffle with map-side aggregation, so a column may have any
    number of values. Columns are counted per type family, so that ties compare right.
    """
    df = nan_to_null(df).select(*[valid_cell(c, ranges or {}).alias(c) for c in columns])
    families: dict[str, list[str]] = {}
    for c in columns:
        kind = df.schema[c].dataType
        cast = "string"
        if isinstance(kind, T.IntegralType):
            cast = "bigint"
        elif isinstance(kind, T.NumericType):
            cast = kind.simpleString()
        families.setdefault(cast, []).append(c)
    parts = []
    for cast, chosen in families.items():
        counted = _value_pairs(df, chosen, cast).groupBy("column", "value").agg(F.count("*").alias("n"))
        best = counted.groupBy("column").agg(F.min(F.struct((-F.col("n")).alias("neg"), "value")).alias("b"))
        parts.append(best.select("column", F.col("b.value").cast("string").alias("mode"), (-F.col("b.neg")).alias("n")))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def group_modes(df: DataFrame, by: Sequence[str], column: str, name: str = "mode") -> DataFrame:
    """Per group the most frequent non-null value, the smallest on a tie."""
    counted = nan_to_null(df).where(F.col(column).isNotNull()).groupBy(*by, column).agg(F.count("*").alias("_n"))
    best = counted.groupBy(*by).agg(F.min(F.struct((-F.col("_n")).alias("neg"), F.col(column).alias("v"))).alias("b"))
    return best.select(*by, F.col("b.v").alias(name), (-F.col("b.neg")).alias("n"))


# --- quantiles ----------------------------------------------------------------------


@dataclass
class _Target:
    """An order statistic being located: the k-th smallest (from 0) inside an open interval."""

    column: str
    k: int
    inside: int
    lo: Any = None
    hi: Any = None
    value: Any = None

    def cell(self) -> Column:
        test = F.col(self.column).isNotNull()
        if self.lo is not None:
            test = test & (F.col(self.column) > F.lit(self.lo))
        if self.hi is not None:
            test = test & (F.col(self.column) < F.lit(self.hi))
        return F.when(test, F.col(self.column))

    def advance(self, a: Any, b: Any, below: int, at_a: int, between: int, at_b: int) -> None:
        """Keep the part that holds the rank, given the counts around two bounds a <= b."""
        if self.k < below:
            self.hi, self.inside = a, below
        elif self.k < below + at_a:
            self.value = a
        elif self.k < below + at_a + between:
            self.k, self.inside, self.lo, self.hi = self.k - below - at_a, between, a, b
        elif self.k < below + at_a + between + at_b:
            self.value = b
        else:
            passed = below + at_a + between + at_b
            self.k, self.inside, self.lo = self.k - passed, self.inside - passed, b


def _settle(df: DataFrame, placed: Sequence[tuple[Sequence[_Target], Any, Any]]) -> None:
    """Count the cells around each pair of bounds, all pairs in one aggregate, and narrow their targets."""
    tests = []
    for i, (group, a, b) in enumerate(placed):
        cell = group[0].cell()
        tests += [
            F.count_if(cell < F.lit(a)).alias(f"{i} below"),
            F.count_if(cell == F.lit(a)).alias(f"{i} a"),
            F.count_if((cell > F.lit(a)) & (cell < F.lit(b))).alias(f"{i} between"),
            F.count_if((cell == F.lit(b)) & F.lit(b > a)).alias(f"{i} b"),
        ]
    found = df.agg(*tests).first()
    for i, (group, a, b) in enumerate(placed):
        for t in group:
            t.advance(a, b, *[found[f"{i} {part}"] for part in ("below", "a", "between", "b")])


def _order_statistics(df: DataFrame, first: Sequence[tuple[Sequence[_Target], Any, Any]], limit: int, accuracy: int) -> None:
    """Find the exact values of the targets, given bounds around each group of them.

    The cells around the bounds are counted, and the few left inside intervals are put
    aside; from then on only those are read. Each further round asks an approximate
    percentile for two bounds around every wanted rank. The bounds themselves leave the
    interval, so a value held by many rows cannot stall the narrowing.
    """
    targets = [t for group, _, _ in first for t in group]
    _settle(df, first)
    left = [t for t in targets if t.value is None]
    if not left:
        return
    inside: dict[str, Column] = {}
    for members in _by_interval(left):
        held = members[0].cell().isNotNull()
        inside[members[0].column] = inside[members[0].column] | held if members[0].column in inside else held
    cells = df.select(*[F.when(test, F.col(c)).alias(c) for c, test in inside.items()])
    df = frozen(cells.dropna("all"), "narrowed")
    while True:
        open_ = [t for t in targets if t.value is None and t.inside > limit]
        if not open_:
            break
        # One aggregate serves all ranks of an interval, and one pair of bounds serves neighbours.
        pairs = [(members, _neighbours(members)) for members in _by_interval(open_)]
        margin = 2.0 / accuracy
        asked = []
        for i, (members, groups) in enumerate(pairs):
            size = members[0].inside
            shares = [
                share for group in groups
                for share in (max(group[0].k / size - margin, 0.0), min((group[-1].k + 1) / size + margin, 1.0))
            ]
            asked.append(F.percentile_approx(members[0].cell(), shares, accuracy).alias(str(i)))
        guesses = df.agg(*asked).first()
        _settle(df, [
            (group, *guesses[str(i)][2 * j : 2 * j + 2]) for i, (_, groups) in enumerate(pairs) for j, group in enumerate(groups)
        ])
    rest = _by_interval([t for t in targets if t.value is None])
    if rest:
        sorted_cells = [F.sort_array(F.collect_list(members[0].cell())) for members in rest]
        gathered = df.agg(*[
            F.array(*[F.get(cells, F.lit(t.k)) for t in members]).alias(str(i))
            for i, (members, cells) in enumerate(zip(rest, sorted_cells))
        ]).first()
        for i, members in enumerate(rest):
            for t, value in zip(members, gathered[str(i)]):
                t.value = value


def _by_interval(targets: Sequence[_Target]) -> list[list[_Target]]:
    """Targets of one column and interval together, by rank."""
    groups: dict[tuple, list[_Target]] = {}
    for t in targets:
        groups.setdefault((t.column, t.lo, t.hi), []).append(t)
    return [sorted(members, key=lambda t: t.k) for members in groups.values()]


def _neighbours(members: Sequence[_Target]) -> list[list[_Target]]:
    """Runs of ranks one apart, as the two a quantile lies between."""
    groups: list[list[_Target]] = []
    for t in members:
        if groups and t.k - groups[-1][-1].k <= 1:
            groups[-1].append(t)
        else:
            groups.append([t])
    return groups


def _quantiles_and(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    also: Sequence[Column] = (),
    buffer_values: int = BUFFER_VALUES,
    gathered_values: int = GATHERED_VALUES,
    accuracy: int = 1_000,
) -> tuple[dict[str, list[float | None]], Any]:
    """Exact quantiles, and the row of the aggregates ``also`` (named), which the first scan takes along.

    At most three scans read ``df`` whole: counts with bounds around the quantiles, the
    cells around the bounds, and the few cells inside them, which are put aside.
    """
    df = nan_to_null(df.select(*dict.fromkeys(columns)))
    margin = 2.0 / accuracy
    shares = [min(max(p + side, 0.0), 1.0) for p in probs for side in (-margin, margin)]
    probe = df.agg(
        *[F.count(c).alias(f"{c} n") for c in columns],
        *[F.approx_count_distinct(c, 0.05).alias(f"{c} d") for c in columns],
        *[F.percentile_approx(c, shares, accuracy).alias(f"{c} b") for c in columns],
        *also,
    ).first()
    out: dict[str, list[float | None]] = {c: [None] * len(probs) for c in columns if not probe[f"{c} n"]}
    few = [c for c in columns if c not in out and probe[f"{c} d"] <= buffer_values]
    many = [c for c in columns if c not in out and c not in few]
    if few:
        asked = F.array(*[F.lit(float(p)) for p in probs])
        row = df.agg(*[F.percentile(c, asked).alias(c) for c in few]).first()
        out.update({c: list(row[c]) for c in few})
    if many:
        found: dict[tuple[str, int], _Target] = {}
        first = []
        for c in many:
            n = probe[f"{c} n"]
            for i, p in enumerate(probs):
                x = p * (n - 1)
                group = [found.setdefault((c, k), _Target(c, k, n)) for k in {math.floor(x), math.ceil(x)} if (c, k) not in found]
                if group:
                    first.append((group, *probe[f"{c} b"][2 * i : 2 * i + 2]))
        _order_statistics(df, first, gathered_values, accuracy)
        for c in many:
            out[c] = []
            for p in probs:
                x = p * (probe[f"{c} n"] - 1)
                low, high = float(found[c, math.floor(x)].value), float(found[c, math.ceil(x)].value)
                out[c].append(low if low == high else low * (math.ceil(x) - x) + high * (x - math.floor(x)))
    return {c: out[c] for c in columns}, probe


def quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    buffer_values: int = BUFFER_VALUES,
    gathered_values: int = GATHERED_VALUES,
    accuracy: int = 1_000,
) -> dict[str, list[float | None]]:
    """Exact quantiles with linear interpolation, missing cells ignored.

    Columns of few distinct values go through one ``percentile`` aggregate; the others
    are narrowed down by bounds and counts, without a shuffle of their values.
    """
    return _quantiles_and(df, columns, probs, (), buffer_values, gathered_values, accuracy)[0]


def quantile_table(df: DataFrame, columns: Sequence[str], probs: Sequence[float], approximate: bool = False) -> DataFrame:
    """``column, prob, value``; exact unless ``approximate``, which takes a single pass."""
    if approximate:
        asked = [float(p) for p in probs]
        wide = nan_to_null(df).agg(*[F.percentile_approx(c, asked, 10_000).alias(c) for c in columns])
        rows = [F.struct(F.lit(c).alias("column"), F.lit(p).alias("prob"), F.get(c, F.lit(i)).cast("double").alias("value"))
                for c in columns for i, p in enumerate(asked)]
        return wide.select(F.inline(F.array(*rows)))
    found = quantiles(df, columns, probs)
    rows = [(c, float(p), v) for c in columns for p, v in zip(probs, found[c])]
    return df.sparkSession.createDataFrame(rows, "column string, prob double, value double")


def group_quantiles(
    df: DataFrame, by: Sequence[str], column: str, probs: Sequence[float], buffer_values: int = BUFFER_VALUES
) -> DataFrame:
    """Group columns, ``prob`` and the exact ``value``.

    Groups that hold more distinct values than one buffer should are taken apart from the
    others: their values are counted first and ranked in slices.
    """
    values = nan_to_null(df.select(*by, F.col(column).cast("double").alias("_v"))).where("_v IS NOT NULL")
    asked = F.array(*[F.lit(float(p)) for p in probs])

    def buffered(part: DataFrame) -> DataFrame:
        both = F.arrays_zip(asked.alias("prob"), F.percentile("_v", asked).alias("value"))
        return part.groupBy(*by).agg(both.alias("q")).select(*by, F.inline("q"))

    spread = values.groupBy(F.struct(*by).alias("_of")).agg(F.approx_count_distinct("_v").alias("d"))
    # a row a group at most, put aside since it is counted before it is read
    large = bounded(frozen(spread.where(F.col("d") > buffer_values).select("_of"), "large"))
    if large.isEmpty():
        return buffered(values)
    keyed = values.withColumn("_key", F.struct(*by))
    small_part = keyed.join(large, keyed["_key"] == large["_of"], "left_anti").drop("_key")
    large_part = keyed.join(large, keyed["_key"] == large["_of"], "left_semi").drop("_key")
    counted = large_part.groupBy(*by, "_v").agg(F.count("*").alias("_n"))
    ranked = running_totals(counted, "_v", "_n", by)
    placed = ranked.select(*by, "_v", "_n", "before", "whole", F.explode(asked).alias("prob"))
    place = F.col("prob") * (F.col("whole") - 1)

    def holds(rank: Column) -> Column:
        return (rank >= F.col("before")) & (rank < F.col("before") + F.col("_n"))

    placed = placed.where(holds(F.floor(place)) | holds(F.ceil(place)))
    share = F.max(place - F.floor(place))
    low, high = F.max(F.when(holds(F.floor(place)), F.col("_v"))), F.max(F.when(holds(F.ceil(place)), F.col("_v")))
    between = F.when(low == high, low).otherwise(low * (1.0 - share) + high * share)
    found = placed.groupBy(*by, "prob").agg(between.alias("value"))
    return buffered(small_part).unionByName(found)


# --- summaries ----------------------------------------------------------------------


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column, n, mean, std, min, q25, q50, q75, max`` of numeric columns; NaN counts as missing."""
    moments = []
    for c in columns:
        cell = F.col(c).cast("double")
        moments += [F.avg(c).cast("double").alias(f"{c} mean"), F.stddev_samp(c).alias(f"{c} std"),
                    F.min(cell).alias(f"{c} min"), F.max(cell).alias(f"{c} max")]
    found, row = _quantiles_and(df, columns, [0.25, 0.5, 0.75], moments)
    rows = [(c, row[f"{c} n"], row[f"{c} mean"], row[f"{c} std"], row[f"{c} min"], *found[c], row[f"{c} max"]) for c in columns]
    kinds = "column string, n bigint, mean double, std double, min double, q25 double, q50 double, q75 double, max double"
    return df.sparkSession.createDataFrame(rows, kinds)


def _corr(a: str, b: str) -> Column:
    """Pearson's r over rows that have both; NULL where one has no spread, for which Spark's own divides by zero."""
    spread = F.stddev_pop(F.when(F.col(b).isNotNull(), F.col(a))) * F.stddev_pop(F.when(F.col(a).isNotNull(), F.col(b)))
    return F.try_divide(F.covar_pop(a, b), spread)


def corr_matrix(
    df: DataFrame, columns: Sequence[str], above: float | None = None, at_least: float | None = None
) -> DataFrame:
    """``col_a, col_b, r, n`` for each pair, over rows where both cells count; no r without spread.

    With ``above`` or ``at_least`` only cells beyond that value count. A few columns are one aggregate of expressions, more
    than ``PAIRED_COLUMNS`` go through matrix products.
    """
    def cell(c: str) -> Column:
        if above is not None:
            return F.when(F.col(c) > above, F.col(c))
        if at_least is not None:
            return F.when(F.col(c) >= at_least, F.col(c))
        return F.col(c)

    cells = nan_to_null(df).select(*[cell(c).cast("double").alias(c) for c in columns])
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1:]]
    if not pairs:
        return df.sparkSession.createDataFrame([], "col_a string, col_b string, r double, n bigint")
    if len(columns) > PAIRED_COLUMNS:
        return gram_correlations(cells, columns)
    return _long([
        {
            "col_a": F.lit(a),
            "col_b": F.lit(b),
            "r": _corr(a, b),
            "n": F.count_if(F.col(a).isNotNull() & F.col(b).isNotNull()),
        }
        for a, b in pairs
    ], cells)


def skew_kurtosis(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column, skew, kurtosis``: population skewness and excess kurtosis."""
    return _long([{"column": F.lit(c), "skew": F.skewness(c), "kurtosis": F.kurtosis(c)} for c in columns], nan_to_null(df))


def adjusted_skew(c: str | Column) -> Column:
    """Sample-adjusted skewness; NULL below three values or without spread."""
    n = F.count(c).cast("double")
    return F.when(n >= 3, F.skewness(c) * F.sqrt(n * (n - 1.0)) / F.nullif(n - 2.0, F.lit(0.0)))


def binned_stats(df: DataFrame, by: Sequence[str], column: str) -> DataFrame:
    """Per group ``mean, median, std, skew`` (adjusted) ``, n``; rows without a group are left out."""
    df = nan_to_null(df)
    figures = df.where(F.col(column).isNotNull()).groupBy(*by).agg(
        F.avg(column).alias("mean"),
        F.stddev_samp(column).alias("std"),
        adjusted_skew(column).alias("skew"),
        F.count(column).alias("n"),
    )
    medians = group_quantiles(df.dropna(subset=list(by)), by, column, [0.5]).select(*by, F.col("value").alias("median"))
    return figures.join(medians, list(by))


def normality(df: DataFrame, by: Sequence[str], column: str, more_than: int = 500, alpha: float = 0.05) -> DataFrame:
    """Per group of more than that many values ``n, jb, p, normal`` (Jarque-Bera); rows without a group are left out."""
    figures = nan_to_null(df).dropna(subset=list(by)).groupBy(*by).agg(
        F.count(column).alias("n"), F.skewness(column).alias("_g"), F.kurtosis(column).alias("_k")
    ).where(F.col("n") > more_than)
    jb = F.col("n") / 6.0 * (F.col("_g") * F.col("_g") + F.col("_k") * F.col("_k") / 4.0)
    tested = figures.withColumn("jb", jb).withColumn("p", F.exp(-F.col("jb") / 2.0))
    return tested.select(*by, "n", "jb", "p", (F.col("p") > alpha).alias("normal"))


# --- distributions ------------------------------------------------------------------


def _extent(df: DataFrame, column: str) -> tuple[float | None, float | None]:
    row = df.agg(F.min(F.col(column).cast("double")), F.max(F.col(column).cast("double"))).first()
    return row[0], row[1]


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """``bin, lo, hi, n`` of all equal-width bins between the extremes; no rows where there is no value."""
    df = nan_to_null(df.select(F.col(column)))
    lo, hi = _extent(df, column)
    if lo is None:
        return df.sparkSession.createDataFrame([], "bin int, lo double, hi double, n bigint")
    width = (hi - lo) / bins or 1.0 / bins
    cells = df.where(F.col(column).isNotNull())
    index = F.least(F.floor((F.col(column).cast("double") - F.lit(lo)) / F.lit(width)).cast("int"), F.lit(bins - 1))
    counted = cells.select(index.alias("bin")).groupBy("bin").agg(F.count("*").alias("n"))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    start = F.lit(lo) + F.col("bin") * F.lit(width)
    filled = every.join(F.broadcast(counted), "bin", "left")
    return filled.select("bin", start.alias("lo"), (start + F.lit(width)).alias("hi"), F.coalesce("n", F.lit(0)).alias("n"))


def density(df: DataFrame, column: str, points: int = 50, bins: int = 512) -> DataFrame:
    """``x, density``: a Gaussian kernel curve (Scott bandwidth) over a grid of points.

    The kernels sit on histogram bins, at most ``bins`` rows, not on the data's rows.
    """
    df = nan_to_null(df.select(F.col(column)))
    row = df.agg(F.count(column), F.stddev_samp(column), F.min(column), F.max(column)).first()
    n, std, lo, hi = row
    if not n or not std:
        return df.sparkSession.createDataFrame([], "x double, density double")
    h = float(std) * n ** -0.2
    step = (float(hi) - float(lo)) / (points - 1)
    counted = histogram(df, column, bins).where("n > 0")
    grid = F.transform(F.sequence(F.lit(0), F.lit(points - 1)), lambda i: F.lit(float(lo)) + i * F.lit(step))
    spread = counted.select(((F.col("lo") + F.col("hi")) / 2.0).alias("mid"), "n", F.explode(grid).alias("x"))
    z = (F.col("x") - F.col("mid")) / F.lit(h)
    weight = F.sum(F.col("n") * F.exp(-z * z / 2.0))
    return spread.groupBy("x").agg((weight / F.lit(n * h * math.sqrt(2.0 * math.pi))).alias("density"))


def _box(cell: Column, q1: Column, q2: Column, q3: Column, k: float) -> dict[str, Column]:
    low, high = q1 - F.lit(k) * (q3 - q1), q3 + F.lit(k) * (q3 - q1)
    near = F.when((cell >= low) & (cell <= high), cell)
    return {"q1": q1, "median": q2, "q3": q3, "iqr": q3 - q1, "whisker_lo": F.min(near), "whisker_hi": F.max(near),
            "n_outliers": F.count_if((cell < low) | (cell > high))}


def box_summary(df: DataFrame, columns: Sequence[str], positive_only: bool = False, k: float = 1.5) -> DataFrame:
    """``column, q1, median, q3, iqr, whisker_lo, whisker_hi, n_outliers``.

    Whiskers end at the last value within ``k`` inter-quartile ranges of the box.
    """
    df = nan_to_null(df.select(*[F.col(c) for c in columns]))
    if positive_only:
        df = df.select(*[F.when(F.col(c) > 0, F.col(c)).alias(c) for c in columns])
    found = quantiles(df, columns, [0.25, 0.5, 0.75])
    records = []
    for c in columns:
        q1, q2, q3 = [F.lit(v).cast("double") for v in found[c]]
        records.append({"column": F.lit(c), **_box(F.col(c).cast("double"), q1, q2, q3, k)})
    return _long(records, df)


def box_by_group(df: DataFrame, by: Sequence[str], column: str, k: float = 1.5) -> DataFrame:
    """The box figures of one column per group; rows without a group are left out."""
    df = nan_to_null(df)
    found = group_quantiles(df, by, column, [0.25, 0.5, 0.75])
    wide = found.groupBy(*by).agg(*[
        F.max(F.when(F.col("prob") == p, F.col("value"))).alias(n) for p, n in ((0.25, "q1"), (0.5, "q2"), (0.75, "q3"))
    ])
    cells = df.where(F.col(column).isNotNull()).select(*by, F.col(column).cast("double").alias("_v"))
    joined = cells.join(bounded(frozen(wide, "boxes")), list(by))
    box = _box(F.col("_v"), F.col("q1"), F.col("q2"), F.col("q3"), k)
    keep = {n: (F.max(v) if n in ("q1", "median", "q3", "iqr") else v) for n, v in box.items()}
    return joined.groupBy(*by).agg(*[v.alias(n) for n, v in keep.items()])


# --- words and best rows ------------------------------------------------------------


def word_counts(df: DataFrame, text: str, at_least: int = 1) -> DataFrame:
    """``token, n``: tokens between single spaces, the empty one included."""
    words = df.select(F.explode(tokens(text)).alias("token"))
    return words.groupBy("token").agg(F.count("*").alias("n")).where(F.col("n") >= at_least)


def best_row(df: DataFrame, measure: str, rank: str) -> DataFrame:
    """The row with the largest measure; on a tie the one listed first by ``rank``."""
    return nan_to_null(df).orderBy(F.col(measure).desc_nulls_last(), F.col(rank)).limit(1)
