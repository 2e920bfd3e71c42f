"""Shapes of a column by group: a rank-based test of normality, and kernel curves for all groups at once."""

from __future__ import annotations

import math
from collections.abc import Sequence
from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prepkit.operators.columns import nan_to_null
from prepkit.operators.lookup import bounded
from prepkit.operators.ranking import running_totals
from prepkit.sources.frozen import frozen

# Coefficients of the rational approximation of the normal quantile (Acklam), error under 1.2e-9 of the value:
# numerator and denominator around the middle, then in the tails, highest power first.
MIDDLE = ((-39.69683028665376, 220.9460984245205, -275.9285104469687, 138.3577518672690, -30.66479806614716, 2.506628277459239),
          (-54.47609879822406, 161.5858368580409, -155.6989798598866, 66.80131188771972, -13.28068155288572, 1.0))
TAIL = ((-0.007784894002430293, -0.3223964580411365, -2.400758277161838, -2.549732539343734, 4.374664141464968, 2.938163982698783),
        (0.007784695709041462, 0.3224671290700398, 2.445134137142996, 3.754408661907416, 1.0))
TAIL_FROM = 0.02425
# Royston's parameters for the distribution of ln(1 - w), of the mean and of the deviation.
MEAN_W, DEVIATION_W = (-1.2725, 1.0521), (1.0308, -0.26758)


def _poly(x: Column, coefficients: Sequence[float]) -> Column:
    value = F.lit(coefficients[0])
    for c in coefficients[1:]:
        value = value * x + c
    return value


def normal_quantile(p: Column) -> Column:
    """Where the standard normal distribution reaches ``p``; NULL at and beyond 0 and 1."""
    near = p - 0.5
    middle = near * _poly(near * near, MIDDLE[0]) / _poly(near * near, MIDDLE[1])

    def tail(share: Column) -> Column:
        q = F.sqrt(-2.0 * F.log(share))
        return _poly(q, TAIL[0]) / _poly(q, TAIL[1])

    value = F.when(p < TAIL_FROM, tail(p)).when(p > 1 - TAIL_FROM, -tail(1.0 - p)).otherwise(middle)
    return F.when((p > 0) & (p < 1), value)


def rank_normality(df: DataFrame, by: Sequence[str], column: str, more_than: int = 500, alpha: float = 0.05) -> DataFrame:
    """Per group of more than that many values ``n, w, z, normal``: the Shapiro-Francia test on exact ranks.

    ``w`` is the squared correlation of the values with the normal scores of their ranks, tied values sharing their middle
    rank; ``z`` is large where it is too low for normal values; ``normal`` is whether z stays under the quantile of 1 -
    alpha. Both are NULL without spread. Values are counted first and ranked in slices, so a group may hold any share of
    the rows. Missing values (NaN too) and rows without a group are left out. Fitted for up to 5,000 values; of more, the
    test is as strict as that formula continued.
    """
    cells = nan_to_null(df.select(*by, F.col(column).cast("double").alias("_v"))).dropna()
    counted = cells.groupBy(*by, (F.col("_v") + 0.0).alias("_v")).agg(F.count("*").alias("_n"))
    ranked = running_totals(counted, "_v", "_n", list(by)).where(F.col("whole") > more_than)
    middle = F.col("before") + (F.col("_n") + 1) / 2.0
    scored = ranked.withColumn("_m", normal_quantile((middle - 0.375) / (F.col("whole") + 0.25)))
    # values are taken relative to one of the group, so that sums of squares keep their digits
    base = scored.groupBy(*by).agg(F.avg("_v").alias("_base")).select(F.struct(*by).alias("_of"), "_base")
    moved = scored.withColumn("_key", F.struct(*by)).join(bounded(frozen(base, "bases")), F.col("_key") == F.col("_of")).withColumn("_x", F.col("_v") - F.col("_base"))
    n, x, m = F.col("_n"), F.col("_x"), F.col("_m")
    sums = moved.groupBy(*by).agg(
        F.sum("_n").alias("n"), F.sum(n * x).alias("_sx"), F.sum(n * m).alias("_sm"), F.sum(n * x * x).alias("_xx"),
        F.sum(n * m * m).alias("_mm"), F.sum(n * x * m).alias("_xm"),
    )
    of = {k: F.col(f"_{k}") for k in ("sx", "sm", "xx", "mm", "xm")}
    both = of["xm"] - of["sx"] * of["sm"] / F.col("n")
    spread = (of["xx"] - of["sx"] * of["sx"] / F.col("n")) * (of["mm"] - of["sm"] * of["sm"] / F.col("n"))
    tested = sums.withColumn("w", F.when(spread > 0, F.least(F.lit(1.0), F.try_divide(both * both, spread))))
    u = F.log(F.log(F.col("n").cast("double")))
    mean = MEAN_W[0] + MEAN_W[1] * (u - F.log(F.col("n")))
    deviation = DEVIATION_W[0] + DEVIATION_W[1] * (u + 2.0 / F.log(F.col("n")))
    tested = tested.withColumn("z", (F.log(F.greatest(1.0 - F.col("w"), F.lit(1e-300))) - mean) / deviation)
    tested = tested.withColumn("z", F.when(F.col("w").isNotNull(), F.col("z")))
    return tested.select(*by, "n", "w", "z", (F.col("z") < NormalDist().inv_cdf(1 - alpha)).alias("normal"))


def density_by_group(df: DataFrame, by: Sequence[str], column: str, points: int = 50, bins: int = 512) -> DataFrame:
    """Per group ``x, density``: a Gaussian kernel curve (Scott bandwidth of the group) over a grid of its points.

    One aggregate finds each group's extremes and spread, a second counts its rows by bin, of all groups together; curves
    are worked out from a group's bins, at most ``bins`` of them. Groups without spread have no curve; missing values (NaN
    too) and rows without a group are left out.
    """
    cells = nan_to_null(df.select(*by, F.col(column).cast("double").alias("_v"))).dropna()
    figures = cells.groupBy(*by).agg(
        F.count("*").alias("_n"), F.stddev_samp("_v").alias("_sd"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")
    ).where("_sd > 0")
    side = figures.select(F.struct(*by).alias("_of"), "_n", "_sd", "_lo", "_hi")
    width = (F.col("_hi") - F.col("_lo")) / bins
    index = F.least(F.floor((F.col("_v") - F.col("_lo")) / width).cast("int"), F.lit(bins - 1))
    joined = cells.withColumn("_key", F.struct(*by)).join(bounded(frozen(side, "extents")), F.col("_key") == F.col("_of"))
    counted = joined.select(*by, "_n", "_sd", "_lo", "_hi", index.alias("_bin")).groupBy(*by, "_n", "_sd", "_lo", "_hi", "_bin").agg(F.count("*").alias("_c"))
    held = counted.groupBy(*by, "_n", "_sd", "_lo", "_hi").agg(F.sort_array(F.collect_list(F.struct("_bin", "_c"))).alias("_bins"))
    h = F.col("_sd") * F.pow(F.col("_n").cast("double"), F.lit(-0.2))
    step = (F.col("_hi") - F.col("_lo")) / (points - 1)
    grid = F.transform(F.sequence(F.lit(0), F.lit(points - 1)), lambda i: F.col("_lo") + i * step)
    spots = held.select(*by, "_n", "_lo", "_bins", h.alias("_h"), width.alias("_w"), F.explode(grid).alias("x"))

    def weight(total: Column, b: Column) -> Column:
        z = (F.col("x") - (F.col("_lo") + (b["_bin"] + 0.5) * F.col("_w"))) / F.col("_h")
        return total + b["_c"] * F.exp(-z * z / 2.0)

    area = F.col("_n") * F.col("_h") * math.sqrt(2.0 * math.pi)
    return spots.select(*by, "x", (F.aggregate("_bins", F.lit(0.0), weight) / area).alias("density"))
