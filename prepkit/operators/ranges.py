"""Rows met with the ranges of a table that hold their value, by equality of cells.

A range lies in one or two cells of a grid whose cells are a power of two wide and at least as long as the range. So a
value meets a range in one cell of that grid: an equi-join on grid and cell, then the exact test. A value looks into one
cell for each grid that some range uses, however long, short, nested or overlapping the ranges are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prepkit.operators.columns import nan_to_null
from prepkit.operators.lookup import bounded
from prepkit.operators.ranking import running_totals
from prepkit.sources.frozen import frozen

#: Grid of ranges that hold one value: the value is the cell.
POINT = -2000
#: Rows of a range table that are broadcast, if they are small.
BROADCAST_RANGES = 500_000


def _number(value: Column, kind: T.DataType) -> Column:
    """A double that never falls where the value rises."""
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(value.cast("timestamp")).cast("double")
    if not isinstance(kind, T.NumericType):
        raise TypeError(f"ranges need numbers, dates or timestamps, not {kind.simpleString()}")
    return F.nanvl(value.cast("double"), F.lit(None))


def _cell(number: Column, grid: Column | int) -> Column:
    """Dividing by a power of two is exact, so cells rise with the number; what is too large to have a fraction stays."""
    grid = F.lit(grid)
    scaled = number / F.pow(F.lit(2.0), grid)
    return F.when(grid == POINT, number + 0.0).when(F.abs(scaled) < 2.0**53, F.floor(scaled).cast("double")).otherwise(scaled)


def range_join(
    df: DataFrame, value: str, ranges: DataFrame, low: str, high: str, how: str = "inner", closed: str = "both",
    broadcast_rows: int = BROADCAST_RANGES,
) -> DataFrame:
    """Rows of ``df`` beside each range that holds ``value``: its columns and those of ``ranges``.

    ``closed`` says which ends belong to a range: both, left, right or neither. A missing end leaves that side open; a
    range whose ends are the wrong way round, and a missing value (NaN too), meet nothing. With ``how`` "left", rows that
    meet no range stay, the range's columns missing. Of a name both tables have, the one of ``df`` is kept; the ends are
    columns of ``ranges`` as any other.

    With ``how`` "totals", each range that meets a row stands once, beside ``n, least, most`` of the values it meets. The
    pairs, which may be as many as rows times ranges, are not made for that: the ends are placed among the sorted values.
    """
    if how not in ("inner", "left", "totals") or closed not in ("both", "left", "right", "neither"):
        raise ValueError("how is inner, left or totals; closed is both, left, right or neither")
    kind = df.schema[value].dataType
    if how == "totals":
        return _totals(df, value, ranges, low, high, closed)
    own = df.columns
    rest = [c for c in ranges.columns if c not in own]
    base = frozen(df.withColumn("_row", F.monotonically_increasing_id()), "ranged") if how == "left" else df
    number = _number(F.col(value), kind)

    # an open side ends where the values end
    ends = df.agg(F.min(number).alias("least"), F.max(number).alias("most")).first()
    least, most = (ends["least"], ends["most"]) if ends["least"] is not None else (0.0, 0.0)
    lo, hi = (_number(F.col(c), ranges.schema[c].dataType) for c in (low, high))
    cut = ranges.select(
        F.col(low).alias("_low"), F.col(high).alias("_high"), *[F.col(c).alias(f"_r_{c}") for c in rest],
        F.greatest(F.coalesce(lo, F.lit(least)), F.lit(least)).alias("_from"), F.least(F.coalesce(hi, F.lit(most)), F.lit(most)).alias("_to"),
    ).where("_from <= _to")
    length = F.col("_to") - F.col("_from")
    # one step wider than the length asks for, so that a rounded length never needs a third cell
    grid = F.when(length > 0, F.ceil(F.log2(length)).cast("int") + 1).otherwise(POINT)
    cut = cut.withColumn("_grid", grid)
    cells = F.array_distinct(F.array(_cell(F.col("_from"), F.col("_grid")), _cell(F.col("_to"), F.col("_grid"))))
    cut = cut.withColumn("_cell", F.explode(cells)).drop("_from", "_to")

    grids = sorted(r["_grid"] for r in cut.select("_grid").distinct().collect())  # as many as a double has exponents, at most
    if not grids:
        looked = base.withColumn("_at", F.lit(None).cast("struct<grid:int,cell:double>"))
    else:
        looked = base.withColumn("_at", F.explode(F.array(*[
            F.struct(F.lit(g).alias("grid"), _cell(number, g).alias("cell")) for g in grids
        ])))
    looked = looked.where(F.col("_at.cell").isNotNull())
    v = F.col(value)
    above = v >= F.col("_low") if closed in ("both", "left") else v > F.col("_low")
    below = v <= F.col("_high") if closed in ("both", "right") else v < F.col("_high")
    holds = (F.col("_low").isNull() | above) & (F.col("_high").isNull() | below)
    side = bounded(cut, broadcast_rows)
    met = looked.join(side, (F.col("_at.grid") == F.col("_grid")) & (F.col("_at.cell") == F.col("_cell")) & holds)
    out = [F.col(f"_r_{c}").alias(c) for c in rest]
    if how == "inner":
        return met.select(*own, *out)
    alone = base.join(met.select(F.col("_row").alias("_met")).distinct(), F.col("_row") == F.col("_met"), "left_anti")
    none = [F.lit(None).cast(ranges.schema[c].dataType).alias(c) for c in rest]
    return met.select(*own, *out).unionByName(alone.select(*own, *none))


def _totals(df: DataFrame, value: str, ranges: DataFrame, low: str, high: str, closed: str) -> DataFrame:
    """``ranges`` with ``n, least, most`` of the values they hold, those that hold none left out.

    Values and ends are sorted as one column, an end standing before or after the values equal to it as ``closed`` asks.
    The values before the two ends then give the count, the value next to each end the least and the most.
    """
    for frame, c in ((df, value), (ranges, low), (ranges, high)):
        _number(F.col(c), frame.schema[c].dataType)  # refuses what is no number or time
    values = nan_to_null(df.select(F.col(value).alias("_value"))).where("_value IS NOT NULL").groupBy("_value").agg(F.count("*").alias("_n"))
    before_low, after_high = (0 if closed in ("both", "left") else 2), (2 if closed in ("both", "right") else 0)
    starts, stops = (ranges.where(F.col(c).isNotNull()).select(F.col(c).alias("_x"), F.lit(side).alias("_side"))
                     for c, side in ((low, before_low), (high, after_high)))
    marks = starts.unionByName(stops).distinct().withColumn("_n", F.lit(0).cast("bigint")).withColumn("_value", F.lit(None).cast(df.schema[value].dataType))
    events = values.select(F.col("_value").alias("_x"), F.lit(1).alias("_side"), "_n", "_value").unionByName(marks)
    kind = events.schema["_x"].dataType
    placed = frozen(running_totals(events.select(F.struct("_x", "_side").alias("_order"), "_n", "_value"), "_order", "_n"), "placed")
    known = placed.where("_order._side = 1")
    whole = known.agg(F.max("whole").alias("n"), F.min("_value").alias("least"), F.max("_value").alias("most")).first()
    if whole["n"] is None:
        return ranges.limit(0).select("*", F.lit(0).cast("bigint").alias("n"), *[F.lit(None).cast(df.schema[value].dataType).alias(c) for c in ("least", "most")])

    def ends(side: int, at: Column, name: str) -> DataFrame:
        """The ends on a side with the values before them and the one next to them."""
        mine = placed.where(F.col("_order._side") == side).select(F.col("_order._x").alias(f"_{name}"), F.col("before").alias(f"_at_{name}"))
        return mine.join(known.select(at.alias(f"_at_{name}"), F.col("_value").alias(name)), f"_at_{name}", "left")

    out = ranges
    for c, side, at, name in ((low, before_low, F.col("before"), "least"), (high, after_high, F.col("before") + F.col("_n"), "most")):
        side_ends = ends(side, at, name)
        out = out.join(side_ends, ranges[c].cast(kind) == side_ends[f"_{name}"], "left")
    # an end that is missing leaves its side open
    first = F.when(ranges[low].isNull(), F.lit(0)).otherwise(F.col("_at_least"))
    last = F.when(ranges[high].isNull(), F.lit(whole["n"])).otherwise(F.col("_at_most"))
    return out.select(
        *[ranges[c] for c in ranges.columns], (last - first).alias("n"),
        F.when(ranges[low].isNull(), F.lit(whole["least"])).otherwise(F.col("least")).alias("least"),
        F.when(ranges[high].isNull(), F.lit(whole["most"])).otherwise(F.col("most")).alias("most"),
    ).where("n > 0")


def range_lookup(
    df: DataFrame, value: str, ranges: DataFrame, low: str, high: str, columns: Sequence[str], closed: str = "both",
) -> DataFrame:
    """``df`` with ``columns`` of the range that holds ``value``, missing where none does; rows stay as many as they were.

    Where several hold it, the one of the smallest columns counts, as in other lookups. That is settled once for each piece
    between the ranges' ends, so that a row meets its one piece, however many ranges overlap there.
    """
    base = frozen(df, "looked-up")
    side = ranges.select(F.col(low).alias("_low"), F.col(high).alias("_high"), F.struct(*columns).alias("_found"))
    cut = _pieces(side, closed)
    met = range_join(base, value, cut, "_from", "_to")
    # a piece is an end, or what lies between two ends
    inside = (F.col("_from").isNull() | (F.col(value) > F.col("_from"))) & (F.col("_to").isNull() | (F.col(value) < F.col("_to")))
    met = met.where(F.col("_end") | inside).select(*df.columns, "_found")
    alone = base.where(_number(F.col(value), df.schema[value].dataType).isNull()).select(*df.columns, F.lit(None).cast(met.schema["_found"].dataType).alias("_found"))
    return met.unionByName(alone).select(*df.columns, *[F.col(f"_found.{c}").alias(c) for c in columns])


def _pieces(ranges: DataFrame, closed: str) -> DataFrame:
    """``_from, _to, _end, _found``: each end of a range, and each open stretch between neighbouring ends, with the smallest
    ``_found`` of the ranges that hold it, if any.

    Pieces are numbered along the line. A range holds a run of them, which is cut into at most two whole blocks of each
    power of two; a piece then looks at the blocks it is in, so that nested ranges are not met one by one.
    """
    either = [ranges.where(F.col(c).isNotNull()).select(F.col(c).alias("_x")) for c in ("_low", "_high")]
    marks = nan_to_null(either[0].unionByName(either[1])).where("_x IS NOT NULL").distinct().withColumn("_one", F.lit(1).cast("bigint"))
    placed = frozen(running_totals(marks, "_x", "_one").select("_x", F.col("before").alias("_at")), "ends")
    n = placed.count()
    levels = F.sequence(F.lit(0), F.lit((2 * n + 1).bit_length()))

    def near(name: str, shift: int) -> DataFrame:
        return placed.select((F.col("_at") + shift).alias("_at"), F.col("_x").alias(name))

    between = ranges.sparkSession.range(n + 1).select(F.col("id").alias("_at")).join(near("_from", 1), "_at", "left").join(near("_to", 0), "_at", "left")
    pieces = between.select((F.col("_at") * 2).alias("_piece"), "_from", "_to", F.lit(False).alias("_end")).unionByName(
        placed.select((F.col("_at") * 2 + 1).alias("_piece"), F.col("_x").alias("_from"), F.col("_x").alias("_to"), F.lit(True).alias("_end")))

    kind = placed.schema["_x"].dataType
    starts, stops = (placed.select(F.col("_x").alias(f"_{c}"), F.col("_at").alias(f"_at_{c}")) for c in ("start", "stop"))
    held = ranges.join(starts, F.col("_low").cast(kind) == F.col("_start"), "left").join(stops, F.col("_high").cast(kind) == F.col("_stop"), "left")
    # of the ends only NaN has no place: above all
    first = F.when(F.col("_low").isNull(), F.lit(0)).otherwise(F.coalesce(F.col("_at_start") * 2 + (1 if closed in ("both", "left") else 2), F.lit(2 * n + 1)))
    last = F.coalesce(F.col("_at_stop") * 2 + (2 if closed in ("both", "right") else 1), F.lit(2 * n + 1))
    runs = held.select("_found", first.cast("bigint").alias("_first"), last.cast("bigint").alias("_last")).where("_first < _last")
    cut = runs.withColumn("_level", F.explode(levels)).selectExpr(
        "_found", "_level", "shiftright(_first + shiftleft(1L, _level) - 1, _level) AS _l", "shiftright(_last, _level) AS _r").where("_l < _r")
    odd = F.array(F.when(F.col("_l") % 2 == 1, F.col("_l")), F.when(F.col("_r") % 2 == 1, F.col("_r") - 1))
    blocks = cut.select("_level", F.explode(odd).alias("_block"), "_found").where("_block IS NOT NULL")
    least = blocks.groupBy("_level", "_block").agg(F.min("_found").alias("_found"))
    numbered = frozen(pieces, "pieces")
    seen = numbered.select("_piece").withColumn("_level", F.explode(levels)).selectExpr("_piece", "_level", "shiftright(_piece, _level) AS _block")
    best = seen.join(least, ["_level", "_block"]).groupBy("_piece").agg(F.min("_found").alias("_found"))
    return frozen(numbered.join(best, "_piece", "left").drop("_piece"), "pieces")
