"""Cell-level expressions used by the cleaning and feature operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

# The age brackets of the two smoking-rate sources, both ends included.
AGE_BRACKETS_FINE = (
    (15, 17, "15-17"),
    (18, 24, "18-24"),
    (25, 34, "25-34"),
    (35, 44, "35-44"),
    (45, 54, "45-54"),
    (55, 64, "55-64"),
    (65, 74, "65-74"),
    (75, None, "75+"),
)
AGE_BRACKETS_COARSE = (
    (18, 24, "18–24 years"),
    (25, 44, "25–44 years"),
    (45, 64, "45–64 years"),
    (65, None, "65 years and older"),
)

Bracket = tuple[float | None, float | None, Any]


def column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_number(c: str | Column) -> Column:
    """Text to double; what does not parse becomes NULL instead of an error."""
    return column(c).try_cast("double")


def half_even(c: str | Column, places: int = 2) -> Column:
    """Round to ``places`` decimals, ties to the even neighbour."""
    return F.bround(column(c), places)


def replace_where(c: str | Column, condition: Column, value: Any) -> Column:
    """``value`` where the condition holds, the old cell elsewhere."""
    return F.when(condition, value if isinstance(value, Column) else F.lit(value)).otherwise(column(c))


def recode(c: str | Column, rules: Sequence[tuple[Any, Any]], default: Any = None) -> Column:
    """Map a cell by the first matching rule.

    A rule is ``(test, result)``; a test is ``None`` (matches NULL), a plain value, a
    list of values, a ``(lo, hi)`` tuple with both ends included and ``None`` for open,
    or a function Column -> Column. A result is a value or a function of the cell.
    Cells no rule matches keep their value, or take ``default`` when given.
    """
    cell = column(c)

    def outcome(result: Any) -> Column:
        return result(cell) if callable(result) else F.lit(result)

    chain: Any = F
    for test, result in rules:
        if test is None:
            matched = cell.isNull()
        elif callable(test):
            matched = test(cell)
        elif isinstance(test, tuple):
            matched = inside(cell, *test)
        elif isinstance(test, list):
            matched = cell.isin(test)
        else:
            matched = cell == F.lit(test)
        chain = chain.when(matched, outcome(result))
    return chain.otherwise(cell if default is None else outcome(default))


# The resting-protocol codes folded into one scale.
PROTOCOL_RULES = (
    (None, 0.0),
    ((None, 6), lambda x: x),
    (7, 12.0),
    ((8, 12), lambda x: 13.0 - x),
    ([25, 50, 75, 100, 125, 150, 175, 200, 225, 250, 275, 300], lambda x: x / 25.0 + 5.0),
)


def inside(c: str | Column, lo: float | None, hi: float | None) -> Column:
    """Whether lo <= cell <= hi; an end given as None is open. NaN, which Spark orders above all, lies in no range."""
    cell = column(c)
    tests = [cell.isNotNull()]
    if lo is not None:
        tests.append(cell >= F.lit(lo))
    if hi is not None:
        tests.append(cell <= F.lit(hi))
    elif isinstance(lo, (int, float)):
        tests.append(cell <= F.lit(float("inf")))
    return reduce(lambda a, b: a & b, tests)


def valid_cell(c: str, ranges: Mapping[str, Any]) -> Column:
    """The cell where its column's range allows it, else NULL; columns without a range as they are.

    A range is ``(lo, hi)``, open where None, or a list of values.
    """
    if c not in ranges:
        return F.col(c)
    allowed = ranges[c]
    test = inside(c, *allowed) if isinstance(allowed, tuple) else F.col(c).isin(list(allowed))
    return F.when(test, F.col(c))


def bracket(c: str | Column, brackets: Sequence[Bracket]) -> Column:
    """The value of the bracket a cell falls in, NULL outside all of them.

    The brackets are literals in the plan: a range lookup without any join.
    """
    chain: Any = F
    for lo, hi, value in brackets:
        chain = chain.when(inside(c, lo, hi), F.lit(value))
    return chain.otherwise(F.lit(None))


def fixed_bin(c: str | Column, width: float, bins: int) -> Column:
    """Index of the right-closed bin (i*width, (i+1)*width]; NULL below 0 and above the last."""
    index = (F.ceil(column(c) / F.lit(float(width))) - 1).cast("int")
    return F.when((column(c) > 0) & (index < bins), index)


def missing(c: str, is_float: bool = False) -> Column:
    """NULL, and NaN too for floating-point columns."""
    return (F.col(c).isNull() | F.isnan(c)) if is_float else F.col(c).isNull()


def missing_share(columns: Sequence[str], floats: Sequence[str] = ()) -> Column:
    """Share of the row's cells that are NULL, or NaN in the columns named as ``floats``."""
    total = sum((missing(c, c in floats).cast("int") for c in columns), F.lit(0))
    return total / F.lit(float(len(columns)))
