"""Reproducible randomness: a draw depends on the row's key and a seed, not on the partition.

``rand()`` changes when rows move between tasks or a lost task is run again; these
draws do not, so samples, splits and imputations survive retries and repartitioning.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# 13 hexadecimal digits are 52 bits, exact in a double.
HEX_DIGITS = 13
DRAWS = 2.0 ** (4 * HEX_DIGITS)

# What stands for a missing key part in the hashed text.
MISSING = "\x00missing"


def _text(key: str | Column | Sequence[str | Column]) -> Column:
    """The key as text; a missing part is marked, so that it draws like any other value."""
    parts = [key] if isinstance(key, (str, Column)) else list(key)
    cols = [F.coalesce((F.col(p) if isinstance(p, str) else p).cast("string"), F.lit(MISSING)) for p in parts]
    return cols[0] if len(cols) == 1 else F.concat_ws("|", *cols)


def _digest(key: str | Column | Sequence[str | Column], seed: int | str) -> Column:
    return F.md5(F.concat(_text(key), F.lit(f"#{seed}")))


def _draw(digest: Column, start: int) -> Column:
    return F.conv(F.substring(digest, start, HEX_DIGITS), 16, 10).cast("bigint") / F.lit(DRAWS)


def unit(key: str | Column | Sequence[str | Column], seed: int | str) -> Column:
    """A uniform draw in [0, 1) fixed by the key columns and the seed."""
    return _draw(_digest(key, seed), 1)


def gaussian(key: str | Column | Sequence[str | Column], seed: int | str, std: float = 1.0) -> Column:
    """A normal draw N(0, std): Box-Muller on two uniform draws, taken from one digest."""
    digest = _digest(key, seed)
    radius = F.sqrt(-2.0 * F.log(F.greatest(_draw(digest, 1), F.lit(1.0 / DRAWS))))
    return F.lit(std) * radius * F.cos(2.0 * math.pi * _draw(digest, 1 + HEX_DIGITS))
