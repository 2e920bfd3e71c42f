"""One step between tables: load, compute, drop, store."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from prepkit.sources.writers import quoted, drop_table, write_table

Frames = DataFrame | list[DataFrame]


def stage(
    spark: SparkSession,
    inputs: str | Sequence[str] | None,
    work: Callable[[Frames], Mapping[str, DataFrame] | None],
    drops: str | Sequence[str] | None = None,
) -> list[str]:
    """Run ``work`` on the named tables and store what it returns.

    One name gives ``work`` one frame, a list gives a list. Returned frames are stored
    under new names first; only then are the listed tables dropped and the new ones put
    in their place, since the frames may still read the tables they replace.
    """
    if inputs is None:
        raise ValueError("a stage needs at least one input table")
    frames: Frames = spark.table(inputs) if isinstance(inputs, str) else [spark.table(n) for n in inputs]
    results = dict(work(frames) or {})
    for name, df in results.items():
        write_table(df, f"{name}__new", "replace")
    for name in [drops] if isinstance(drops, str) else list(drops or []):
        drop_table(spark, name)
    for name in results:
        drop_table(spark, name)
        spark.sql(f"ALTER TABLE {quoted(name + '__new')} RENAME TO {quoted(name)}")
    return list(results)


def version_of(spark: SparkSession, name: str) -> str | None:
    """The version table that a published name points at; None where the name is not a published one."""
    if not spark.catalog.tableExists(name):
        return None
    found = spark.sql(f"SHOW TBLPROPERTIES {quoted(name)}").where("key = 'prepkit.version'").first()
    return found["value"] if found else None


def publish(
    spark: SparkSession, frames: Mapping[str, DataFrame], checks: Mapping[str, Callable[[DataFrame], bool]] | None = None,
    keep_last: bool = True,
) -> dict[str, str]:
    """Store frames under names without a moment in which a name is missing or holds half of a table.

    Each frame is written beside, as a table of its own, and then checked; only when all are written and pass does each
    name, a view, point at its new table, by one change of the catalog. If a frame or a check fails, what was written
    goes and all names stay as they were. The tables that names pointed at before stay for readers still at them, until
    the next time (``keep_last``), or go at once. Returns each name's version. A name that is a plain table is an error.
    """
    for name in frames:
        if spark.catalog.tableExists(name) and version_of(spark, name) is None:
            raise ValueError(f"{name} is a table of its own, not a published name")
    made: dict[str, str] = {}
    try:
        for name, df in frames.items():
            made[name] = f"{name}__v_{uuid.uuid4().hex[:12]}"
            write_table(df, made[name], "fail")
        for name, check in (checks or {}).items():
            if not check(spark.table(made[name])):
                raise ValueError(f"the new {name} did not pass its check")
    except BaseException:
        for version in made.values():
            drop_table(spark, version)
        raise
    for name, version in made.items():
        old = version_of(spark, name)
        before = spark.sql(f"SHOW TBLPROPERTIES {quoted(name)}").where("key = 'prepkit.before'").first() if old else None
        columns = ", ".join(f"`{c.replace('`', '``')}`" for c in spark.table(version).columns)
        properties = f"'prepkit.version' = '{version}'" + (f", 'prepkit.before' = '{old}'" if old and keep_last else "")
        spark.sql(f"CREATE OR REPLACE VIEW {quoted(name)} TBLPROPERTIES ({properties}) AS SELECT {columns} FROM {quoted(version)}")
        for gone in [before["value"] if before else None, None if keep_last else old]:
            if gone:
                drop_table(spark, gone)
    return made


def stage_published(
    spark: SparkSession, inputs: str | Sequence[str], work: Callable[[Frames], Mapping[str, DataFrame] | None],
    checks: Mapping[str, Callable[[DataFrame], bool]] | None = None, keep_last: bool = True,
) -> dict[str, str]:
    """Run ``work`` on the named tables and publish what it returns, all of it or, if anything fails, nothing.

    Published names may be among the inputs: the step reads the versions they pointed at when it began.
    """
    frames: Frames = spark.table(inputs) if isinstance(inputs, str) else [spark.table(n) for n in inputs]
    return publish(spark, dict(work(frames) or {}), checks, keep_last)
