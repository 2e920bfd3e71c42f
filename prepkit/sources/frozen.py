"""Rows put aside for work that passes over them many times."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from prepkit.session import scratch_path

_WRITTEN: list[tuple[SparkSession, str]] = []


def frozen(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    Iterative training reads its rows dozens of times. A written table cuts the lineage,
    so a lost executor costs a read instead of the whole computation, and it is split
    by size, while a cached frame keeps every partition of the plan that made it.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    _WRITTEN.append((df.sparkSession, path))
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, per_core: int = 4) -> DataFrame:
    """``df`` in some parts per core.

    A narrow table is read in few parts, whatever work its rows make; put this before a step that makes each row wide or
    passes over the rows many times. Fewer parts cost less in each pass, more are smaller once the rows are wide.
    """
    return df.repartition(per_core * df.sparkSession.sparkContext.defaultParallelism)


def release(spark: SparkSession) -> int:
    """Delete the copies made in this session, and tell how many there were.

    Frames that read them are lazy, so call it when their results are saved.
    """
    mine = [entry for entry in _WRITTEN if entry[0] is spark]
    for entry in mine:
        path = spark._jvm.org.apache.hadoop.fs.Path(entry[1])
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        _WRITTEN.remove(entry)
    return len(mine)
