"""Writers. Everything is written in parallel unless the result is known to be small."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: tuple[str, ...] = ()) -> None:
    writer = df.write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "overwrite") -> None:
    """A folder of CSV parts."""
    df.write.mode(mode).option("header", header).csv(path)


def write_single_csv(df: DataFrame, path: str, header: bool = True, mode: str = "overwrite") -> None:
    """One CSV part, as a single file asks for: rows are computed in parallel and streamed through one writing task.

    For anything but a report use ``write_csv``.
    """
    df.repartition(1).write.mode(mode).option("header", header).csv(path)


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def write_xml(df: DataFrame, path: str, row_tag: str = "row", root_tag: str = "root", mode: str = "overwrite") -> None:
    df.write.mode(mode).format("xml").option("rowTag", row_tag).option("rootTag", root_tag).save(path)


def write_text(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A one-column string table as lines."""
    df.write.mode(mode).text(path)


# What to do when the table exists.
TABLE_MODES = {"fail": "errorifexists", "replace": "overwrite", "append": "append"}


def write_table(df: DataFrame, name: str, if_exists: str = "fail") -> None:
    """A catalog table; ``if_exists`` is fail, replace or append."""
    df.write.mode(TABLE_MODES[if_exists]).saveAsTable(name)


def write_jdbc(df: DataFrame, url: str, name: str, if_exists: str = "fail", properties: dict[str, str] | None = None) -> None:
    """A database table, written by all partitions at once."""
    df.write.jdbc(url, name, mode=TABLE_MODES[if_exists], properties=properties or {})


def quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.replace("`", "").split("."))


def drop_table(spark: SparkSession, name: str) -> None:
    """Drop a table where it exists."""
    spark.sql(f"DROP TABLE IF EXISTS {quoted(name)}")


def reset_schema(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Drop a schema with all its tables and make it anew. The caller names it; there is no default.

    Its tables live in ``location`` when given, else in the warehouse folder.
    """
    if not name or name == "default":
        raise ValueError("name the schema to reset; the default schema is not reset")
    spark.sql(f"DROP SCHEMA IF EXISTS {quoted(name)} CASCADE")
    place = "" if location is None else " LOCATION '" + location.replace("'", "\\'") + "'"
    spark.sql(f"CREATE SCHEMA {quoted(name)}{place}")
