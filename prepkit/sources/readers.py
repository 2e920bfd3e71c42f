"""Readers. Any path may carry a scheme (``s3a://``, ``hdfs://``): access is Hadoop configuration."""

from __future__ import annotations

import warnings
from collections.abc import Callable, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prepkit.operators.columns import nan_to_null
from prepkit.operators.places import READING_ORDER, first_read, reading_order
from prepkit.operators.rows import union_by_name

Schema = T.StructType | str | None

CORRUPT = "_corrupt_record"


def _struct(schema: Schema) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def _paths(path: str | Sequence[str]) -> list[str]:
    return [path] if isinstance(path, str) else list(path)


def _csv_files(spark: SparkSession, path: str | Sequence[str]) -> list[str]:
    """The files a CSV read of the path takes, by name."""
    return sorted(unquote(f) for f in spark.read.text(_paths(path)).inputFiles())


def _by_header(spark: SparkSession, path: str | Sequence[str], wanted: T.StructType, reader: DataFrameReader) -> DataFrame:
    """Files with a header line, columns matched by name whatever their order in each file.

    Columns a file lacks are missing there, further ones are left out. Only the first
    line of each file is read for this; files of one header are then read together.
    """
    groups: dict[tuple[str, ...], list[str]] = {}
    for file in _csv_files(spark, path):
        groups.setdefault(tuple(spark.read.option("header", True).csv(file).columns), []).append(file)
    parts = []
    types = {f.name: f for f in wanted.fields}
    extra = [f for f in wanted.fields if f.name == CORRUPT]
    for header, files in groups.items():
        own = T.StructType([types.get(c, T.StructField(c, T.StringType())) for c in header] + extra)
        df = reader.option("header", True).schema(own).csv(files)
        parts.append(df.select(*[F.col(f"`{f.name}`") if f.name in own.names else F.lit(None).cast(f.dataType).alias(f.name) for f in wanted.fields],
                               F.col("_metadata")))
    return union_by_name(*parts) if parts else reader.schema(wanted).csv(_paths(path)).select("*", "_metadata")


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: Schema = None,
    header: bool = True,
    infer: bool = False,
    max_rows: int | None = None,
    trim: bool = False,
) -> DataFrame:
    """CSV files or globs. A schema spares the pass that ``infer`` takes; without both, all text.

    With a header line, the schema's columns are found by name; without one, by place.
    ``max_rows`` takes exactly the first rows: of the first file by name, then of the next,
    however files are cut into splits. Only the files needed for them are read.
    """
    def read(of: Sequence[str]) -> DataFrame:
        reader = spark.read.option("ignoreLeadingWhiteSpace", trim).option("ignoreTrailingWhiteSpace", trim)
        if schema is not None and header:
            return _by_header(spark, of, _struct(schema), reader)
        reader = reader.option("header", header)
        reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", infer)
        return reader.csv(list(of)).select("*", "_metadata")

    if max_rows is None:
        return nan_to_null(read(_paths(path)).drop("_metadata"))
    return nan_to_null(first_rows(read, _csv_files(spark, path), max_rows))


def first_rows(read: Callable[[Sequence[str]], DataFrame], files: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows over the files in their order by name; ``read`` gives a frame with the hidden ``_metadata``.

    Of the files, the first one is counted, then the first four and so on, until they hold enough.
    """
    def ordered(k: int) -> DataFrame:
        df = read(files[:k])
        return df.select(*[F.col(f"`{c}`") for c in df.columns if c != "_metadata"], *reading_order())

    k = 1
    while k < len(files) and read(files[:k]).count() < n:
        k *= 4
    return first_read(ordered(k), n)


def read_csv_checked(
    spark: SparkSession, path: str | Sequence[str], schema: Schema, header: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Well-formed rows, and the malformed ones with their raw text; with a header, columns are found by name.

    Spark refuses to read the raw text alone, so take it together with another column.
    """
    whole = T.StructType([*_struct(schema).fields, T.StructField(CORRUPT, T.StringType())])
    reader = spark.read.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    if header:
        df = _by_header(spark, path, whole, reader).drop("_metadata")
    else:
        df = reader.option("header", False).schema(whole).csv(_paths(path))
    good = df.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    return nan_to_null(good), df.where(F.col(CORRUPT).isNotNull())


def read_jsonl(spark: SparkSession, path: str | Sequence[str], schema: Schema = None) -> DataFrame:
    """One JSON object per line."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return nan_to_null(reader.json(_paths(path)))


def read_xml(spark: SparkSession, path: str | Sequence[str], schema: Schema, row_tag: str = "row") -> DataFrame:
    """Elements named ``row_tag`` as rows, their children cast to the schema."""
    reader = spark.read.format("xml").option("rowTag", row_tag).schema(schema)
    return nan_to_null(reader.load(_paths(path)))


def read_parquet(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """All parquet files of a folder."""
    return nan_to_null(spark.read.parquet(*_paths(path)))


def read_text(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """One row per line, in ``value``."""
    return spark.read.text(_paths(path))


def read_table(spark: SparkSession, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A catalog table."""
    df = spark.table(name)
    return nan_to_null(df if columns is None else df.select(*columns))


def read_jdbc(
    spark: SparkSession, url: str, table: str, column: str, lower: object, upper: object, parts: int,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """A database table in ``parts`` ranges of ``column``, read at the same time."""
    return nan_to_null(spark.read.jdbc(
        url, table, column=column, lowerBound=lower, upperBound=upper, numPartitions=parts, properties=properties or {}
    ))


def list_inputs(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """``path, length`` of the files whose name matches, without reading them."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True)
    return reader.load(folder).select("path", "length")


def pick_input(spark: SparkSession, folder: str, glob: str) -> str | None:
    """Path of the first matching file by name."""
    row = list_inputs(spark, folder, glob).orderBy("path").first()
    return row["path"] if row else None


# The order in which a folder's formats count.
FORMAT_RANK = (("csv", 0), ("json", 1), ("xml", 2))
# Endings by format, and those of compressed files, which Spark opens by their name in lower case.
ENDINGS = {"csv": "csv", "json": "json", "jsonl": "json", "ndjson": "json", "xml": "xml"}
PACKED = ("gz", "bz2", "zst", "lz4", "snappy", "deflate")


def _format_of(path: str) -> str | None:
    """The format a file's name tells, NULL for one that is unknown."""
    parts = path.rsplit("/", 1)[-1].split(".")
    if len(parts) > 2 and parts[-1] in PACKED:
        parts.pop()
    return ENDINGS.get(parts[-1].lower()) if len(parts) > 1 else None


def ingest_folder(spark: SparkSession, folder: str, schema: Schema, row_tag: str = "row") -> DataFrame:
    """CSV, JSON Lines and XML files of a folder as one table, compressed ones too; other files bring a warning.

    CSV columns are found by the names in each file's header. ``src_rank, src_file,
    src_block, src_row`` give the reading order: format, file name, place of the split in
    the file, and place of the row in the split.
    """
    struct = _struct(schema)
    files = sorted(r["path"] for r in list_inputs(spark, folder).select("path").collect())
    unknown = [f for f in files if _format_of(f) is None]
    if unknown:
        warnings.warn(f"{len(unknown)} files of no known format left out of {folder}, the first: {unknown[0]}", stacklevel=2)
    parts = []
    for fmt, rank in FORMAT_RANK:
        chosen = [f for f in files if _format_of(f) == fmt]
        if not chosen:
            continue
        if fmt == "csv":
            df = _by_header(spark, chosen, struct, spark.read)
        elif fmt == "json":
            df = spark.read.schema(struct).json(chosen).select("*", "_metadata")
        else:
            df = spark.read.schema(struct).format("xml").option("rowTag", row_tag).load(chosen).select("*", "_metadata")
        parts.append(df.select(
            *struct.names,
            F.lit(rank).alias("src_rank"),
            F.col("_metadata.file_name").alias("src_file"),
            F.col("_metadata.file_block_start").alias("src_block"),
            F.monotonically_increasing_id().alias("src_row"),
        ))
    if not parts:
        raise FileNotFoundError(f"no csv, json or xml files in {folder}")
    return nan_to_null(union_by_name(*parts))


def redistribute(df: DataFrame, partitions: int, *by: str) -> DataFrame:
    """Spread rows over a number of partitions; normally adaptive execution decides."""
    return df.repartition(partitions, *by)
