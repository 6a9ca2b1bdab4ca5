"""File sources with explicit schemas (no inference)."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopflow import schemas
from shopflow.tables import SourcePaths

# Text is kept as written: surrounding blanks are data for the cleaner to
# trim, and an empty quoted field stays an empty string (not NULL).
CSV_READ = {"header": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
            "mode": "PERMISSIVE"}
CSV_WRITE = {"header": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header row: the declared columns are taken by header name,
    whatever else a file holds and in whatever order; text that does not
    parse as the declared type becomes NULL.  A column that no file has is
    absent from the result, so the column checks see the files as they are.

    Spark takes one file's header for all files of a folder.  Where files
    differ, each layout is read for itself and the layouts are put together
    by name (NULL where a layout lacks a column of another)."""
    layouts = csv_layouts(spark, path)
    if len(layouts) <= 1:
        return by_name(spark.read.options(**CSV_READ).csv(path), schema)
    parts = [by_name(spark.read.options(**CSV_READ).csv(files), schema) for files in layouts]
    df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return df.select(*[f.name for f in schema if f.name in set(df.columns)])


def _first_line(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a split that begins its file, the first line; the rest of the
    split is not read."""
    for b in batches:
        if b.num_rows:
            if b.column("start")[0].as_py() == 0:
                yield b.slice(0, 1).select(["file", "header"])
            return


def first_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, header``: the first line of every file that has one, found by
    a task a split that stops after its first rows.  A session of its own
    keeps the splits apart without a change to the caller's settings."""
    own = spark.newSession()
    size = own.conf.get("spark.sql.files.maxPartitionBytes")
    own.conf.set("spark.sql.files.openCostInBytes", size)      # one split a task
    own.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    lines = own.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("header"),
                                       F.col("_metadata.file_block_start").alias("start"))
    return lines.mapInArrow(_first_line, "file string, header string")


def csv_layouts(spark: SparkSession, path: str) -> list[list[str]]:
    """The files of each layout (header line).  One layout needs no list: the
    usual case brings a single header to the driver, others the names of
    their files, which a scan keeps there anyway."""
    if len(spark.read.text(path).inputFiles()) <= 1:
        return []
    lines = first_lines(spark, path)
    headers = [r["header"] for r in lines.select("header").distinct().collect()]
    if len(headers) <= 1:
        return []
    return [[r["file"] for r in lines.where(F.col("header") == h).collect()] for h in sorted(headers)]


def by_name(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The declared columns that ``df`` has, in the declared types."""
    there = set(df.columns)
    return df.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema if f.name in there])


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).options(**CSV_WRITE).csv(path)


def read_source(spark: SparkSession, paths: SourcePaths, name: str) -> DataFrame:
    """One landed source table (``orders``, ``customers``, ``products`` or
    ``order_items``) in its raw schema."""
    schema = schemas.RAW[name]
    if paths.fmt == "csv":
        return read_csv(spark, paths.path(name), schema)
    return by_name(spark.read.format(paths.fmt).load(paths.path(name)), schema)


def read_sources(spark: SparkSession, paths: SourcePaths) -> dict[str, DataFrame]:
    return {n: read_source(spark, paths, n) for n in schemas.RAW}


def read_available_sources(spark: SparkSession, paths: SourcePaths) -> dict[str, DataFrame]:
    """Like :func:`read_sources`, but a source whose path does not exist is
    left out: the quality gate then fails that dataset ("source not found",
    zero checks) while the other datasets are still validated."""
    from pyspark.errors import AnalysisException
    out = {}
    for n in schemas.RAW:
        try:
            out[n] = read_source(spark, paths, n)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    return out
