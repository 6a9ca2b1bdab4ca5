"""Helpers shared by the operators: inputs, work folders, task packing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopflow.session import work_dir

# The six ASCII white-space characters between words, as a regex class body.
SPACE = r"\x20\x09-\x0D"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id`` and ``text`` (null text: empty) plus the named columns;
    every other column of the input, whatever its name, is left out."""
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"), *more)


def boxed(docs: DataFrame, *columns: Column | str) -> DataFrame:
    """The named columns beside whole rows as one struct, so that no column
    of the input, whatever its name, meets those that an operator adds."""
    return docs.select(*columns, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the decimal doc_id, modulo ``n``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % n


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def saved(df: DataFrame, name: str, **options) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back: cuts
    the lineage, so a lost executor never recomputes what came before."""
    path = save(df, name, **options)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def save(df: DataFrame, name: str, **options) -> str:
    path = work_dir(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a work folder of this run through the store it lives in."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
