"""A corpus pipeline: quality rules, exact dedup, n-gram Jaccard join, suffix
dedup, packing.

Each stage takes all rows that its predecessor kept, written as Parquet and
read again; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shopflow.llm import exact_dedup, jaccard_join, packing, quality_rules, suffix_dedup
from shopflow.llm.common import saved, table
from shopflow.llm.queries import BYTES_50K, vocabulary


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go.  A null or empty text fails the word rule; null
    and repeated ids are judged row by row; an empty table stays empty."""
    return quality_rules.keep_good(spark, docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one stays: the longest as written, then the smallest id
    (null: largest).  All null and blank texts are one group."""
    return exact_dedup.keep_one(spark, docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of linked texts the smallest id stays (null: largest,
    then by a hash of the text).  Rows without words link with nothing and
    stay; rows that repeat an id are told apart by their texts."""
    return jaccard_join.keep_one(spark, docs)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages are cut out of the texts; every row stays.  Null texts
    stay null; rows equal in id and text do not cut each other."""
    return suffix_dedup.without_repeats(spark, docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences.  A null or empty text is its end id
    alone; rows with null or repeated ids are each packed."""
    return packing.pack(spark, docs, vocabulary(BYTES_50K), end=1)


STAGES = [("quality rules", quality), ("exact dedup", exact), ("n-gram Jaccard join", near),
          ("suffix-array dedup", passages), ("packing", pack)]

# Stages hash n-grams and use a tokenizer, which SQL cannot express; tests/llm
# holds every stage and run() against the same chain on one machine.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
