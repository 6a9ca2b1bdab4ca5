"""Key index of a landing table: a Bloom filter per landed date.

A blocked filter: a key picks one of ``WORDS`` 64-bit words of its date's
filter and sets ``BITS`` bits in it.  The index is a table beside the data,
``date, word, bits``, with a row for every word that is not zero (about a row
for six keys) and a folder a date, so probing it is an equi-join on the word
and never a read of the keys themselves.  Only dates whose filter says
"maybe" for some key of the batch have their keys read, and those decide.

A batch's bits are written before its rows.  A crash between the two leaves
bits without rows, which cost one needless read; the other order could let a
key in twice.  Rows of one word add up by OR, so replays and appends only add
rows; ``compact`` folds them.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopflow.sources import sinks

WORDS = 1 << 20            # of 64 bits per date: 8 MB, sized for about 6 million keys a date
BITS = 4
BROADCAST_KEYS = 2_000_000  # a batch of so many keys (16 bytes each) is sent to every task


def location(landing: sinks.Target, words: int = WORDS) -> str:
    """The width is part of the name: another width is another index."""
    return f"{landing.location.rstrip('/')}__keys_{words}"


def _target(landing: sinks.Target, date: str, words: int) -> sinks.Target:
    schema = T.StructType([T.StructField("word", T.IntegerType()), T.StructField("bits", T.LongType()),
                           T.StructField(date, T.DateType())])
    return sinks.file_target(f"{landing.name}_keys", location(landing, words), partition_by=(date,), schema=schema)


def slots(key: Column, words: int = WORDS) -> tuple[Column, Column]:
    """The word of a key and its bits there, from disjoint parts of one hash."""
    h = F.xxhash64(key)
    mask = F.lit(0).cast("long")
    for i in range(BITS):
        bit = F.shiftrightunsigned(h, 6 * i).bitwiseAND(63).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), bit))
    return F.pmod(F.shiftrightunsigned(h, 6 * BITS), F.lit(words)).cast("int"), mask


def entries(rows: DataFrame, key: str, date: str, words: int = WORDS) -> DataFrame:
    word, mask = slots(F.col(key), words)
    return rows.groupBy(date, word.alias("word")).agg(F.bit_or(mask).alias("bits")).select("word", "bits", date)


def add(rows: DataFrame, landing: sinks.Target, key: str, date: str, words: int = WORDS) -> dict:
    """Set the bits of these rows' keys.  One file a date and batch."""
    return sinks.write_table(entries(rows, key, date, words).repartition(date),
                             _target(landing, date, words), "append")


def ensure(spark: SparkSession, landing: sinks.Target, key: str, date: str, words: int = WORDS) -> None:
    """Build the index of a table that has none yet (or one of another width)."""
    target = _target(landing, date, words)
    if sinks.exists(spark, target):
        return
    if sinks.exists(spark, landing):
        add(sinks.read_table(spark, landing).select(key, date), landing, key, date, words)
    sinks.ensure_exists(spark, target)


def hit_dates(rows: DataFrame, landing: sinks.Target, key: str, date: str, n: int | None = None,
              words: int = WORDS) -> list[dt.date]:
    """Dates whose filter may hold a key of ``rows``; one value a date
    reaches the driver.  ``n``: the number of rows, where known."""
    spark = rows.sparkSession
    word, mask = slots(F.col(key), words)
    wanted = rows.select(word.alias("word"), mask.alias("mask"))
    if n is not None and n <= BROADCAST_KEYS:
        wanted = F.broadcast(wanted)
    index = sinks.read_table(spark, _target(landing, date, words))
    # a key's bits may have come in several rows of one word
    maybe = (index.join(wanted, "word").groupBy(date, "word", "mask").agg(F.bit_or("bits").alias("bits"))
             .where(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask")))
    return sorted(r[0] for r in maybe.select(date).distinct().collect())


def landed_keys(spark: SparkSession, landing: sinks.Target, key: str, date: str, dates: list[dt.date],
                *more: str) -> DataFrame:
    """The keys of these dates only: the filter on the partition column never
    opens the files of another date."""
    return sinks.read_table(spark, landing).where(F.col(date).isin(dates)).select(key, *more)


def compact(spark: SparkSession, landing: sinks.Target, key: str, date: str, words: int = WORDS) -> None:
    """One row a word again, into a new folder that then takes the place of
    the old one.  Not while a stream writes to the table."""
    target = _target(landing, date, words)
    fresh = target.at(f"{target.location}_compacted")
    index = sinks.read_table(spark, target)
    sinks.write_table(index.groupBy(date, "word").agg(F.bit_or("bits").alias("bits")).select("word", "bits", date)
                      .repartition(date), fresh, "overwrite")
    sinks.swap(spark, fresh.location, target.location)
