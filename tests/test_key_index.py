"""The key index of the landing table."""

import datetime as dt

from pyspark.sql import functions as F

from shopflow.sources import key_index as K
from shopflow.sources import sinks


def _landing(tmp, name="landing"):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("order_id", T.StringType()), T.StructField("order_date", T.DateType())])
    return sinks.file_target(name, f"{tmp}/{name}", partition_by=("order_date",), schema=schema)


def _rows(spark, n, days, prefix="o"):
    return (spark.range(n).select(F.concat(F.lit(prefix), F.col("id").cast("string")).alias("order_id"),
                                  F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") % days).cast("int")).alias("order_date")))


def test_no_landed_key_is_missed_and_few_dates_are_hit(spark, tmp):
    t = _landing(tmp)
    old = _rows(spark, 5000, 100)
    K.add(old, t, "order_id", "order_date")
    sinks.write_table(old, t, "append")
    # 100 dates of new keys: no date, or next to none, has to be read
    assert len(K.hit_dates(_rows(spark, 1000, 100, "n"), t, "order_id", "order_date", 1000)) <= 1
    # keys of two dates come again, at other dates
    again = old.where(F.col("order_date").isin([dt.date(2024, 1, 5), dt.date(2024, 2, 1)])).withColumn(
        "order_date", F.lit(dt.date(2025, 1, 1)))
    hits = K.hit_dates(again, t, "order_id", "order_date", 100)
    assert {dt.date(2024, 1, 5), dt.date(2024, 2, 1)} <= set(hits) and len(hits) <= 3
    there = K.landed_keys(spark, t, "order_id", "order_date", hits)
    assert again.join(there, "order_id", "left_anti").count() == 0
    # the same without a broadcast
    assert K.hit_dates(again, t, "order_id", "order_date") == hits
    # every key is found again: a filter has no false negatives
    assert len(K.hit_dates(old, t, "order_id", "order_date", 5000)) == 100


def test_only_hit_dates_are_opened(spark, tmp):
    t = _landing(tmp)
    sinks.write_table(_rows(spark, 200, 100), t, "append")
    K.ensure(spark, t, "order_id", "order_date")            # built from the table
    hits = K.hit_dates(_rows(spark, 1, 1), t, "order_id", "order_date", 1)
    df = K.landed_keys(spark, t, "order_id", "order_date", hits)
    scan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in scan and "2024-01-01" in scan or str((dt.date(2024, 1, 1) - dt.date(1970, 1, 1)).days) in scan
    files = df._jdf.queryExecution().optimizedPlan().toString()
    assert df.count() == 2 * len(hits) and files


def test_compact_keeps_every_bit(spark, tmp):
    t = _landing(tmp)
    for k in range(3):
        K.add(_rows(spark, 300, 3, f"b{k}-"), t, "order_id", "order_date", words=64)
    sinks.write_table(_rows(spark, 1, 1), t, "append")
    index = sinks.read_table(spark, K._target(t, "order_date", 64))
    before = index.count()
    K.compact(spark, t, "order_id", "order_date", words=64)
    spark.catalog.clearCache()
    index = sinks.read_table(spark, K._target(t, "order_date", 64))
    assert index.count() == 3 * 64 < before
    assert len(K.hit_dates(_rows(spark, 300, 3, "b1-"), t, "order_id", "order_date", words=64)) == 3
