"""A third of all items in one order: found, spread, joined exactly."""

from pyspark.sql import functions as F

from shopflow.operators.hot_keys import hot_keys, salted_join
from shopflow.plans import models as M

N = 30_000


def _items(spark):
    return spark.range(N).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, "warm").when(F.col("id") == 4, None)
        .otherwise(F.concat(F.lit("o"), (F.col("id") % 5000).cast("string"))).alias("order_id"),
        F.concat(F.lit("p"), (F.col("id") % 7).cast("string")).alias("product_id"),
        F.col("id").cast("double").alias("price"), F.lit(1.0).alias("freight_value"))


def _orders(spark, items):
    return (items.select("order_id").distinct().where("order_id is not null and order_id <> 'o7'")
            .select("order_id", F.lit("c").alias("customer_id"), F.lit(None).cast("timestamp_ntz").alias("purchase_timestamp")))


def test_hot_keys_are_found_by_bounded_summaries(spark):
    items = _items(spark).repartition(13)
    assert hot_keys(items, "order_id") == ["hot", "warm"]
    assert hot_keys(items, "order_id", share=0.2) == ["hot"]
    # far fewer counters than keys still tell the heavy ones
    assert hot_keys(items, "order_id", share=0.2, counters=64) == ["hot"]
    assert hot_keys(items.where("order_id is null"), "order_id") == []
    assert hot_keys(items.where("order_id not in ('hot', 'warm')"), "order_id") == []


def test_fact_join_spreads_a_hot_order(spark):
    """The query's own form, without the daily run's written layer: the order
    side is partitioned by its dedup, so only the salt can split the key."""
    items = _items(spark)
    orders = _orders(spark, items)
    hot = hot_keys(items, "order_id")
    got = M.fact_orders(orders, items, hot)
    want = M.fact_orders(orders, items)
    assert got.columns == want.columns
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    keys = ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k) for k in keys}
    try:
        spark.conf.set(keys[0], "false")
        spark.conf.set(keys[1], "-1")
        size = lambda df: df.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]
        assert size(M.fact_orders(orders, items)) >= N // 3
        assert size(M.fact_orders(orders, items, hot)) < N // 4      # 8 partitions: about N / 8 each
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_no_hot_keys_is_the_plain_join(spark):
    items = _items(spark)
    plan = salted_join(items, _orders(spark, items), "order_id", [])._jdf.queryExecution().toString()
    assert "salt__" not in plan


def test_repeated_rows_of_a_hot_key_are_kept(spark):
    rows = spark.createDataFrame([("k", 1)] * 50 + [("a", 2)], "k string, v int")
    other = spark.createDataFrame([("k", "x"), ("k", "y"), ("a", "z")], "k string, w string")
    got = salted_join(rows, other, "k", ["k"], salts=4)
    assert got.count() == 101 and got.where("w = 'y'").count() == 50
