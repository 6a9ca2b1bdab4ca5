"""One key holding a third of all rows: results stay exact and the plans
reduce the hot key before it crosses a shuffle."""

from pyspark.sql import functions as F

from conftest import plan_text
from shopflow.operators import quality as Q
from shopflow.operators.clean import dedup_keep_first
from shopflow.plans import models as M

N = 30000


def _hot(spark):
    # key 'hot' carries a third of the rows; the rest are unique
    return spark.range(N).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id").cast("string")))
        .alias("order_id"),
        (F.col("id") % 7).cast("int").alias("order_item_id"),
        F.col("id").cast("double").alias("price"))


def test_dedup_hot_key(spark):
    df = _hot(spark)
    out = dedup_keep_first(df, ["order_id"])
    assert out.count() == N - N // 3 + 1
    assert out.filter("order_id = 'hot'").first().price == 0.0
    tree = plan_text(out).split("\n\n")[0]
    # a limit per key runs before the exchange (map side) and after it
    assert tree.index("WindowGroupLimit") < tree.index("Exchange") < tree.rindex("WindowGroupLimit")


def test_relationship_check_pre_aggregates_hot_value(spark):
    child = _hot(spark).select(F.col("order_id").alias("customer_id"))
    parent = spark.createDataFrame([("k1",)], "customer_id string")
    t = Q.ModelTest("child", "relationships", "customer_id", {"to": "parent", "field": "customer_id"})
    rel = {"child": child, "parent": parent}
    res = Q.run_model_tests(rel, [t]).first()
    assert res.failures == N - 1                       # every row but the one 'k1'
    assert res.failures == Q.violations(rel, t).count()
    tree = plan_text(Q.run_model_tests(rel, [t]), "formatted")
    assert "partial_count" in tree                     # counted per value before the shuffle


def test_fact_join_hot_order(spark):
    items = _hot(spark).select("order_id", F.lit("p").alias("product_id"), "price",
                               F.lit(1.0).alias("freight_value"))
    orders = (items.select("order_id").distinct()
                   .select("order_id", F.lit("c").alias("customer_id"),
                           F.lit(None).cast("timestamp_ntz").alias("purchase_timestamp")))
    fact = M.fact_orders(orders, items)
    assert fact.count() == N
    assert fact.filter("order_id = 'hot'").count() == N // 3


def test_fact_join_splits_hot_order_when_sort_merge(spark, tmp):
    """As the daily run builds it (both sides read from written tables),
    with broadcast off and skew thresholds scaled to the test data: AQE's
    skew join splits the hot order's partition; the result stays exact."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1024",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4096",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    prev = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        items = _hot(spark).select("order_id", F.lit("p").alias("product_id"), "price",
                                   F.lit(1.0).alias("freight_value"))
        orders = (items.select("order_id").distinct()
                       .select("order_id", F.lit("c").alias("customer_id"),
                               F.lit(None).cast("timestamp_ntz").alias("purchase_timestamp")))
        items.write.parquet(f"{tmp}/items")
        orders.write.parquet(f"{tmp}/orders")
        fact = M.fact_orders(spark.read.parquet(f"{tmp}/orders"), spark.read.parquet(f"{tmp}/items"))
        rows = fact.collect()                  # executes this plan, so explain shows the final one
        assert len(rows) == N
        final = plan_text(fact, "formatted")
        assert "isFinalPlan=true" in final and "SortMergeJoin" in final
        assert "skew=true" in final.replace(" ", "") or "isSkewJoin=true" in final.replace(" ", "")
    finally:
        for k, v in prev.items():
            spark.conf.set(k, v)
