import datetime as dt

from pyspark.sql import functions as F

from conftest import plan_text
from shopflow import schemas
from shopflow.operators import clean as C


def test_dedup_keeps_first_in_total_order(spark):
    df = spark.createDataFrame([("o1", "zz"), ("o1", "aa"), ("o2", None), ("o2", "b")], "k string, v string")
    out = {r.k: r.v for r in C.dedup_keep_first(df, ["k"]).collect()}
    assert out == {"o1": "aa", "o2": None}   # NULLs first


def test_dedup_composite_key(spark):
    df = spark.createDataFrame([("o", 1, 5.0), ("o", 1, 3.0), ("o", 2, 9.0)], "a string, b int, p double")
    rows = sorted(tuple(r) for r in C.dedup_keep_first(df, ["a", "b"]).collect())
    assert rows == [("o", 1, 3.0), ("o", 2, 9.0)]


def test_filter_runs_before_dedup(spark):
    raw = spark.createDataFrame(
        [("o1", None, "delivered", "2024-01-01 00:00:00", None, None),
         ("o1", "c1", "delivered", "2024-01-01 00:00:00", None, None)], schemas.RAW_ORDERS)
    rows = C.clean_orders(raw).collect()
    assert [(r.order_id, r.customer_id) for r in rows] == [("o1", "c1")]


def test_bad_text_casts_to_null_without_error(spark):
    raw = spark.createDataFrame(
        [("o1", "c", "s", "garbage", "", None), ("o2", "c", "s", "2024-01-02 03:04:05", None, None)],
        schemas.RAW_ORDERS)
    rows = {r.order_id: r for r in C.clean_orders(raw).collect()}
    assert rows["o1"].order_purchase_timestamp is None
    assert rows["o1"].order_delivered_customer_date is None
    assert rows["o2"].order_purchase_timestamp == dt.datetime(2024, 1, 2, 3, 4, 5)
    items = spark.createDataFrame([("o", 1, "p", "s", 1.0, "n/a"), ("o", 2, "p", "s", 2.0, "3.5")],
                                  schemas.RAW_ORDER_ITEMS)
    got = {r.order_item_id: r.freight_value for r in C.clean_order_items(items).collect()}
    assert got == {1: None, 2: 3.5}


def test_trim_spaces_only(spark):
    raw = spark.createDataFrame([("c1", "u", "  rio ", " RJ"), ("c2", "u", "\tsp", "SP")], schemas.RAW_CUSTOMERS)
    got = {r.customer_id: (r.customer_city, r.customer_state) for r in C.clean_customers(raw).collect()}
    assert got == {"c1": ("rio", "RJ"), "c2": ("\tsp", "SP")}


def test_category_fill_nulls_only(spark):
    raw = spark.createDataFrame([("p1", None), ("p2", ""), ("p3", "toys"), (None, "x")], schemas.RAW_PRODUCTS)
    got = {r.product_id: r.product_category_name for r in C.clean_products(raw).collect()}
    assert got == {"p1": "unknown", "p2": "", "p3": "toys"}


def test_dedup_plan_limits_rows_before_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    plan = plan_text(C.dedup_keep_first(df, ["k"]))
    assert "WindowGroupLimit" in plan
    assert sorted(tuple(r) for r in C.dedup_keep_first(df, ["k"]).collect()) == [(0, 0), (1, 1), (2, 2)]
