"""Ids cross shuffles as bytes: any text comes back, the kept duplicate and
the tests' counts are those of the texts."""

import random

from pyspark.sql import functions as F

from conftest import SF_SMALL, plan_text
from shopflow.functions.expressions import packed_id, unpacked_id
from shopflow.operators import clean as C
from shopflow.operators import quality as Q
from shopflow.plans import jobs
from shopflow.sources import feeds, sinks

HEX = "0123456789abcdef0123456789abcd"   # 30 digits
ODD = ["", "a", HEX, HEX + "zz", HEX + "ef", HEX + "00", HEX + "EF", HEX + "ef\n", HEX + "efe", HEX + "é", "é" * 8, "x" * 15, "x" * 16,
       "x" * 17, "x" * 15 + "\0", "x" * 16 + "\0", "0123456789abcdef", "ord_001", " ", None]


def test_any_text_comes_back_and_no_two_share_bytes(spark):
    df = spark.createDataFrame([(v,) for v in ODD], "v string")
    rows = df.select("v", packed_id(F.col("v")).alias("p"), unpacked_id(packed_id(F.col("v"))).alias("u")).collect()
    assert [r.u for r in rows] == ODD
    assert len({bytes(r.p) for r in rows if r.p is not None}) == len(ODD) - 1
    assert {len(r.p) for r in rows if r.v in (HEX + "ef", HEX + "00")} == {16}


def _orders(spark, customers):
    return spark.createDataFrame([(o, c, "shipped", None, None, None) for o, c in customers],
                                 "order_id string, customer_id string, order_status string, order_purchase_timestamp string, "
                                 "order_delivered_customer_date string, order_estimated_delivery_date string")


def test_load_keeps_the_duplicate_that_the_texts_name(spark, tmp):
    rnd = random.Random(7)
    digits = [f"{rnd.getrandbits(128):032x}" for _ in range(200)]
    for name, more in (("hex", []), ("mixed", ["Z", "~", "a", ""]), ("other", [HEX + "zz"])):
        feed = _orders(spark, [(rnd.choice(digits[:20] + ["ord_1"]), rnd.choice(digits + more)) for _ in range(3000)])
        ids = C.packable_ids(feed, C.ORDERS)
        assert ids == (["order_id", "customer_id"] if name == "hex" else ["order_id"])
        wh = jobs.Warehouse(f"{tmp}/{name}")
        assert jobs.run_batch(spark, {"orders": feed}, wh, tables=["orders"])[0]["rows"] == 21
        loaded = sinks.read_table(spark, wh.target("raw.orders"))
        assert sorted(map(tuple, loaded.collect()), key=str) == sorted(map(tuple, C.clean_orders(feed).collect()), key=str)


def test_load_shuffles_bytes_and_writes_zstd(spark, tmp):
    feed = feeds.raw_order_items(spark, SF_SMALL)
    tree = plan_text(C.clean_order_items(feed, C.packable_ids(feed, C.ORDER_ITEMS)), "simple")
    assert tree.count("unhex(") >= 3 and tree.rindex("Exchange hashpartitioning") < tree.index("unhex(")
    wh = jobs.Warehouse(f"{tmp}/wh")
    jobs.run_batch(spark, {"order_items": feed}, wh, tables=["order_items"])
    files = sinks.read_table(spark, wh.target("raw.order_items")).inputFiles()
    assert files and all(f.endswith(".zstd.parquet") for f in files)


def test_fact_and_orphans_join_on_bytes(spark):
    orders = spark.createDataFrame([(o, f"{i:032x}", None) for i, o in enumerate(o for o in ODD if o is not None)],
                                   "order_id string, customer_id string, purchase_timestamp timestamp_ntz")
    items = spark.createDataFrame([(o, i, f"p{i}", 1.0, 2.0) for i, o in enumerate([*ODD, "none", HEX + "0f"])],
                                  "order_id string, order_item_id int, product_id string, price double, freight_value double")
    from shopflow.plans import models as M
    want = sorted(map(tuple, M.fact_orders(orders, items).collect()), key=str)
    for hot in ([], [HEX + "ef", "a"]):
        assert sorted(map(tuple, M.fact_orders(orders, items, hot, packed=True).collect()), key=str) == want
    got = {(r.order_id, r.product_id) for r in Q.orphan_items(items, orders).collect()}
    assert got == {(None, f"p{len(ODD) - 1}"), ("none", f"p{len(ODD)}"), (HEX + "0f", f"p{len(ODD) + 1}")}
    assert "unhex(" in plan_text(Q.orphan_items(items, orders), "simple")


def test_a_key_column_is_told_once_whatever_tests_read_it(spark):
    groups = Q._groups(Q.MODEL_TESTS)
    assert [("stg_order_items", "order_id"), ("stg_orders", "order_id")] in [sorted(g) for g in groups]
    every = [k for g in groups for k in g]
    assert len(every) == len(set(every))
    child = spark.createDataFrame([("a",), ("a",), ("b",), ("c",), (None,), (None,)], "order_id string")
    parent = spark.createDataFrame([("a",), ("b",), ("b",), (None,), (None,)], "order_id string")
    rel = {"child": child, "parent": parent}
    link = {"to": "parent", "field": "order_id"}
    tests = [Q.ModelTest("child", "unique", "order_id"), Q.ModelTest("child", "relationships", "order_id", link),
             Q.ModelTest("child", "not_null", "order_id"), Q.ModelTest("parent", "unique", "order_id"),
             Q.ModelTest("child", "accepted_values", "order_id", {"values": ["a"]})]
    orphan = Q.ModelTest("child", "no_orphan_items", None, {"to": "parent"})
    items = {"child": child.selectExpr("order_id", "1 AS order_item_id", "'p' AS product_id"), "parent": parent}
    for r, ts in ((rel, tests), (items, [*tests, orphan])):
        got = {(x.relation, x.test_name, x.column_name): x.failures for x in Q.run_model_tests(r, ts).collect()}
        assert got == {(t.relation, t.test, t.column): Q.violations(r, t).count() for t in ts}
    assert got["child", "no_orphan_items", None] == 3 and got["child", "unique", "order_id"] == 1
