import json

import pytest

from shopflow.operators import quality as Q
from shopflow.operators.clean import CLEANERS
from shopflow.plans import models as M

E = Q.E


def test_each_expectation_counts_one_violation(spark):
    # one violating row + one NULL row per check; NULL counts only for not_null
    df = spark.createDataFrame(
        [("a", "ok", "AB", 5.0), ("a", "bad", "x", 99.0), (None, None, None, None), ("b", "ok", "CD", 1.0)],
        "id string, status string, state string, price double")
    suite = [
        E("expect_column_values_to_not_be_null", column="id"),
        E("expect_column_values_to_be_unique", column="id"),
        E("expect_column_values_to_be_in_set", column="status", value_set=["ok"]),
        E("expect_column_values_to_match_regex", column="state", regex="^[A-Z]{2}$"),
        E("expect_column_value_lengths_to_be_between", column="state", min_value=2, max_value=2),
        E("expect_column_values_to_be_between", column="price", min_value=0, max_value=10),
        E("expect_table_row_count_to_be_between", min_value=1, max_value=3),
        E("expect_column_to_exist", column="id"),
        E("expect_column_to_exist", column="nope"),
        E("expect_column_values_to_not_be_null", column="nope"),
    ]
    res = Q.run_suite(df, "t", suite)
    rows = {r.check_index: r for r in res.collect()}
    assert len(rows) == len(suite)
    assert rows[0].unexpected_count == 1 and not rows[0].success
    assert rows[1].unexpected_count == 2 and rows[1].element_count == 4   # both 'a' rows
    for i in (2, 3, 4, 5):
        assert rows[i].unexpected_count == 1, (i, rows[i])
        assert rows[i].element_count == 4
    assert rows[6].element_count == 4 and rows[6].success is False
    assert rows[7].success is True
    assert rows[8].success is False and "not found" in rows[8].detail
    assert rows[9].success is False and rows[9].detail.startswith("ERROR")


def test_summary_and_gate(spark):
    good = spark.createDataFrame([("a",), ("b",)], "id string")
    bad = spark.createDataFrame([("a",), ("a",)], "id string")
    suites = {"good": [E("expect_column_values_to_be_unique", column="id")],
              "bad": [E("expect_column_values_to_be_unique", column="id")],
              "nosource": [E("expect_column_to_exist", column="id")]}
    res = Q.run_suites({"good": good, "bad": bad}, suites)
    summ = {r.dataset: r for r in Q.summarize(res).collect()}
    assert summ["good"].success and summ["good"].total == 1 and summ["good"].passed == 1
    assert not summ["bad"].success and summ["bad"].failed == 1
    assert not summ["nosource"].success and summ["nosource"].total == 0
    with pytest.raises(Q.QualityGateError) as e:
        Q.gate(res)
    assert {f["dataset"] for f in e.value.failed} == {"bad", "nosource"}
    Q.gate(Q.run_suites({"good": good}, {"good": suites["good"]}))   # passes


def test_load_suite(tmp_path):
    p = tmp_path / "s.json"
    p.write_text(json.dumps({"expectations": [
        {"expectation_type": "expect_column_to_exist", "kwargs": {"column": "x"}}]}))
    assert Q.load_suite(str(p))[0].column == "x"
    q = tmp_path / "empty.json"
    q.write_text("{}")
    assert Q.load_suite(str(q)) == []


def test_catalogue_sizes():
    assert sum(len(s) for s in Q.SUITES.values()) == 46
    kinds = {}
    for t in Q.MODEL_TESTS:
        kinds[t.test] = kinds.get(t.test, 0) + 1
    assert kinds == {"not_null": 43, "unique": 10, "accepted_values": 1, "relationships": 4,
                     "accepted_range": 7, "no_orphan_items": 1}


def _seed_relations(seed, seed_landing):
    raw = {k: CLEANERS[k](v) for k, v in seed.items()}
    m = M.build_models(raw, seed_landing)
    rel = {f"raw.{k}": v for k, v in raw.items()}
    rel["streaming.raw_orders_stream"] = seed_landing
    rel.update(m)
    return rel, m


def test_seed_passes_all_model_tests(spark, seed, seed_landing):
    rel, m = _seed_relations(seed, seed_landing)
    assert m["fact_orders"].count() == 4
    assert m["dim_customers"].count() == 3 and m["dim_products"].count() == 3
    assert m["fact_orders_realtime"].count() == 2
    res = Q.run_model_tests(rel).collect()
    assert len(res) == 66
    assert [r for r in res if r.status != "pass"] == []


def test_negative_model_tests(spark, seed, seed_landing):
    from shopflow import schemas
    seed = dict(seed)
    seed["order_items"] = seed["order_items"].unionByName(spark.createDataFrame(
        [("ord_999", 1, "prod_001", "seller_001", -1.0, "2.0")], schemas.RAW_ORDER_ITEMS))
    seed["orders"] = seed["orders"].unionByName(spark.createDataFrame(
        [("ord_004", "cust_001", "lost", None, None, None)], schemas.RAW_ORDERS))
    rel, m = _seed_relations(seed, seed_landing)
    res = {(r.relation, r.test_name, r.column_name): r.failures for r in Q.run_model_tests(rel).collect()}
    assert res[("stg_order_items", "no_orphan_items", None)] == 1
    assert res[("stg_order_items", "relationships", "order_id")] == 1
    assert res[("stg_order_items", "accepted_range", "price")] == 1
    assert res[("stg_orders", "accepted_values", "order_status")] == 1
    assert res[("stg_orders", "not_null", "purchase_timestamp")] == 1
    orphans = Q.orphan_items(m["stg_order_items"], m["stg_orders"]).collect()
    assert [(r.order_id, r.order_item_id) for r in orphans] == [("ord_999", 1)]
    # NULL keys are not flagged by unique / relationships / accepted_values
    nul = spark.createDataFrame([(None, None)], "order_id string, order_status string")
    t = Q.ModelTest("x", "accepted_values", "order_status", {"values": ["a"]})
    assert Q.violations({"x": nul}, t).count() == 0


def test_checks_fuse_into_one_scan(spark):
    """All row-level checks of a table share one aggregate: one parquet scan."""
    from conftest import SF_SMALL, plan_text
    from shopflow.sources import feeds
    df = feeds.raw_order_items(spark, SF_SMALL)
    suite = [e for e in Q.SUITES["order_items"]
             if e.expectation_type not in Q.GROUPED | Q.SCHEMA_ONLY]
    tree = plan_text(Q.run_suite(df, "order_items", suite)).split("\n\n")[0]
    assert tree.count("Scan parquet") == 1
    assert len(suite) == 9


def test_no_sources_fails_every_dataset(spark):
    res = Q.run_suites({}, Q.SUITES)
    summ = {r.dataset: r for r in Q.summarize(res).collect()}
    assert set(summ) == set(Q.SUITES) and not any(r.success for r in summ.values())
    with pytest.raises(Q.QualityGateError):
        Q.gate(res)


def test_bad_arguments_fail_their_check_alone(spark):
    df = spark.createDataFrame([("a",), ("b",)], "c string")
    suite = [Q.Expectation("expect_column_values_to_be_in_set", {"column": "c"}),
             Q.Expectation("expect_column_values_to_match_regex", {"column": "c", "regex": "(["}),
             Q.Expectation("expect_column_values_to_not_be_null", {}),
             Q.Expectation("expect_column_values_to_not_be_null", {"column": "c"})]
    got = {r["check_index"]: r["success"] for r in Q.run_suite(df, "d", suite).collect()}
    assert got == {0: False, 1: False, 2: False, 3: True}
    empty = Q.summarize(Q.run_suite(df, "d", [])).collect()
    assert [(r["dataset"], r["total"], r["success"]) for r in empty] == [("d", 0, True)]
