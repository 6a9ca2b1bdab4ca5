"""Plan properties the design relies on (checked with ``explain``)."""

import re

import __spark_entry__ as E
from conftest import SF_SMALL, plan_text
from shopflow.plans import catalog

# the retail queries with no side effects (no writes, no streams): plans only
PURE = [n for n in sorted(catalog.QUERIES)
        if not n.startswith(("stream_", "sink_", "src_", "test_", "dlq_", "stage_", "fact_orders_realtime",
                             "dim_products_translated"))]


def _read_schemas(plan: str) -> list[str]:
    return re.findall(r"ReadSchema: (struct<[^\n]*>)", plan)


def test_fact_orders_reads_only_needed_columns(spark):
    plan = plan_text(E.queries()["fact_orders"](spark, SF_SMALL))
    schemas = " ".join(_read_schemas(plan))
    for unused in ("l_quantity", "l_discount", "l_returnflag", "l_linestatus", "l_shipdate",
                   "o_totalprice", "o_orderpriority"):
        assert unused not in schemas, unused
    assert "l_orderkey" in schemas and "o_orderkey" in schemas


def test_messages_parsed_once(spark):
    for name in ("valid_split_valid", "valid_split_invalid", "except_distinct"):
        plan = plan_text(E.queries()[name](spark, SF_SMALL), "simple")
        assert plan.count("from_json(") == 1, name


def test_no_python_udfs_in_batch_queries(spark):
    assert len(PURE) >= 25
    for name in PURE:
        plan = plan_text(E.queries()[name](spark, SF_SMALL), "simple")
        assert not re.search("EvalPython|PythonUDF|InArrow|InPandas", plan), name


def test_no_cartesian_products(spark):
    for name in PURE:
        plan = plan_text(E.queries()[name](spark, SF_SMALL), "simple")
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
