"""Conditional append into an embedded database."""

import pytest

from shopflow.sources import database as DB
from shopflow.sources import sinks
from shopflow.streaming import ingest as ING
from shopflow.streaming import transform as ST
from tests.test_streaming import _msg, _write_batches

DRIVER = "org.apache.derby.iapi.jdbc.AutoloadedDriver"
DDL = ("CREATE TABLE orders_stream (order_id VARCHAR(50) PRIMARY KEY, customer_id VARCHAR(50) NOT NULL, "
       "product_id VARCHAR(50) NOT NULL, amount DOUBLE NOT NULL, quantity INTEGER NOT NULL, "
       "total_value DOUBLE NOT NULL, event_time TIMESTAMP NOT NULL, processing_time TIMESTAMP NOT NULL)")


@pytest.fixture()
def target(spark, request):
    t = sinks.jdbc_target("raw_orders_stream", f"jdbc:derby:memory:{request.node.name};create=true", "orders_stream", driver=DRIVER)
    with DB.connection(spark, t) as con:
        DB._run(con, DDL)
    return t


def _batch(spark, *msgs):
    df = spark.createDataFrame([(m.encode(),) for m in msgs], "value binary").repartition(2)
    return ING.deduplicated(ST.parse_orders(df))


def _ids(spark, t):
    return sorted(r.order_id for r in sinks.read_table(spark, t).selectExpr("order_id").collect())


def test_replayed_batch_is_a_no_op(spark, tmp, target):
    targets = ING.ingest_sinks(f"{tmp}/out", landing=target)
    ING.prepare_sinks(spark, targets)
    ING.prepare_sinks(spark, targets)                      # a restart finds its tables
    first = _batch(spark, *[_msg(f"o{i}", "00:00:00") for i in range(20)], "junk")
    assert ING.process_batch(first, 0, targets, stream="s")["landed"] == 20
    assert ING.process_batch(first, 0, targets, stream="s")["landed"] == 0
    # known keys stay as they are, new ones land, whichever the partition
    second = _batch(spark, *[_msg(f"o{i}", "00:00:00", amount=7.0) for i in range(15, 25)])
    assert ING.process_batch(second, 1, targets, stream="s")["landed"] == 5
    assert _ids(spark, target) == sorted(f"o{i}" for i in range(25))
    assert sinks.read_table(spark, target).where("amount = 7.0").count() == 5
    # the same number of another stream (or of a new checkpoint) is another batch
    assert ING.process_batch(_batch(spark, _msg("z", "00:00:00")), 0, targets, stream="t")["landed"] == 1


def test_half_done_batch_is_finished_by_its_replay(spark, target):
    DB.prepare(spark, target, ING.LANDING_COLUMNS)
    rows = ING.to_landing(_batch(spark, *[_msg(f"o{i}", "00:00:00") for i in range(6)]))
    # staged twice by a task that ran twice, and never moved
    twice = rows.unionAll(rows).selectExpr("*", "cast(0 as bigint) as batch_id")
    sinks.write_table(twice, DB.staging_target(target), "overwrite")
    assert DB.append_batch(spark, rows, target, ["order_id"], "s", 0)["rows"] == 6
    with DB.connection(spark, target) as con:
        assert DB._any(con, "SELECT 1 FROM shopflow_batches WHERE stream = ? AND batch_id = ? AND moved = 6", "s", 0)


def test_failed_move_leaves_neither_rows_nor_ledger(spark, target):
    DB.prepare(spark, target, ING.LANDING_COLUMNS)
    rows = ING.to_landing(_batch(spark, _msg("a", "00:00:00"), _msg("b", "00:00:00"))).selectExpr(
        "order_id", "CASE WHEN order_id = 'a' THEN customer_id END AS customer_id", "product_id", "amount", "quantity",
        "total_value", "event_time", "processing_time")
    with pytest.raises(Exception):
        DB.append_batch(spark, rows, target, ["order_id"], "s", 0)
    assert _ids(spark, target) == []
    with DB.connection(spark, target) as con:
        assert not DB._any(con, "SELECT 1 FROM shopflow_batches WHERE stream = ?", "s")


def test_stream_into_the_database_by_command_line_options(spark, tmp, target):
    from shopflow.__main__ import main
    _write_batches(f"{tmp}/src", [[_msg("a", "00:00:00"), "junk"], [_msg("b", "00:00:01"), _msg("a", "00:00:00")]])
    args = ["stream", "--files", f"{tmp}/src", "--output", f"{tmp}/out", "--checkpoint", f"{tmp}/ck", "--available-now",
            "--jdbc-url", target.options["url"], "--jdbc-table", "orders_stream", "--jdbc-driver", DRIVER]
    assert main(args) == 0
    assert _ids(spark, target) == ["a", "b"]
    with DB.connection(spark, target) as con:      # named by the checkpoint's own id
        assert not DB._any(con, "SELECT 1 FROM shopflow_batches WHERE stream = ?", ING.QUERY_NAME)
        assert DB._any(con, "SELECT 1 FROM shopflow_batches WHERE batch_id = ?", 0)


def test_identifiers_are_plain():
    with pytest.raises(ValueError):
        DB._name("orders; DROP TABLE orders")
