import json

from shopflow.__main__ import main
from shopflow.operators import quality as Q
from shopflow.sources import files, sinks
from test_jobs import RELAXED
from test_streaming import BATCHES, _write_batches


def _csv_sources(seed, root):
    for n, df in seed.items():
        files.write_csv(df, f"{root}/{n}")


def test_daily_cli_gate_failure_and_success(spark, seed, seed_landing, tmp):
    _csv_sources(seed, f"{tmp}/src")
    seed_landing.write.parquet(f"{tmp}/landing")
    assert main(["daily", "--sources", f"{tmp}/src", "--warehouse", f"{tmp}/wh_fail"]) == 1
    for n, suite in RELAXED.items():
        with open(f"{tmp}/{n}_suite.json", "w") as f:
            json.dump({"expectations": [{"expectation_type": e.expectation_type, "kwargs": e.kwargs}
                                        for e in suite]}, f)
    assert main(["daily", "--sources", f"{tmp}/src", "--warehouse", f"{tmp}/wh",
                 "--suites", tmp, "--landing", f"{tmp}/landing"]) == 0
    fact = sinks.read_table(spark, sinks.file_target("f", f"{tmp}/wh/analytics/fact_orders"))
    assert fact.count() == 4
    assert len(Q.load_suite(f"{tmp}/orders_suite.json")) == len(RELAXED["orders"])


def test_stream_cli(spark, tmp):
    _write_batches(f"{tmp}/in", BATCHES[:2])
    assert main(["stream", "--files", f"{tmp}/in", "--output", f"{tmp}/out",
                 "--checkpoint", f"{tmp}/ck", "--available-now"]) == 0
    landed = spark.read.parquet(f"{tmp}/out/raw_orders_stream")
    assert sorted(r.order_id for r in landed.collect()) == ["a", "b", "btg"]


def test_daily_cli_with_jdbc_copy(spark, seed, seed_landing, tmp):
    _csv_sources(seed, f"{tmp}/src")
    seed_landing.write.parquet(f"{tmp}/landing")
    for n, suite in RELAXED.items():
        with open(f"{tmp}/{n}_suite.json", "w") as f:
            json.dump({"expectations": [{"expectation_type": e.expectation_type, "kwargs": e.kwargs}
                                        for e in suite]}, f)
    spark.sql("SELECT 1")  # session is shared with the CLI
    url = "jdbc:derby:memory:shopflow_cli;create=true"
    rc = main(["daily", "--sources", f"{tmp}/src", "--warehouse", f"{tmp}/wh", "--suites", tmp, "--landing", f"{tmp}/landing",
               "--jdbc-url", url, "--jdbc-driver", "org.apache.derby.iapi.jdbc.AutoloadedDriver"])
    assert rc == 0
    t = sinks.jdbc_target("orders", url, "raw.orders", driver="org.apache.derby.iapi.jdbc.AutoloadedDriver")
    assert sinks.read_table(spark, t).count() == 3


def test_daily_cli_missing_source_fails_gate(spark, seed, tmp):
    from shopflow.tables import SourcePaths
    _csv_sources({k: v for k, v in seed.items() if k != "products"}, f"{tmp}/src")
    paths = SourcePaths(**{n: f"{tmp}/src/{n}" for n in ("orders", "customers", "products", "order_items")})
    got = files.read_available_sources(spark, paths)
    assert sorted(got) == ["customers", "order_items", "orders"]
    res = {r.dataset: r for r in Q.summarize(Q.run_suites(got, RELAXED)).collect()}
    assert res["products"].success is False and res["products"].total == 0
    assert res["orders"].success is True
    assert main(["daily", "--sources", f"{tmp}/src", "--warehouse", f"{tmp}/wh"]) == 1
