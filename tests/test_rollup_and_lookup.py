"""Roll-ups over the landing table and the translation lookup."""

from pyspark.sql import functions as F

from shopflow.plans import models as M
from shopflow.sources import sinks
from shopflow.streaming import ingest as ING
from shopflow.streaming import rollup as RU
from tests.test_streaming import _msg, _run, _write_batches


def test_windows_close_once_by_the_watermark(spark, tmp):
    src, root = f"{tmp}/src", f"{tmp}/out"
    _write_batches(src, [[_msg("a", "00:10:00"), _msg("b", "00:50:00", amount=0.1, qty=3), _msg("c", "01:05:00")]])
    targets, _ = _run(spark, src, root)

    def roll():
        q = RU.start_rollup(spark, targets.landing, f"{root}/hours", f"{root}/hours_ck", trigger={"availableNow": True})
        q.awaitTermination()
        assert q.exception() is None
        return sorted((r.period_start.hour, r.orders, r.quantity, r.total_value) for r in spark.read.parquet(f"{root}/hours").collect())
    assert roll() == []                                    # 01:05 less ten minutes: no hour is over
    _write_batches(src, [[_msg("d", "03:30:00"), _msg("e", "03:31:00")]], start=1)
    _run(spark, src, root)
    assert roll() == [(0, 2, 4, 10.3), (1, 1, 1, 10.0)]
    _write_batches(src, [[_msg("f", "05:30:00")]], start=2)
    _run(spark, src, root)
    assert roll() == [(0, 2, 4, 10.3), (1, 1, 1, 10.0), (3, 2, 2, 20.0)]    # nothing is written twice


def test_batch_form_adds_up_every_window(spark, tmp):
    targets = ING.ingest_sinks(f"{tmp}/b")
    _write_batches(f"{tmp}/src", [[_msg(str(i), f"0{i % 3}:00:00") for i in range(9)]])
    targets, _ = _run(spark, f"{tmp}/src", f"{tmp}/b")
    rows = RU.rolled_up(sinks.read_table(spark, targets.landing), RU.DAILY).collect()
    assert [(r.orders, r.quantity, r.total_value) for r in rows] == [(9, 9, 90.0)]


def test_lookup_keeps_rows_and_names_the_unknown(spark):
    dim = spark.createDataFrame([("p1", "moveis"), ("p2", "nada"), ("p3", None), ("p4", "moveis"), ("p5", "vazio")],
                                "product_id string, product_category string")
    lookup = spark.createDataFrame([("moveis", "furniture"), ("moveis", "movables"), (None, "nothing"), ("vazio", None)],
                                   "product_category_name string, product_category_name_english string")
    for rows in (M.LOOKUP_ROWS, 0):                        # broadcast, and joined by shuffle
        before, M.LOOKUP_ROWS = M.LOOKUP_ROWS, rows
        try:
            out = M.dim_products_translated(dim, lookup)
            got = {r.product_id: r.product_category_english for r in out.collect()}
        finally:
            M.LOOKUP_ROWS = before
        assert got == {"p1": "furniture", "p2": "unknown", "p3": "unknown", "p4": "furniture", "p5": "unknown"}
        assert out.columns == ["product_id", "product_category", "product_category_english"]
    assert M.translated(dim, "product_category", lookup.limit(0).withColumnRenamed("product_category_name", "product_category"),
                        "product_category_name_english", "e").where(F.col("e") != "unknown").count() == 0
