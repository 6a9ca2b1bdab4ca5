import json
import os
import time

from pyspark.sql import functions as F

from shopflow.sources import sinks
from shopflow.streaming import ingest as ING
from shopflow.streaming import transform as ST


def _msg(oid, t, amount=10.0, qty=1, **extra):
    d = {"order_id": oid, "customer_id": "C1", "product_id": "P1", "amount": amount, "quantity": qty,
         "event_time": f"2024-01-01T{t}+00:00"}
    d.update(extra)
    return json.dumps(d)


BATCHES = [
    [_msg("a", "00:00:00"), _msg("a", "00:00:01"), "garbage1", "garbage2", _msg("btg", "00:00:00", amount=-1)],
    [_msg("b", "01:00:00"), "garbage3", _msg("btg", "01:00:00", amount=9)],
    [_msg("late1", "00:30:00")],
    [_msg("late2", "00:30:00"), _msg("d", "05:00:00")],
    [_msg("a", "05:01:00")],
]


def _write_batches(src, batches, start=0):
    os.makedirs(src, exist_ok=True)
    base = time.time() - 1000
    for i, lines in enumerate(batches, start):
        p = os.path.join(src, f"batch_{i:03d}.json")
        with open(p, "w") as f:
            f.write("\n".join(lines) + "\n")
        os.utime(p, (base + i, base + i))


def _run(spark, src, root):
    targets = ING.ingest_sinks(root)
    q = ING.run_available(ING.json_file_source(spark, src, max_files_per_trigger=1), targets,
                          f"{root}/_checkpoint")
    return targets, q


def test_multi_batch_ingest(spark, tmp):
    src = f"{tmp}/src"
    _write_batches(src, BATCHES)
    targets, q = _run(spark, src, f"{tmp}/out")
    landed = sinks.read_table(spark, targets.landing)
    ids = sorted(r.order_id for r in landed.collect())
    # 'a' twice: its key expired before the 05:01 copy arrived, and the sink
    # is insert-if-absent, so the landing table still holds one 'a'
    assert ids == ["a", "b", "btg", "d", "late1"]
    assert landed.filter("order_id = 'btg'").first().amount == 9.0      # corrected record landed
    dead = sinks.read_table(spark, targets.dead_letter)
    raws = sorted(r.raw_value for r in dead.collect())
    assert [r for r in raws if r.startswith("garbage")] == ["garbage1", "garbage2", "garbage3"]
    assert any('"amount": -1' in r for r in raws)                       # bad_then_good's bad copy
    assert dead.select("reason").distinct().first().reason == ING.REJECT_REASON
    assert ING.dropped_by_watermark(q) == 1                             # late2


def test_restart_does_not_reemit(spark, tmp):
    src, root = f"{tmp}/src", f"{tmp}/out"
    _write_batches(src, BATCHES[:2])
    targets, _ = _run(spark, src, root)
    n1 = sinks.read_table(spark, targets.landing).count()
    dl1 = sinks.read_table(spark, targets.dead_letter).count()
    # resume from the checkpoint with one new file: only its row is added
    _write_batches(src, [[_msg("c", "02:00:00")]], start=2)
    targets, _ = _run(spark, src, root)
    rows = sorted(r.order_id for r in sinks.read_table(spark, targets.landing).collect())
    assert n1 == 3 and rows == ["a", "b", "btg", "c"]
    assert sinks.read_table(spark, targets.dead_letter).count() == dl1 == 4


def test_replayed_batch_leaves_same_contents(spark, tmp):
    targets = ING.ingest_sinks(f"{tmp}/replay")
    sinks.ensure_exists(spark, targets.landing)
    sinks.ensure_exists(spark, targets.dead_letter)
    msgs = spark.createDataFrame([(m.encode(),) for m in BATCHES[0]], "value binary")
    batch = ING.deduplicated(ST.parse_orders(msgs))     # as the stream hands it over
    for _ in range(2):
        ING.process_batch(batch, 7, targets)
    assert sinks.read_table(spark, targets.landing).count() == 1        # 'a' (in-batch dup collapsed)
    assert sinks.read_table(spark, targets.dead_letter).count() == 3


def test_parse_edge_cases(spark):
    msgs = [_msg("n", "00:00:00", amount=float("nan")), _msg("w", "00:00:00", qty="x"),
            _msg("e", "00:00:00", extra_field=1), json.dumps({"order_id": "t", "customer_id": "C",
                                                             "product_id": "P", "amount": 1.0, "quantity": 1})]
    df = ST.parse_orders(spark.createDataFrame([(m.encode(),) for m in msgs], "value binary"))
    valid, invalid = ST.split_valid(df)
    assert sorted(r.order_id for r in valid.collect()) == ["e"]
    bad = {r.order_id: r for r in invalid.collect()}
    assert set(bad) == {"n", "w", "t"}
    assert bad["w"].quantity is None and bad["w"].amount == 10.0       # wrong type: that field only
    assert bad["t"].event_time is None
    assert ST.parse_orders(spark.createDataFrame([(b"",)], "value binary")).first().order_id is None


def test_total_value_rounds_in_decimal(spark):
    df = spark.createDataFrame([(1.005, 1), (2.67, 3), (0.1, 3), (0.125, 8), (1.234, 10), (1e25, 1), (float("inf"), 1)],
                               "amount double, quantity int")
    from shopflow.functions.expressions import money_product
    got = [r.t for r in df.select(money_product(F.col("amount"), F.col("quantity")).alias("t")).collect()]
    assert got == [1.01, 8.01, 0.3, 1.0, 12.34, None, None]   # 0.1 * 3 as a double is 0.30000000000000004


def test_stream_and_batch_agree(spark, tmp):
    """The same messages through the live stream and the batch function."""
    src = f"{tmp}/src"
    _write_batches(src, [BATCHES[0] + BATCHES[1]])
    targets, _ = _run(spark, src, f"{tmp}/out")
    streamed = sorted(tuple(r) for r in sinks.read_table(spark, targets.landing)
                      .select("order_id", "amount", "total_value", "event_time").collect())
    msgs = spark.createDataFrame([(m.encode(),) for m in BATCHES[0] + BATCHES[1]], "value binary")
    batch = sorted(tuple(r) for r in ST.batch_landing(msgs)
                   .select("order_id", "amount", "total_value", "event_time").collect())
    assert [r[0] for r in streamed] == ["a", "b", "btg"]
    assert streamed[:2] == batch[:2]


def test_rocksdb_state_store(spark, tmp):
    src = f"{tmp}/src"
    _write_batches(src, BATCHES[:2])
    targets = ING.ingest_sinks(f"{tmp}/out")
    prev = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    try:
        ING.run_available(ING.json_file_source(spark, src, max_files_per_trigger=1), targets,
                          f"{tmp}/out/_checkpoint", state_store="rocksdb")
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", prev)
    assert sorted(r.order_id for r in sinks.read_table(spark, targets.landing).collect()) == ["a", "b", "btg"]


def test_kafka_options():
    o = ING.kafka_options("broker:9092", "orders_stream", max_offsets_per_trigger=1000)
    assert o == {"kafka.bootstrap.servers": "broker:9092", "subscribe": "orders_stream",
                 "startingOffsets": "latest", "failOnDataLoss": "false", "maxOffsetsPerTrigger": "1000"}


def test_redelivery_at_another_date_lands_once(spark, tmp):
    msgs = [[_msg("r", "00:00:00")], [_msg("r", "00:00:00").replace("2024-01-01", "2024-01-03")]]
    targets = ING.ingest_sinks(f"{tmp}/redelivered")
    sinks.ensure_exists(spark, targets.landing)
    sinks.ensure_exists(spark, targets.dead_letter)
    for i, batch in enumerate(msgs):
        df = spark.createDataFrame([(m.encode(),) for m in batch], "value binary")
        ING.process_batch(ING.deduplicated(ST.parse_orders(df)), i, targets)
    assert sinks.read_table(spark, targets.landing).count() == 1


def test_huge_and_infinite_amounts_are_dead_letters(spark, tmp):
    big = [_msg(k, "00:00:00") for k in ("ok", "huge", "inf")]
    df = spark.createDataFrame([(m.encode(),) for m in big], "value binary")
    parsed = ST.parse_orders(df).withColumn("amount", F.when(F.col("order_id") == "huge", F.lit(1e25))
                                            .when(F.col("order_id") == "inf", F.lit(float("inf")))
                                            .otherwise(F.lit(1e13)))
    targets = ING.ingest_sinks(f"{tmp}/big")
    sinks.ensure_exists(spark, targets.landing)
    sinks.ensure_exists(spark, targets.dead_letter)
    got = ING.process_batch(ING.deduplicated(parsed), 0, targets)
    assert (got["landed"], got["dead_letters"]) == (1, 2)


def test_null_payloads_keyed_by_source_position(spark):
    """Kafka-shaped input: NULL payloads are told apart by topic:partition:offset."""
    rows = [(None, "orders_stream", 0, 10), (None, "orders_stream", 0, 11),
            (_msg("k", "00:00:00").encode(), "orders_stream", 1, 5)]
    df = spark.createDataFrame(rows, "value binary, topic string, partition int, offset long")
    parsed = ST.parse_orders(df)
    keys = sorted(r.k for r in parsed.select(ST.dedup_key().alias("k")).collect())
    assert keys == ["v:k", "x:orders_stream:0:10", "x:orders_stream:0:11"]
    assert ING.deduplicated(parsed).count() == 3


def test_multi_date_batch_is_dealt_by_date(spark, tmp):
    """A backfill batch over several dates: few files, all rows."""
    msgs = [_msg(f"o{d}_{i}", "00:00:00").replace("2024-01-01", f"2024-01-0{d}")
            for d in range(1, 6) for i in range(40)]
    targets = ING.ingest_sinks(f"{tmp}/range")
    sinks.ensure_exists(spark, targets.landing)
    sinks.ensure_exists(spark, targets.dead_letter)
    df = spark.createDataFrame([(m.encode(),) for m in msgs], "value binary").repartition(8)
    ING.process_batch(ING.deduplicated(ST.parse_orders(df)), 0, targets)
    landed = sinks.read_table(spark, targets.landing)
    assert landed.count() == 200
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert len(spark.read.parquet(targets.landing.location).inputFiles()) <= n + 5


def test_hot_date_is_written_by_many_tasks(spark, tmp, monkeypatch):
    """A date with more rows than a file holds is dealt to more tasks, the
    others of the same batch stay one file each."""
    monkeypatch.setattr(ING, "ROWS_PER_FILE", 50)
    msgs = [_msg(f"h{i}", "00:00:00") for i in range(240)]
    msgs += [_msg(f"o{d}", "00:00:00").replace("2024-01-01", f"2024-01-0{d}") for d in range(2, 6)]
    targets = ING.ingest_sinks(f"{tmp}/hot")
    ING.prepare_sinks(spark, targets)
    df = spark.createDataFrame([(m.encode(),) for m in msgs], "value binary").repartition(4)
    key = "spark.sql.adaptive.enabled"      # off inside a micro-batch
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "false")
        assert ING.process_batch(ING.deduplicated(ST.parse_orders(df)), 0, targets)["landed"] == 244
    finally:
        spark.conf.set(key, before)
    files = [f.split("order_date=")[1][:10] for f in spark.read.parquet(targets.landing.location).inputFiles()]
    assert 2 <= files.count("2024-01-01") <= 5
    assert all(files.count(f"2024-01-0{d}") == 1 for d in range(2, 6))
