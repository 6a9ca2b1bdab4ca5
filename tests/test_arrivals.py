"""Labelled arrivals: every row in exactly one table."""

import random

from pyspark.sql import functions as F

from shopflow.sources import sinks
from shopflow.streaming import arrivals as A
from shopflow.streaming import ingest as ING
from tests.test_streaming import _msg, _write_batches


def test_labels_against_a_plain_version():
    """The bucketed form with stored state against one dictionary of times."""
    rnd = random.Random(3)
    delay, plain, seen, mark, top = 600, {}, {}, None, 0
    for _ in range(200):
        rows = [(rnd.choice("abcdefgh").encode() * 16, rnd.choice([None, top + rnd.randint(-1500, 900)])) for _ in range(rnd.randint(0, 6))]
        want = []
        for k, t in rows:
            if t is not None and mark is not None and t <= mark:
                want.append("late")
            elif k in plain and (mark is None or plain[k] > mark):
                want.append("repeat")
            else:
                plain[k] = (t if t is not None else mark or 0) + delay
                want.append("first")
        assert A.labels([k for k, _ in rows], [t for _, t in rows], seen, mark, delay) == want
        top = max([top, *[t for _, t in rows if t is not None]])
        mark = max(mark or 1, top - delay)
        seen = {k: t for k, t in seen.items() if t > mark}        # what store() keeps


def _ingest(spark, src, root, targets):
    return ING.run_available(ING.json_file_source(spark, src, max_files_per_trigger=1), targets, f"{root}/_checkpoint")


BATCHES = [
    [_msg("a", "00:00:00"), _msg("a", "00:00:00"), "garbage", "garbage", _msg("bad", "00:00:00", amount=-1)],
    [_msg("b", "01:00:00"), _msg("a", "00:00:00")],                      # not late yet: the mark moves after the batch
    [_msg("late1", "00:30:00"), _msg("b", "01:00:00"), _msg("c", "01:01:00")],
    [_msg("d", "05:00:00")],
    [_msg("c", "05:01:00"), _msg("late2", "01:00:00", amount=-1)],       # c's key has expired, but it is landed
]


def test_every_row_in_exactly_one_table(spark, tmp):
    src, root = f"{tmp}/src", f"{tmp}/out"
    _write_batches(src, BATCHES)
    targets = ING.ingest_sinks(root, arrivals=True)
    q = _ingest(spark, src, root, targets)
    got = {n: sorted((r.order_id or r.raw_value) for r in sinks.read_table(spark, t).collect()) if n != "landed"
           else sorted(r.order_id for r in sinks.read_table(spark, t).collect())
           for n, t in (("landed", targets.landing), ("dead", targets.dead_letter),
                        ("repeats", targets.repeats), ("late", targets.late))}
    assert got["landed"] == ["a", "b", "c", "d"]
    assert got["dead"] == ["bad", "garbage"]
    assert got["repeats"] == ["a", "a", "b", "c", "garbage"]
    assert got["late"] == ["late1", "late2"]
    assert sum(map(len, got.values())) == sum(map(len, BATCHES))
    assert ING.dropped_by_watermark(q) == 0
    # the state lets go of keys that the watermark has passed
    assert q.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] <= 2


def test_replayed_batch_keeps_its_rows_where_they_were(spark, tmp):
    from shopflow.streaming import transform as ST
    targets = ING.ingest_sinks(f"{tmp}/replay", arrivals=True)
    ING.prepare_sinks(spark, targets)
    msgs = [_msg("a", "00:00:00"), _msg("b", "00:00:00"), "junk"]
    df = ST.parse_orders(spark.createDataFrame([(m.encode(),) for m in msgs], "value binary"))
    batch = df.withColumn("processing_time", F.lit("2024-01-01 09:00:00").cast("timestamp")).withColumn("arrival", F.lit("first"))
    for _ in range(2):
        ING.process_batch(batch, 0, targets)
        count = [sinks.read_table(spark, t).count() for t in (targets.landing, targets.dead_letter, targets.repeats, targets.late)]
        assert count == [2, 1, 0, 0]
    # another batch with the same keys: nothing lands, both are repeats
    ING.process_batch(batch.withColumn("processing_time", F.lit("2024-01-01 10:00:00").cast("timestamp")), 1, targets)
    count = [sinks.read_table(spark, t).count() for t in (targets.landing, targets.dead_letter, targets.repeats, targets.late)]
    assert count == [2, 2, 2, 0]
