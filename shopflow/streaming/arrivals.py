"""Labelled arrivals: first, repeat or late, with no row dropped.

``dropDuplicatesWithinWatermark`` drops repeated and late rows without a
trace.  Here every row of the stream comes out once, with a label:

late     its event time is not after the watermark that holds for its batch
repeat   not late, and its key came before and has not expired
first    all others

State is kept per bucket of keys, not per key: one Python call a bucket and
micro-batch, and one state row that holds the 16-byte digests of the bucket's
live keys and when each expires (event time + delay).  An event-time timer
set to the earliest expiry lets go of the keys of a bucket that gets no more
rows, so state is bounded by the watermark window.

Spark drops late rows before they reach a stateful operator that has
event-time timers: it compares the column that carries the watermark's mark.
The true event time goes in as plain microseconds, and the mark sits on a
constant far in the future, so all rows arrive and the label decides.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from shopflow.streaming.transform import dedup_key

FIRST, REPEAT, LATE = "first", "repeat", "late"
BUCKETS = 128     # tasks that share the state; like a state store's partitions, fixed by the checkpoint
DIGEST = 16                                     # bytes: md5 of a state key
MARK = "spark.watermarkDelayMs"                 # column metadata of a watermark
STATE = T.StructType([T.StructField("digests", T.BinaryType()), T.StructField("expiry", T.BinaryType())])


def _delay_ms(delay: str) -> int:
    """A fixed-length interval (``10 minutes``) in milliseconds."""
    return int(pd.Timedelta(delay).total_seconds() * 1000)


def load(state: GroupState) -> dict[bytes, int]:
    if not state.exists:
        return {}
    digests, expiry = state.get
    return dict(zip((bytes(digests[i:i + DIGEST]) for i in range(0, len(digests), DIGEST)),
                    np.frombuffer(expiry, np.int64).tolist(), strict=True))


def store(state: GroupState, seen: dict[bytes, int], now: int) -> None:
    """Keep the keys that expire after ``now`` (microseconds) and wake up
    when the first of them does."""
    live = {k: t for k, t in seen.items() if t > now}
    if not live:
        if state.exists:
            state.remove()
        return
    state.update((b"".join(live), np.array(list(live.values()), np.int64).tobytes()))
    state.setTimeoutTimestamp(max(min(live.values()) // 1000, now // 1000) + 1)


def labels(digests: list[bytes], times: list[int | None], seen: dict[bytes, int],
           now: int | None, delay: int) -> list[str]:
    """The label of each row, in order; ``seen`` takes the new keys.  A row
    without an event time is never late; its key is kept for one delay."""
    out = []
    for key, at in zip(digests, times, strict=True):
        if at is not None and now is not None and at <= now:
            out.append(LATE)
            continue
        until = seen.get(key)
        if until is not None and (now is None or until > now):
            out.append(REPEAT)
            continue
        seen[key] = (at if at is not None else now or 0) + delay
        out.append(FIRST)
    return out


def _label_buckets(delay_us: int, columns: list[str]):
    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        # Spark joins the frames of many buckets; a column of nulls in one of
        # them makes pandas warn each time
        warnings.filterwarnings("ignore", "The behavior of DataFrame concatenation", FutureWarning)
        mark = state.getCurrentWatermarkMs() * 1000
        now = mark if mark > 0 else None        # 0: no row has set a watermark yet
        seen = load(state)
        if not state.hasTimedOut:
            for f in frames:
                if len(f):
                    times = [None if pd.isna(t) else int(t) for t in f["event_us"]]
                    marked = labels([bytes(d) for d in f["digest"]], times, seen, now, delay_us)
                    yield f[columns].assign(arrival=marked)
        store(state, seen, now or 0)
    return run


def labelled(parsed: DataFrame, delay: str = "10 minutes", buckets: int = BUCKETS) -> DataFrame:
    """The parsed stream with one more column, ``arrival``."""
    ms = _delay_ms(delay)
    columns = [f.name for f in parsed.schema if f.name != "event_time"]
    digest = F.unhex(F.md5(dedup_key().cast("binary")))
    rows = parsed.withWatermark("event_time", delay).select(
        *columns, F.unix_micros("event_time").alias("event_us"), digest.alias("digest"),
        F.pmod(F.xxhash64(dedup_key()), F.lit(buckets)).alias("bucket"),
        F.to_timestamp(F.lit("2250-01-01")).alias("clock", metadata={MARK: ms}))
    out = T.StructType([*(T.StructField(f.name, f.dataType) for f in parsed.schema if f.name != "event_time"),
                        T.StructField("event_us", T.LongType()), T.StructField("arrival", T.StringType())])
    marked = rows.groupBy("bucket").applyInPandasWithState(
        _label_buckets(ms * 1000, [*columns, "event_us"]), out, STATE, "append", GroupStateTimeout.EventTimeTimeout)
    return marked.select(*[F.timestamp_micros("event_us").alias("event_time") if f.name == "event_time" else f.name
                           for f in parsed.schema], "arrival")
