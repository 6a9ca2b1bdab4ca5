"""Structured Streaming ingest of order events.

source (Kafka, or files carrying the same ``value`` column)
  -> parse + derive (stateless, shared with batch)
  -> event-time watermark + dropDuplicatesWithinWatermark (bounded state)
     or, where late and repeated rows are to be kept, labelled arrivals
  -> foreachBatch: persist once; valid rows -> landing table (insert-if-absent
     by its key index, partitioned by order_date) or a database table
     (conditional append); invalid rows -> dead-letter table (partitioned by
     batch_id, replay-safe); repeats and late rows -> their own tables; release.

Delivery is at-least-once from the source's point of view; both sinks are
idempotent per batch id, so a replayed micro-batch leaves the same contents.
"""

from __future__ import annotations

import uuid
import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from shopflow.operators.clean import dedup_keep_first
from shopflow.sources import database, key_index, sinks
from shopflow.sources.feeds import order_messages
from shopflow.streaming.arrivals import BUCKETS, FIRST, LATE, REPEAT, labelled
from shopflow.schemas import LANDING_COLUMNS
from shopflow.streaming.transform import dedup_key, parse_orders, split_valid, to_landing, valid_flag

log = logging.getLogger("shopflow.ingest")

# Watermark delay, trigger interval, default topic and the
# rejection reason recorded with every dead letter.
WATERMARK_DELAY = "10 minutes"
TRIGGER_INTERVAL = "30 seconds"
DEFAULT_TOPIC = "orders_stream"
REJECT_REASON = "Failed data quality checks"

ROWS_PER_FILE = 1_000_000   # of one date in a micro-batch

QUERY_NAME = "orders_stream_ingest"
LANDING_KEY, LANDING_DATE = "order_id", "order_date"
DEAD_LETTER_COLUMNS = ["raw_value", "source_position", "order_id", "customer_id", "product_id",
                       "amount", "quantity", "total_value", "event_time"]


# ---- sources -------------------------------------------------------------------

def kafka_options(bootstrap_servers: str, topic: str, starting_offsets: str = "latest",
                  fail_on_data_loss: bool = False, max_offsets_per_trigger: int | None = None) -> dict:
    opts = {"kafka.bootstrap.servers": bootstrap_servers, "subscribe": topic,
            "startingOffsets": starting_offsets, "failOnDataLoss": str(fail_on_data_loss).lower()}
    if max_offsets_per_trigger is not None:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return opts


def kafka_source(spark: SparkSession, bootstrap_servers: str, topic: str, **kw) -> DataFrame:
    """Kafka topic as a stream of ``value`` bytes (needs the Kafka connector)."""
    return spark.readStream.format("kafka").options(**kafka_options(bootstrap_servers, topic, **kw)).load()


def json_file_source(spark: SparkSession, directory: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """JSON-lines files in a directory, one message per line, as ``value``."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(directory).select(F.col("value").cast("binary").alias("value"))


def events_source(spark: SparkSession, sf_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The driver's events table, read as a stream and encoded as messages."""
    schema = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet").schema
    r = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return order_messages(r.parquet(sf_dir))


# ---- plan ------------------------------------------------------------------------

def parsed_stream(messages: DataFrame) -> DataFrame:
    """Stateless stage: parse + derive + processing stamp."""
    return parse_orders(messages)


def deduplicated(parsed: DataFrame, delay: str = WATERMARK_DELAY) -> DataFrame:
    """Watermark on event time, then dedup on the state key.

    ``dropDuplicatesWithinWatermark`` evicts a key once the watermark passes
    its event time + delay, so state stays bounded (a plain
    ``dropDuplicates`` on a non-time key would keep every key forever).
    Rows later than the watermark are dropped and counted in the query's
    ``numRowsDroppedByWatermark`` metric.
    """
    keyed = parsed.withColumn("dedup_key", dedup_key())
    if not parsed.isStreaming:   # batch form (backfills, tests): first row per key
        return dedup_keep_first(keyed, ["dedup_key"],
                                order_by=["event_time", "raw_value"]).drop("dedup_key")
    return (keyed.withWatermark("event_time", delay)
                 .dropDuplicatesWithinWatermark(["dedup_key"])
                 .drop("dedup_key"))


@dataclass(frozen=True)
class IngestSinks:
    """Landing and dead-letter targets; with ``late`` and ``repeats``, rows
    that come late or again are kept there instead of dropped."""

    landing: sinks.Target
    dead_letter: sinks.Target
    late: sinks.Target | None = None
    repeats: sinks.Target | None = None

    def all(self) -> list[sinks.Target]:
        return [t for t in (self.landing, self.dead_letter, self.late, self.repeats) if t is not None]


LANDING_SCHEMA = T.StructType([
    T.StructField("order_id", T.StringType()), T.StructField("customer_id", T.StringType()),
    T.StructField("product_id", T.StringType()), T.StructField("amount", T.DoubleType()),
    T.StructField("quantity", T.IntegerType()), T.StructField("total_value", T.DoubleType()),
    T.StructField("event_time", T.TimestampNTZType()), T.StructField("processing_time", T.TimestampType()),
    T.StructField("order_date", T.DateType()),
])
DEAD_LETTER_SCHEMA = T.StructType([
    T.StructField("raw_value", T.StringType()), T.StructField("source_position", T.StringType()),
    T.StructField("order_id", T.StringType()),
    T.StructField("customer_id", T.StringType()), T.StructField("product_id", T.StringType()),
    T.StructField("amount", T.DoubleType()), T.StructField("quantity", T.IntegerType()),
    T.StructField("total_value", T.DoubleType()), T.StructField("event_time", T.TimestampNTZType()),
    T.StructField("reason", T.StringType()), T.StructField("captured_at", T.TimestampType()),
    T.StructField("batch_id", T.LongType()),
])


def ingest_sinks(root: str, arrivals: bool = False, landing: sinks.Target | None = None) -> IngestSinks:
    """The tables below ``root``; ``arrivals`` adds those of late and repeated
    rows, ``landing`` replaces the landing table (by one in a database)."""
    def side(name):
        return sinks.file_target(name, f"{root}/{name}", partition_by=("batch_id",), schema=DEAD_LETTER_SCHEMA)
    return IngestSinks(
        landing=landing or sinks.file_target("raw_orders_stream", f"{root}/raw_orders_stream",
                                             partition_by=("order_date",), schema=LANDING_SCHEMA),
        dead_letter=side("dead_letter"),
        late=side("late") if arrivals else None, repeats=side("repeats") if arrivals else None)


def prepare_sinks(spark: SparkSession, targets: IngestSinks) -> None:
    """Empty tables where there are none, and what each landing needs to find
    its keys: the ledger in a database, the key index of a file table."""
    for t in targets.all():
        sinks.ensure_exists(spark, t)
    if targets.landing.format == "jdbc":
        database.prepare(spark, targets.landing, LANDING_COLUMNS)
    else:
        key_index.ensure(spark, targets.landing, LANDING_KEY, LANDING_DATE)


def landing_rows(valid: DataFrame) -> DataFrame:
    return to_landing(valid).withColumn(LANDING_DATE, F.to_date("event_time"))


def _landing_layout(rows: DataFrame, per_date: dict) -> DataFrame:
    """Write layout of a micro-batch.  AQE (and so the rebalance hint) is off
    inside micro-batches, and each write task would create one file per date
    it holds.  Rows are dealt by date and a small hash of the order id, into
    as many tasks a date as its rows in this batch fill files."""
    many = {d: -(-n // ROWS_PER_FILE) for d, n in per_date.items() if d is not None and n > ROWS_PER_FILE}
    deal = F.lit(1)
    if many:
        pairs = [F.lit(x) for d, n in sorted(many.items()) for x in (d, n)]
        deal = F.coalesce(F.element_at(F.create_map(*pairs), F.col(LANDING_DATE)), F.lit(1))
    return rows.repartition(LANDING_DATE, F.pmod(F.xxhash64(LANDING_KEY), deal))


def land_files(rows: DataFrame, landing: sinks.Target, per_date: dict) -> tuple[dict, DataFrame]:
    """Append the rows whose key is not landed, by the key index: only dates
    that may hold a key of the batch have their keys read.  Returns the load
    and the landed keys of those dates."""
    spark, n = rows.sparkSession, sum(per_date.values())
    key_index.ensure(spark, landing, LANDING_KEY, LANDING_DATE)
    dates = key_index.hit_dates(rows, landing, LANDING_KEY, LANDING_DATE, n)
    there = key_index.landed_keys(spark, landing, LANDING_KEY, LANDING_DATE, dates, "processing_time")
    fresh = rows.join(there, LANDING_KEY, "left_anti") if dates else rows
    key_index.add(rows, landing, LANDING_KEY, LANDING_DATE)     # before the rows themselves
    return sinks.write_table(_landing_layout(fresh, per_date), landing, "append"), there


def process_batch(batch: DataFrame, batch_id: int, targets: IngestSinks,
                  reason: str = REJECT_REASON, stream: str | None = None) -> dict:
    """One micro-batch: split, land valid rows, dead-letter the rest.

    ``batch`` is the output of :func:`deduplicated` (one row per state key)
    or of :func:`labelled` (every row, with its arrival).  ``stream`` names
    the query and checkpoint in a database's ledger of batches.

    The batch is persisted once so the stateful plan above it runs once per
    trigger (not once per action); any failure propagates and stops the
    query, whose checkpoint then replays this batch id.
    """
    spark = batch.sparkSession
    cached = batch.persist()
    try:
        arrival = F.col("arrival") if "arrival" in batch.columns else F.lit(FIRST)
        # one row a date (and label) of the batch
        stats = cached.groupBy(arrival.alias("arrival"), valid_flag().alias("valid"),
                               F.when(valid_flag(), F.to_date("event_time")).alias("date")).count().collect()
        if not stats:
            log.info("batch %d: empty, skipped", batch_id)
            return {"batch_id": batch_id, "empty": True}
        per_date = {r["date"]: r["count"] for r in stats if r["valid"] and r["arrival"] == FIRST}
        # a database table has its own columns only, no partition column
        files = targets.landing.format != "jdbc"
        out = {"batch_id": batch_id}
        first = cached.where(arrival == FIRST).drop("arrival")
        valid, invalid = split_valid(first)
        dead = sinks.write_dead_letters(_side_rows(invalid), targets.dead_letter, batch_id, reason)
        # valid rows arrive unique per order id, so no second in-batch dedup;
        # an id may come again with another date once its state has expired
        if files:
            landed, there = land_files(landing_rows(valid), targets.landing, per_date)
        else:
            landed = database.append_batch(spark, to_landing(valid), targets.landing, [LANDING_KEY],
                                           stream or QUERY_NAME, batch_id)
        out |= {"landed": landed["rows"], "dead_letters": dead["rows"]}
        if targets.repeats is not None:
            rows = cached.where(arrival == REPEAT).drop("arrival")
            if files and landed["rows"] < sum(per_date.values()):
                # no longer in the state, but landed before: not by this batch,
                # whose time stamp stays the same when it is replayed
                other = there.select(F.col(LANDING_KEY).alias("k"), F.col("processing_time").alias("t"))
                rows = rows.unionByName(valid.join(other, (F.col(LANDING_KEY) == F.col("k"))
                                                   & ~F.col("processing_time").eqNullSafe(F.col("t")), "left_semi"))
            out["repeats"] = sinks.write_dead_letters(_side_rows(rows), targets.repeats, batch_id, "Repeated")["rows"]
            out["late"] = sinks.write_dead_letters(_side_rows(cached.where(arrival == LATE)), targets.late, batch_id,
                                                   "Later than the watermark")["rows"]
        log.info("batch %d: %s", batch_id, out)
        return out
    finally:
        cached.unpersist()


def _side_rows(rows: DataFrame) -> DataFrame:
    return rows.withColumn("event_time", F.col("event_time").cast("timestamp_ntz")).select(*DEAD_LETTER_COLUMNS)


STATE_STORES = {
    "rocksdb": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def start_ingest(messages: DataFrame, targets: IngestSinks, checkpoint: str,
                 trigger: dict | None = None, delay: str = WATERMARK_DELAY,
                 query_name: str = QUERY_NAME, state_store: str | None = None,
                 state_partitions: int | None = None, state_buckets: int = BUCKETS) -> StreamingQuery:
    """Start the ingest.  ``trigger`` defaults to a 30 s processing-time
    trigger; tests pass ``{"availableNow": True}``.  ``state_store="rocksdb"``
    keeps dedup state off the JVM heap (large key sets); like the number of
    state partitions (``state_partitions``: size it so each partition's key
    set fits one task) it is fixed by the checkpoint's first start.  A query
    takes a copy of the session's settings when it starts, so both are set
    for the start only and other jobs of the session keep theirs.
    ``state_buckets``: the groups of keys whose arrivals are labelled
    together, fixed by the first start as well."""
    spark = messages.sparkSession
    prepare_sinks(spark, targets)
    parsed = parsed_stream(messages)
    plan = labelled(parsed, delay, state_buckets) if targets.late is not None else deduplicated(parsed, delay)
    trig = trigger or {"processingTime": TRIGGER_INTERVAL}
    own = {}
    if state_partitions is not None:
        own["spark.sql.shuffle.partitions"] = str(state_partitions)
    if state_store is not None:
        own["spark.sql.streaming.stateStore.providerClass"] = STATE_STORES[state_store]
    before = {k: spark.conf.get(k, None) for k in own}
    try:
        for k, v in own.items():
            spark.conf.set(k, v)
        return (plan.writeStream
                    .outputMode("append")
                    .foreachBatch(lambda df, bid: process_batch(df, bid, targets, stream=_query_id(df.sparkSession)))
                    .option("checkpointLocation", checkpoint)
                    .trigger(**trig)
                    .queryName(query_name)
                    .start())
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _query_id(spark: SparkSession) -> str | None:
    """The id of the running query: kept by its checkpoint over restarts, new
    with a new checkpoint."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId")


def run_available(messages: DataFrame, targets: IngestSinks, checkpoint: str,
                  delay: str = WATERMARK_DELAY, state_store: str | None = None) -> StreamingQuery:
    """Process everything currently available, then stop (tests, backfills)."""
    q = start_ingest(messages, targets, checkpoint, {"availableNow": True}, delay,
                     query_name=f"{QUERY_NAME}_available_{uuid.uuid4().hex[:8]}",
                     state_store=state_store)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return q


def dropped_by_watermark(query: StreamingQuery) -> int:
    """Rows dropped as late by the dedup (those older than the watermark),
    summed over the query's recent progress reports.  Late rows are not
    dead-lettered: they are counted here."""
    return sum(op.get("numRowsDroppedByWatermark", 0)
               for p in query.recentProgress for op in p.get("stateOperators", []))
