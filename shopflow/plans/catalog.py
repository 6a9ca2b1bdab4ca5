"""Registered queries: ``name -> fn(spark, sf_dir) -> DataFrame`` plus the
matching oracle SQL.  Each query reads the driver's whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shopflow.functions.expressions import money_product
from shopflow.operators import clean as C
from shopflow.operators import quality as Q
from shopflow.operators.hot_keys import hot_keys
from shopflow.plans import jobs
from shopflow.plans import models as M
from shopflow.plans import oracle_sql as O
from shopflow.schemas import CATEGORY_TRANSLATION, RAW_CUSTOMERS
from shopflow.session import work_dir
from shopflow.sources import dead_letters as DL
from shopflow.sources import feeds, files, sinks
from shopflow.streaming import ingest as ING
from shopflow.streaming import rollup as RU
from shopflow.streaming import transform as ST
from shopflow.tables import STREAM_TABLE

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


# ---- shared building blocks -----------------------------------------------

def cleaned(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The four loaded (raw-schema) tables: feeds passed through the cleaners."""
    return {n: C.CLEANERS[n](df) for n, df in feeds.raw_feeds(spark, sf_dir).items()}


def models(spark: SparkSession, sf_dir: str, landing: DataFrame | None = None) -> dict[str, DataFrame]:
    return M.build_models(cleaned(spark, sf_dir), landing)


# ---- cleaning ---------------------------------------------------------------

def _clean_query(table: str):
    def q(spark, sf_dir):
        return C.CLEANERS[table](feeds.RAW_FEEDS[table](spark, sf_dir))
    return q


for _t in ("orders", "customers", "products", "order_items"):
    register(f"clean_{_t}", O.with_ctes(f"SELECT * FROM clean_{_t}", f"clean_{_t}"))(_clean_query(_t))


@register("dedup_single_key", O.with_ctes(
    O.keep_first("SELECT * FROM raw_orders", ["order_id"],
                 ["customer_id", "order_status", "order_purchase_timestamp",
                  "order_delivered_customer_date", "order_estimated_delivery_date"]),
    "raw_orders"))
def dedup_single_key(spark, sf_dir):
    """Keep-first dedup on one key over the twice-exported order feed."""
    return C.dedup_keep_first(feeds.raw_orders(spark, sf_dir), ["order_id"])


@register("dedup_composite_key", O.with_ctes(
    O.keep_first("SELECT * FROM raw_order_items", ["order_id", "order_item_id"],
                 ["product_id", "seller_id", "price", "freight_value"]),
    "raw_order_items"))
def dedup_composite_key(spark, sf_dir):
    """Keep-first dedup on (order_id, order_item_id): the line-item feed has
    naturally repeated composite keys."""
    return C.dedup_keep_first(feeds.raw_order_items(spark, sf_dir), ["order_id", "order_item_id"])


# ---- staging and marts ------------------------------------------------------

def _model_query(name: str):
    def q(spark, sf_dir):
        return models(spark, sf_dir)[name]
    return q


@register("fact_orders", O.with_ctes("SELECT * FROM fact_orders", "fact_orders"))
def fact_orders(spark, sf_dir):
    """Items joined to their orders; orders that hold a large share of the
    landed items are found first and their items spread."""
    raw = cleaned(spark, sf_dir)
    hot = hot_keys(feeds.raw_order_items(spark, sf_dir).select("order_id"), "order_id")
    return M.build_models(raw, only=["fact_orders"], hot=hot)["fact_orders"]


@register("dim_products_translated", O.PRODUCTS_TRANSLATED)
def dim_products_translated(spark, sf_dir):
    """The product dimension translated by a lookup file (with a byte-order
    mark before its header), made from the feed's own categories but for
    some, which come out as unknown."""
    path = work_dir(spark, "category_translation")
    dim = models(spark, sf_dir)["dim_products"]
    known = dim.select("product_category").distinct().where("length(product_category) % 5 <> 0 and product_category not in ('', 'unknown')")
    files.write_csv(known.select(F.col("product_category").alias("\ufeffproduct_category_name"),
                                 F.upper("product_category").alias("product_category_name_english")), path)
    return M.dim_products_translated(dim, files.read_csv(spark, path, CATEGORY_TRANSLATION))


for _m in ("stg_orders", "stg_customers", "stg_products", "stg_order_items",
           "dim_customers", "dim_products"):
    register(_m, O.with_ctes(f"SELECT * FROM {_m}", _m))(_model_query(_m))


def batch_run(spark: SparkSession, sf_dir: str) -> tuple[list[dict], dict[str, DataFrame]]:
    """The batch job over all feeds: clean and load the four tables, then
    build the models from what was loaded.  The loads and the models by name."""
    wh = jobs.Warehouse(work_dir(spark, "warehouse"))
    loads = jobs.run_batch(spark, feeds.raw_feeds(spark, sf_dir), wh)
    return loads, jobs.run_models(spark, wh)


@register("batch_load_counts", O.BATCH_LOAD_COUNTS)
def batch_load_counts(spark, sf_dir):
    """The batch job's report: rows of every table it loaded (observed while
    writing) and of every model built from them."""
    loads, built = batch_run(spark, sf_dir)
    rows = [(r["table"], r["rows"]) for r in loads]
    out = spark.createDataFrame(rows, "relation string, row_count long")
    for name in sorted(built):
        out = out.unionByName(built[name].agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("relation"), "row_count"))
    return out


# ---- source expectations (pre-load gate) -------------------------------------


DQ_TYPES = {
    "dq_row_count": "expect_table_row_count_to_be_between",
    "dq_not_null": "expect_column_values_to_not_be_null",
    "dq_unique": "expect_column_values_to_be_unique",
    "dq_in_set": "expect_column_values_to_be_in_set",
    "dq_regex": "expect_column_values_to_match_regex",
    "dq_length": "expect_column_value_lengths_to_be_between",
    "dq_between": "expect_column_values_to_be_between",
}


def _dq_query(t: str):
    def q(spark, sf_dir):
        return Q.run_suites(feeds.raw_feeds(spark, sf_dir), Q.SUITES, only={t})
    return q


for _k, _t in DQ_TYPES.items():
    register(_k, O.suites_sql(Q.SUITES, only={_t}))(_dq_query(_t))


@register("dq_suite_results", O.suites_sql(Q.SUITES))
def dq_suite_results(spark, sf_dir):
    """All 46 source expectations over the four landed feeds."""
    return Q.run_suites(feeds.raw_feeds(spark, sf_dir), Q.SUITES)


@register("dq_summary", O.summary_sql(Q.SUITES))
def dq_summary(spark, sf_dir):
    """Per-dataset roll-up: total / passed / failed, overall success."""
    return Q.summarize(Q.run_suites(feeds.raw_feeds(spark, sf_dir), Q.SUITES))


# ---- stream transforms in batch form ------------------------------------------


PARSED_COLS = ["order_id", "customer_id", "product_id", "amount", "quantity", "total_value", "event_time"]


def parsed_events(spark, sf_dir):
    """Order-event messages of the whole events table, parsed."""
    return ST.parse_orders(feeds.order_messages(feeds.read_table(spark, sf_dir, "events")))


def _out(df):
    return df.withColumn("event_time", F.col("event_time").cast("timestamp_ntz")).select(*PARSED_COLS)


def landing(spark, sf_dir):
    return ST.batch_landing(feeds.order_messages(feeds.read_table(spark, sf_dir, "events")))


@register("json_parse", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def json_parse(spark, sf_dir):
    """from_json of the events' ``props`` document with a declared schema."""
    ev = feeds.read_table(spark, sf_dir, "events")
    return ev.select("event_id", F.from_json("props", "k INT").alias("p")).select("event_id", "p.k")


@register("parse_order_events", O.with_ctes(f"SELECT {', '.join(PARSED_COLS)} FROM parsed", "parsed"))
def parse_order_events(spark, sf_dir):
    """bytes -> JSON -> flat order events with derived total (batch form of
    the stream's stateless stage)."""
    return _out(parsed_events(spark, sf_dir))


@register("derive_total_value",
          "SELECT event_id, value AS amount, CAST(json_extract_string(props, '$.k') AS INTEGER) AS quantity, "
          "CAST(round(TRY_CAST(value AS DECIMAL(27,8)) * CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) "
          "AS DECIMAL(10,0)), 2) AS DOUBLE) AS total_value FROM events")
def derive_total_value(spark, sf_dir):
    """round(amount * quantity, 2) in exact decimal arithmetic."""
    ev = feeds.read_table(spark, sf_dir, "events")
    q = F.get_json_object("props", "$.k").cast("int")
    return ev.select("event_id", F.col("value").alias("amount"), q.alias("quantity"),
                     money_product(F.col("value"), q).alias("total_value"))


@register("valid_split_valid", O.with_ctes(f"SELECT {', '.join(PARSED_COLS)} FROM parsed WHERE {O.VALID}", "parsed"))
def valid_split_valid(spark, sf_dir):
    valid, _ = ST.split_valid(parsed_events(spark, sf_dir))
    return _out(valid)


@register("valid_split_invalid",
          O.with_ctes(f"SELECT {', '.join(PARSED_COLS)} FROM parsed WHERE NOT {O.VALID}", "parsed"))
def valid_split_invalid(spark, sf_dir):
    _, invalid = ST.split_valid(parsed_events(spark, sf_dir))
    return _out(invalid)


@register("except_distinct", O.with_ctes(
    f"SELECT {', '.join(PARSED_COLS)} FROM parsed EXCEPT "
    f"SELECT {', '.join(PARSED_COLS)} FROM parsed WHERE {O.VALID}", "parsed"))
def except_distinct(spark, sf_dir):
    """``batch.subtract(valid)``: the EXCEPT DISTINCT form of the split."""
    p = _out(parsed_events(spark, sf_dir))
    valid, _ = ST.split_valid(p)
    return p.subtract(valid)


# ---- model tests (post-transform) ---------------------------------------------


def relations(spark, sf_dir, tests=None) -> dict:
    """The relations the given tests read (default: the whole catalogue),
    named as in the test catalogue and built the way the daily job builds
    them: each layer is written once to a warehouse under the checkpoint
    root and read back, so the tests of all relations share one computation
    of cleaning, landing and marts (and lineage is cut at each layer)."""
    tests = Q.MODEL_TESTS if tests is None else tests
    names = {t.relation for t in tests} | {t.args["to"] for t in tests if "to" in t.args}
    raw_tables = {n.split(".", 1)[1] for n in names if n.startswith("raw.")}
    models_ = {n for n in names if "." not in n}
    raw_tables |= {t for m in models_ for t in jobs.MODEL_SOURCES[m]}
    need_landing = bool(names & {STREAM_TABLE, "fact_orders_realtime"})

    wh = jobs.Warehouse(work_dir(spark, "tested_warehouse"))
    land_t = wh.target(STREAM_TABLE)
    tasks = []
    if raw_tables:
        feeds_ = {t: feeds.RAW_FEEDS[t](spark, sf_dir) for t in raw_tables}
        tasks.append(lambda: jobs.run_batch(spark, feeds_, wh, tables=sorted(raw_tables)))
    if need_landing:
        tasks.append(lambda: sinks.write_table(landing(spark, sf_dir), land_t, "overwrite"))
    jobs.concurrently(tasks)
    land = sinks.read_table(spark, land_t) if need_landing else None
    rel = {f"raw.{k}": v for k, v in jobs.loaded_tables(spark, wh, sorted(raw_tables)).items()}
    if land is not None:
        rel[STREAM_TABLE] = land
    if models_:
        rel.update(jobs.run_models(spark, wh, land, only=models_))
    return rel


def _tests(kind: str):
    return [t for t in Q.MODEL_TESTS if t.test == kind]


def _test_query(kind: str):
    def q(spark, sf_dir):
        return Q.run_model_tests(relations(spark, sf_dir, _tests(kind)), _tests(kind))
    return q


for _kind in ("not_null", "unique", "accepted_values", "relationships", "accepted_range"):
    register(f"test_{_kind}", O.model_tests_sql(_tests(_kind)))(_test_query(_kind))


@register("test_suite_results", O.model_tests_sql(Q.MODEL_TESTS))
def test_suite_results(spark, sf_dir):
    """All 66 model tests over sources, staging and marts."""
    return Q.run_model_tests(relations(spark, sf_dir), Q.MODEL_TESTS)


@register("test_no_orphan_items", O.with_ctes(
    "SELECT order_id, order_item_id, product_id FROM stg_order_items AS item "
    "WHERE NOT EXISTS (SELECT 1 FROM stg_orders AS placed WHERE placed.order_id = item.order_id)",
    "stg_orders", "stg_order_items"))
def test_no_orphan_items(spark, sf_dir):
    """The singular test's failing rows: items without a staged order."""
    rel = relations(spark, sf_dir, _tests("no_orphan_items"))
    return Q.orphan_items(rel["stg_order_items"], rel["stg_orders"])


# ---- sources and sinks ----------------------------------------------------------------


@register("src_csv_scan", O.with_ctes("SELECT * FROM raw_customers", "raw_customers"))
def src_csv_scan(spark, sf_dir):
    """Land the customer feed as CSV text in one folder, half of it in files
    with more columns and in another order, and scan the declared ones back
    by each file's own header (blanks and empty strings preserved)."""
    path = work_dir(spark, "csv_customers")
    feed = feeds.raw_customers(spark, sf_dir)
    half = F.pmod(F.xxhash64("customer_id"), F.lit(2)) == 0
    wider = feed.select(F.lit("01310").alias("customer_zip_code_prefix"), *reversed(feed.columns), F.lit(1).alias("extra"))
    files.write_csv(feed.where(half), path)
    files.write_csv(wider.where(~half), path, "append")
    return files.read_csv(spark, path, RAW_CUSTOMERS)


@register("sink_overwrite", O.with_ctes("SELECT * FROM clean_customers", "clean_customers"))
def sink_overwrite(spark, sf_dir):
    """Full-refresh load written twice: the second overwrite replaces, never adds."""
    t = sinks.file_target("customers", work_dir(spark, "raw_customers"))
    df = C.clean_customers(feeds.raw_customers(spark, sf_dir))
    sinks.write_table(df, t, "overwrite")
    sinks.write_table(df, t, "overwrite")
    return sinks.read_table(spark, t)


@register("sink_multi_target", O.with_ctes(
    "SELECT 'parquet' AS target, * FROM clean_products UNION ALL "
    "SELECT 'orc' AS target, * FROM clean_products", "clean_products"))
def sink_multi_target(spark, sf_dir):
    """One cleaned frame, computed once, loaded into two targets that change
    together or not at all."""
    root = work_dir(spark, "multi_target")
    targets = [sinks.file_target("products", f"{root}/parquet", "parquet"),
               sinks.file_target("products_orc", f"{root}/orc", "orc")]
    sinks.write_together(C.clean_products(feeds.raw_products(spark, sf_dir)), targets, f"{root}/commits")
    a, b = sinks.read_together(spark, targets, f"{root}/commits")
    return (a.select(F.lit("parquet").alias("target"), "*")
             .unionByName(b.select(F.lit("orc").alias("target"), "*")))


@register("sink_insert_if_absent", O.insert_if_absent_sql(
    feeds.feed_sql(feeds.ORDERS_EXPRS, "orders"), feeds.feed_sql(feeds.ORDERS_COPY2_EXPRS, "orders")))
def sink_insert_if_absent(spark, sf_dir):
    """Target seeded with the delivered orders of the first export; the
    second export is inserted where the key is absent (existing rows keep
    their values)."""
    t = sinks.file_target("orders", work_dir(spark, "insert_if_absent"))
    seed = C.clean_orders(feeds.raw_orders(spark, sf_dir, copies=(1,))).filter(F.col("order_status") == "delivered")
    sinks.write_table(seed, t, "overwrite")
    sinks.append_if_absent(spark, C.clean_orders(feeds.raw_orders(spark, sf_dir, copies=(2,))), t, ["order_id"])
    return sinks.read_table(spark, t)


@register("stage_row_counts", O.STAGE_ROW_COUNTS)
def stage_row_counts(spark, sf_dir):
    """Rows per table as landed and after cleaning, both observed while the
    cleaned table is computed: one pass a table and no counting job."""
    raw = feeds.raw_feeds(spark, sf_dir)
    rows = F.count(F.lit(1)).alias("rows")

    def pass_over(name):
        landed, cleaned_ = Observation(), Observation()
        df = C.CLEANERS[name](raw[name].observe(landed, rows)).observe(cleaned_, rows)
        df.write.format("noop").mode("overwrite").save()
        return [(name, stage, o.get["rows"]) for stage, o in (("landed", landed), ("cleaned", cleaned_))]
    counts = jobs.concurrently([lambda n=n: pass_over(n) for n in ("orders", "customers", "products", "order_items")])
    return spark.createDataFrame([r for rs in counts for r in rs], "dataset string, stage string, row_count long")


# ---- Structured Streaming (run to completion with availableNow) ---------------------

STREAM_OUT = ["order_id", "customer_id", "product_id", "amount", "quantity", "total_value", "event_time"]


def _stream_to_files(df, spark, name):
    root = work_dir(spark, name)
    q = (df.writeStream.format("parquet").option("path", f"{root}/out")
           .option("checkpointLocation", f"{root}/_checkpoint")
           .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return spark.read.parquet(f"{root}/out")


def _ntz(df):
    return df.withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))


@register("stream_parse", O.STREAM_PARSE)
def stream_parse(spark, sf_dir):
    """Stateless streaming stage: bytes -> JSON -> flat order events."""
    out = _stream_to_files(_ntz(ING.parsed_stream(ING.events_source(spark, sf_dir))), spark, "stream_parse")
    return out.select(*STREAM_OUT)


@register("stream_dedup", O.STREAM_DEDUP)
def stream_dedup(spark, sf_dir):
    """Watermark + dedup within the watermark on the validity-tagged key."""
    plan = ING.deduplicated(ING.parsed_stream(ING.events_source(spark, sf_dir)))
    out = _stream_to_files(_ntz(plan), spark, "stream_dedup")
    return out.select(*STREAM_OUT)


def ingest_run(spark, sf_dir) -> ING.IngestSinks:
    root = work_dir(spark, "ingest")
    targets = ING.ingest_sinks(root)
    ING.run_available(ING.events_source(spark, sf_dir), targets, f"{root}/_checkpoint")
    return targets


@register("stream_ingest_valid", O.STREAM_LANDING)
def stream_ingest_valid(spark, sf_dir):
    """Landing table after the full foreachBatch ingest of the event stream."""
    t = ingest_run(spark, sf_dir)
    return sinks.read_table(spark, t.landing).select(*STREAM_OUT)


@register("stream_dead_letter", O.STREAM_DEAD)
def stream_dead_letter(spark, sf_dir):
    """Dead-letter table after the ingest: every rejected record, once."""
    t = ingest_run(spark, sf_dir)
    return sinks.read_table(spark, t.dead_letter).select(*STREAM_OUT, "reason")


@register("dlq_envelope", O.DLQ_ENVELOPE)
def dlq_envelope(spark, sf_dir):
    """Per-batch dead-letter envelope: batch id, reason, record count."""
    t = ingest_run(spark, sf_dir)
    dead = sinks.read_table(spark, t.dead_letter).withColumn("batch_id", F.col("batch_id").cast("bigint"))
    return sinks.dead_letter_envelopes(dead).select("batch_id", "reason", "record_count")


DOCUMENT_BYTES = 64 << 10   # of the registered query; the writer's default is larger


@register("dlq_documents", O.dlq_documents_sql(DOCUMENT_BYTES, DL.OVERHEAD))
def dlq_documents(spark, sf_dir):
    """Dead-letter documents of bounded size, written as files and read
    back: each with its records, told here by a digest of their payloads."""
    t = ingest_run(spark, sf_dir)
    path = work_dir(spark, "dead_letter_documents")
    DL.write_documents(sinks.read_table(spark, t.dead_letter), path, DOCUMENT_BYTES)
    docs = DL.read_documents(spark, path, "struct<raw_value: string>")
    payload = F.array_join(F.transform("records", lambda r: r["raw_value"]), "\n")
    return docs.select("batch_id", "reason", "part", "record_count", F.md5(payload).alias("payload_md5"))


@register("stream_late_drop", O.STREAM_LATE)
def stream_late_drop(spark, sf_dir):
    """The event stream in three waves with delayed and repeated deliveries:
    every message ends in exactly one of the landing, dead-letter, repeat
    and late tables."""
    root = work_dir(spark, "waves")
    targets = ING.ingest_sinks(root, arrivals=True)
    events = feeds.event_waves(feeds.read_table(spark, sf_dir, "events"))
    for wave in range(feeds.WAVES):
        feeds.order_messages(events.where(F.col("wave") == wave)).write.mode("append").parquet(f"{root}/messages")
        arriving = spark.readStream.schema("value binary").parquet(f"{root}/messages")
        ING.run_available(arriving, targets, f"{root}/_checkpoint")
    out = None
    for target, outcome in ((targets.landing, "landed"), (targets.dead_letter, "dead letter"),
                            (targets.repeats, "repeat"), (targets.late, "late")):
        rows = sinks.read_table(spark, target).select(
            "order_id", "customer_id", "product_id", "amount", "quantity", "event_time", F.lit(outcome).alias("outcome"))
        out = rows if out is None else out.unionByName(rows)
    return out


@register("fact_orders_realtime", O.REALTIME_NO_PT)
def fact_orders_realtime(spark, sf_dir):
    """Realtime mart over the streamed landing table (processing_time, a
    wall-clock stamp, is left out of the comparison)."""
    t = ingest_run(spark, sf_dir)
    mart = M.fact_orders_realtime(sinks.read_table(spark, t.landing))
    return mart.drop("processing_time")


def _rollup_query(every: str):
    def q(spark, sf_dir):
        """Closed windows of the landing table, added up as a stream."""
        t, root = ingest_run(spark, sf_dir), work_dir(spark, "rollup")
        run = RU.start_rollup(spark, t.landing, f"{root}/out", f"{root}/_checkpoint", every, trigger={"availableNow": True})
        run.awaitTermination()
        if run.exception() is not None:
            raise run.exception()
        return spark.read.parquet(f"{root}/out")
    return q


register("stream_rollup_hourly", O.rollup_sql("hour"))(_rollup_query(RU.HOURLY))
register("stream_rollup_daily", O.rollup_sql("day"))(_rollup_query(RU.DAILY))
