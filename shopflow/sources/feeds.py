"""Landed source feeds derived from the driver's TPC-H-style parquet tables.

The driver tables are clean (no NULLs, no orphans, unique keys), so the
feeds inject defects row by row with arithmetic that Spark SQL and DuckDB
evaluate alike.  Every feed covers its whole source table: defects are
``CASE`` expressions on each row, never a filter or a sample.

The expression text is shared: Spark applies it with ``selectExpr``; the
DuckDB oracle in ``plans/catalog.py`` embeds the very same text in CTEs.

Mapping (TPC-H-ish -> retail domain):

* orders      <- orders; every order is exported twice (at-least-once
                 export) and the second copy carries a status update for
                 some orders; ids are md5 hex strings like the real feed.
* customers   <- customer + nation (city) + region (state code).
* products    <- part (category = p_type).
* order_items <- lineitem (price = l_extendedprice, freight = l_tax as text).
* order events<- events, JSON-encoded as a message ``value``; some messages
                 are redelivered, some are not JSON at all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
                 "lineitem", "events")

# --- injected defects (fixed values; both engines evaluate them alike) -------
_STATUS = ("CASE WHEN o_orderkey % 89 = 0 THEN 'X' "
           "WHEN o_orderstatus = 'F' THEN 'delivered' "
           "WHEN o_orderstatus = 'O' THEN 'shipped' ELSE 'processing' END")

ORDERS_EXPRS = [
    ("order_id", "md5(concat('order-', cast(o_orderkey as string)))"),
    ("customer_id", "CASE WHEN o_orderkey % 97 = 0 THEN NULL "
                    "ELSE md5(concat('customer-', cast(o_custkey as string))) END"),
    ("order_status", _STATUS),
    ("order_purchase_timestamp", "CASE WHEN o_orderkey % 71 = 0 THEN 'not a timestamp' "
                                 "ELSE cast(o_orderdate as string) END"),
    ("order_delivered_customer_date", "CASE WHEN o_orderstatus = 'F' "
                                      "THEN cast(o_orderdate + INTERVAL '7' DAY as string) END"),
    ("order_estimated_delivery_date", "cast(o_orderdate + INTERVAL '14' DAY as string)"),
]
# second export of every order: a status update on some of them
ORDERS_COPY2_STATUS = f"CASE WHEN o_orderkey % 50 = 0 THEN 'created' ELSE {_STATUS} END"

CUSTOMERS_EXPRS = [
    ("customer_id", "md5(concat('customer-', cast(c_custkey as string)))"),
    ("customer_unique_id", "c_name"),
    ("customer_city", "CASE WHEN c_custkey % 7 = 0 THEN concat('  ', lower(n_name), ' ') "
                      "ELSE lower(n_name) END"),
    ("customer_state", "CASE WHEN c_custkey % 61 = 0 THEN lower(substr(r_name, 1, 2)) "
                       "ELSE upper(substr(r_name, 1, 2)) END"),
]

PRODUCTS_EXPRS = [
    ("product_id", "md5(concat('part-', cast(p_partkey as string)))"),
    ("product_category_name", "CASE WHEN p_partkey % 13 = 0 THEN NULL "
                              "WHEN p_partkey % 17 = 0 THEN '' ELSE lower(p_type) END"),
]

ORDER_ITEMS_EXPRS = [
    ("order_id", "md5(concat('order-', cast(CASE WHEN l_orderkey % 101 = 0 "
                 "THEN l_orderkey + 100000000 ELSE l_orderkey END as string)))"),
    ("order_item_id", "l_linenumber"),
    ("product_id", "md5(concat('part-', cast(l_partkey as string)))"),
    ("seller_id", "md5(concat('supplier-', cast(l_suppkey as string)))"),
    ("price", "CASE WHEN l_orderkey % 83 = 0 THEN -l_extendedprice ELSE l_extendedprice END"),
    ("freight_value", "CASE WHEN l_orderkey % 79 = 0 THEN 'n/a' ELSE cast(l_tax as string) END"),
]

# Order-event messages.  Field values (Spark and DuckDB text alike):
EVENT_FIELDS = [
    ("order_id", "concat('ORD-', cast(event_id as string))"),
    ("customer_id", "concat('C', cast(user_id as string))"),
    ("product_id", "concat('P-', event_type)"),
    ("amount", "CASE WHEN event_id % 47 = 0 THEN -value ELSE value END"),
]
# quantity comes from the props JSON; event_time is omitted on some messages
EVENT_NOT_JSON = "event_id % 53 = 0"
EVENT_NO_TIME = "event_id % 59 = 0"
EVENT_REDELIVERED = "event_id % 11 = 0"


# Waves of deliveries (ten days each): some events come a wave late, some come
# again in the next wave.
EVENT_DELAYED = "event_id % 41 = 0"
EVENT_AGAIN = "event_id % 43 = 0"
WAVES = 3


def _select(exprs) -> list[str]:
    return [f"{e} AS {a}" for a, e in exprs]


def feed_sql(exprs, source: str) -> str:
    """SQL text of a feed (used by the DuckDB oracle)."""
    return "SELECT " + ", ".join(_select(exprs)) + f" FROM {source}"


ORDERS_COPY2_EXPRS = [(a, ORDERS_COPY2_STATUS if a == "order_status" else e) for a, e in ORDERS_EXPRS]
CUSTOMER_SOURCE = ("customer JOIN nation ON c_nationkey = n_nationkey "
                   "JOIN region ON n_regionkey = r_regionkey")

ORACLE_FEEDS = {
    "raw_orders": f"{feed_sql(ORDERS_EXPRS, 'orders')} UNION ALL {feed_sql(ORDERS_COPY2_EXPRS, 'orders')}",
    "raw_customers": feed_sql(CUSTOMERS_EXPRS, CUSTOMER_SOURCE),
    "raw_products": feed_sql(PRODUCTS_EXPRS, "part"),
    "raw_order_items": feed_sql(ORDER_ITEMS_EXPRS, "lineitem"),
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_orders(spark: SparkSession, sf_dir: str, copies=(1, 2)) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    parts = []
    if 1 in copies:
        parts.append(o.selectExpr(*_select(ORDERS_EXPRS)))
    if 2 in copies:
        parts.append(o.selectExpr(*_select(ORDERS_COPY2_EXPRS)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    n = read_table(spark, sf_dir, "nation")
    r = read_table(spark, sf_dir, "region")
    # nation/region are fixed-size dimensions (25 and 5 rows by definition)
    return (c.join(n, c.c_nationkey == n.n_nationkey)
             .join(r, n.n_regionkey == r.r_regionkey)
             .selectExpr(*_select(CUSTOMERS_EXPRS)))


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "part").selectExpr(*_select(PRODUCTS_EXPRS))


def raw_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "lineitem").selectExpr(*_select(ORDER_ITEMS_EXPRS))


RAW_FEEDS = {
    "orders": raw_orders,
    "customers": raw_customers,
    "products": raw_products,
    "order_items": raw_order_items,
}


def raw_feeds(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: fn(spark, sf_dir) for name, fn in RAW_FEEDS.items()}


def order_messages(events: DataFrame) -> DataFrame:
    """Events -> message rows ``(value: binary)`` as a broker would deliver
    them.  Works on a batch or a streaming DataFrame (no state, no shuffle).

    Some messages are delivered twice (at-least-once producer), some are not
    JSON, some lack ``event_time``; quantity is the ``k`` of ``props``.
    """
    fields = [(a, F.expr(e)) for a, e in EVENT_FIELDS]
    fields.append(("quantity", F.get_json_object("props", "$.k").cast("int")))
    fields.append(("event_time", F.when(F.expr(EVENT_NO_TIME), F.lit(None)).otherwise(
        F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00")))))
    body = F.to_json(F.named_struct(*[x for a, c in fields for x in (F.lit(a), c)]))
    text = (F.when(F.expr(EVENT_NOT_JSON),
                   F.concat(F.lit("not json: ORD-"), F.col("event_id").cast("string")))
             .otherwise(body))
    attempts = F.when(F.expr(EVENT_REDELIVERED), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return (events
            .select(text.cast("binary").alias("value"), F.explode(attempts).alias("delivery_attempt"))
            .select("value"))


def event_waves(events: DataFrame) -> DataFrame:
    """The events with the ``wave`` of each of their deliveries."""
    own = F.least(F.lit(WAVES - 1), F.floor((F.dayofmonth("ts") - 1) / 10))
    first = (own + F.when(F.expr(EVENT_DELAYED) & (own < WAVES - 1), 1).otherwise(0)).cast("int")
    waves = F.when(F.expr(EVENT_AGAIN) & (first < WAVES - 1), F.array(first, first + 1)).otherwise(F.array(first))
    return events.withColumn("wave", F.explode(waves))
