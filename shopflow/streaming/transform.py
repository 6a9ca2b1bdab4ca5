"""Stateless order-event transforms shared by the stream and batch jobs.

``parse_orders`` works on any DataFrame with a binary/string ``value``
column, streaming or not, so the batch oracle and the live stream run the
very same plan fragment.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopflow.functions.expressions import is_valid_event, money_product, to_event_time
from shopflow.operators.clean import dedup_keep_first
from shopflow.schemas import LANDING_COLUMNS, ORDER_EVENT

PAYLOAD_FIELDS = ["order_id", "customer_id", "product_id", "amount", "quantity", "event_time"]


def parse_orders(messages: DataFrame) -> DataFrame:
    """bytes -> text -> JSON struct -> flat columns, plus derived fields.

    Malformed text yields NULL fields (PERMISSIVE), a wrong-typed field is
    NULL on its own, unknown fields are ignored.  The raw text is kept so a
    rejected record can be replayed from the dead-letter table.
    """
    text = F.col("value").cast("string")
    # where the message came from (Kafka: topic:partition:offset), if known
    position = (F.concat_ws(":", "topic", F.col("partition").cast("string"), F.col("offset").cast("string"))
                if {"topic", "partition", "offset"} <= set(messages.columns)
                else F.lit(None).cast("string"))
    # The fields come out of a generator (one row per message, all-NULL for
    # text that is not JSON): filters on them cannot be pushed beneath it,
    # so each message is parsed exactly once instead of once per field a
    # later predicate reads.
    return (messages
            .select(text.alias("raw_value"), position.alias("source_position"),
                    F.inline(F.array(F.from_json(text, ORDER_EVENT))))
            .select("raw_value", "source_position", *PAYLOAD_FIELDS)
            .withColumn("event_time", to_event_time(F.col("event_time")))
            .withColumn("total_value", money_product(F.col("amount"), F.col("quantity")))
            .withColumn("processing_time", F.current_timestamp()))


def valid_flag() -> Column:
    return is_valid_event()


def dedup_key() -> Column:
    """State key of the stream dedup: valid rows by order id; invalid rows
    by a hash of their raw text, so malformed records neither collide with
    one another nor block a later corrected record of the same order."""
    # a NULL payload has no text to hash: its position in the source names it
    raw_hash = F.coalesce(F.sha2(F.col("raw_value"), 256), F.col("source_position"),
                          F.lit("null-payload"))
    return F.when(valid_flag(), F.concat(F.lit("v:"), F.col("order_id"))) \
            .otherwise(F.concat(F.lit("x:"), raw_hash))


def split_valid(batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid): complementary NULL-safe filters over one input —
    every row lands on exactly one side, duplicates included, no shuffle."""
    flag = valid_flag()
    return batch.filter(flag), batch.filter(~flag)


def to_landing(valid: DataFrame) -> DataFrame:
    """Landing-table shape: event time stored zone-less (UTC wall clock)."""
    return (valid.withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))
                 .select(*LANDING_COLUMNS))


def batch_landing(messages: DataFrame) -> DataFrame:
    """Batch equivalent of the streaming ingest: parse, keep valid rows,
    one row per order id."""
    valid, _ = split_valid(parse_orders(messages))
    landed = to_landing(valid)
    return dedup_keep_first(landed, ["order_id"],
                            order_by=["event_time", "customer_id", "product_id", "amount", "quantity"])
