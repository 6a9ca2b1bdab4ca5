"""Staging views and marts as functions of their upstream DataFrames.

A model's upstream relations are its arguments (``ref``/``source`` become
function composition), so the whole graph is one lazy plan that Catalyst
optimises end to end: staging filters are pushed through the mart join into
the scans and unused columns are pruned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopflow.functions.expressions import hour_of, pack_ids, packed_id, text_columns, unpack_ids
from shopflow.operators.clean import dedup_keep_first
from shopflow.operators.hot_keys import salted_join

# --- staging (materialised as views) --------------------------------------

# Per view its raw table, the columns that must be there, and
# output column -> raw column.
STAGING = {
    "stg_orders": ("orders", ("order_id",), {
        "order_id": "order_id", "customer_id": "customer_id", "order_status": "order_status",
        "purchase_timestamp": "order_purchase_timestamp",
        "delivered_timestamp": "order_delivered_customer_date",
        "estimated_delivery_timestamp": "order_estimated_delivery_date"}),
    "stg_customers": ("customers", ("customer_id",), {
        "customer_id": "customer_id", "customer_unique_id": "customer_unique_id",
        "customer_city": "customer_city", "customer_state": "customer_state"}),
    "stg_products": ("products", ("product_id",), {
        "product_id": "product_id", "product_category": "product_category_name"}),
    "stg_order_items": ("order_items", ("order_id", "product_id"), {
        "order_id": "order_id", "order_item_id": "order_item_id", "product_id": "product_id",
        "seller_id": "seller_id", "price": "price", "freight_value": "freight_value"}),
}


def staged(name: str, raw: DataFrame) -> DataFrame:
    """A staging view over its raw table."""
    _, required, columns = STAGING[name]
    return raw.dropna(how="any", subset=list(required)).select(
        *[F.col(c).alias(out) for out, c in columns.items()])


def staging_sql(name: str, relation: str) -> str:
    """The same as a statement over a named relation (a catalog view keeps
    text, not a plan)."""
    _, required, columns = STAGING[name]
    return (f"SELECT {', '.join(f'{c} AS {out}' for out, c in columns.items())} FROM {relation} "
            f"WHERE {' AND '.join(f'{c} IS NOT NULL' for c in required)}")


# --- marts (materialised as tables) ----------------------------------------


def fact_orders(stg_orders_df: DataFrame, stg_order_items_df: DataFrame, hot: list = (),
                packed: bool = False) -> DataFrame:
    """Line-item grain fact: items inner-join their order.

    Both sides are large at scale, so no broadcast hint: the planner uses
    the runtime sizes (AQE) to pick broadcast vs sort-merge, and AQE's skew
    join splits a hot order_id on the item side where both sides are plain
    shuffles.  Where they are not (a side that is already partitioned by its
    dedup), ``hot`` names the orders whose items are to be spread.
    ``packed``: the ids cross the join's shuffles as bytes, which pays where
    both sides are read from tables.
    """
    o = stg_orders_df.select("order_id", "customer_id", "purchase_timestamp")
    oi = stg_order_items_df.select("order_id", "product_id", "price", "freight_value")
    ids = text_columns(o, ["order_id"]) and text_columns(oi, ["order_id"]) if packed else []
    if ids:
        own = text_columns(o, ["customer_id"]), text_columns(oi, ["product_id"])
        o, oi = pack_ids(o, ids + own[0]), pack_ids(oi, ids + own[1])
        hot, ids = [packed_id(F.lit(h)) for h in hot], ids + own[0] + own[1]
    return (unpack_ids(salted_join(oi, o, "order_id", list(hot)), ids)
              .select("order_id", "customer_id", "product_id", "price",
                      "freight_value", "purchase_timestamp"))


def dim_customers(stg_customers_df: DataFrame) -> DataFrame:
    return stg_customers_df.select("customer_id", "customer_city", "customer_state").distinct()


def dim_products(stg_products_df: DataFrame) -> DataFrame:
    return stg_products_df.select("product_id", "product_category").distinct()


LOOKUP_ROWS = 100_000   # a lookup of up to so many rows is sent to every task


def translated(df: DataFrame, column: str, lookup: DataFrame, found: str, out: str) -> DataFrame:
    """``df`` with ``out``: the ``found`` column of the lookup row with the
    same ``column``, or ``unknown``.  A name that the lookup holds twice has
    its first translation, so no row of ``df`` is multiplied; the lookup is
    broadcast only where its counted size allows."""
    names = dedup_keep_first(lookup.select(column, F.col(found).alias(out)).where(F.col(column).isNotNull()), [column])
    if names.count() <= LOOKUP_ROWS:
        names = F.broadcast(names)
    return df.join(names, column, "left").select(*df.columns, F.coalesce(F.col(out), F.lit("unknown")).alias(out))


def dim_products_translated(dim: DataFrame, lookup: DataFrame) -> DataFrame:
    """The product dimension with its category in English."""
    names = lookup.withColumnRenamed("product_category_name", "product_category")
    return translated(dim, "product_category", names, "product_category_name_english", "product_category_english")


def fact_orders_realtime(landing: DataFrame) -> DataFrame:
    """Realtime fact over the stream's landing table, with day and hour."""
    et = F.col("event_time")
    return (landing
            .filter(F.col("order_id").isNotNull())
            .select("order_id", "customer_id", "product_id", "amount", "quantity",
                    "total_value", "event_time", "processing_time",
                    F.to_date(et).alias("order_date"),
                    hour_of(et).alias("order_hour")))


def build_models(raw: dict[str, DataFrame], landing: DataFrame | None = None,
                 only=None, hot: list = (), packed: bool = False) -> dict[str, DataFrame]:
    """Models from the raw (loaded) tables and the landing table; ``only``
    names a subset (their upstream staging models are built as needed);
    ``hot``, ``packed``: see :func:`fact_orders`."""
    want = set(only) if only is not None else None

    def wanted(*names):
        return want is None or any(n in want for n in names)

    m = {name: staged(name, raw[src]) for name, (src, _, _) in STAGING.items()
         if src in raw and wanted(name, *DOWNSTREAM.get(name, ()))}
    if wanted("fact_orders"):
        m["fact_orders"] = fact_orders(m["stg_orders"], m["stg_order_items"], hot, packed)
    if wanted("dim_customers"):
        m["dim_customers"] = dim_customers(m["stg_customers"])
    if wanted("dim_products"):
        m["dim_products"] = dim_products(m["stg_products"])
    if landing is not None and wanted("fact_orders_realtime"):
        m["fact_orders_realtime"] = fact_orders_realtime(landing)
    if want is not None:
        m = {k: v for k, v in m.items() if k in want}
    return m


DOWNSTREAM = {
    "stg_orders": ("fact_orders",), "stg_order_items": ("fact_orders",),
    "stg_customers": ("dim_customers",), "stg_products": ("dim_products",),
}
