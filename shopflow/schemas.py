"""Explicit schemas: raw landed shape and cleaned (loaded) shape.

Raw CSV text is never type-inferred: an all-digit id column would come back
as an integer.  Raw files are read as declared here and cast during cleaning
with ``try_cast`` so bad text becomes NULL instead of failing the job.
"""

from pyspark.sql import types as T

S = T.StringType()

# --- raw, as landed (CSV text) -------------------------------------------
RAW_ORDERS = T.StructType([
    T.StructField("order_id", S),
    T.StructField("customer_id", S),
    T.StructField("order_status", S),
    T.StructField("order_purchase_timestamp", S),
    T.StructField("order_delivered_customer_date", S),
    T.StructField("order_estimated_delivery_date", S),
])

RAW_CUSTOMERS = T.StructType([
    T.StructField("customer_id", S),
    T.StructField("customer_unique_id", S),
    T.StructField("customer_city", S),
    T.StructField("customer_state", S),
])

RAW_PRODUCTS = T.StructType([
    T.StructField("product_id", S),
    T.StructField("product_category_name", S),
])

RAW_ORDER_ITEMS = T.StructType([
    T.StructField("order_id", S),
    T.StructField("order_item_id", T.IntegerType()),
    T.StructField("product_id", S),
    T.StructField("seller_id", S),
    T.StructField("price", T.DoubleType()),
    T.StructField("freight_value", S),
])

RAW = {
    "orders": RAW_ORDERS,
    "customers": RAW_CUSTOMERS,
    "products": RAW_PRODUCTS,
    "order_items": RAW_ORDER_ITEMS,
}

# --- lookups --------------------------------------------------------------
CATEGORY_TRANSLATION = T.StructType([
    T.StructField("product_category_name", S),
    T.StructField("product_category_name_english", S),
])

# --- order event stream ---------------------------------------------------
# JSON payload fields.  from_json makes every field nullable whatever the
# declared flag, so nullability is enforced by the validity predicate.
ORDER_EVENT = T.StructType([
    T.StructField("order_id", S),
    T.StructField("customer_id", S),
    T.StructField("product_id", S),
    T.StructField("amount", T.DoubleType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("event_time", S),
])

# Landing table of the stream (one row per accepted order event).
LANDING_COLUMNS = [
    "order_id", "customer_id", "product_id", "amount", "quantity",
    "total_value", "event_time", "processing_time",
]
