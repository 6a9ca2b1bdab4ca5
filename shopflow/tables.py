"""Logical table registry, schema routing and namespace creation.

A relation is addressed as ``<schema>.<name>``.  A model that names its own
schema keeps it verbatim (it is not prefixed by the target schema); a model
with none lands in the target's default schema.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession

NAMESPACES = ("raw", "staging", "analytics", "streaming")

# Source (raw) tables keyed by logical name.
RAW_TABLES = {
    "orders": "raw.orders",
    "customers": "raw.customers",
    "products": "raw.products",
    "order_items": "raw.order_items",
}

STREAM_TABLE = "streaming.raw_orders_stream"

STAGING_MODELS = ("stg_orders", "stg_customers", "stg_products", "stg_order_items")
MART_MODELS = ("fact_orders", "dim_customers", "dim_products", "fact_orders_realtime")


def schema_name(custom_schema: str | None, default_schema: str) -> str:
    """Custom schema used verbatim (trimmed); otherwise the default."""
    if custom_schema is None:
        return default_schema
    return custom_schema.strip()


def qualified(name: str, custom_schema: str | None = None, default_schema: str = "analytics") -> str:
    return f"{schema_name(custom_schema, default_schema)}.{name}"


def model_schema(model: str) -> str:
    return "staging" if model.startswith("stg_") else "analytics"


def create_namespaces(spark: SparkSession, names=NAMESPACES) -> None:
    for ns in names:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {ns}")


@dataclass(frozen=True)
class SourcePaths:
    """Where the four landed source files live (CSV or parquet)."""

    orders: str
    customers: str
    products: str
    order_items: str
    fmt: str = "csv"

    def path(self, name: str) -> str:
        return getattr(self, name)
