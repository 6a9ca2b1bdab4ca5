import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from shopflow.session import build_session
    s = build_session(master="local[*]", shuffle_partitions=8, app="shopflow-tests",
                      extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="shopflow-test-wh-")})
    # tests own their checkpoint folder; a cluster names a shared one instead
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="shopflow-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp(spark):
    """A fresh folder under the session's checkpoint root, as a plain local
    path (tests write fixture files with ``os``; local mode only)."""
    from shopflow.session import work_dir
    path = work_dir(spark, "test")
    return path[len("file:"):] if path.startswith("file:") else path


# ---- seed rows (the bootstrap rows the warehouse ships with) ----------------
# Transcribed as data, they must equal the shipped seed rows.
SEED_CUSTOMERS = [
    ("cust_001", "uniq_001", "sao paulo", "SP"),
    ("cust_002", "uniq_002", "rio de janeiro", "RJ"),
    ("cust_003", "uniq_003", "belo horizonte", "MG"),
]
SEED_PRODUCTS = [("prod_001", "electronics"), ("prod_002", "furniture"), ("prod_003", "toys")]
SEED_ORDERS = [
    ("ord_001", "cust_001", "delivered", "2024-01-15 10:30:00", "2024-01-20 14:00:00", "2024-01-22 00:00:00"),
    ("ord_002", "cust_002", "shipped", "2024-01-16 11:00:00", None, "2024-01-25 00:00:00"),
    ("ord_003", "cust_003", "processing", "2024-01-17 09:15:00", None, "2024-01-28 00:00:00"),
]
SEED_ITEMS = [
    ("ord_001", 1, "prod_001", "seller_001", 199.90, "15.50"),
    ("ord_001", 2, "prod_002", "seller_002", 349.00, "25.00"),
    ("ord_002", 1, "prod_003", "seller_001", 59.90, "8.75"),
    ("ord_003", 1, "prod_001", "seller_003", 199.90, "12.00"),
]
SEED_STREAM = [
    ("stream_001", "cust_001", "prod_001", 99.90, 2, 199.80, "2024-01-15 10:30:00", "2024-01-15 10:30:05"),
    ("stream_002", "cust_002", "prod_002", 49.50, 1, 49.50, "2024-01-15 11:00:00", "2024-01-15 11:00:03"),
]


@pytest.fixture()
def seed(spark):
    from shopflow import schemas
    return {
        "customers": spark.createDataFrame(SEED_CUSTOMERS, schemas.RAW_CUSTOMERS),
        "products": spark.createDataFrame(SEED_PRODUCTS, schemas.RAW_PRODUCTS),
        "orders": spark.createDataFrame(SEED_ORDERS, schemas.RAW_ORDERS),
        "order_items": spark.createDataFrame(SEED_ITEMS, schemas.RAW_ORDER_ITEMS),
    }


@pytest.fixture()
def seed_landing(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(
        SEED_STREAM,
        "order_id string, customer_id string, product_id string, amount double, quantity int, "
        "total_value double, event_time string, processing_time string")
    return (df.withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))
              .withColumn("processing_time", F.col("processing_time").cast("timestamp")))


def plan_text(df, mode="formatted") -> str:
    """The physical plan as printed by ``DataFrame.explain``."""
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()
