"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every shopflow job relies on.  Time zone is fixed to UTC so that
# timestamp parsing and truncation give the same wall-clock values everywhere.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app: str = "shopflow", extra: dict | None = None) -> SparkSession:
    """Local/test session.  On a cluster the session is supplied by the
    launcher and only :func:`configure` is applied to it."""
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime (non-static) settings to an existing session."""
    for k, v in BASE_CONF.items():
        if k.startswith("spark.ui."):
            continue
        try:
            spark.conf.set(k, v)
        except Exception:  # static conf on a shared session: keep what is set
            pass
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A cluster must name it; only a local master (tests) may leave it unset,
    and then a private folder is created and registered, so ``DataFrame.checkpoint()`` and
    every table written by shopflow land in the same place.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext on the client
        sc = None
    root = sc.getCheckpointDir() if sc is not None else None
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the whole cluster shares")
        root = tempfile.mkdtemp(prefix="shopflow-ckpt-")
        if sc is not None:
            sc.setCheckpointDir(root)
            root = sc.getCheckpointDir() or root
    return root


_made: list[str] = []   # work folders of this process, oldest first


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the checkpoint root for one run of ``name``."""
    path = os.path.join(checkpoint_root(spark), "shopflow", f"{name}-{uuid.uuid4().hex[:12]}")
    _made.append(path)
    return path


def remove_work(spark: SparkSession) -> int:
    """Delete the work folders made so far by this process, through the store
    they live in.  Results that still read from them are gone with them, so
    call it when those are written or no longer needed."""
    gone = 0
    while _made:
        p = spark._jvm.org.apache.hadoop.fs.Path(_made.pop())
        gone += bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True))
    return gone


def size_shuffles(spark: SparkSession, shuffle_bytes: int, target_bytes: int = 128 * 1024 * 1024,
                  min_partitions: int = 200) -> int:
    """Start shuffles with enough partitions for ``shuffle_bytes`` of data at
    about ``target_bytes`` each, and let AQE coalesce the small ones.

    AQE can merge partitions after a stage but cannot split an oversized one
    outside a join, so the initial count must follow the data volume (at
    100 TB of shuffle input that is about 820,000 partitions).  Set
    it before a batch job; a streaming query keeps the count its checkpoint
    was started with.
    """
    n = max(min_partitions, -(-int(shuffle_bytes) // int(target_bytes)))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(int(target_bytes)))
    return n
