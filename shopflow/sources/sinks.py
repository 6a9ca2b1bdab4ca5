"""Sinks: file/catalog/JDBC/BigQuery targets, overwrite and append loads,
insert-if-absent, multi-target loads and the dead-letter table.

Every load is a distributed write from the executors; the driver only sees
metrics gathered with ``DataFrame.observe`` during that same write (no
extra counting job).
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shopflow.operators.clean import dedup_keep_first


@dataclass(frozen=True)
class Target:
    """Where a table goes.  ``location`` is a path for file formats, a
    table name for ``catalog``/``jdbc``/``bigquery``."""

    name: str
    format: str = "parquet"
    location: str = ""
    options: dict = field(default_factory=dict, hash=False)
    partition_by: tuple[str, ...] = ()
    schema: StructType | None = field(default=None, hash=False, compare=False)

    def at(self, location: str) -> "Target":
        return replace(self, location=location)


def file_target(name: str, path: str, fmt: str = "parquet", partition_by=(), schema=None,
                **options) -> Target:
    return Target(name, fmt, path, dict(options), tuple(partition_by), schema)


def catalog_target(name: str, table: str, fmt: str = "parquet", partition_by=()) -> Target:
    return Target(name, "catalog", table, {"format": fmt}, tuple(partition_by))


def jdbc_target(name: str, url: str, table: str, user: str | None = None, password: str | None = None,
                driver: str | None = None, batchsize: int = 10000,
                num_partitions: int | None = None) -> Target:
    """JDBC table.  An overwrite keeps the target's DDL (keys, NOT NULL) by
    truncating instead of dropping; ``numPartitions`` bounds the number of
    concurrent connections opened by the executors."""
    opts = {"url": url, "dbtable": table, "batchsize": str(batchsize)}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver is not None:
        opts["driver"] = driver
    if num_partitions is not None:
        opts["numPartitions"] = str(num_partitions)
    return Target(name, "jdbc", table, opts)


def bigquery_target(name: str, project: str, dataset: str, table: str, **extra) -> Target:
    """BigQuery table written with the direct (storage write API) method.
    Needs the BigQuery connector on the classpath at write time."""
    opts = {"table": f"{project}.{dataset}.{table}", "writeMethod": "direct"}
    opts.update(extra)
    return Target(name, "bigquery", f"{project}.{dataset}.{table}", opts)


def _rebalanced(df: DataFrame, target: Target) -> DataFrame:
    """Without this every task writes one file per partition value it holds
    (tasks x values small files).  REBALANCE groups rows by the partition
    columns into reasonably sized partitions, and AQE splits a value that is
    too big (a table that is all one date) across tasks.  It needs AQE:
    inside a streaming micro-batch (AQE off) the hint is a no-op and each
    task writes its own files."""
    if target.partition_by and target.format not in ("jdbc", "bigquery"):
        return df.hint("rebalance", *target.partition_by)
    return df


def writer(df: DataFrame, target: Target, mode: str):
    w = df.write.mode(mode)
    if target.format == "jdbc":
        opts = dict(target.options)
        if mode == "overwrite":
            opts["truncate"] = "true"
        return w.format("jdbc").options(**opts)
    if target.format == "catalog":
        w = w.format(target.options.get("format", "parquet"))
    else:
        w = w.format(target.format).options(**target.options)
    if target.partition_by:
        w = w.partitionBy(*target.partition_by)
    return w


def _save(df: DataFrame, target: Target, mode: str) -> None:
    w = writer(df, target, mode)
    if target.format == "catalog":
        w.saveAsTable(target.location)
    elif target.format in ("jdbc",):
        w.save()
    else:
        w.save(target.location)


def write_table(df: DataFrame, target: Target, mode: str = "overwrite") -> dict:
    """Write ``df`` and return the row count observed during the write."""
    obs = Observation(f"load_{target.name}_{uuid.uuid4().hex[:8]}")
    # metrics are collected above the rebalance, so they survive AQE
    # replacing an empty input below it
    _save(_rebalanced(df, target).observe(obs, F.count(F.lit(1)).alias("rows")), target, mode)
    return {"target": target.name, "rows": obs.get.get("rows", 0)}


def read_table(spark: SparkSession, target: Target) -> DataFrame:
    if target.format == "catalog":
        return spark.table(target.location)
    if target.format == "jdbc":
        return spark.read.format("jdbc").options(**target.options).load()
    r = spark.read.format(target.format).options(**target.options)
    if target.schema is not None:
        r = r.schema(target.schema)
    return r.load(target.location)


def exists(spark: SparkSession, target: Target) -> bool:
    """Whether the target can be read yet (metadata only, no data job)."""
    if target.format == "catalog":
        return spark.catalog.tableExists(target.location)
    if target.format in ("jdbc", "bigquery"):
        return True
    # a path without a scheme is in the cluster's default file system
    path = spark._jvm.org.apache.hadoop.fs.Path(target.location)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def ensure_exists(spark: SparkSession, target: Target) -> None:
    """Create an empty table with the target's schema if it is missing, so
    later readers (e.g. the per-batch key check) never meet a missing path."""
    if target.schema is None or exists(spark, target):
        return
    _save(spark.createDataFrame([], target.schema), target, "append")


def swap(spark: SparkSession, fresh: str, old: str) -> None:
    """Put the folder ``fresh`` in the place of ``old``, which is deleted."""
    paths = [spark._jvm.org.apache.hadoop.fs.Path(p) for p in (fresh, old, f"{old}_replaced")]
    fs = paths[0].getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(paths[1]):
        fs.rename(paths[1], paths[2])
    fs.rename(paths[0], paths[1])
    fs.delete(paths[2], True)


def _keeps_types(target: Target) -> bool:
    return target.format in ("parquet", "orc", "catalog")


def write_all(df: DataFrame, targets: list[Target], mode: str = "overwrite") -> list[dict]:
    """Load one cleaned frame into several targets, computed once: the later
    targets are copies of what the first now holds, read back from it.  Only
    where the first has no types of its own (text, a database) or is appended
    to is the frame kept for the time of the load."""
    spark = df.sparkSession
    if mode == "overwrite" and _keeps_types(targets[0]):
        first = write_table(df, targets[0], mode)
        source = read_table(spark, targets[0])
        return [first, *[write_table(source, t, mode) for t in targets[1:]]]
    cached = df.persist()
    try:
        return [write_table(cached, t, mode) for t in targets]
    finally:
        cached.unpersist()


# ---- all-or-nothing loads of several targets ---------------------------------

def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def commits(spark: SparkSession, manifests: str) -> list[str]:
    """Names of the commits of a load, oldest first."""
    fs, path = _fs(spark, manifests)
    if not fs.exists(path):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    return sorted(n for n in names if n.isdigit())


def write_together(df: DataFrame, targets: list[Target], manifests: str) -> dict:
    """Replace the contents of several file targets as one.

    Each target's new contents go into a folder of their own below its
    location; the first is written from ``df`` and the others are copies of
    it.  When all are there, one small manifest names the folders, and it
    appears by a rename: readers (:func:`read_together`) see the old contents
    of all targets or the new contents of all.  A load that fails leaves the
    last commit as it was."""
    spark = df.sparkSession
    if any(t.format in ("jdbc", "bigquery", "catalog") for t in targets) or not _keeps_types(targets[0]):
        raise ValueError("an all-or-nothing load takes file targets, the first with types of its own")
    version = uuid.uuid4().hex[:12]
    staged = [t.at(f"{t.location}/{version}") for t in targets]
    loads = [write_table(df, staged[0], "errorifexists")]
    source = read_table(spark, staged[0])
    loads += [write_table(source, t, "errorifexists") for t in staged[1:]]
    done = commits(spark, manifests)
    name = f"{int(done[-1]) + 1 if done else 1:012d}"
    fs, draft = _fs(spark, f"{manifests}/_{version}")
    spark.createDataFrame([(t.name, s.location) for t, s in zip(targets, staged, strict=True)],
                          "name string, location string").coalesce(1).write.json(draft.toString())
    final = spark._jvm.org.apache.hadoop.fs.Path(f"{manifests}/{name}")
    if fs.exists(final) or not fs.rename(draft, final):
        raise RuntimeError(f"another load has committed {name}")
    return {"commit": name, "loads": loads}


def committed(spark: SparkSession, manifests: str, commit: str | None = None) -> dict[str, str]:
    """Target name -> folder, of a commit (default: the last)."""
    done = commits(spark, manifests)
    if not done:
        return {}
    rows = spark.read.schema("name string, location string").json(f"{manifests}/{commit or done[-1]}").collect()
    return {r["name"]: r["location"] for r in rows}


def read_together(spark: SparkSession, targets: list[Target], manifests: str) -> list[DataFrame]:
    """The targets as the last commit left them, all of one commit."""
    where = committed(spark, manifests)
    return [read_table(spark, t.at(where[t.name])) for t in targets]


def forget_old(spark: SparkSession, targets: list[Target], manifests: str, keep: int = 2) -> int:
    """Delete the folders that none of the last ``keep`` commits names (those
    of older commits and of failed loads).  Not while a load runs."""
    named = {p for c in commits(spark, manifests)[-keep:] for p in committed(spark, manifests, c).values()}
    names = {p.rstrip("/").rsplit("/", 1)[-1] for p in named}
    gone = 0
    for t in targets:
        fs, path = _fs(spark, t.location)
        for s in fs.listStatus(path) if fs.exists(path) else []:
            if s.getPath().getName() not in names:
                fs.delete(s.getPath(), True)
                gone += 1
    return gone


def insert_if_absent(new: DataFrame, existing: DataFrame | None, keys: list[str],
                     dedup: bool = True) -> DataFrame:
    """Rows of ``new`` whose key is not in ``existing`` (INSERT ... ON
    CONFLICT DO NOTHING).  Keys repeated inside ``new`` keep their first row."""
    rows = dedup_keep_first(new, keys) if dedup else new
    if existing is None:
        return rows
    return rows.join(existing.select(*keys), keys, "left_anti")


def append_if_absent(spark: SparkSession, new: DataFrame, target: Target, keys: list[str],
                     prune_by: str | None = None, dedup: bool = True,
                     target_exists: bool | None = None, bounds: tuple | None = None,
                     layout=None) -> dict:
    """Idempotent append: a replayed batch adds nothing.

    ``prune_by`` names a partition column of the target: only the
    partitions between the batch's min and max value are read for the key
    check (two scalars reach the driver; pass them as ``bounds`` when
    already known), so the check does not rescan a table that keeps
    growing.  ``layout`` may re-partition the rows to write.
    """
    if target_exists is None:
        target_exists = exists(spark, target)
    existing = read_table(spark, target) if target_exists else None
    if existing is not None and prune_by:
        lo, hi = bounds if bounds is not None else new.agg(F.min(prune_by), F.max(prune_by)).first()
        if lo is None:
            existing = None
        else:
            existing = existing.filter(F.col(prune_by).between(lo, hi))
    rows = insert_if_absent(new, existing, keys, dedup)
    if layout is not None:
        rows = layout(rows)
    return write_table(rows, target, "append")


def write_dead_letters(bad: DataFrame, target: Target, batch_id: int, reason: str) -> dict:
    """Rejected records of one micro-batch, one row each, raw payload kept.

    Partitioned by ``batch_id`` with dynamic partition overwrite: a replay of
    the same batch id rewrites its own partition instead of adding a copy.
    """
    rows = (bad.withColumn("reason", F.lit(reason))
               .withColumn("captured_at", F.current_timestamp())
               .withColumn("batch_id", F.lit(int(batch_id)).cast("bigint")))
    t = target if target.partition_by else replace(target, partition_by=("batch_id",))
    # per-write option: other (full-refresh) overwrites keep static semantics
    t = replace(t, options={**t.options, "partitionOverwriteMode": "dynamic"})
    return write_table(rows, t, "overwrite")


def dead_letter_envelopes(dead: DataFrame) -> DataFrame:
    """One summary row per (batch_id, reason): record count and capture time.
    The records themselves stay one row each in the dead-letter table (an
    envelope holding every record would put a whole batch in one row)."""
    return (dead.groupBy("batch_id", "reason")
                .agg(F.count(F.lit(1)).alias("record_count"),
                     F.max("captured_at").alias("captured_at")))
