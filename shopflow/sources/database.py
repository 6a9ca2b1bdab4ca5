"""Conditional append into a database table.

The executors write a batch into a staging table; one transaction on the
driver's connection then moves the rows whose key is not there yet and
records the batch in a ledger.  No key is read back into Spark, and nothing
but statements passes through the driver.

A batch that the ledger knows is a no-op.  A batch that failed half way is
not in the ledger: its staging rows are replaced, and the move finds the keys
that it must leave out.  A task that ran twice has written the same rows
twice; the move takes them once.
"""

from __future__ import annotations

import contextlib
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopflow.sources import sinks

LEDGER = "shopflow_batches"
STAGING = "_staging"
_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*)*$")


def _name(text: str) -> str:
    """Identifiers go into statements as text, so only plain ones do."""
    if not _NAME.match(text):
        raise ValueError(f"not a plain identifier: {text!r}")
    return text


@contextlib.contextmanager
def connection(spark: SparkSession, target: sinks.Target):
    """A connection of the driver by the target's own driver class, which may
    have come with ``spark.jars``.  Commits at the end, rolls back on error."""
    jvm, o = spark._jvm, target.options
    properties = jvm.java.util.Properties()
    for k in ("user", "password"):
        if k in o:
            properties.setProperty(k, o[k])
    if "driver" in o:
        loader = jvm.java.lang.Thread.currentThread().getContextClassLoader()
        made = loader.loadClass(o["driver"]).newInstance()
        con = made.connect(o["url"], properties)
    else:
        con = jvm.java.sql.DriverManager.getConnection(o["url"], properties)
    con.setAutoCommit(False)
    try:
        yield con
        con.commit()
    except BaseException:
        con.rollback()
        raise
    finally:
        con.close()


def _run(con, sql: str, *values) -> int:
    st = con.prepareStatement(sql)
    try:
        for i, v in enumerate(values, 1):
            st.setLong(i, v) if isinstance(v, int) else st.setString(i, v)
        return st.executeUpdate()
    finally:
        st.close()


def _any(con, sql: str, *values) -> bool:
    st = con.prepareStatement(sql)
    try:
        for i, v in enumerate(values, 1):
            st.setLong(i, v) if isinstance(v, int) else st.setString(i, v)
        return st.executeQuery().next()
    finally:
        st.close()


def _has_table(con, name: str) -> bool:
    schema, _, table = _name(name).rpartition(".")
    meta = con.getMetaData()
    for fold in (str, str.upper, str.lower):
        if meta.getTables(None, fold(schema) or None, fold(table), None).next():
            return True
    return False


def prepare(spark: SparkSession, target: sinks.Target, columns: list[str]) -> None:
    """The ledger and the staging table, where they are missing.  The staging
    table has the target's own types, so keys compare as they do there."""
    table, stage = _name(target.location), staging_target(target).location
    names = ", ".join(_name(c) for c in columns)
    with connection(spark, target) as con:
        if not _has_table(con, stage):
            _run(con, f"CREATE TABLE {stage} ({names}, batch_id) AS "
                      f"SELECT {names}, CAST(0 AS BIGINT) FROM {table} WITH NO DATA")
        if not _has_table(con, LEDGER):
            _run(con, f"CREATE TABLE {LEDGER} (stream VARCHAR(200) NOT NULL, batch_id BIGINT NOT NULL, "
                      f"moved BIGINT NOT NULL, PRIMARY KEY (stream, batch_id))")


def staging_target(target: sinks.Target) -> sinks.Target:
    name = f"{_name(target.location)}{STAGING}"
    return sinks.Target(f"{target.name}{STAGING}", "jdbc", name, {**target.options, "dbtable": name})


def append_batch(spark: SparkSession, rows: DataFrame, target: sinks.Target, keys: list[str],
                 stream: str, batch_id: int) -> dict:
    """Append the rows whose key the table lacks, once per (stream, batch).

    ``rows`` hold one row a key.  ``stream`` must differ between streams
    and between checkpoints of one stream, since batch numbers start again
    with a new checkpoint.  The target table is there already, with its own
    columns, keys and types."""
    table, stage = _name(target.location), staging_target(target)
    with connection(spark, target) as con:
        if _any(con, f"SELECT 1 FROM {LEDGER} WHERE stream = ? AND batch_id = ?", stream, int(batch_id)):
            return {"target": target.name, "rows": 0, "replayed": True}
    # replaces what a failed attempt of this or another batch has left
    sinks.write_table(rows.withColumn("batch_id", F.lit(int(batch_id)).cast("long")), stage, "overwrite")
    columns = ", ".join(_name(c) for c in rows.columns)
    same = " AND ".join(f"t.{_name(k)} = s.{_name(k)}" for k in keys)
    with connection(spark, target) as con:
        # the ledger's key stops a second writer of the same batch
        _run(con, f"INSERT INTO {LEDGER} VALUES (?, ?, 0)", stream, int(batch_id))
        moved = _run(con, f"INSERT INTO {table} ({columns}) SELECT DISTINCT {columns} FROM {stage.location} s "
                          f"WHERE s.batch_id = ? AND NOT EXISTS (SELECT 1 FROM {table} t WHERE {same})", int(batch_id))
        _run(con, f"UPDATE {LEDGER} SET moved = ? WHERE stream = ? AND batch_id = ?", moved, stream, int(batch_id))
    return {"target": target.name, "rows": moved, "replayed": False}
