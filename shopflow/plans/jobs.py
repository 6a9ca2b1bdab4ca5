"""Batch jobs: clean-and-load, models, and the ordered daily run
(validate -> load -> models -> tests), stopping at the first failure.

Every step hands the next one a *written* table, read back from storage:
lineage is cut at each layer, a lost executor only recomputes the current
step, and each layer is a restart point.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopflow.operators import quality as Q
from shopflow.operators.clean import CLEANERS, SPECS, packable_ids
from shopflow.plans import models as M
from shopflow.session import work_dir
from shopflow.sources import sinks
from shopflow.tables import (MART_MODELS, RAW_TABLES, STAGING_MODELS, create_namespaces, model_schema,
                             qualified)


class ModelTestError(RuntimeError):
    def __init__(self, failed: list[dict]):
        self.failed = failed
        super().__init__(f"{len(failed)} model test(s) failed: {failed}")


@dataclass
class Warehouse:
    """Table locations: ``<root>/<schema>/<table>`` parquet folders, plus
    optional extra targets per raw table (e.g. a JDBC or BigQuery copy)."""

    root: str
    extra: dict[str, list[sinks.Target]] = field(default_factory=dict)

    def target(self, qualified: str, partition_by=()) -> sinks.Target:
        schema, name = qualified.split(".", 1)
        return sinks.file_target(name, f"{self.root}/{schema}/{name}", partition_by=partition_by, compression="zstd")

    def raw_targets(self, table: str) -> list[sinks.Target]:
        return [self.target(RAW_TABLES[table])] + list(self.extra.get(table, []))


def concurrently(tasks: list, max_workers: int = 4) -> list:
    """Run independent Spark actions as concurrent jobs (the scheduler
    interleaves their tasks, so a narrow stage of one table does not leave
    the rest of the cluster idle)."""
    if len(tasks) <= 1:
        return [t() for t in tasks]
    with ThreadPoolExecutor(max_workers=min(max_workers, len(tasks))) as pool:
        return [f.result() for f in [pool.submit(t) for t in tasks]]


def run_batch(spark: SparkSession, sources: dict[str, DataFrame], wh: Warehouse,
              tables=tuple(CLEANERS)) -> list[dict]:
    """Clean the sources and load each into all of its targets (the loads
    run as concurrent jobs).  Row counts come from observations made during
    the writes.  Ids cross the dedup as bytes where that keeps its result."""
    def load(table):
        cleaned = CLEANERS[table](sources[table], packable_ids(sources[table], SPECS[table]))
        targets = wh.raw_targets(table)
        loads = (sinks.write_all(cleaned, targets) if len(targets) > 1
                 else [sinks.write_table(cleaned, targets[0])])
        return [{"table": table, **r} for r in loads]
    return [r for rs in concurrently([lambda t=t: load(t) for t in tables]) for r in rs]


def loaded_tables(spark: SparkSession, wh: Warehouse, tables=tuple(RAW_TABLES)) -> dict[str, DataFrame]:
    return {t: sinks.read_table(spark, wh.target(RAW_TABLES[t])) for t in tables}


# raw tables each model reads (the landing table feeds the realtime mart)
MODEL_SOURCES = {
    "stg_orders": ("orders",), "stg_customers": ("customers",), "stg_products": ("products",),
    "stg_order_items": ("order_items",), "fact_orders": ("orders", "order_items"),
    "dim_customers": ("customers",), "dim_products": ("products",), "fact_orders_realtime": (),
}


def run_models(spark: SparkSession, wh: Warehouse, landing: DataFrame | None = None,
               only=None) -> dict[str, DataFrame]:
    """Staging models become temp views, marts are written as tables (full
    refresh) and read back; returns the models by name (``only``: a subset)."""
    wanted = [m for m in (*STAGING_MODELS, *MART_MODELS) if only is None or m in only]
    tables = sorted({t for m in wanted for t in MODEL_SOURCES[m]})
    built = M.build_models(loaded_tables(spark, wh, tables), landing, wanted, packed=True)
    out: dict[str, DataFrame] = {}
    for name in STAGING_MODELS:
        if name in built:
            built[name].createOrReplaceTempView(name)
            out[name] = built[name]
    marts = [n for n in MART_MODELS if n in built]

    def write(name):
        t = wh.target(f"{model_schema(name)}.{name}",
                      partition_by=("order_date",) if name == "fact_orders_realtime" else ())
        sinks.write_table(built[name], t, "overwrite")
        return name, sinks.read_table(spark, t)
    out.update(dict(concurrently([lambda n=n: write(n) for n in marts])))
    return out


def register(spark: SparkSession, wh: Warehouse, built: dict[str, DataFrame]) -> list[str]:
    """Name the warehouse in the catalog: the raw tables and marts as external
    tables over their folders, the staging views over the raw tables.  A name
    of an earlier run moves to this warehouse (its files stay); a managed
    table under such a name is somebody else's and stops the run."""
    create_namespaces(spark)
    names = [*RAW_TABLES.values(), *(qualified(m, model_schema(m)) for m in MART_MODELS if m in built)]
    for name in names:
        if spark.catalog.tableExists(name):
            if spark.catalog.getTable(name).tableType != "EXTERNAL":
                raise ValueError(f"{name} is already there and not a table over a folder")
            spark.sql(f"DROP TABLE {name}")
        t = wh.target(name)
        spark.catalog.createTable(name, path=t.location, source=t.format)
        if any(c.isPartition for c in spark.catalog.listColumns(name)):
            spark.catalog.recoverPartitions(name)
    views = [m for m in STAGING_MODELS if m in built]
    for m in views:
        sql = M.staging_sql(m, RAW_TABLES[M.STAGING[m][0]])
        spark.sql(f"CREATE OR REPLACE VIEW {qualified(m, model_schema(m))} AS {sql}")
    return names + [qualified(m, model_schema(m)) for m in views]


def run_tests(spark: SparkSession, wh: Warehouse, built: dict[str, DataFrame],
              landing: DataFrame | None = None, tests=Q.MODEL_TESTS) -> DataFrame:
    rel = {f"raw.{k}": v for k, v in loaded_tables(spark, wh).items()}
    if landing is not None:
        rel["streaming.raw_orders_stream"] = landing
    rel.update(built)
    there = lambda t: t.relation in rel and t.args.get("to", t.relation) in rel
    results = Q.run_model_tests(rel, [t for t in tests if there(t)])
    absent = [t for t in tests if not there(t)]
    if not absent:
        return results
    # a test without its relation has failed; it has no failing rows to count
    rows = spark.range(1).select(F.explode(F.array(*[Q._result(t, F.lit(None).cast("long")) for t in absent])).alias("r"))
    missing = rows.select("r.*").withColumn("status", F.lit("fail"))
    return results.unionByName(missing.select(results.columns))


def run_daily(spark: SparkSession, sources: dict[str, DataFrame], wh: Warehouse | None = None,
              suites=Q.SUITES, landing: DataFrame | None = None) -> dict:
    """validate -> load -> models -> tests; raises on the first failing step.
    The tables and views are named in the catalog before the tests run."""
    wh = wh or Warehouse(work_dir(spark, "warehouse"))
    summary = Q.gate(Q.run_suites(sources, suites))               # 1. source gate
    loads = run_batch(spark, sources, wh)                        # 2. clean + load
    built = run_models(spark, wh, landing)                       # 3. models
    named = register(spark, wh, built)
    results = run_tests(spark, wh, built, landing)               # 4. model tests
    failed = [r.asDict() for r in results.filter(F.col("status") == "fail").collect()]
    if failed:
        raise ModelTestError(failed)
    return {"gate": summary, "loads": loads,
            "models": sorted(built), "relations": sorted(named), "warehouse": wh.root}
