"""Distributed data-quality checks.

Two families, both returning small result DataFrames (one row per check):

* **source expectations** (pre-load gate): row count, column presence,
  not-null, uniqueness, set membership, regex, string length, numeric range;
* **model tests** (post-transform): not_null, unique, accepted_values,
  relationships, accepted_range and the orphan-item singular test.

Execution is fused.  Source expectations: every row-level check of one table
is a ``count_if`` inside a single aggregate, and a uniqueness check is a
``groupBy`` on its column.  Model tests: every relation is scanned once and
all tests, uniqueness and relationships included, share one aggregation by
(test, key), with partial sums on the map side, so a hot value is pre-counted
before the shuffle.  Nothing is collected except the per-dataset summary that
the gate inspects (a handful of rows).
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopflow.functions.expressions import pack_ids, packed_id, text_columns, unpack_ids


class QualityGateError(RuntimeError):
    """Raised when a quality gate fails; carries the failing summary rows."""

    def __init__(self, failed: list[dict]):
        self.failed = failed
        super().__init__(f"quality gate failed: {failed}")


# =============================================================================
# Source expectations
# =============================================================================

@dataclass(frozen=True)
class Expectation:
    expectation_type: str
    kwargs: dict = field(default_factory=dict, hash=False)

    @property
    def column(self) -> str | None:
        return self.kwargs.get("column")


def E(expectation_type: str, **kwargs) -> Expectation:
    return Expectation(expectation_type, kwargs)


# The source suites (thresholds, patterns and value sets as
# configured for the retail sources).
ORDER_STATUSES = ["delivered", "shipped", "canceled", "unavailable", "invoiced",
                  "processing", "created", "approved"]

SUITES: dict[str, list[Expectation]] = {
    "orders": [
        E("expect_table_row_count_to_be_between", min_value=90000, max_value=150000),
        E("expect_column_to_exist", column="order_id"),
        E("expect_column_to_exist", column="customer_id"),
        E("expect_column_to_exist", column="order_status"),
        E("expect_column_to_exist", column="order_purchase_timestamp"),
        E("expect_column_values_to_not_be_null", column="order_id"),
        E("expect_column_values_to_not_be_null", column="customer_id"),
        E("expect_column_values_to_be_unique", column="order_id"),
        E("expect_column_values_to_not_be_null", column="order_status"),
        E("expect_column_values_to_be_in_set", column="order_status", value_set=ORDER_STATUSES),
        E("expect_column_values_to_not_be_null", column="order_purchase_timestamp"),
        E("expect_column_values_to_match_regex", column="order_id", regex="^[a-f0-9]{32}$"),
    ],
    "customers": [
        E("expect_table_row_count_to_be_between", min_value=90000, max_value=150000),
        E("expect_column_to_exist", column="customer_id"),
        E("expect_column_to_exist", column="customer_unique_id"),
        E("expect_column_to_exist", column="customer_city"),
        E("expect_column_to_exist", column="customer_state"),
        E("expect_column_values_to_not_be_null", column="customer_id"),
        E("expect_column_values_to_be_unique", column="customer_id"),
        E("expect_column_values_to_not_be_null", column="customer_unique_id"),
        E("expect_column_values_to_not_be_null", column="customer_city"),
        E("expect_column_values_to_not_be_null", column="customer_state"),
        E("expect_column_values_to_match_regex", column="customer_state", regex="^[A-Z]{2}$"),
        E("expect_column_value_lengths_to_be_between", column="customer_city", min_value=1, max_value=100),
    ],
    "products": [
        E("expect_table_row_count_to_be_between", min_value=30000, max_value=50000),
        E("expect_column_to_exist", column="product_id"),
        E("expect_column_to_exist", column="product_category_name"),
        E("expect_column_values_to_not_be_null", column="product_id"),
        E("expect_column_values_to_be_unique", column="product_id"),
        E("expect_column_values_to_match_regex", column="product_id", regex="^[a-f0-9]{32}$"),
        E("expect_column_value_lengths_to_be_between", column="product_category_name",
          min_value=1, max_value=100),
    ],
    "order_items": [
        E("expect_table_row_count_to_be_between", min_value=100000, max_value=150000),
        E("expect_column_to_exist", column="order_id"),
        E("expect_column_to_exist", column="order_item_id"),
        E("expect_column_to_exist", column="product_id"),
        E("expect_column_to_exist", column="seller_id"),
        E("expect_column_to_exist", column="price"),
        E("expect_column_to_exist", column="freight_value"),
        E("expect_column_values_to_not_be_null", column="order_id"),
        E("expect_column_values_to_not_be_null", column="order_item_id"),
        E("expect_column_values_to_not_be_null", column="product_id"),
        E("expect_column_values_to_not_be_null", column="price"),
        E("expect_column_values_to_not_be_null", column="freight_value"),
        E("expect_column_values_to_be_between", column="price", min_value=0, max_value=100000),
        E("expect_column_values_to_be_between", column="freight_value", min_value=0, max_value=50000),
        E("expect_column_values_to_be_between", column="order_item_id", min_value=1, max_value=50),
    ],
}


def load_suite(path: str) -> list[Expectation]:
    """Read an expectation-suite JSON file; a missing list means no checks."""
    with open(path, encoding="utf-8") as f:
        data = json.load(f)
    return [Expectation(e["expectation_type"], dict(e.get("kwargs", {})))
            for e in data.get("expectations", [])]


RESULT_SCHEMA = T.StructType([
    T.StructField("dataset", T.StringType()),
    T.StructField("check_index", T.IntegerType()),
    T.StructField("expectation", T.StringType()),
    T.StructField("column_name", T.StringType()),
    T.StructField("element_count", T.LongType()),
    T.StructField("unexpected_count", T.LongType()),
    T.StructField("success", T.BooleanType()),
    T.StructField("detail", T.StringType()),
])

# row-level expectations: predicate marking an *unexpected* non-null value
_ROW_RULES = {
    "expect_column_values_to_not_be_null": lambda c, kw: c.isNull(),
    "expect_column_values_to_be_in_set": lambda c, kw: c.isNotNull() & ~c.isin(list(kw["value_set"])),
    "expect_column_values_to_match_regex": lambda c, kw: c.isNotNull() & ~c.rlike(kw["regex"]),
    "expect_column_value_lengths_to_be_between":
        lambda c, kw: c.isNotNull() & ~_in_range(F.length(c), kw.get("min_value"), kw.get("max_value")),
    # text that is not a number is an unexpected value, not a missing one
    "expect_column_values_to_be_between":
        lambda c, kw: c.isNotNull() & ~F.coalesce(
            _in_range(c.try_cast("double"), kw.get("min_value"), kw.get("max_value")), F.lit(False)),
}
SCHEMA_ONLY = {"expect_column_to_exist"}
TABLE_LEVEL = {"expect_table_row_count_to_be_between"}
GROUPED = {"expect_column_values_to_be_unique"}
KNOWN = set(_ROW_RULES) | SCHEMA_ONLY | TABLE_LEVEL | GROUPED


def _in_range(x: Column, lo, hi) -> Column:
    pred = F.lit(True)
    if lo is not None:
        pred = pred & (x >= F.lit(lo))
    if hi is not None:
        pred = pred & (x <= F.lit(hi))
    return pred


def _row(dataset, idx, exp, column, element_count, unexpected, success, detail) -> Column:
    def lit(v, t):
        return v if isinstance(v, Column) else F.lit(v).cast(t)
    return F.struct(
        F.lit(dataset).alias("dataset"),
        F.lit(idx).cast("int").alias("check_index"),
        F.lit(exp).alias("expectation"),
        lit(column, "string").alias("column_name"),
        lit(element_count, "bigint").alias("element_count"),
        lit(unexpected, "bigint").alias("unexpected_count"),
        lit(success, "boolean").alias("success"),
        lit(detail, "string").alias("detail"),
    )


def _bad_arguments(spark: SparkSession, expectation: str, kw: dict) -> str | None:
    """Why a check's arguments cannot work, before it joins the others in
    one aggregate; None if they can."""
    if expectation.endswith("in_set") and not isinstance(kw.get("value_set"), (list, tuple, set)):
        return "value_set is not a list"
    if expectation.endswith("match_regex"):
        if not isinstance(kw.get("regex"), str):
            return "regex is not text"
        try:  # the pattern language of rlike
            spark._jvm.java.util.regex.Pattern.compile(kw["regex"])
        except Exception:
            return f"regex {kw['regex']} is not valid"
    for bound in ("min_value", "max_value"):
        if not isinstance(kw.get(bound), (int, float, type(None))):
            return f"{bound} is not a number"
    return None


def run_suite(df: DataFrame, dataset: str, suite: list[Expectation],
              only: set[str] | None = None) -> DataFrame:
    """All expectations of one dataset -> result rows (one per expectation).

    A check that cannot run (unknown type, missing column, bad arguments) is
    a failed row with a detail message; the other checks still run.  ``only``
    restricts the run to some expectation types (indices stay those of the
    suite).  A suite without checks is one passed row outside the count.
    """
    spark = df.sparkSession
    cols = set(df.columns)
    aggs: list[Column] = [F.count(F.lit(1)).alias("n__")]
    fused: list[Column] = []     # struct rows built over the fused aggregate
    static: list[tuple] = []     # rows known without a job
    grouped: list[DataFrame] = []
    for idx, e in enumerate(suite):
        t, kw, c = e.expectation_type, e.kwargs, e.column
        if only is not None and t not in only:
            continue
        if t not in KNOWN:
            static.append((dataset, idx, t, c, None, None, False, f"ERROR: unknown expectation {t}"))
        elif t in SCHEMA_ONLY:
            ok = c in cols
            static.append((dataset, idx, t, c, None, None, ok, None if ok else f"column {c} not found"))
        elif t not in TABLE_LEVEL and c not in cols:
            static.append((dataset, idx, t, c, None, None, False, f"ERROR: column {c} not found"))
        elif (error := _bad_arguments(spark, t, kw)) is not None:
            static.append((dataset, idx, t, c, None, None, False, f"ERROR: {error}"))
        elif t in TABLE_LEVEL:
            n = F.col("n__")
            fused.append(_row(dataset, idx, t, None, n, None,
                              _in_range(n, kw.get("min_value"), kw.get("max_value")), None))
        elif t in GROUPED:
            # duplicated non-null values: every row of such a value counts
            g = (df.groupBy(F.col(c).alias("v__")).agg(F.count(F.lit(1)).alias("k__"))
                   .agg(F.sum("k__").alias("n__"),
                        F.coalesce(F.sum(F.when(F.col("v__").isNotNull() & (F.col("k__") > 1),
                                                F.col("k__"))), F.lit(0)).alias("u__")))
            grouped.append(g.select(_row(dataset, idx, t, c, F.col("n__"), F.col("u__"),
                                         F.col("u__") == 0, None).alias("r")).select("r.*"))
        else:
            name = f"u{idx}__"
            aggs.append(F.count_if(_ROW_RULES[t](F.col(c), kw)).alias(name))
            fused.append(_row(dataset, idx, t, c, F.col("n__"), F.col(name), F.col(name) == 0, None))
    if not suite and only is None:
        static.append((dataset, -1, "dataset", None, None, None, True, "suite is empty"))
    parts: list[DataFrame] = []
    if fused:
        parts.append(df.agg(*aggs).select(F.explode(F.array(*fused)).alias("r")).select("r.*"))
    parts.extend(grouped)
    if static:
        parts.append(spark.createDataFrame(static, RESULT_SCHEMA))
    if not parts:
        return spark.createDataFrame([], RESULT_SCHEMA)
    return reduce(DataFrame.unionByName, parts)


def run_suites(tables: dict[str, DataFrame], suites: dict[str, list[Expectation]] = SUITES,
               only: set[str] | None = None) -> DataFrame:
    """Every dataset's suite.  A dataset without a table, or a table
    without a suite, is one failed row with zero checks."""
    parts = []
    spark = None
    for name in sorted(set(tables) | set(suites)):
        if name in tables:
            spark = tables[name].sparkSession
        if name not in tables or name not in suites:
            continue
        parts.append(run_suite(tables[name], name, suites[name], only))
    missing = [] if only is not None else [(n, -1, "dataset", None, None, None, False,
                "source not found" if n not in tables else "suite not found")
               for n in sorted(set(tables) ^ set(suites))]
    spark = spark or SparkSession.active()
    if missing:
        parts.append(spark.createDataFrame(missing, RESULT_SCHEMA))
    if not parts:
        return spark.createDataFrame([], RESULT_SCHEMA)
    return reduce(DataFrame.unionByName, parts)


def summarize(results: DataFrame) -> DataFrame:
    """Per dataset: total/passed/failed checks and overall success.  The
    marker row of a missing dataset/suite counts as a failure with 0 checks."""
    is_check = F.col("check_index") >= 0
    return (results.groupBy("dataset")
            .agg(F.count_if(is_check).alias("total"),
                 F.count_if(is_check & F.col("success")).alias("passed"),
                 F.count_if(is_check & ~F.col("success")).alias("failed"),
                 F.bool_and("success").alias("success")))


def gate(results: DataFrame) -> list[dict]:
    """Fail fast: raise :class:`QualityGateError` unless every dataset passed.
    The checks run once; only the per-dataset summary (one row per dataset)
    reaches the driver and is returned."""
    summary = [r.asDict() for r in summarize(results).collect()]
    failed = [r for r in summary if not r["success"]]
    if failed:
        raise QualityGateError(failed)
    return summary


# =============================================================================
# Model tests
# =============================================================================

@dataclass(frozen=True)
class ModelTest:
    relation: str
    test: str
    column: str | None = None
    args: dict = field(default_factory=dict, hash=False)


def _t(relation, test, column=None, **args) -> ModelTest:
    return ModelTest(relation, test, column, args)


def _nn(relation, *columns):
    return [_t(relation, "not_null", c) for c in columns]


# The model-test catalogue (sources, staging, marts, singular).
MODEL_TESTS: list[ModelTest] = [
    *_nn("raw.orders", "order_id", "customer_id"), _t("raw.orders", "unique", "order_id"),
    *_nn("raw.customers", "customer_id"), _t("raw.customers", "unique", "customer_id"),
    *_nn("raw.products", "product_id"), _t("raw.products", "unique", "product_id"),
    *_nn("raw.order_items", "order_id", "order_item_id"),
    *_nn("streaming.raw_orders_stream", "order_id"),
    _t("streaming.raw_orders_stream", "unique", "order_id"),
    *_nn("streaming.raw_orders_stream", "customer_id", "product_id", "amount", "total_value", "event_time"),
    *_nn("stg_orders", "order_id"), _t("stg_orders", "unique", "order_id"),
    *_nn("stg_orders", "customer_id", "order_status"),
    _t("stg_orders", "accepted_values", "order_status", values=ORDER_STATUSES),
    *_nn("stg_orders", "purchase_timestamp"),
    *_nn("stg_customers", "customer_id"), _t("stg_customers", "unique", "customer_id"),
    *_nn("stg_customers", "customer_city", "customer_state"),
    *_nn("stg_products", "product_id"), _t("stg_products", "unique", "product_id"),
    *_nn("stg_order_items", "order_id"),
    _t("stg_order_items", "relationships", "order_id", to="stg_orders", field="order_id"),
    *_nn("stg_order_items", "order_item_id", "product_id"),
    _t("stg_order_items", "relationships", "product_id", to="stg_products", field="product_id"),
    *_nn("stg_order_items", "price"),
    _t("stg_order_items", "accepted_range", "price", min_value=0, inclusive=True),
    *_nn("stg_order_items", "freight_value"),
    _t("stg_order_items", "accepted_range", "freight_value", min_value=0, inclusive=True),
    *_nn("fact_orders", "order_id", "customer_id"),
    _t("fact_orders", "relationships", "customer_id", to="dim_customers", field="customer_id"),
    *_nn("fact_orders", "product_id"),
    _t("fact_orders", "relationships", "product_id", to="dim_products", field="product_id"),
    *_nn("fact_orders", "price"),
    _t("fact_orders", "accepted_range", "price", min_value=0, inclusive=True),
    *_nn("fact_orders", "freight_value"),
    _t("fact_orders", "accepted_range", "freight_value", min_value=0, inclusive=True),
    *_nn("fact_orders", "purchase_timestamp"),
    *_nn("dim_customers", "customer_id"), _t("dim_customers", "unique", "customer_id"),
    *_nn("dim_customers", "customer_city", "customer_state"),
    *_nn("dim_products", "product_id"), _t("dim_products", "unique", "product_id"),
    *_nn("fact_orders_realtime", "order_id"), _t("fact_orders_realtime", "unique", "order_id"),
    *_nn("fact_orders_realtime", "customer_id", "product_id", "amount"),
    _t("fact_orders_realtime", "accepted_range", "amount", min_value=0, inclusive=False),
    *_nn("fact_orders_realtime", "quantity"),
    _t("fact_orders_realtime", "accepted_range", "quantity", min_value=1, inclusive=True),
    *_nn("fact_orders_realtime", "total_value"),
    _t("fact_orders_realtime", "accepted_range", "total_value", min_value=0, inclusive=False),
    *_nn("fact_orders_realtime", "event_time", "processing_time"),
    _t("stg_order_items", "no_orphan_items", None, to="stg_orders"),
]

TEST_RESULT_SCHEMA = T.StructType([
    T.StructField("relation", T.StringType()),
    T.StructField("test_name", T.StringType()),
    T.StructField("column_name", T.StringType()),
    T.StructField("failures", T.LongType()),
    T.StructField("status", T.StringType()),
])


def _range_violation(c: Column, args: dict) -> Column:
    lo = F.lit(args["min_value"]) if args.get("min_value") is not None else None
    hi = F.lit(args["max_value"]) if args.get("max_value") is not None else None
    inclusive = args.get("inclusive", True)
    ok = F.lit(True)
    if lo is not None:
        ok = ok & ((c >= lo) if inclusive else (c > lo))
    if hi is not None:
        ok = ok & ((c <= hi) if inclusive else (c < hi))
    return ~ok   # NULL stays NULL -> not counted


def violations(relations: dict[str, DataFrame], t: ModelTest) -> DataFrame:
    """The failing rows of one test (the test passes when this is empty)."""
    df = relations[t.relation]
    c = F.col(t.column) if t.column else None
    if t.test == "not_null":
        return df.filter(c.isNull())
    if t.test == "accepted_range":
        return df.filter(_range_violation(c, t.args))
    if t.test == "unique":
        return (df.filter(c.isNotNull()).groupBy(c.alias("unique_field"))
                  .agg(F.count(F.lit(1)).alias("n_records")).filter("n_records > 1"))
    if t.test == "accepted_values":
        return (df.groupBy(c.alias("value_field")).agg(F.count(F.lit(1)).alias("n_records"))
                  .filter(~F.col("value_field").isin(list(t.args["values"]))))
    if t.test == "relationships":
        parent = relations[t.args["to"]].select(F.col(t.args["field"]).alias("to_field"))
        return (df.select(c.alias("from_field")).filter(F.col("from_field").isNotNull())
                  .join(parent, F.col("from_field") == F.col("to_field"), "left_anti"))
    if t.test == "no_orphan_items":
        return orphan_items(df, relations[t.args["to"]])
    raise ValueError(f"unknown test {t.test}")


def orphan_items(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Items whose order is missing, items without an order id included: one
    anti-join, whose item side AQE splits where an order is hot.  The ids
    cross it as bytes."""
    items, orders = items.select("order_id", "order_item_id", "product_id"), orders.select("order_id")
    ids = text_columns(orders, ["order_id"]) and text_columns(items, ["order_id"])
    own = text_columns(items, ["product_id"])
    return (unpack_ids(pack_ids(items, ids + own).join(pack_ids(orders, ids), "order_id", "left_anti"), ids + own)
            .select("order_id", "order_item_id", "product_id"))


def _result(t: ModelTest, failures: Column) -> Column:
    return F.struct(F.lit(t.relation).alias("relation"), F.lit(t.test).alias("test_name"),
                    F.lit(t.column).cast("string").alias("column_name"),
                    failures.cast("bigint").alias("failures"),
                    F.when(failures == 0, "pass").otherwise("fail").alias("status"))


KEYED = ("unique", "relationships", "no_orphan_items")


def _keys(t: ModelTest) -> list[tuple[str, str]]:
    """The key columns of a keyed test, as (relation, column): its own and,
    if it has one, that of its parent."""
    if t.test == "no_orphan_items":
        return [(t.relation, "order_id"), (t.args["to"], "order_id")]
    return [(t.relation, t.column)] + ([(t.args["to"], t.args["field"])] if "to" in t.args else [])


def _groups(tests: list[ModelTest]) -> list[list[tuple[str, str]]]:
    """The key columns of the keyed tests; those that a test compares are in
    one group."""
    groups: list[list] = []
    for t in tests:
        if t.test in KEYED:
            met = [g for g in groups if set(g) & set(_keys(t))]
            one = list(dict.fromkeys([k for g in met for k in g] + _keys(t)))
            groups = [g for g in groups if g not in met] + [one]
    return groups


def _entries(df: DataFrame, keys: list[tuple[int, int, str, bool]], rows: list[tuple[int, ModelTest]]) -> DataFrame:
    """What one relation says to the tests it takes part in: rows ``(part,
    slot, key)``, from one scan.

    A key column is told once per row, whichever tests read it: its group and
    its place there.  A row-level test gets an entry without a key for each
    failing row only.  The entries are counted within the task first (see
    :func:`run_model_tests`), so a key that a third of the rows carry, or a
    test that they all fail, is one entry a task in the shuffle."""
    entries = []

    def entry(there, part, slot, key):
        key = F.lit(None).cast("binary") if key is None else packed_id(key.cast("string"))
        entries.append(F.when(there, F.struct(F.lit(part).alias("part"), F.lit(slot).alias("slot"), key.alias("key"))))
    for part, slot, column, nulls in keys:
        entry(F.lit(True) if nulls else F.col(column).isNotNull(), part, slot, F.col(column))
    for i, t in rows:
        c = F.col(t.column)
        if t.test == "not_null":
            entry(c.isNull(), i, 0, None)
        elif t.test == "accepted_range":
            entry(_range_violation(c, t.args), i, 0, None)
        elif t.test == "accepted_values":   # the failing values, each counted once
            entry(c.isNotNull() & ~c.isin(list(t.args["values"])), i, 0, c)
        else:
            raise ValueError(f"unknown test {t.test}")
    return df.select(F.explode(F.filter(F.array(*entries), lambda e: e.isNotNull())).alias("e")).select("e.*")


def run_model_tests(relations: dict[str, DataFrame], tests: list[ModelTest] = MODEL_TESTS) -> DataFrame:
    """Failure count and status of every test.

    Every relation is scanned once.  All tests of all relations share one
    shuffle: entries are added up per (part, key), where a part is a group of
    key columns or a row-level test.  A unique test looks for keys counted
    more than once in its column, a relationship for keys with children and
    no parent (its failing rows are the children counted), an accepted value
    for one failing group, and a row-level test adds up its rows."""
    groups = _groups(tests)
    place = {k: (len(tests) + g, slot) for g, ks in enumerate(groups) for slot, k in enumerate(ks)}
    # a null key is nobody's duplicate and needs no parent, but an item
    # without an order id is an orphan
    orphans = {_keys(t)[0] for t in tests if t.test == "no_orphan_items"}
    parts = []
    for rel in dict.fromkeys([r for t in tests for r in (t.relation, t.args.get("to", t.relation))]):
        keys = [(*place[k], k[1], k in orphans) for k in place if k[0] == rel]
        rows = [(i, t) for i, t in enumerate(tests) if t.relation == rel and t.test not in KEYED]
        parts.append(_entries(relations[rel], keys, rows))
    slots = max([1, *map(len, groups)])
    per_key = (reduce(DataFrame.unionByName, parts).groupBy("part", "key")
               .agg(*[F.count(F.when(F.col("slot") == s, 1)).alias(f"n{s}") for s in range(slots)]))
    there = F.col("key").isNotNull()

    def failing(t):
        n, *parent = [F.col(f"n{place[k][1]}") for k in _keys(t)]
        if t.test == "unique":
            return F.when(there & (n > 1), F.lit(1)).otherwise(F.lit(0))
        alone = ~there | (parent[0] == 0) if t.test == "no_orphan_items" else there & (parent[0] == 0)
        return F.when(alone, n).otherwise(F.lit(0))

    def outcome(i, f):
        return F.struct(F.lit(i).alias("test"), f.cast("long").alias("failures"))
    values = [i for i, t in enumerate(tests) if t.test == "accepted_values"]
    own = F.when(F.col("part").isin(values), (F.col("n0") > 0).cast("long")).otherwise(F.col("n0"))
    told = F.array(F.struct(F.col("part").alias("test"), own.alias("failures")))
    for g, ks in enumerate(groups):
        of_group = [outcome(i, failing(t)) for i, t in enumerate(tests) if t.test in KEYED and _keys(t)[0] in ks]
        told = F.when(F.col("part") == len(tests) + g, F.array(*of_group)).otherwise(told)
    # a test with nothing to say still has its row
    silent = next(iter(relations.values())).sparkSession.range(len(tests)).select(
        F.col("id").cast("int").alias("test"), F.lit(0).cast("long").alias("failures"))
    totals = (per_key.select(F.explode(told).alias("r")).select("r.*").unionByName(silent)
              .groupBy("test").agg(F.sum("failures").alias("f")))
    results = F.element_at(F.array(*[_result(t, F.col("f")) for t in tests]), F.col("test") + 1)
    return totals.select(results.alias("r")).select("r.*")
