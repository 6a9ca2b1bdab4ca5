"""Independent SQL statements of every registered query (DuckDB dialect).

They run on the driver's parquet tables, pre-registered as views.  The raw
feeds are the same expression text Spark uses (``sources/feeds.py``); all
semantics past the feed (cleaning, models, checks, stream rules) are
restated here in plain SQL.
"""

from __future__ import annotations

from shopflow.sources.feeds import (
    EVENT_AGAIN,
    EVENT_DELAYED,
    EVENT_FIELDS,
    EVENT_NO_TIME,
    EVENT_NOT_JSON,
    EVENT_REDELIVERED,
    ORACLE_FEEDS,
)


def keep_first(source: str, keys: list[str], others: list[str]) -> str:
    order = ", ".join(f"{c} ASC NULLS FIRST" for c in others)
    cols = ", ".join(keys + others)
    part = ", ".join(keys)
    return (f"SELECT {cols} FROM (SELECT {cols}, row_number() OVER "
            f"(PARTITION BY {part} ORDER BY {order}) AS rn__ FROM ({source}) s__) d__ WHERE rn__ = 1")


CLEAN = {
    "clean_orders": keep_first(
        "SELECT order_id, customer_id, order_status, "
        "TRY_CAST(order_purchase_timestamp AS TIMESTAMP) AS order_purchase_timestamp, "
        "TRY_CAST(order_delivered_customer_date AS TIMESTAMP) AS order_delivered_customer_date, "
        "TRY_CAST(order_estimated_delivery_date AS TIMESTAMP) AS order_estimated_delivery_date "
        "FROM raw_orders WHERE order_id IS NOT NULL AND customer_id IS NOT NULL",
        ["order_id"],
        ["customer_id", "order_status", "order_purchase_timestamp",
         "order_delivered_customer_date", "order_estimated_delivery_date"]),
    "clean_customers": keep_first(
        "SELECT customer_id, customer_unique_id, trim(customer_city) AS customer_city, "
        "trim(customer_state) AS customer_state FROM raw_customers WHERE customer_id IS NOT NULL",
        ["customer_id"], ["customer_unique_id", "customer_city", "customer_state"]),
    "clean_products": keep_first(
        "SELECT product_id, coalesce(product_category_name, 'unknown') AS product_category_name "
        "FROM raw_products WHERE product_id IS NOT NULL",
        ["product_id"], ["product_category_name"]),
    "clean_order_items": keep_first(
        "SELECT order_id, order_item_id, product_id, seller_id, TRY_CAST(price AS DOUBLE) AS price, "
        "TRY_CAST(freight_value AS DOUBLE) AS freight_value FROM raw_order_items "
        "WHERE order_id IS NOT NULL AND product_id IS NOT NULL",
        ["order_id", "order_item_id"], ["product_id", "seller_id", "price", "freight_value"]),
}

STAGING = {
    "stg_orders": "SELECT order_id, customer_id, order_status, "
                  "order_purchase_timestamp AS purchase_timestamp, "
                  "order_delivered_customer_date AS delivered_timestamp, "
                  "order_estimated_delivery_date AS estimated_delivery_timestamp "
                  "FROM clean_orders WHERE order_id IS NOT NULL",
    "stg_customers": "SELECT customer_id, customer_unique_id, customer_city, customer_state "
                     "FROM clean_customers WHERE customer_id IS NOT NULL",
    "stg_products": "SELECT product_id, product_category_name AS product_category "
                    "FROM clean_products WHERE product_id IS NOT NULL",
    "stg_order_items": "SELECT order_id, order_item_id, product_id, seller_id, price, freight_value "
                       "FROM clean_order_items WHERE order_id IS NOT NULL AND product_id IS NOT NULL",
}

MARTS = {
    # The mart's columns.
    "fact_orders": "SELECT o.order_id, o.customer_id, oi.product_id, oi.price, oi.freight_value, o.purchase_timestamp "
                   "FROM stg_orders o INNER JOIN stg_order_items oi ON o.order_id = oi.order_id",
    "dim_customers": "SELECT DISTINCT customer_id, customer_city, customer_state FROM stg_customers",
    "dim_products": "SELECT DISTINCT product_id, product_category FROM stg_products",
}

# ---- order-event messages, restated from the events table -----------------
_EVENT_COLS = ", ".join(f"{e} AS {a}" for a, e in EVENT_FIELDS)
MESSAGES = (
    "SELECT event_id, "
    f"CASE WHEN {EVENT_NOT_JSON} THEN NULL ELSE concat('ORD-', cast(event_id as string)) END AS order_id, "
    f"CASE WHEN {EVENT_NOT_JSON} THEN NULL ELSE concat('C', cast(user_id as string)) END AS customer_id, "
    f"CASE WHEN {EVENT_NOT_JSON} THEN NULL ELSE concat('P-', event_type) END AS product_id, "
    f"CASE WHEN {EVENT_NOT_JSON} THEN NULL WHEN event_id % 47 = 0 THEN -value ELSE value END AS amount, "
    f"CASE WHEN {EVENT_NOT_JSON} THEN NULL ELSE CAST(json_extract_string(props, '$.k') AS INTEGER) END AS quantity, "
    f"CASE WHEN {EVENT_NOT_JSON} OR {EVENT_NO_TIME} THEN NULL ELSE ts END AS event_time, "
    f"unnest(CASE WHEN {EVENT_REDELIVERED} THEN [1, 2] ELSE [1] END) AS delivery_attempt "
    "FROM events"
)
assert _EVENT_COLS  # the restated fields above follow EVENT_FIELDS

TOTAL_VALUE = ("CAST(round(TRY_CAST(amount AS DECIMAL(27,8)) * CAST(quantity AS DECIMAL(10,0)), 2) "
               "AS DOUBLE)")
VALID = ("coalesce(amount > 0 AND NOT isnan(amount) AND quantity > 0 AND event_time IS NOT NULL "
         "AND order_id IS NOT NULL AND customer_id IS NOT NULL AND product_id IS NOT NULL, false)")

PARSED = (f"SELECT event_id, delivery_attempt, order_id, customer_id, product_id, amount, quantity, "
          f"{TOTAL_VALUE} AS total_value, event_time FROM messages")

# landing table: valid events, one per order_id (redeliveries are identical)
LANDING = (f"SELECT order_id, customer_id, product_id, amount, quantity, total_value, event_time "
           f"FROM parsed WHERE {VALID} AND delivery_attempt = 1")


# deliveries in waves of ten days (see feeds.event_waves)
WAVES = (f"SELECT event_id, unnest(CASE WHEN {EVENT_AGAIN} AND w < 2 THEN [w, w + 1] ELSE [w] END) AS wave FROM ("
         f"SELECT event_id, own + CASE WHEN {EVENT_DELAYED} AND own < 2 THEN 1 ELSE 0 END AS w FROM ("
         "SELECT event_id, least(2, (day(ts) - 1) // 10) AS own FROM events) o) f")
DELIVERIES = ("SELECT *, coalesce(order_id, '') || CASE WHEN event_time IS NULL OR order_id IS NULL "
              "THEN '#' || CAST(event_id AS VARCHAR) ELSE '' END AS key FROM parsed JOIN waves USING (event_id)")


def with_ctes(body: str, *names: str) -> str:
    """Prefix ``body`` with the CTEs it needs (dependencies included)."""
    defs = {}
    defs.update(ORACLE_FEEDS)
    defs.update(CLEAN)
    defs.update(STAGING)
    defs.update(MARTS)
    defs["messages"] = MESSAGES
    defs["parsed"] = PARSED
    defs["landing"] = LANDING
    defs["waves"] = WAVES
    defs["deliveries"] = DELIVERIES
    deps = {
        "clean_orders": ["raw_orders"], "clean_customers": ["raw_customers"],
        "clean_products": ["raw_products"], "clean_order_items": ["raw_order_items"],
        "stg_orders": ["clean_orders"], "stg_customers": ["clean_customers"],
        "stg_products": ["clean_products"], "stg_order_items": ["clean_order_items"],
        "fact_orders": ["stg_orders", "stg_order_items"],
        "dim_customers": ["stg_customers"], "dim_products": ["stg_products"],
        "parsed": ["messages"], "landing": ["parsed"], "deliveries": ["waves", "parsed"],
    }
    ordered: list[str] = []

    def visit(n):
        for d in deps.get(n, []):
            visit(d)
        if n not in ordered:
            ordered.append(n)

    for n in names:
        visit(n)
    if not ordered:
        return body
    return "WITH " + ", ".join(f"{n} AS ({defs[n]})" for n in ordered) + " " + body


# ---- source expectations ------------------------------------------------------

def _q(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return repr(v)


def _between(x: str, lo, hi, strict=False) -> str:
    ge, le = (">", "<") if strict else (">=", "<=")
    parts = []
    if lo is not None:
        parts.append(f"{x} {ge} {_q(lo)}")
    if hi is not None:
        parts.append(f"{x} {le} {_q(hi)}")
    return " AND ".join(parts) or "TRUE"


def expectation_sql(dataset: str, idx: int, e, table: str) -> str:
    t, kw, c = e.expectation_type, e.kwargs, e.kwargs.get("column")
    head = f"SELECT '{dataset}' AS dataset, {idx} AS check_index, '{t}' AS expectation, "
    col = f"'{c}'" if c else "CAST(NULL AS VARCHAR)"
    null_b, null_s = "CAST(NULL AS BIGINT)", "CAST(NULL AS VARCHAR)"
    if t == "expect_column_to_exist":
        return head + f"{col} AS column_name, {null_b} AS element_count, {null_b} AS unexpected_count, " \
                      f"TRUE AS success, {null_s} AS detail"
    if t == "expect_table_row_count_to_be_between":
        return head + f"{col} AS column_name, count(*) AS element_count, {null_b} AS unexpected_count, " \
                      f"({_between('count(*)', kw.get('min_value'), kw.get('max_value'))}) AS success, " \
                      f"{null_s} AS detail FROM {table}"
    if t == "expect_column_values_to_be_unique":
        return head + f"{col} AS column_name, CAST(sum(k) AS BIGINT) AS element_count, " \
                      "CAST(coalesce(sum(CASE WHEN v IS NOT NULL AND k > 1 THEN k END), 0) AS BIGINT) AS unexpected_count, " \
                      "coalesce(sum(CASE WHEN v IS NOT NULL AND k > 1 THEN k END), 0) = 0 AS success, " \
                      f"{null_s} AS detail FROM (SELECT {c} AS v, count(*) AS k FROM {table} GROUP BY {c}) g"
    if t == "expect_column_values_to_not_be_null":
        bad = f"{c} IS NULL"
    elif t == "expect_column_values_to_be_in_set":
        bad = f"{c} IS NOT NULL AND {c} NOT IN ({', '.join(_q(v) for v in kw['value_set'])})"
    elif t == "expect_column_values_to_match_regex":
        bad = f"{c} IS NOT NULL AND NOT regexp_matches({c}, {_q(kw['regex'])})"
    elif t == "expect_column_value_lengths_to_be_between":
        bad = f"{c} IS NOT NULL AND NOT ({_between(f'length({c})', kw.get('min_value'), kw.get('max_value'))})"
    elif t == "expect_column_values_to_be_between":
        num = f"TRY_CAST({c} AS DOUBLE)"
        bad = f"{c} IS NOT NULL AND NOT coalesce({_between(num, kw.get('min_value'), kw.get('max_value'))}, FALSE)"
    else:
        raise ValueError(t)
    return head + f"{col} AS column_name, count(*) AS element_count, " \
                  f"count(*) FILTER (WHERE {bad}) AS unexpected_count, " \
                  f"count(*) FILTER (WHERE {bad}) = 0 AS success, {null_s} AS detail FROM {table}"


def suites_sql(suites: dict, only: set | None = None) -> str:
    parts = []
    for ds in sorted(suites):
        for idx, e in enumerate(suites[ds]):
            if only is None or e.expectation_type in only:
                parts.append(expectation_sql(ds, idx, e, f"raw_{ds}"))
    feeds = [f"raw_{ds}" for ds in sorted(suites)]
    return with_ctes(" UNION ALL ".join(parts), *feeds)


def summary_sql(suites: dict) -> str:
    body = suites_sql(suites)
    return (f"SELECT dataset, count(*) FILTER (WHERE check_index >= 0) AS total, "
            f"count(*) FILTER (WHERE check_index >= 0 AND success) AS passed, "
            f"count(*) FILTER (WHERE check_index >= 0 AND NOT success) AS failed, "
            f"bool_and(success) AS success FROM ({body}) r GROUP BY dataset")


# ---- model tests ----------------------------------------------------------------

REALTIME = ("SELECT order_id, customer_id, product_id, amount, quantity, total_value, event_time, "
            "processing_time, CAST(event_time AS DATE) AS order_date, "
            "date_trunc('hour', event_time) AS order_hour FROM landing_tbl WHERE order_id IS NOT NULL")
LANDING_TBL = "SELECT *, current_timestamp AS processing_time FROM landing"

RELATION_CTE = {
    "raw.orders": "clean_orders", "raw.customers": "clean_customers",
    "raw.products": "clean_products", "raw.order_items": "clean_order_items",
    "streaming.raw_orders_stream": "landing_tbl",
    "fact_orders_realtime": "realtime",
}


def _rel(name: str) -> str:
    return RELATION_CTE.get(name, name)


def model_test_sql(t) -> str:
    rel, c, a = _rel(t.relation), t.column, t.args
    if t.test == "not_null":
        fail = f"SELECT count(*) FILTER (WHERE {c} IS NULL) AS f FROM {rel}"
    elif t.test == "accepted_range":
        ok = _between(c, a.get("min_value"), a.get("max_value"), strict=not a.get("inclusive", True))
        fail = f"SELECT count(*) FILTER (WHERE NOT ({ok})) AS f FROM {rel}"
    elif t.test == "unique":
        fail = (f"SELECT count(*) AS f FROM (SELECT {c} FROM {rel} WHERE {c} IS NOT NULL "
                f"GROUP BY {c} HAVING count(*) > 1) u")
    elif t.test == "accepted_values":
        vals = ", ".join(_q(v) for v in a["values"])
        fail = (f"SELECT count(*) AS f FROM (SELECT {c} AS value_field, count(*) AS n FROM {rel} "
                f"GROUP BY {c}) v WHERE value_field NOT IN ({vals})")
    elif t.test == "relationships":
        fail = (f"SELECT count(*) AS f FROM (SELECT {c} AS from_field FROM {rel} WHERE {c} IS NOT NULL) ch "
                f"LEFT JOIN (SELECT {a['field']} AS to_field FROM {_rel(a['to'])}) p "
                f"ON ch.from_field = p.to_field WHERE p.to_field IS NULL")
    elif t.test == "no_orphan_items":
        fail = (f"SELECT count(*) AS f FROM {rel} AS item WHERE NOT EXISTS "
                f"(SELECT 1 FROM {_rel(a['to'])} AS placed WHERE placed.order_id = item.order_id)")
    else:
        raise ValueError(t.test)
    col = f"'{c}'" if c else "CAST(NULL AS VARCHAR)"
    return (f"SELECT '{t.relation}' AS relation, '{t.test}' AS test_name, {col} AS column_name, "
            f"CAST(f AS BIGINT) AS failures, CASE WHEN f = 0 THEN 'pass' ELSE 'fail' END AS status "
            f"FROM ({fail}) x")


MODEL_CTES = ("clean_orders", "clean_customers", "clean_products", "clean_order_items",
              "stg_orders", "stg_customers", "stg_products", "stg_order_items",
              "fact_orders", "dim_customers", "dim_products", "landing")


def model_tests_sql(tests) -> str:
    body = " UNION ALL ".join(model_test_sql(t) for t in tests)
    base = with_ctes("SELECT 1", *MODEL_CTES)
    # append the two stream-side relations after the generated CTE list
    ctes = base[len("WITH "):-len(" SELECT 1")]
    return f"WITH {ctes}, landing_tbl AS ({LANDING_TBL}), realtime AS ({REALTIME}) {body}"


# ---- sinks and stream read-backs ----------------------------------------------------

RAW_ORDERS_COPY = {1: "raw_orders_1", 2: "raw_orders_2"}


def clean_orders_of(source: str) -> str:
    return CLEAN["clean_orders"].replace("FROM raw_orders WHERE", f"FROM {source} WHERE")


def insert_if_absent_sql(feed_copy1: str, feed_copy2: str) -> str:
    seed = f"SELECT * FROM ({clean_orders_of('raw_orders_1')}) s WHERE order_status = 'delivered'"
    new = clean_orders_of("raw_orders_2")
    return (f"WITH raw_orders_1 AS ({feed_copy1}), raw_orders_2 AS ({feed_copy2}), seed AS ({seed}), "
            f"new_rows AS ({new}) SELECT * FROM seed UNION ALL SELECT * FROM new_rows n "
            f"WHERE NOT EXISTS (SELECT 1 FROM seed s WHERE s.order_id = n.order_id)")


STREAM_COLS = "order_id, customer_id, product_id, amount, quantity, total_value, event_time"
STREAM_PARSE = with_ctes(f"SELECT {STREAM_COLS} FROM parsed", "parsed")
# one row per message key: redeliveries are identical messages
STREAM_DEDUP = with_ctes(f"SELECT {STREAM_COLS} FROM parsed WHERE delivery_attempt = 1", "parsed")
STREAM_LANDING = with_ctes(f"SELECT {STREAM_COLS} FROM landing", "landing")
STREAM_DEAD = with_ctes(f"SELECT {STREAM_COLS}, 'Failed data quality checks' AS reason FROM parsed "
                        f"WHERE NOT {VALID} AND delivery_attempt = 1", "parsed")
DLQ_ENVELOPE = with_ctes("SELECT CAST(0 AS BIGINT) AS batch_id, 'Failed data quality checks' AS reason, "
                         f"count(*) AS record_count FROM parsed WHERE NOT {VALID} AND delivery_attempt = 1",
                         "parsed")
# The text of a message, restated.
MESSAGE_TEXT = (
    f"CASE WHEN {EVENT_NOT_JSON} THEN concat('not json: ORD-', cast(event_id as string)) ELSE concat("
    "'{\"order_id\":\"ORD-', cast(event_id as string), '\",\"customer_id\":\"C', cast(user_id as string), "
    "'\",\"product_id\":\"P-', event_type, '\",\"amount\":', "
    "cast(CASE WHEN event_id % 47 = 0 THEN -value ELSE value END as string), "
    "',\"quantity\":', json_extract_string(props, '$.k'), "
    f"CASE WHEN {EVENT_NO_TIME} THEN '' ELSE concat(',\"event_time\":\"', "
    "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'), '+00:00\"') END, '}') END")


def dlq_documents_sql(max_bytes: int, overhead: int) -> str:
    return with_ctes(
        "SELECT CAST(0 AS BIGINT) AS batch_id, 'Failed data quality checks' AS reason, part, "
        "count(*) AS record_count, md5(string_agg(raw_value, chr(10) ORDER BY raw_value)) AS payload_md5 FROM ("
        f"SELECT raw_value, CAST(floor((sum(strlen(raw_value) + {overhead}) OVER (ORDER BY raw_value "
        f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - strlen(raw_value) - {overhead}) / {max_bytes}) AS BIGINT) AS part "
        f"FROM (SELECT {MESSAGE_TEXT} AS raw_value FROM events JOIN parsed USING (event_id) "
        f"WHERE NOT {VALID} AND delivery_attempt = 1) r) p GROUP BY part", "parsed")


# Deliveries in waves: a row is late if its time is not after the highest time
# of the waves before, less ten minutes (whole milliseconds); of the others of
# one key the first counts.  Keys without a time do not outlive their wave.
STREAM_LATE = with_ctes(
    "SELECT order_id, customer_id, product_id, amount, quantity, event_time, "
    f"CASE WHEN late THEN 'late' WHEN nth > 1 THEN 'repeat' WHEN {VALID} THEN 'landed' ELSE 'dead letter' END AS outcome "
    "FROM (SELECT *, row_number() OVER (PARTITION BY key, late, CASE WHEN event_time IS NULL THEN wave END ORDER BY wave) AS nth "
    "FROM (SELECT d.*, coalesce(epoch_us(d.event_time) <= m.mark, false) AS late FROM deliveries d LEFT JOIN "
    "(SELECT w.wave, (epoch_us(max(x.event_time)) // 1000) * 1000 - 600000000 AS mark FROM (SELECT DISTINCT wave FROM deliveries) w "
    "JOIN deliveries x ON x.wave < w.wave GROUP BY w.wave) m ON m.wave = d.wave) marked) numbered", "deliveries")

REALTIME_NO_PT = with_ctes(
    f"SELECT {STREAM_COLS}, CAST(event_time AS DATE) AS order_date, "
    "date_trunc('hour', event_time) AS order_hour FROM landing WHERE order_id IS NOT NULL", "landing")

STAGE_ROW_COUNTS = with_ctes(
    " UNION ALL ".join(
        f"SELECT '{n}' AS dataset, '{stage}' AS stage, count(*) AS row_count FROM {cte}"
        for n in ("orders", "customers", "products", "order_items")
        for stage, cte in (("landed", f"raw_{n}"), ("cleaned", f"clean_{n}"))),
    "clean_orders", "clean_customers", "clean_products", "clean_order_items")


def rollup_sql(unit: str) -> str:
    """Closed windows only: those that end by the watermark, the highest
    landed time less ten minutes (whole milliseconds)."""
    return with_ctes(
        f"SELECT date_trunc('{unit}', event_time) AS period_start, count(*) AS orders, CAST(sum(quantity) AS BIGINT) AS quantity, "
        "CAST(sum(CAST(total_value AS DECIMAL(18,2))) AS DOUBLE) AS total_value FROM landing "
        f"GROUP BY date_trunc('{unit}', event_time) HAVING epoch_us(date_trunc('{unit}', event_time) + INTERVAL 1 {unit}) "
        "<= (SELECT (epoch_us(max(event_time)) // 1000) * 1000 - 600000000 FROM landing)", "landing")


PRODUCTS_TRANSLATED = with_ctes(
    "SELECT product_id, product_category, CASE WHEN length(product_category) % 5 = 0 OR product_category IN ('', 'unknown') "
    "THEN 'unknown' ELSE upper(product_category) END AS product_category_english FROM dim_products", "dim_products")

BATCH_LOAD_COUNTS = with_ctes(
    " UNION ALL ".join(f"SELECT '{n}' AS relation, count(*) AS row_count FROM {cte}" for n, cte in (
        *((t, f"clean_{t}") for t in ("orders", "customers", "products", "order_items")),
        *((m, m) for m in (*STAGING, *MARTS)))),
    "clean_orders", "clean_customers", "clean_products", "clean_order_items", *STAGING, *MARTS)
