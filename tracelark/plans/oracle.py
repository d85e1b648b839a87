"""The queries of the catalogue as SQL over the same tables, written for DuckDB.

Only common table expressions are shared; the results are derived from the
tables on their own, not from the library.
"""

from __future__ import annotations

from .catalogue import CHANNELS, MIN_FREQUENCY, NUMBERED, STORES


def _quoted(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


CTES = {
    "places": """
        SELECT c_custkey, n_name AS store_id, c_mktsegment AS channel
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "lines": """
        SELECT * EXCLUDE (copy) FROM (
            SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS copy
            FROM lineitem) WHERE copy = 1""",
    "order_events": """
        SELECT o_orderkey AS case_id, 'ORDER_PLACED' AS activity_name, o_orderdate AS event_ts,
               'ORDER' AS activity_category, 0 AS category_rank, '' AS event_key,
               o_orderstatus AS status, NULL AS line, NULL AS part, NULL AS supplier, NULL AS incident_id
        FROM orders
        UNION ALL
        SELECT o_orderkey, 'PAYMENT_APPLIED', o_orderdate + INTERVAL 1 DAY, 'PAYMENT', 3, '',
               NULL, NULL, NULL, NULL, NULL
        FROM orders WHERE o_orderpriority = '1-URGENT'
        UNION ALL
        SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'ORDER_FILLED' WHEN 'O' THEN 'ORDER_OPEN'
               ELSE 'ORDER_PARTIAL' END, last_ship, 'ORDER', 0, '', NULL, NULL, NULL, NULL, NULL
        FROM orders JOIN (SELECT l_orderkey, max(l_shipdate) AS last_ship FROM lines GROUP BY 1)
             ON o_orderkey = l_orderkey
        UNION ALL
        SELECT l_orderkey, CASE WHEN l_returnflag = 'R' THEN 'ITEM_RETURNED' WHEN l_linestatus = 'O' THEN 'ITEM_OPEN'
               ELSE 'ITEM_SHIPPED' END, l_shipdate, 'LINE', 1, l_linenumber::varchar,
               NULL, l_linenumber::varchar, l_partkey::varchar, l_suppkey::varchar, NULL
        FROM lines
        UNION ALL
        SELECT l_orderkey, 'RETURN_RAISED', l_shipdate, 'RETURN', 2, l_linenumber::varchar,
               NULL, NULL, NULL, NULL, l_linenumber::varchar
        FROM lines WHERE l_returnflag = 'R'
        UNION ALL
        SELECT l_orderkey, 'RETURN_RESOLVED', l_shipdate + to_days(l_linenumber), 'RETURN', 2, l_linenumber::varchar,
               NULL, NULL, NULL, NULL, l_linenumber::varchar
        FROM lines WHERE l_returnflag = 'R'""",
    "order_dims": """
        SELECT o_orderkey AS case_id, store_id, channel FROM orders LEFT JOIN places ON o_custkey = c_custkey""",
    "click_events": """
        SELECT user_id::varchar || '/' || ts::date::varchar AS case_id, event_type AS activity_name, ts AS event_ts,
               'CLICK' AS activity_category, 0 AS category_rank, event_id::varchar AS event_key, user_id
        FROM events""",
    "click_dims": """
        SELECT DISTINCT case_id, store_id, channel FROM click_events LEFT JOIN places ON user_id = c_custkey""",
    "user_events": """
        SELECT * REPLACE (user_id::varchar AS case_id) FROM click_events""",
    "user_dims": """
        SELECT DISTINCT case_id, store_id, channel FROM user_events LEFT JOIN places ON user_id = c_custkey""",
    # --- retail documents
    "transactions": """
        SELECT 'T' || o_orderkey AS transaction_id,
               'STR-00' || (o_custkey % 7 + 1) AS store_id,
               'STR-00' || (o_custkey % 7 + 1) || '-TERM-0' || (o_orderkey % 4 + 1) AS terminal_id,
               CASE WHEN o_orderkey % 3 = 0 THEN 'C' || (o_custkey % 50) END AS cashier_id,
               'CUST-' || o_custkey AS customer_id,
               CASE o_orderkey % 3 WHEN 0 THEN 'IN_STORE_ASSISTED' WHEN 1 THEN 'SELF_CHECKOUT' ELSE 'KIOSK' END AS channel,
               make_timestamp((1746057600000 + o_orderkey * 37000 + (o_orderkey * 7) % 1000) * 1000)
                   AS transaction_start_ts,
               make_timestamp((1746057600000 + o_orderkey * 37000 + (o_orderkey * 7) % 1000
                   + 45000 + (o_custkey % 30) * 1000) * 1000) AS transaction_end_ts,
               CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'SUSPENDED' ELSE 'VOIDED' END AS status,
               'USD' AS currency,
               round(o_totalprice, 2) AS subtotal_amount, 0::double AS discount_amount, 0::double AS tax_amount,
               round(o_totalprice, 2) AS total_amount, o_custkey % 10 AS item_count,
               o_orderkey, o_custkey
        FROM orders""",
    "items": """
        SELECT 'T' || l_orderkey AS transaction_id, 'LN-00' || l_linenumber AS line_id,
               l_linenumber::bigint AS sequence_number,
               make_timestamp((1746057600000 + l_orderkey * 37000 + (l_orderkey * 7) % 1000
                   + ((l_linenumber + 1) // 2) * 11000) * 1000) AS scan_ts,
               'SKU-' || l_partkey AS sku, 'Part ' || l_partkey AS item_name,
               CASE l_partkey % 4 WHEN 0 THEN 'Grocery' WHEN 1 THEN 'Electronics' WHEN 2 THEN 'Bakery'
                    ELSE 'Produce' END AS department,
               'C' || (l_partkey % 10) AS category,
               CASE l_suppkey % 6 WHEN 0 THEN 'BARCODE' WHEN 1 THEN 'QR_CODE' WHEN 2 THEN 'MANUAL_ENTRY'
                    WHEN 3 THEN 'WEIGHT_PLU' WHEN 4 THEN 'PLU_LOOKUP' ELSE 'RFID' END AS scan_method,
               l_quantity AS quantity, round(l_extendedprice, 2) AS unit_price, l_discount AS line_discount_amount,
               round(l_extendedprice, 2) AS extended_amount,
               l_returnflag = 'R' AS is_return, l_linenumber = 7 AS is_void,
               l_partkey, l_suppkey, l_linenumber
        FROM lines""",
    "incidents": """
        SELECT transaction_id, 'I' || l_linenumber AS incident_id, scan_ts AS incident_ts,
               CASE l_suppkey % 3 WHEN 0 THEN 'WEIGHT_SCAN_REQUIRED' WHEN 1 THEN 'PRICE_OVERRIDE'
                    ELSE 'MANAGER_APPROVAL_REQUIRED' END AS incident_type,
               line_id AS related_line_id,
               CASE WHEN l_suppkey % 5 <> 0 THEN 'APPROVED' END AS resolution,
               CASE WHEN l_suppkey % 5 <> 0 THEN scan_ts + to_milliseconds((l_partkey % 40) * 500) END AS resolution_ts,
               CASE WHEN l_suppkey % 5 <> 0 AND l_suppkey % 2 = 1 THEN 'MGR-' || (l_suppkey % 100) END AS resolved_by,
               CASE WHEN l_suppkey % 5 <> 0 THEN ((l_partkey % 40) * 500) // 1000 END AS duration_seconds
        FROM items WHERE is_return""",
    "tender": """
        SELECT transaction_id, 'P1' AS tender_id, transaction_end_ts AS tender_ts,
               CASE o_custkey % 3 WHEN 0 THEN 'CASH' WHEN 1 THEN 'CREDIT_CARD' ELSE 'COUPON' END AS tender_type,
               total_amount AS amount, CASE WHEN o_custkey % 3 = 1 THEN 'VISA' END AS card_brand
        FROM transactions WHERE status = 'COMPLETED'
        UNION ALL
        SELECT transaction_id, 'P2', transaction_end_ts - INTERVAL 2 SECOND, 'GIFT_CARD', 1::double, NULL
        FROM transactions WHERE status = 'COMPLETED' AND o_orderkey % 12 = 0""",
    "item_labels": """
        SELECT *, CASE WHEN is_void THEN 'ITEM_VOIDED' WHEN is_return THEN 'ITEM_RETURNED'
               WHEN scan_method = 'QR_CODE' THEN 'ITEM_SCANNED_QR_CODE'
               WHEN scan_method = 'MANUAL_ENTRY' THEN 'ITEM_ENTERED_MANUALLY'
               WHEN scan_method = 'WEIGHT_PLU' THEN 'ITEM_WEIGHED'
               WHEN scan_method = 'PLU_LOOKUP' THEN 'ITEM_LOOKED_UP'
               ELSE 'ITEM_SCANNED_BARCODE' END AS activity_name
        FROM items""",
    "retail_events": """
        SELECT transaction_id AS case_id, 'TRANSACTION_STARTED' AS activity_name, transaction_start_ts AS event_ts,
               cashier_id AS resource_id, 'TRANSACTION_LIFECYCLE' AS activity_category, 0 AS category_rank,
               '' AS event_key, NULL AS line_id, NULL AS incident_id
        FROM transactions
        UNION ALL
        SELECT transaction_id, 'TRANSACTION_' || status, transaction_end_ts, cashier_id, 'TRANSACTION_LIFECYCLE', 0,
               '', NULL, NULL
        FROM transactions
        UNION ALL
        SELECT transaction_id, activity_name, scan_ts, NULL, 'ITEM_SCAN', 1, line_id, line_id, NULL FROM item_labels
        UNION ALL
        SELECT transaction_id, incident_type || '_RAISED', incident_ts, NULL, 'INCIDENT', 2, incident_id, NULL,
               incident_id
        FROM incidents
        UNION ALL
        SELECT transaction_id, incident_type || '_RESOLVED', resolution_ts, resolved_by, 'INCIDENT', 2, incident_id,
               NULL, incident_id
        FROM incidents WHERE resolution_ts IS NOT NULL
        UNION ALL
        SELECT transaction_id, 'TENDER_APPLIED', tender_ts, NULL, 'PAYMENT', 3, tender_id, NULL, NULL FROM tender""",
    "retail_dims": """
        SELECT transaction_id AS case_id, store_id, channel FROM transactions""",
}

#: Which expressions a name needs, in order.
NEEDS = {
    "order": ["places", "lines", "order_events", "order_dims"],
    "click": ["places", "click_events", "click_dims"],
    "user": ["places", "click_events", "user_events", "user_dims"],
    "retail": ["lines", "transactions", "items", "incidents", "tender", "item_labels", "retail_events", "retail_dims"],
}


def _log(kind: str) -> dict[str, str]:
    """Numbered log with successor, end flag and dimensions."""
    expressions = {name: CTES[name] for name in NEEDS[kind]}
    expressions["log"] = f"""
        SELECT e.*, store_id, channel,
               row_number() OVER w AS event_sequence,
               lead(activity_name) OVER w AS next_activity,
               lead(event_ts) OVER w AS next_ts,
               row_number() OVER w = count(*) OVER (PARTITION BY e.case_id) AS is_end
        FROM {kind}_events e LEFT JOIN {kind}_dims d ON e.case_id = d.case_id
        WINDOW w AS (PARTITION BY e.case_id
                     ORDER BY event_ts NULLS FIRST, category_rank, activity_name, event_key)"""
    return expressions


def _seconds(ts: str) -> str:
    return f"(epoch_us({ts}) // 1000000 * 1000)"


def _millis(ts: str) -> str:
    return f"(epoch_us({ts}) // 1000)"


def _edge_stats(keys: str) -> str:
    group = f"{keys}, source_activity, target_activity" if keys else "source_activity, target_activity"
    return f"""
        SELECT {group}, count(*)::bigint AS edge_frequency, count(DISTINCT case_id)::bigint AS case_count,
               round(avg(duration_ms), 4) AS avg_transition_duration_ms,
               min(duration_ms)::bigint AS min_transition_duration_ms,
               max(duration_ms)::bigint AS max_transition_duration_ms,
               quantile_disc(duration_ms, 0.5)::bigint AS p50_transition_duration_ms,
               quantile_disc(duration_ms, 0.95)::bigint AS p95_transition_duration_ms
        FROM observed GROUP BY {group}"""


def _graph(kind: str, epoch=_seconds, pair_by_id: bool = False) -> dict[str, str]:
    """Observations, edges, durations and nodes of a log."""
    expressions = _log(kind)
    expressions["observed"] = f"""
        SELECT case_id, store_id, channel, activity_name AS source_activity, next_activity AS target_activity,
               {epoch('next_ts')} - {epoch('event_ts')} AS duration_ms
        FROM log WHERE next_activity IS NOT NULL"""
    expressions["edges"] = _edge_stats("store_id, channel")
    same_id = "AND a.incident_id = b.incident_id" if pair_by_id else ""
    expressions["spans"] = f"""
        SELECT a.store_id, a.channel, a.activity_name,
               avg({epoch('b.event_ts')} - {epoch('a.event_ts')}) AS avg_activity_duration_ms
        FROM log a JOIN log b ON a.case_id = b.case_id {same_id}
             AND a.activity_name LIKE '%\\_RAISED' ESCAPE '\\' AND b.activity_name LIKE '%\\_RESOLVED' ESCAPE '\\'
             AND regexp_replace(a.activity_name, '_RAISED$', '') = regexp_replace(b.activity_name, '_RESOLVED$', '')
        GROUP BY 1, 2, 3"""
    expressions["nodes"] = """
        SELECT n.activity_name, n.store_id, n.channel, occurrence_count, case_count,
               (sum(starts) OVER same)::bigint AS start_count, (sum(ends) OVER same)::bigint AS end_count,
               round(avg_activity_duration_ms, 4) AS avg_activity_duration_ms, activity_category
        FROM (SELECT activity_name, activity_category, store_id, channel, count(*)::bigint AS occurrence_count,
                     count(DISTINCT case_id)::bigint AS case_count,
                     count(*) FILTER (event_sequence = 1) AS starts, count(*) FILTER (is_end) AS ends
              FROM log GROUP BY 1, 2, 3, 4) n
        LEFT JOIN spans s ON n.activity_name = s.activity_name AND n.store_id IS NOT DISTINCT FROM s.store_id
             AND n.channel IS NOT DISTINCT FROM s.channel
        WINDOW same AS (PARTITION BY n.activity_name, n.store_id, n.channel)"""
    return expressions


def _rollup(where: str = "") -> str:
    return f"""
        SELECT source_activity, target_activity, sum(edge_frequency)::bigint AS edge_frequency,
               sum(case_count)::bigint AS case_count,
               round(avg(avg_transition_duration_ms), 4) AS avg_transition_duration_ms,
               min(min_transition_duration_ms)::bigint AS min_transition_duration_ms,
               max(max_transition_duration_ms)::bigint AS max_transition_duration_ms,
               round(avg(p50_transition_duration_ms), 4) AS p50_transition_duration_ms,
               round(avg(p95_transition_duration_ms), 4) AS p95_transition_duration_ms
        FROM edges {where} GROUP BY 1, 2"""


def _node_rollup(where: str = "") -> str:
    return f"""
        SELECT activity_name, activity_category, sum(occurrence_count)::bigint AS occurrence_count,
               sum(case_count)::bigint AS case_count, sum(start_count)::bigint AS start_count,
               sum(end_count)::bigint AS end_count,
               round(avg(coalesce(avg_activity_duration_ms, 0)), 4) AS avg_activity_duration_ms
        FROM nodes {where} GROUP BY 1, 2"""


def _totals(kind: str = "order") -> dict[str, str]:
    return {**_graph(kind), "edge_totals": _rollup(), "node_totals": _node_rollup()}


def _title(column: str) -> str:
    words = f"string_split(lower(replace({column}, '_', ' ')), ' ')"
    return f"array_to_string(list_transform({words}, lambda w: upper(w[1:1]) || w[2:]), ' ')"


def _duration(column: str) -> str:
    whole = f"({column} // 1000)"
    return (
        f"CASE WHEN {column} IS NULL THEN '—' WHEN {column} < 60000 THEN printf('%.1fs', {column} / 1000.0) "
        f"ELSE {whole} // 60 || 'm ' || {whole} % 60 || 's' END"
    )


def _with(expressions: dict[str, str], select: str) -> str:
    parts = ",\n".join(f"{name} AS ({body})" for name, body in expressions.items())
    return f"WITH {parts}\n{select}" if parts else select


def _tables(*names: str) -> dict[str, str]:
    """The typed retail tables needed for the named ones."""
    wanted = NEEDS["retail"]
    last = max(wanted.index(name) for name in names)
    return {name: CTES[name] for name in wanted[: last + 1]}


def all_sql() -> dict[str, str]:
    order, click, user, retail = _graph("order"), _graph("click"), _graph("user", _millis), _graph("retail")
    totals = _totals()
    dims_where = f"WHERE store_id IN ({_quoted(STORES)}) AND channel IN ({_quoted(CHANNELS)})"
    loop = "source_activity = target_activity"
    width = (
        "CASE WHEN (SELECT max(edge_frequency) FROM edge_totals) = 0 THEN 2.0 ELSE "
        "round(1 + sqrt(edge_frequency / (SELECT max(edge_frequency) FROM edge_totals)) * 11, 1) END"
    )
    edge_label = "format('{:,}', edge_frequency)"
    edge_id = "source_activity || '→' || target_activity"
    money = "decimal(12,2)"
    sales = {
        "lines": CTES["lines"],
        "priced": f"""
            SELECT l_orderkey AS transaction_id, l_partkey AS sku, p_type AS department,
                   l_extendedprice::{money} AS extended_amount, l_discount::{money} AS line_discount_amount,
                   l_linenumber = 7 AS is_void, l_returnflag = 'R' AS is_return
            FROM lines LEFT JOIN (SELECT p_partkey, min(p_type) AS p_type FROM part GROUP BY 1) ON l_partkey = p_partkey""",
        "sums": f"""
            SELECT transaction_id,
                   coalesce(sum(extended_amount) FILTER (NOT is_void), 0) AS subtotal,
                   coalesce(sum(line_discount_amount) FILTER (NOT is_void), 0) AS discount,
                   round(coalesce(sum(extended_amount) FILTER (NOT is_void AND department IN ('ECONOMY', 'SMALL')), 0)
                         * 0.0825::decimal(6,4), 2) AS tax,
                   count(*) FILTER (NOT is_void AND NOT is_return) AS items
            FROM priced GROUP BY 1""",
    }
    broken = {
        "valid_order": "l_orderkey IS NULL",
        "known_shipdate": "NOT coalesce(l_shipdate >= timestamp '1996-01-01', false)",
        "small_discount": "NOT coalesce(l_discount < 0.09, false)",
        "non_negative_tax": "NOT coalesce(l_tax >= 0, false)",
        "small_quantity": "NOT coalesce(nullif(l_quantity, 13) <= 45, false)",
    }
    warn = ("non_negative_tax", "small_quantity")
    drops = [name for name in broken if name not in warn]

    def counted(table: str, rules: dict[str, tuple[str, str]]) -> str:
        return " UNION ALL ".join(
            f"SELECT '{rule}' AS rule, '{action}' AS action, count(*) FILTER (NOT coalesce({holds}, false))::bigint"
            f" AS violations, '{table}' AS table_name FROM {table}"
            for rule, (action, holds) in rules.items()
        )

    has_id = ("drop", "transaction_id IS NOT NULL")
    retail_rules = {
        "transactions": {
            "valid_transaction_id": has_id,
            "valid_start_ts": ("drop", "transaction_start_ts IS NOT NULL"),
            "non_negative_total": ("warn", "total_amount >= 0"),
            "end_after_start": ("warn", "transaction_end_ts >= transaction_start_ts"),
        },
        "items": {
            "valid_transaction_id": has_id,
            "valid_line_id": ("drop", "line_id IS NOT NULL"),
            "valid_sku": ("drop", "sku IS NOT NULL"),
            "valid_scan_ts": ("drop", "scan_ts IS NOT NULL"),
            "non_negative_quantity": ("warn", "quantity >= 0"),
            "non_negative_unit_price": ("warn", "unit_price >= 0"),
        },
        "incidents": {
            "valid_transaction_id": has_id,
            "valid_incident_id": ("drop", "incident_id IS NOT NULL"),
            "valid_incident_ts": ("drop", "incident_ts IS NOT NULL"),
            "resolution_after_incident": ("warn", "resolution_ts >= incident_ts OR resolution_ts IS NULL"),
            "non_negative_duration": ("warn", "duration_seconds >= 0 OR duration_seconds IS NULL"),
        },
        "tender": {
            "valid_transaction_id": has_id,
            "valid_tender_id": ("drop", "tender_id IS NOT NULL"),
            "valid_tender_ts": ("drop", "tender_ts IS NOT NULL"),
            "valid_tender_type": ("drop", "tender_type IS NOT NULL"),
            "positive_amount": ("warn", "amount > 0"),
        },
    }

    faulty = {
        **_tables("tender"),
        "faulty_transactions": """SELECT * REPLACE (CASE WHEN terminal_id <> 'STR-007-TERM-01' THEN transaction_start_ts END
            AS transaction_start_ts) FROM transactions""",
        "faulty_items": """SELECT * REPLACE (CASE WHEN l_partkey % 10 <> 7 THEN sku END AS sku,
            CASE WHEN quantity = 5 THEN -5 ELSE quantity END AS quantity) FROM items""",
        "faulty_incidents": "SELECT * FROM incidents",
        "faulty_tender": """SELECT * REPLACE (CASE WHEN tender_type <> 'COUPON' THEN tender_type END AS tender_type,
            CASE WHEN tender_id = 'P2' THEN 0 ELSE amount END AS amount) FROM tender""",
    }

    def shares(table: str, column: str) -> str:
        return (
            f"SELECT '{column}' AS dimension, {column} AS value, count(*)::bigint AS n, "
            f"round(count(*) / sum(count(*)) OVER (), 4) AS share FROM {table} GROUP BY {column}"
        )

    def variant_sql(k: int) -> str:
        return f"""
            SELECT variant, count(*)::bigint AS case_count
            FROM (SELECT case_id, string_agg(activity_name, ' → ' ORDER BY event_sequence) AS variant
                  FROM log GROUP BY 1)
            GROUP BY 1 ORDER BY case_count DESC, min(case_id) LIMIT {k}"""

    def weighted(name: str, weight: str) -> str:
        return f"round(sum({name} * {weight}) / sum({weight}) FILTER ({name} IS NOT NULL), 4) AS {name}"

    def from_events(cases: str = "") -> str:
        """Nodes over all stores and channels, with the mean over all raised and resolved pairs of a case."""
        return f"""SELECT n.activity_name, n.activity_category, count(*)::bigint AS occurrence_count, {cases}
            count(*) FILTER (event_sequence = 1)::bigint AS start_count, count(*) FILTER (is_end)::bigint AS end_count,
            round(any_value(avg_activity_duration_ms), 4) AS avg_activity_duration_ms
            FROM log n LEFT JOIN (
                SELECT a.activity_name, avg({_seconds('b.event_ts')} - {_seconds('a.event_ts')}) AS avg_activity_duration_ms
                FROM log a JOIN log b ON a.case_id = b.case_id AND a.activity_name LIKE '%#_RAISED' ESCAPE '#'
                    AND b.activity_name = left(a.activity_name, -7) || '_RESOLVED' GROUP BY 1) s ON n.activity_name = s.activity_name
            GROUP BY n.activity_name, n.activity_category"""

    header_columns = (
        "transaction_id, store_id, terminal_id, cashier_id, customer_id, channel, transaction_start_ts, "
        "transaction_end_ts, status, currency, subtotal_amount, discount_amount, tax_amount, total_amount, item_count"
    )
    exact = {**_graph("order")}
    exact_filtered = {**_log("order")}
    exact_filtered["observed"] = order["observed"] + dims_where.replace("WHERE", " AND")
    payload = "'{\"o_orderkey\":' || o_orderkey || ',\"o_custkey\":' || o_custkey || ',\"o_orderstatus\":\"' || o_orderstatus || '\"}'"
    loaded_edges = "SELECT * FROM edges"
    step_label = (
        "CASE WHEN step >= 1000000 THEN (step // 1000000) || 'M' WHEN step >= 1000 THEN (step // 1000) || 'k' "
        "ELSE step::varchar END"
    )
    return {
        "raw_ingest": f"""SELECT raw_json, 'POS_SYSTEM' AS source_system, sha256(raw_json) AS record_hash,
            true AS has_path, true AS file_before_ingest, true AS has_batch FROM (SELECT {payload} AS raw_json FROM orders)""",
        "parse_headers": _with(_tables("transactions"), f"SELECT {header_columns} FROM transactions"),
        "unique_records": "SELECT DISTINCT props AS raw_json, sha256(props) AS record_hash FROM events",
        "parse_props": "SELECT event_id, json_extract(props, '$.k')::bigint AS k FROM events",
        "explode_items": _with(_tables("items"), "SELECT * EXCLUDE (l_partkey, l_suppkey, l_linenumber) FROM items"),
        "explode_incidents": _with(_tables("incidents"), "SELECT * FROM incidents"),
        "explode_tender": _with(_tables("tender"), "SELECT * FROM tender"),
        "dedup_batch": _with({"lines": CTES["lines"]}, "SELECT * REPLACE (l_linenumber::bigint AS l_linenumber) FROM lines"),
        "dedup_stream_forever": "SELECT DISTINCT user_id, event_type FROM events",
        "dedup_stream_payload": """SELECT user_id, event_type, event_id, ts FROM events
            QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) = 1""",
        "dedup_stream_payload_watermark": """SELECT user_id, event_type, date_trunc('hour', ts) AS hour, event_id, ts FROM events
            QUALIFY row_number() OVER (PARTITION BY user_id, event_type, date_trunc('hour', ts) ORDER BY event_id) = 1""",
        "dedup_stream_watermark": "SELECT DISTINCT user_id, event_type, date_trunc('hour', ts) AS hour FROM events",
        "dq_counts": " UNION ALL ".join(
            f"SELECT '{rule}' AS rule, '{'warn' if rule in warn else 'drop'}' AS action, "
            f"count(*) FILTER ({test})::bigint AS violations FROM lineitem"
            for rule, test in broken.items()
        ),
        "dq_counts_retail": _with(
            _tables("tender"), " UNION ALL ".join(counted(table, rules) for table, rules in retail_rules.items())
        ),
        "dq_clean": "SELECT l_orderkey, l_linenumber::bigint AS l_linenumber, l_shipdate, l_discount FROM lineitem WHERE "
        + " AND ".join(f"NOT ({broken[name]})" for name in drops),
        "dq_quarantine": "SELECT l_orderkey, l_linenumber::bigint AS l_linenumber, l_shipdate, l_discount, "
        + "concat_ws(',', "
        + ", ".join(f"CASE WHEN {broken[name]} THEN '{name}' END" for name in drops)
        + ") AS broken_rules FROM lineitem WHERE "
        + " OR ".join(f"({broken[name]})" for name in drops),
        "lifecycle_events": _with(
            _tables("transactions"),
            """
            SELECT transaction_id AS case_id, 'TRANSACTION_STARTED' AS activity_name, transaction_start_ts AS event_ts,
                   cashier_id AS resource_id, 'TRANSACTION_LIFECYCLE' AS activity_category, store_id AS attr_store_id,
                   terminal_id AS attr_terminal_id, channel AS attr_channel, currency AS attr_currency,
                   NULL::varchar AS attr_status, NULL::varchar AS attr_total_amount, NULL::varchar AS attr_item_count
            FROM transactions
            UNION ALL
            SELECT transaction_id, 'TRANSACTION_' || status, transaction_end_ts, cashier_id, 'TRANSACTION_LIFECYCLE',
                   store_id, NULL, NULL, NULL, status, total_amount::decimal(12,2)::varchar, item_count::varchar
            FROM transactions""",
        ),
        "item_events": _with(
            _tables("item_labels"),
            """
            SELECT transaction_id AS case_id, activity_name, scan_ts AS event_ts, NULL::varchar AS resource_id,
                   'ITEM_SCAN' AS activity_category, sku AS attr_sku, item_name AS attr_item_name,
                   department AS attr_department, category AS attr_category, scan_method AS attr_scan_method,
                   quantity::decimal(10,3)::varchar AS attr_quantity, unit_price::decimal(12,2)::varchar AS attr_unit_price,
                   line_id AS attr_line_id
            FROM item_labels""",
        ),
        "incident_events": _with(
            _tables("incidents"),
            """
            SELECT transaction_id AS case_id, incident_type || '_RAISED' AS activity_name, incident_ts AS event_ts,
                   NULL::varchar AS resource_id, 'INCIDENT' AS activity_category, incident_id AS attr_incident_id,
                   incident_type AS attr_incident_type, related_line_id AS attr_related_line_id,
                   NULL::varchar AS attr_resolution, NULL::varchar AS attr_duration_seconds
            FROM incidents
            UNION ALL
            SELECT transaction_id, incident_type || '_RESOLVED', resolution_ts, resolved_by, 'INCIDENT', incident_id,
                   incident_type, NULL, resolution, duration_seconds::varchar
            FROM incidents WHERE resolution_ts IS NOT NULL""",
        ),
        "tender_events": _with(
            _tables("tender"),
            """
            SELECT transaction_id AS case_id, 'TENDER_APPLIED' AS activity_name, tender_ts AS event_ts,
                   NULL::varchar AS resource_id, 'PAYMENT' AS activity_category, tender_type AS attr_tender_type,
                   amount::decimal(12,2)::varchar AS attr_amount, card_brand AS attr_card_brand,
                   tender_id AS attr_tender_id
            FROM tender""",
        ),
        "event_log": _with(
            _log("order"), "SELECT case_id, activity_name, event_ts, activity_category, event_sequence FROM log"
        ),
        "event_log_attrs": _with(
            _log("order"),
            "SELECT case_id, event_sequence, activity_name, status, line, part, supplier, incident_id FROM log",
        ),
        "retail_event_log": _with(
            _log("retail"),
            "SELECT case_id, activity_name, event_ts, resource_id, activity_category, event_sequence, line_id, "
            "store_id, channel FROM log",
        ),
        "stream_pipeline_log": _with(
            _log("retail"),
            "SELECT case_id, activity_name, event_ts, resource_id, activity_category, event_sequence, line_id, "
            "store_id, channel FROM log",
        ),
        "stream_retail_events": _with(
            _log("retail"), "SELECT case_id, activity_name, event_ts, resource_id, activity_category FROM log"
        ),
        "late_rows": """SELECT event_id, ts FROM events WHERE event_id % 5 <> 0
            OR ts > (SELECT max(ts) FROM events WHERE event_id % 5 IN (1, 2)) - INTERVAL 1 HOUR""",
        "late_rows_aside": """SELECT event_id, ts,
            CASE WHEN ts <= mark THEN (epoch_us(mark) - epoch_us(ts)) // 1000 END AS lag_ms FROM (
            SELECT *, make_timestamp(((SELECT max(epoch_us(ts)) FROM events x WHERE x.event_id % 5 <> 0 AND (e.event_id % 5 = 0
                OR x.event_id % 5 < 3)) // 1000 - 3600000) * 1000) AS mark FROM events e WHERE event_id % 5 NOT IN (1, 2)
            UNION ALL SELECT *, NULL FROM events WHERE event_id % 5 IN (1, 2))""",
        "files_per_trigger": "SELECT count(*) AS rows, true AS within, true AS no_batch_more FROM orders",
        "parse_once_tables": _with(
            _tables("tender"),
            """SELECT 'silver_transactions' AS table_name, transaction_id, customer_id AS part_id, transaction_end_ts AS at,
                status AS what, total_amount::double AS number FROM transactions
            UNION ALL SELECT 'silver_transaction_items', transaction_id, line_id, scan_ts, scan_method, quantity FROM items
            UNION ALL SELECT 'silver_transaction_incidents', transaction_id, incident_id, resolution_ts, incident_type, duration_seconds
            FROM incidents
            UNION ALL SELECT 'silver_transaction_tender', transaction_id, tender_id, tender_ts, tender_type, amount FROM tender""",
        ),
        "stream_rule_counts": _with(
            faulty,
            " UNION ALL ".join(
                f"SELECT 'silver_{name}' AS table_name, '{rule}' AS rule, '{action}' AS action, "
                f"count(*) FILTER (NOT coalesce({holds}, false))::bigint AS violations FROM faulty_{table}"
                for table, name in (
                    ("transactions", "transactions"),
                    ("items", "transaction_items"),
                    ("incidents", "transaction_incidents"),
                    ("tender", "transaction_tender"),
                )
                for rule, (action, holds) in {
                    **retail_rules[table],
                    "rows": ("all", "false"),
                    "quarantined": (
                        "quarantined",
                        " AND ".join(f"coalesce({h}, false)" for a, h in retail_rules[table].values() if a == "drop"),
                    ),
                }.items()
            ),
        ),
        "stream_quarantine": _with(
            faulty,
            """SELECT 'silver_transactions' AS table_name, transaction_id, customer_id AS part_id, 'valid_start_ts' AS broken_rules
                FROM faulty_transactions WHERE transaction_start_ts IS NULL
            UNION ALL SELECT 'silver_transaction_items', transaction_id, line_id, 'valid_sku' FROM faulty_items WHERE sku IS NULL
            UNION ALL SELECT 'silver_transaction_tender', transaction_id, tender_id, 'valid_tender_type'
                FROM faulty_tender WHERE tender_type IS NULL""",
        ),
        "dedup_lasting": """SELECT user_id, event_type, event_id, ts, event_id % 5 AS batch FROM events
            QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id % 5, event_id) = 1""",
        "layout_clustered": _with(order, "SELECT * FROM edges WHERE channel = 'BUILDING'"),
        "pipeline_reset": "SELECT g AS generation, o_orderkey FROM orders, (VALUES ('g0'), ('g1')) t(g)",
        "numbers_from_text": """SELECT l_orderkey, l_linenumber::bigint AS l_linenumber, q AS whole, q::double AS part FROM (
            SELECT *, CASE WHEN l_quantity::int % 7 = 0 OR l_quantity::int % 11 = 0 THEN 0 ELSE l_quantity::int END::bigint AS q
            FROM lineitem)""",
        "stream_event_log": _with(
            {"click_events": CTES["click_events"]},
            "SELECT case_id, activity_name, event_ts, user_id::varchar AS resource_id, event_key, "
            "category_rank::bigint AS category_rank FROM click_events",
        ),
        "stream_numbered_log": _with(
            {
                **_log("click"),
                "complete": f"""SELECT case_id FROM click_events GROUP BY case_id HAVING max(event_ts) + INTERVAL {NUMBERED['gap']}
                    < (SELECT max(event_ts) FROM click_events) - INTERVAL {NUMBERED['delay']}""",
            },
            """SELECT case_id, activity_name, event_ts, l.user_id::varchar AS resource_id, event_sequence, e.props
                FROM log l JOIN events e ON l.event_key = e.event_id::varchar WHERE case_id IN (SELECT case_id FROM complete)""",
        ),
        "increment_edges": _with(order, "SELECT * FROM edges"),
        "increment_nodes": _with(order, "SELECT * FROM nodes"),
        "increment_log": _with(
            _log("order"),
            "SELECT case_id, activity_name, event_ts, event_sequence, next_activity, is_end, store_id, channel FROM log",
        ),
        "stream_pipeline": _with(retail, "SELECT * FROM edges"),
        "edge_observations": _with(click, "SELECT * FROM observed"),
        "dfg_edges": _with(order, "SELECT * FROM edges"),
        "dfg_edges_click": _with(click, "SELECT * FROM edges"),
        "dfg_edges_milli": _with(user, "SELECT * FROM edges"),
        "retail_dfg_edges": _with(retail, "SELECT * FROM edges"),
        "start_activities": _with(
            order,
            "SELECT activity_name, store_id, channel, count(*)::bigint AS start_count FROM log "
            "WHERE event_sequence = 1 GROUP BY 1, 2, 3",
        ),
        "end_activities": _with(
            order,
            "SELECT activity_name, store_id, channel, count(*)::bigint AS end_count FROM log WHERE is_end GROUP BY 1, 2, 3",
        ),
        "node_occurrences": _with(
            click,
            "SELECT activity_name, activity_category, store_id, channel, occurrence_count, case_count, start_count, "
            "end_count FROM nodes",
        ),
        "incident_duration": _with(
            order,
            "SELECT store_id, channel, activity_name, round(avg_activity_duration_ms, 4) AS avg_activity_duration_ms FROM spans",
        ),
        "incident_duration_paired": _with(
            _graph("order", pair_by_id=True),
            "SELECT store_id, channel, activity_name, round(avg_activity_duration_ms, 4) AS avg_activity_duration_ms FROM spans",
        ),
        "dfg_nodes": _with(order, "SELECT * FROM nodes"),
        "retail_dfg_nodes": _with(retail, "SELECT * FROM nodes"),
        "stream_pipeline_nodes": _with(retail, "SELECT * FROM nodes"),
        "retail_dfg_nodes_paired": _with(_graph("retail", _millis, pair_by_id=True), "SELECT * FROM nodes"),
        "layout_pruned": _with(order, "SELECT * FROM edges WHERE store_id = 'NATION_3' AND channel = 'BUILDING'"),
        "ordered_edges": _with(order, loaded_edges),
        "ordered_nodes": _with(
            order,
            "SELECT * REPLACE (coalesce(avg_activity_duration_ms, 0) AS avg_activity_duration_ms) FROM nodes",
        ),
        "edge_rollup": _with(order, _rollup()),
        "node_rollup": _with(order, _node_rollup()),
        "rollup_filtered": _with(order, _rollup(dims_where)),
        "node_rollup_filtered": _with(order, _node_rollup(f"WHERE store_id IN ({_quoted(STORES)})")),
        "edge_rollup_weighted": _with(
            order,
            f"""SELECT source_activity, target_activity, sum(edge_frequency)::bigint AS edge_frequency,
                sum(case_count)::bigint AS case_count, {weighted('avg_transition_duration_ms', 'edge_frequency')},
                min(min_transition_duration_ms)::bigint AS min_transition_duration_ms,
                max(max_transition_duration_ms)::bigint AS max_transition_duration_ms,
                {weighted('p50_transition_duration_ms', 'edge_frequency')},
                {weighted('p95_transition_duration_ms', 'edge_frequency')} FROM edges GROUP BY 1, 2""",
        ),
        "node_rollup_weighted": _with(order, from_events("count(DISTINCT case_id)::bigint AS case_count,")),
        "node_rollup_weighted_retail": _with(retail, from_events()),
        "edge_rollup_sketch": _with(
            exact,
            f"""SELECT source_activity, target_activity, edge_frequency, case_count, avg_transition_duration_ms,
                min_transition_duration_ms, max_transition_duration_ms, true AS p50_within, true AS p95_within
                FROM ({_edge_stats('')}), (SELECT 1)""",
        ),
        "edge_rollup_exact": _with(exact, _edge_stats("")),
        "edge_rollup_exact_filtered": _with(exact_filtered, _edge_stats("")),
        "node_rollup_exact": _with(order, from_events("count(DISTINCT case_id)::bigint AS case_count,")),
        "dfg_subgraph_nodes": _with(
            {**totals, "kept": f"SELECT * FROM edge_totals WHERE edge_frequency >= {MIN_FREQUENCY}"},
            f"""SELECT n.*, coalesce(activity_name IN (SELECT source_activity FROM kept WHERE {loop}), false) AS has_self_loop,
                start_count > 0 AS is_start, end_count > 0 AS is_end, {_title('activity_name')} AS node_label
                FROM node_totals n
                WHERE activity_name IN (SELECT source_activity FROM kept UNION SELECT target_activity FROM kept)
                   OR start_count > 0 OR end_count > 0""",
        ),
        "dfg_subgraph_edges": _with(
            totals,
            f"SELECT *, {edge_id} AS edge_id, {edge_label} AS edge_label, {width} AS width, {loop} AS is_self_loop "
            f"FROM edge_totals WHERE edge_frequency >= {MIN_FREQUENCY}",
        ),
        "self_loops": _with(totals, f"SELECT DISTINCT source_activity AS activity_name FROM edge_totals WHERE {loop}"),
        "edge_weights": _with(
            totals,
            f"SELECT source_activity, target_activity, {edge_id} AS edge_id, {edge_label} AS edge_label, "
            f"{width} AS width, {loop} AS is_self_loop FROM edge_totals",
        ),
        "outgoing_share": _with(
            totals,
            f"SELECT source_activity, target_activity, edge_frequency, case_count, "
            f"round(edge_frequency / sum(edge_frequency) OVER (PARTITION BY source_activity) * 100, 4) AS outgoing_percent, "
            f"{loop} AS is_self_loop FROM edge_totals",
        ),
        "out_degree": _with(
            totals,
            "SELECT source_activity AS activity_name, count(*)::bigint AS out_degree FROM edge_totals GROUP BY 1",
        ),
        "successor_rows": _with(
            totals,
            """SELECT source_activity AS activity_name, target_activity AS successor FROM edge_totals
               UNION SELECT source_activity, source_activity FROM edge_totals""",
        ),
        "successors": _with(
            totals,
            """SELECT activity_name, string_agg(successor, ',' ORDER BY successor) AS successors FROM (
                SELECT source_activity AS activity_name, target_activity AS successor FROM edge_totals
                UNION SELECT source_activity, source_activity FROM edge_totals) GROUP BY 1""",
        ),
        "dim_values": _with(
            order,
            f"""SELECT DISTINCT 'store_id' AS dimension, store_id AS value, store_id AS label FROM nodes
                WHERE store_id IS NOT NULL
                UNION ALL SELECT DISTINCT 'channel', channel, {_title('channel')} FROM nodes WHERE channel IS NOT NULL""",
        ),
        "graph_summary": _with(
            order,
            """SELECT count(DISTINCT activity_name)::bigint AS activities,
                (SELECT count(*) FROM (SELECT DISTINCT source_activity, target_activity FROM edges))::bigint AS edge_types,
                count(DISTINCT store_id)::bigint AS stores, count(DISTINCT channel)::bigint AS channels FROM nodes""",
        ),
        "freq_steps": _with(
            {
                **totals,
                "steps": "SELECT 0::bigint AS step UNION ALL SELECT (2 ** i)::bigint FROM range(19) AS r(i)",
            },
            f"""SELECT step, (SELECT count(*) FROM edge_totals WHERE edge_frequency >= step)::bigint AS edges_kept,
                {step_label} AS label
                FROM steps WHERE step <= (SELECT coalesce(max(edge_frequency), 0) FROM edge_totals)""",
        ),
        "label_format": _with(
            _totals("click"),
            f"""SELECT {_title('source_activity')} AS source_label, {_title('target_activity')} AS target_label,
                {edge_label} AS frequency_label, {_duration('min_transition_duration_ms')} AS shortest,
                {_duration('max_transition_duration_ms')} AS longest FROM edge_totals""",
        ),
        "variants_top": _with(_log("click"), variant_sql(10)),
        "variants_top_orders": _with(_log("order"), variant_sql(25)),
        "variant_steps": _with(
            {
                **_log("order"),
                "spelled": "SELECT case_id, string_agg(activity_name, ' → ' ORDER BY event_sequence) AS variant FROM log GROUP BY 1",
                "best": """SELECT min(case_id) AS first_case, count(*)::bigint AS case_count,
                    row_number() OVER (ORDER BY count(*) DESC, min(case_id)) AS rank
                    FROM spelled GROUP BY variant ORDER BY rank LIMIT 25""",
            },
            "SELECT rank, event_sequence AS position, activity_name, case_count FROM log JOIN best ON case_id = first_case",
        ),
        "v1_order": _with(
            _log("order"),
            """SELECT case_id, (count(*) FILTER (gap < INTERVAL 0 SECOND))::bigint AS violations FROM (
                SELECT case_id, lead(event_ts) OVER (PARTITION BY case_id ORDER BY event_sequence) - event_ts AS gap FROM log)
                GROUP BY case_id HAVING violations > 0""",
        ),
        "v1_order_wrong": """SELECT case_id, count(*)::bigint AS violations FROM (
                SELECT event_id % 97 AS case_id, ts, lag(ts) OVER (PARTITION BY event_id % 97
                    ORDER BY reverse(lpad(event_id::varchar, 18, '0'))::bigint) AS prev_ts FROM events)
                WHERE ts < prev_ts GROUP BY 1""",
        "v2_labels": _with(
            _log("order"),
            "SELECT activity_name, activity_category, count(*)::bigint AS occurrences FROM log GROUP BY 1, 2",
        ),
        "v3_edges": _with(
            order,
            """SELECT sum(edge_frequency)::bigint AS total_edge_obs, any_value(expected_obs)::bigint AS expected_obs
                FROM edges, (SELECT sum(events - 1) AS expected_obs FROM (SELECT count(*) AS events FROM log GROUP BY case_id))""",
        ),
        "v4_starts_ends": _with(
            order,
            """SELECT total_starts::bigint AS total_starts, total_ends::bigint AS total_ends, total_cases::bigint AS total_cases
                FROM (SELECT sum(start_count) AS total_starts, sum(end_count) AS total_ends FROM nodes),
                     (SELECT count(DISTINCT case_id) AS total_cases FROM log)""",
        ),
        "v5_dims": _with(
            order,
            """SELECT store_id, channel, count(DISTINCT activity_name)::bigint AS activities,
                sum(occurrence_count)::bigint AS total_occurrences FROM nodes GROUP BY 1, 2""",
        ),
        "product_lookup": _with(
            sales, "SELECT transaction_id, sku, department, extended_amount::double AS extended_amount FROM priced"
        ),
        "reconcile_totals": _with(
            sales,
            """SELECT o_orderkey AS transaction_id,
                (o_totalprice::decimal(12,2) - coalesce(subtotal, 0))::double AS subtotal_difference,
                (0 - coalesce(discount, 0))::double AS discount_difference,
                (0 - coalesce(tax, 0))::double AS tax_difference,
                (o_totalprice::decimal(12,2) - greatest(coalesce(round(subtotal + tax, 2), 0), 0))::double AS total_difference,
                (0 - coalesce(items, 0))::bigint AS items_difference
                FROM orders LEFT JOIN sums ON o_orderkey = transaction_id""",
        ),
        "distribution": _with(
            _tables("tender"),
            " UNION ALL ".join(
                [
                    shares("transactions", "status"),
                    shares("transactions", "channel"),
                    shares("incidents", "incident_type"),
                    shares("tender", "tender_type"),
                ]
            ),
        ),
        "incident_rate": _with(
            _tables("incidents"),
            """SELECT count(*)::bigint AS transactions,
                count(*) FILTER (hit)::bigint AS with_incident,
                round(count(*) FILTER (hit) / count(*), 4) AS incident_rate
                FROM (SELECT transaction_id IN (SELECT transaction_id FROM incidents) AS hit FROM transactions)""",
        ),
    }
