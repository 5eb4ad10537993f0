"""Independent SQL oracles (DuckDB dialect) for the driver queries.

Each oracle derives the expected result straight from the warehouse tables,
without JSON: the fixture rules are restated relationally and the validation
outcome follows from the rule order.  The Spark side goes through the real
message path (serialise -> parse -> type checks -> rules), so a match checks
the parser, the rules, the error order and the aggregations together.
"""

from __future__ import annotations

from .. import config as C

P = C.TOPIC_PREFIX


def iso(x: str) -> str:
    """DuckDB: naive UTC timestamp -> ``datetime.isoformat()`` of the aware value."""
    return (f"(CASE WHEN epoch_us({x}) % 1000000 = 0 THEN strftime({x}, '%Y-%m-%dT%H:%M:%S') "
            f"ELSE strftime({x}, '%Y-%m-%dT%H:%M:%S.%f') END || '+00:00')")


def uuid_of(text: str) -> str:
    h = f"md5({text})"
    return (f"(substr({h},1,8) || '-' || substr({h},9,4) || '-3' || substr({h},14,3) || '-' || "
            f"substr('89ab', ((instr('0123456789abcdef', substr({h},17,1)) - 1) % 4) + 1, 1) || "
            f"substr({h},18,3) || '-' || substr({h},21,12))")


SALES = """sales AS (
  SELECT event_id, 'STORE_' || CAST(user_id % 10 + 1 AS VARCHAR) AS store_id, ts AS event_time,
         value AS total_amount,
         event_id + CASE WHEN event_id % 13 = 0 THEN 50 ELSE 0 END AS arrival_key
  FROM events)"""

LATE = """tagged AS (
  SELECT *, coalesce(event_time < max(event_time) OVER (
             PARTITION BY store_id ORDER BY arrival_key, event_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 100 MILLISECONDS, false) AS late
  FROM sales)"""


def turnover_sql(source: str, length_us: int = 10_000_000, offset_us: int = 0) -> str:
    ws = "make_timestamp(ws)"
    we = f"make_timestamp(ws + {length_us})"
    return f"""
SELECT store_id, {iso(ws)} AS window_start, {iso(we)} AS window_end,
       CAST(sum(CAST(total_amount AS DECIMAL(28,10))) AS DOUBLE) AS total_amount,
       count(*) AS n_events,
       {iso('min(event_time)')} AS begin_stream_aggregator,
       {iso('max(event_time)')} AS end_stream_aggregator
FROM (SELECT *, (epoch_us(event_time) - {offset_us}) // {length_us} * {length_us} + {offset_us} AS ws
      FROM {source}) b
GROUP BY store_id, ws"""


def agg_events_sql(source: str) -> str:
    """Turnover per 10 s window formatted as AggregatedEvent rows (+ ws)."""
    return f"""
SELECT round(CAST(sum(CAST(total_amount AS DECIMAL(28,10))) AS DOUBLE), 2) AS total_amount,
       {uuid_of("store_id || '|' || " + iso('make_timestamp(ws)'))} AS event_id,
       store_id,
       {iso('min(event_time)')} AS begin_stream_aggregator,
       {iso('max(event_time)')} AS end_stream_aggregator,
       ws, count(*) AS n_events
FROM (SELECT *, epoch_us(event_time) // 10000000 * 10000000 AS ws FROM {source}) b
GROUP BY store_id, ws"""


def agg_topic(t: str = "") -> str:
    return f"'{P}/aggregations/' || {t}store_id || '/' || {t}event_id || '/' || CAST({t}total_amount AS VARCHAR)"


FIXTURE = f"""li AS (
  SELECT l_orderkey, count(*) AS n_lines,
         round(sum(CAST(l_extendedprice AS DECIMAL(28,10))), 2) AS line_cents,
         list_reduce(list(l_extendedprice ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity,
                          l_extendedprice), lambda a, x: a + x) AS line_fold,
         bool_and(l_quantity > 0 AND l_extendedprice > 0 AND l_extendedprice / l_quantity > 0) AS lines_ok
  FROM lineitem GROUP BY l_orderkey),
fx AS (
  SELECT o.o_orderkey,
         '00000000-0000-0000-0000-' || lpad(CAST(o.o_orderkey AS VARCHAR), 12, '0') AS transaction_id,
         o.o_orderdate + to_seconds(o.o_orderkey % 86400) AS event_time,
         strftime(o.o_orderdate + to_seconds(o.o_orderkey % 86400), '%Y-%m-%dT%H:%M:%S.%fZ') AS ts_text,
         CAST(o.o_custkey % 11 + 1 AS VARCHAR) AS store_n,
         'STORE_' || CAST(o.o_custkey % 11 + 1 AS VARCHAR) AS store_id,
         'CASHIER_' || CAST(o.o_orderkey % 9 + 1 AS VARCHAR) AS cashier_id,
         coalesce(li.n_lines, 0) AS n_lines,
         coalesce(li.line_cents, 0) AS line_cents,
         coalesce(li.line_fold, 0.0) AS line_fold,
         coalesce(li.lines_ok, true) AS lines_ok,
         CASE WHEN o.o_orderkey % 2 = 0 AND li.n_lines > 0 THEN li.line_fold ELSE o.o_totalprice END AS total_amount,
         CASE o.o_orderpriority WHEN '1-URGENT' THEN 'credit_card' WHEN '2-HIGH' THEN 'cash'
              WHEN '3-MEDIUM' THEN 'debit_card' WHEN '5-LOW' THEN 'voucher'
              WHEN '4-NOT SPECIFIED' THEN 'bitcoin' END AS payment_method,
         CASE WHEN o.o_orderkey % 1000 = 0 THEN 'failure' WHEN o.o_orderstatus = 'F' THEN 'failed'
              WHEN o.o_orderstatus IN ('O', 'P') THEN 'success' END AS payment_status,
         'CUSTOMER_' || CAST(o.o_custkey AS VARCHAR) AS customer_id,
         'R-' || CAST(o.o_orderkey AS VARCHAR) AS receipt_id,
         o.o_orderkey % 500 = 1 AS bad_receipt
  FROM orders o LEFT JOIN li ON o.o_orderkey = li.l_orderkey),
fc AS (
  SELECT *, line_fold <> total_amount AS corrected,
         CASE WHEN line_fold <> total_amount THEN CAST(line_cents AS DOUBLE) ELSE total_amount END AS final_total
  FROM fx)"""

_STORE_OK = "regexp_full_match({s}, 'STORE_0*([1-9]|10)')"
_CASHIER_OK = "regexp_full_match(cashier_id, 'CASHIER_0*[1-8]')"
_METHOD_OK = "coalesce(payment_method IN ('credit_card', 'cash', 'debit_card', 'voucher'), false)"
_STATUS_OK = "coalesce(payment_status IN ('success', 'failed'), false)"

CLEAN = f"""vx AS (
  SELECT *,
    CASE WHEN NOT {_STORE_OK.format(s='store_id')} THEN '{C.MSG_STORE}'
         WHEN NOT {_CASHIER_OK} THEN '{C.MSG_CASHIER}'
         WHEN total_amount <= 0 THEN '{C.MSG_TOTAL}'
         WHEN NOT {_METHOD_OK} THEN '{C.MSG_METHOD}' || coalesce(payment_method, 'None')
         WHEN NOT {_STATUS_OK} THEN '{C.MSG_STATUS}' || coalesce(payment_status, 'None')
    END AS rule_msg
  FROM fc),
ox AS (
  SELECT *,
    CASE WHEN rule_msg IS NOT NULL OR bad_receipt THEN 'rejected'
         WHEN payment_status = 'success' THEN 'published' ELSE 'unpaid' END AS outcome,
    CASE WHEN rule_msg IS NOT NULL THEN 'Field ''body'' validation failed: Value error, ' || rule_msg
         WHEN bad_receipt THEN 'Field ''receipt'' validation failed: Value error, {C.MSG_TOTAL}'
         ELSE '' END AS errors_text,
    CASE WHEN rule_msg IS NOT NULL OR bad_receipt THEN 1 ELSE 0 END AS n_errors
  FROM vx)"""

NOISE_CASE = """CASE WHEN o_orderkey % 137 = 9 THEN 'truncated'
  WHEN o_orderkey % 139 = 10 THEN 'trailing_garbage'
  WHEN o_orderkey % 149 = 11 THEN 'json_null'
  WHEN o_orderkey % 151 = 12 THEN 'json_array'
  WHEN o_orderkey % 179 = 17 THEN 'items_not_objects'
  WHEN o_orderkey % 173 = 16 THEN 'receipt_not_object'
  WHEN o_orderkey % 109 = 2 THEN 'total_as_string'
  WHEN o_orderkey % 101 = 7 THEN 'zero_quantity'
  WHEN o_orderkey % 103 = 5 THEN 'negative_unit_price'
  WHEN o_orderkey % 107 = 3 THEN 'fractional_quantity'
  WHEN o_orderkey % 113 = 4 THEN 'customer_as_number'
  WHEN o_orderkey % 127 = 6 THEN 'missing_timestamp'
  WHEN o_orderkey % 131 = 8 THEN 'garbage_timestamp'
  WHEN o_orderkey % 157 = 13 THEN 'loyalty_as_text'
  WHEN o_orderkey % 163 = 14 THEN 'uuid_simple_upper'
  WHEN o_orderkey % 167 = 15 THEN 'uuid_invalid'
  WHEN o_orderkey % 191 = 18 THEN 'padded_store_id'
  WHEN o_orderkey % 193 = 19 THEN 'forged_end'
  WHEN o_orderkey % 197 = 20 THEN 'forged_array_end'
  WHEN o_orderkey % 199 = 21 THEN 'nonpositive_total'
  WHEN o_orderkey % 211 = 22 THEN 'negative_line_total' END"""
_MALFORMED = "('truncated', 'trailing_garbage', 'json_null', 'json_array', 'forged_end', 'forged_array_end')"

NOISY = f"""n0 AS (
  SELECT *, {NOISE_CASE} AS noise FROM fc),
n1 AS (
  SELECT *, CASE WHEN noise = 'padded_store_id' THEN 'STORE_0' || store_n ELSE store_id END AS store_id2,
    CASE WHEN noise = 'uuid_simple_upper'
         THEN '00000000-0000-0000-abcd-' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0')
         ELSE transaction_id END AS transaction_id2
  FROM n0),
n2 AS (
  SELECT *,
    CASE WHEN noise IN {_MALFORMED} THEN 'M'
         WHEN NOT {_STORE_OK.format(s='store_id2')} THEN 'R{C.MSG_STORE}'
         WHEN NOT {_CASHIER_OK} THEN 'R{C.MSG_CASHIER}'
         WHEN noise = 'total_as_string' THEN 'Stotal_amount'
         WHEN total_amount <= 0 OR noise = 'nonpositive_total' THEN 'R{C.MSG_TOTAL}'
         WHEN NOT {_METHOD_OK} THEN 'R{C.MSG_METHOD}' || coalesce(payment_method, 'None')
         WHEN NOT {_STATUS_OK} THEN 'R{C.MSG_STATUS}' || coalesce(payment_status, 'None')
         WHEN noise = 'items_not_objects' THEN 'Sitems'
         WHEN noise = 'receipt_not_object' THEN 'Sreceipt'
    END AS stage1,
    concat_ws(' | ',
      CASE WHEN noise = 'uuid_invalid' THEN 'Field ''transaction_id'' validation failed: {C.MSG_UUID}' END,
      CASE WHEN noise = 'missing_timestamp' THEN 'Field ''timestamp'' validation failed: {C.MSG_REQUIRED}' END,
      CASE WHEN n_lines > 0 AND noise = 'zero_quantity'
             THEN 'Field ''0'' validation failed: Value error, {C.MSG_QUANTITY}'
           WHEN n_lines > 0 AND noise = 'negative_unit_price'
             THEN 'Field ''0'' validation failed: Value error, {C.MSG_PRICE}'
           WHEN n_lines > 0 AND noise = 'negative_line_total'
             THEN 'Field ''0'' validation failed: Value error, {C.MSG_LINE_TOTAL}'
           WHEN n_lines > 0 AND noise = 'fractional_quantity'
             THEN 'Field ''quantity'' validation failed: {C.MSG_INT_FRACTION}' END,
      CASE WHEN noise = 'customer_as_number' THEN 'Field ''customer_id'' validation failed: {C.MSG_STRING}' END,
      CASE WHEN bad_receipt THEN 'Field ''receipt'' validation failed: Value error, {C.MSG_TOTAL}' END
    ) AS field_errors
  FROM n1),
nx AS (
  SELECT *,
    CASE WHEN stage1 = 'M' THEN 'malformed'
         WHEN stage1 LIKE 'S%' THEN 'server_error'
         WHEN stage1 LIKE 'R%' THEN 'rejected'
         WHEN field_errors <> '' THEN 'rejected'
         WHEN payment_status = 'success' THEN 'published' ELSE 'unpaid' END AS outcome,
    CASE WHEN stage1 = 'M' THEN 'Field ''body'' validation failed: {C.MSG_JSON}'
         WHEN stage1 LIKE 'S%' THEN '{C.REASON_MISSING_OR_WRONG_TYPE}' || substr(stage1, 2)
         WHEN stage1 LIKE 'R%' THEN 'Field ''body'' validation failed: Value error, ' || substr(stage1, 2)
         ELSE field_errors END AS errors_text
  FROM n2)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


TXN_TOPIC = (f"'{P}/receipt/' || store_id || '/' || cashier_id || '/' || payment_method || '/' || "
             "payment_status || '/' || ts_text || '/' || transaction_id || '/' || CAST(final_total AS VARCHAR) || "
             "'/' || receipt_id || '/' || customer_id")

SALES_AGG = f"""sagg AS ({agg_events_sql('sales')})"""

CLEAN_PUB_AGG = f"""pub AS (SELECT store_id, event_time, final_total AS total_amount FROM ox WHERE outcome = 'published'),
pagg AS ({agg_events_sql('pub')})"""

NOISY_PUB_AGG = f"""npub AS (
  SELECT store_id2 AS store_id, event_time, final_total AS total_amount FROM nx
  WHERE outcome = 'published' AND noise IS DISTINCT FROM 'garbage_timestamp'),
nagg AS ({agg_events_sql('npub')})"""


ORACLE: dict[str, str] = {
    "turnover_10s": with_(SALES) + turnover_sql("sales"),
    "turnover_1h": with_(SALES) + turnover_sql("sales", 3_600_000_000),
    "turnover_offset_origin": with_(SALES) + turnover_sql("sales", 10_000_000, 3_500_000),
    "turnover_formatted": with_(SALES, SALES_AGG) + """
SELECT total_amount, event_id, store_id, begin_stream_aggregator, end_stream_aggregator FROM sagg""",
    "turnover_merge": with_(SALES) + turnover_sql("sales"),
    "late_split": with_(SALES, LATE) + "SELECT event_id, store_id, late FROM tagged",
    "turnover_on_time": with_(SALES, LATE, "ontime AS (SELECT * FROM tagged WHERE NOT late)")
    + turnover_sql("ontime"),
    "json_parse_outcomes": with_(FIXTURE, NOISY) + "SELECT o_orderkey, noise, outcome, errors_text FROM nx",
    "rule_outcomes": with_(FIXTURE, NOISY) + f"""
SELECT o_orderkey,
       o AND {_STORE_OK.format(s='store_id2')} AS store_ok, o AND {_CASHIER_OK} AS cashier_ok,
       o AND total_amount > 0 AND k NOT IN ('total_as_string', 'nonpositive_total') AS total_ok,
       o AND {_METHOD_OK} AS method_ok, o AND {_STATUS_OK} AS status_ok,
       o AND k <> 'items_not_objects' AND NOT (n_lines > 0 AND k = 'zero_quantity') AS quantity_ok,
       o AND k <> 'items_not_objects' AND NOT (n_lines > 0 AND k = 'negative_unit_price') AS price_ok,
       o AND k <> 'items_not_objects' AND NOT (n_lines > 0 AND k = 'negative_line_total') AS line_total_ok,
       o AND NOT bad_receipt AND total_amount > 0 AND k <> 'receipt_not_object' AS receipt_ok,
       o AND k NOT IN ('items_not_objects', 'receipt_not_object', 'missing_timestamp') AS present_ok,
       o AND k <> 'uuid_invalid' AS uuid_ok,
       o AND k NOT IN ('total_as_string', 'items_not_objects', 'receipt_not_object', 'customer_as_number')
         AND NOT (n_lines > 0 AND k = 'fractional_quantity') AS types_ok
FROM (SELECT *, coalesce(noise, '') AS k, coalesce(noise NOT IN {_MALFORMED}, true) AS o FROM nx) x""",
    "agg_body_validation": with_(SALES, SALES_AGG) + f"""
SELECT store_id, {iso('make_timestamp(ws)')} AS window_start, noise,
       CASE WHEN noise = 'truncated' THEN 'malformed' WHEN noise IN ('missing_total', 'total_as_text') THEN 'server_error'
            WHEN errors = '' THEN 'accepted' ELSE 'rejected' END AS outcome,
       errors AS errors_text,
       CASE WHEN errors = '' THEN event_id END AS event_id,
       CASE WHEN errors = '' THEN CASE WHEN noise = 'total_as_true' THEN 1.0 ELSE total_amount END END AS total_amount
FROM (
  SELECT *, CASE
      WHEN noise = 'truncated' THEN 'Field ''body'' validation failed: {C.MSG_JSON}'
      WHEN noise IN ('missing_total', 'total_as_text') THEN '{C.REASON_MISSING_OR_WRONG_TYPE}total_amount'
      WHEN noise = 'nonpositive_total' OR (total_amount <= 0 AND noise IS DISTINCT FROM 'total_as_true')
        THEN 'Field ''body'' validation failed: Value error, {C.MSG_TOTAL}'
      WHEN noise = 'bad_uuid' THEN 'Field ''event_id'' validation failed: {C.MSG_UUID}'
      WHEN noise = 'uuid_as_number' THEN 'Field ''event_id'' validation failed: {C.MSG_UUID_TYPE}'
      WHEN noise = 'missing_store' THEN 'Field ''store_id'' validation failed: {C.MSG_REQUIRED}'
      WHEN noise = 'store_as_number' THEN 'Field ''store_id'' validation failed: {C.MSG_STRING}'
      WHEN noise = 'null_end' THEN 'Field ''end_stream_aggregator'' validation failed: {C.MSG_STRING}'
      WHEN noise = 'two_errors' THEN 'Field ''event_id'' validation failed: {C.MSG_UUID} | '
        'Field ''begin_stream_aggregator'' validation failed: {C.MSG_REQUIRED}'
      ELSE '' END AS errors
  FROM (
    SELECT *, CASE WHEN k % 31 = 1 THEN 'missing_total' WHEN k % 37 = 2 THEN 'total_as_text'
      WHEN k % 41 = 3 THEN 'nonpositive_total' WHEN k % 43 = 4 THEN 'bad_uuid' WHEN k % 47 = 5 THEN 'uuid_as_number'
      WHEN k % 53 = 6 THEN 'missing_store' WHEN k % 59 = 7 THEN 'store_as_number' WHEN k % 61 = 8 THEN 'null_end'
      WHEN k % 67 = 9 THEN 'two_errors' WHEN k % 71 = 10 THEN 'truncated' WHEN k % 73 = 11 THEN 'total_as_true'
      WHEN k % 79 = 12 THEN 'uuid_braced' END AS noise
    FROM (SELECT *, ws // 10000000 + CAST(substr(store_id, 7) AS BIGINT) AS k FROM sagg) a) b) c""",
    "progress_counts": with_(FIXTURE, NOISY) + """
SELECT counter, n FROM (
  SELECT 'rows' AS counter, count(*) AS n FROM nx UNION ALL
  SELECT o, count(outcome) FROM unnest(['published', 'unpaid', 'rejected', 'server_error', 'malformed']) u(o)
    LEFT JOIN nx ON outcome = o GROUP BY o) c""",
    "string_lookup": "SELECT DISTINCT o_orderpriority AS name FROM orders",
    "validation_errors": with_(FIXTURE, CLEAN) + "SELECT o_orderkey, outcome, n_errors, errors_text FROM ox",
    "rejects": with_(FIXTURE, NOISY) + """
SELECT o_orderkey, outcome AS reject_stage, errors_text FROM nx
WHERE outcome IN ('malformed', 'server_error', 'rejected')""",
    "accept_ack": with_(FIXTURE, NOISY) + f"""
SELECT o_orderkey,
       CASE WHEN outcome IN ('published', 'unpaid') THEN 'success' ELSE 'error' END AS status,
       CASE WHEN outcome IN ('published', 'unpaid') THEN transaction_id2 END AS transaction_id,
       CASE WHEN outcome IN ('published', 'unpaid') THEN '{C.MSG_TXN_ACCEPTED}'
            ELSE '{C.MSG_REQUEST_FAILED}' END AS message
FROM nx""",
    "corrected_totals": with_(FIXTURE, CLEAN) + """
SELECT transaction_id, total_amount AS original_total, corrected, final_total AS total_amount
FROM ox WHERE outcome IN ('published', 'unpaid')""",
    "basket_sum": with_(FIXTURE, CLEAN) + """
SELECT transaction_id, CAST(n_lines AS INTEGER) AS n_items, CAST(line_cents AS DOUBLE) AS basket_sum
FROM ox WHERE outcome IN ('published', 'unpaid')""",
    "payment_gate": with_(FIXTURE, CLEAN) + """
SELECT transaction_id, store_id, final_total AS total_amount FROM ox WHERE outcome = 'published'""",
    "unpaid": with_(FIXTURE, CLEAN) + """
SELECT transaction_id, payment_status FROM ox WHERE outcome = 'unpaid'""",
    "txn_envelope": with_(FIXTURE, CLEAN) + f"""
SELECT {TXN_TOPIC} AS topic, transaction_id AS key, 'application' AS header_key, 'json' AS header_value,
       final_total AS payload_total_amount, store_id AS payload_store_id, transaction_id AS payload_id,
       CAST(n_lines AS INTEGER) AS payload_n_items
FROM ox WHERE outcome = 'published'""",
    "agg_envelope": with_(SALES, SALES_AGG) + f"""
SELECT {agg_topic()} AS topic, event_id AS key, 'application' AS header_key, 'json' AS header_value,
       total_amount AS payload_total_amount, store_id AS payload_store_id, event_id AS payload_id
FROM sagg""",
    "topic_filter": with_(FIXTURE, CLEAN, SALES, SALES_AGG) + f"""
SELECT topic, key FROM (
  SELECT {TXN_TOPIC} AS topic, transaction_id AS key FROM ox WHERE outcome = 'published'
  UNION ALL
  SELECT {agg_topic()} AS topic, event_id AS key FROM sagg) u
WHERE starts_with(topic, '{P}/receipt/STORE_3/') OR starts_with(topic, '{P}/aggregations/STORE_7/')""",
    "topic_deliveries": with_(FIXTURE, CLEAN, "pub AS (SELECT * FROM ox WHERE outcome = 'published')") + """
SELECT 'customer_' || CAST(c_custkey AS VARCHAR) AS queue, transaction_id AS key
FROM pub JOIN customer ON customer_id = 'CUSTOMER_' || CAST(c_custkey AS VARCHAR)
UNION ALL
SELECT 'region_' || CAST(r_regionkey AS VARCHAR), transaction_id
FROM pub JOIN region ON store_id = 'STORE_' || CAST(r_regionkey + 1 AS VARCHAR)
UNION ALL
SELECT 'nation_' || CAST(n_nationkey AS VARCHAR), transaction_id
FROM pub JOIN nation ON starts_with(store_id, 'STORE_' || CAST(n_nationkey AS VARCHAR))""",
    "broker_records": with_(FIXTURE, CLEAN) + f"""
SELECT '{P.replace('/', '.')}.receipt' AS topic, transaction_id AS key, {TXN_TOPIC} AS path
FROM ox WHERE outcome = 'published'""",
    "topic_parse": with_(FIXTURE, CLEAN) + """
SELECT transaction_id AS key, 'receipt' AS t_kind, store_id AS t_store_id, cashier_id AS t_cashier_id,
       payment_method AS t_payment_method, payment_status AS t_payment_status, ts_text AS t_timestamp,
       transaction_id AS t_transaction_id, CAST(final_total AS VARCHAR) AS t_total_amount,
       receipt_id AS t_receipt_id, customer_id AS t_customer_id
FROM ox WHERE outcome = 'published'""",
    "store_routes": with_(FIXTURE, NOISY, NOISY_PUB_AGG) + f"""
SELECT CASE WHEN regexp_full_match(store_id, 'STORE_([1-9]|10)')
            THEN 'sale_pos_transaction_aggregations_store' || substr(store_id, 7) || '.q'
            ELSE '{C.UNROUTED_QUEUE}' END AS queue,
       {agg_topic()} AS topic, event_id AS key
FROM nagg WHERE total_amount > 0""",
    "agg_validation": with_(FIXTURE, CLEAN, CLEAN_PUB_AGG) + f"""
SELECT store_id, {iso('make_timestamp(ws)')} AS window_start, total_amount, n_events,
       CASE WHEN total_amount > 0 THEN 'success' ELSE 'error' END AS status,
       CASE WHEN total_amount > 0 THEN '{C.MSG_AGG_ACCEPTED}' ELSE '{C.MSG_REQUEST_FAILED}' END AS message,
       CASE WHEN total_amount > 0 THEN ''
            ELSE 'Field ''body'' validation failed: Value error, {C.MSG_TOTAL}' END AS errors_text
FROM pagg""",
    "bad_event_time": with_(FIXTURE, NOISY) + f"""
SELECT o_orderkey, 'garbage' AS timestamp, '{C.REASON_BAD_EVENT_TIME}' AS reason
FROM nx WHERE outcome = 'published' AND noise = 'garbage_timestamp'""",
    "outcome_counts": with_(FIXTURE, NOISY) + "SELECT outcome, count(*) AS n FROM nx GROUP BY outcome",
    "lag_histogram": """
WITH lagged AS (SELECT event_type, ((event_id % 61) * 100000) / 1e6 AS lag_seconds FROM events)
SELECT event_type,
       count(*) FILTER (WHERE lag_seconds <= 0.1) AS le_0_1,
       count(*) FILTER (WHERE lag_seconds <= 0.3) AS le_0_3,
       count(*) FILTER (WHERE lag_seconds <= 1.2) AS le_1_2,
       count(*) FILTER (WHERE lag_seconds <= 5.0) AS le_5_0,
       count(*) AS le_inf, count(lag_seconds) AS count,
       CAST(round(sum(CAST(lag_seconds AS DECIMAL(18,6))), 6) AS DOUBLE) AS sum_seconds
FROM lagged GROUP BY event_type""",
}

ORACLE["stream_validate"] = with_(FIXTURE, NOISY) + "SELECT o_orderkey, outcome, errors_text FROM nx"
ORACLE["stream_turnover"] = ORACLE["turnover_10s"]
ORACLE["stream_strict_late"] = ORACLE["late_split"]
ORACLE["stream_strict_late_scan"] = ORACLE["late_split"]
ORACLE["stream_chain"] = ORACLE["store_routes"]
ORACLE["stream_generic_fold"] = ORACLE["turnover_10s"]
ORACLE["stream_strict_turnover"] = ORACLE["turnover_on_time"]
SALES_DAMAGED = """sales AS (
  SELECT event_id, CASE WHEN event_id % 89 <> 0 THEN 'STORE_' || CAST(user_id % 10 + 1 AS VARCHAR) END AS store_id,
         CASE WHEN event_id % 101 <> 0 AND event_id % 103 <> 0 THEN ts END AS event_time,
         CASE WHEN event_id % 97 <> 0 THEN value END AS total_amount,
         event_id + CASE WHEN event_id % 13 = 0 THEN 50 ELSE 0 END AS arrival_key
  FROM events),
reasoned AS (
  SELECT *, CASE WHEN store_id IS NULL THEN 'missing_store' WHEN event_time IS NULL THEN 'bad_event_time'
                 WHEN total_amount IS NULL THEN 'missing_total' END AS reason
  FROM sales)"""
SALES_APART = SALES.replace("ts AS event_time", "ts + to_days(CAST(user_id % 10 + 1 AS INTEGER) * 30) AS event_time")
ORACLE["late_split_ranked"] = with_(SALES.replace("event_id + CASE", "epoch_us(ts) // 3600000000 * 3600000000 + CASE"), LATE) \
    + "SELECT event_id, store_id, late FROM tagged"
ORACLE["stream_unusable"] = with_(SALES_DAMAGED) + "SELECT event_id, reason FROM reasoned WHERE reason IS NOT NULL"
ORACLE["stream_strict_apart"] = with_(SALES_APART, LATE, "ontime AS (SELECT * FROM tagged WHERE NOT late)") \
    + turnover_sql("ontime")
ORACLE["stream_strict_rejects"] = with_(SALES_DAMAGED, LATE.replace("FROM sales)", "FROM reasoned WHERE reason IS NULL)")) + """
SELECT event_id, store_id, 'late' AS kind, NULL AS reason FROM tagged WHERE late
UNION ALL SELECT event_id, store_id, 'unusable', reason FROM reasoned WHERE reason IS NOT NULL"""
ORACLE["stream_progress"] = ORACLE["progress_counts"]
ORACLE["topic_replay"] = with_(FIXTURE, NOISY) + f"""
SELECT '{P}/receipt/' || store_id2 || '/' || cashier_id || '/' || payment_method || '/' || payment_status || '/' ||
       CASE WHEN noise = 'garbage_timestamp' THEN 'garbage' ELSE ts_text END || '/' || transaction_id2 || '/' ||
       CAST(final_total AS VARCHAR) || '/' || receipt_id || '/' || customer_id AS topic,
       transaction_id2 AS key, 'application=json' AS header, store_id2 AS payload_store_id
FROM nx WHERE outcome = 'published'"""
ORACLE["generic_fold"] = ORACLE["turnover_10s"]
ORACLE["longest_rise"] = with_(SALES, """hours AS (
  SELECT *, epoch_us(event_time) // 3600000000 * 3600000000 AS ws FROM sales),
steps AS (
  SELECT *, CASE WHEN total_amount > lag(total_amount) OVER (PARTITION BY store_id, ws ORDER BY event_time, event_id)
                 THEN 0 ELSE 1 END AS breaks
  FROM hours),
runs AS (
  SELECT *, sum(breaks) OVER (PARTITION BY store_id, ws ORDER BY event_time, event_id) AS run FROM steps),
lengths AS (
  SELECT store_id, ws, run, count(*) AS n, arg_min(total_amount, nth) AS first_amount,
         arg_max(total_amount, nth) AS last_amount
  FROM (SELECT *, row_number() OVER (PARTITION BY store_id, ws, run ORDER BY event_time, event_id) AS nth FROM runs)
  GROUP BY store_id, ws, run)""") + f"""
SELECT store_id, {iso('make_timestamp(ws)')} AS window_start, CAST(sum(n) AS BIGINT) AS n_events,
       arg_min(first_amount, run) AS first_amount, arg_max(last_amount, run) AS last_amount, max(n) AS longest_rise
FROM lengths GROUP BY store_id, ws"""
ORACLE["json_lookup"] = "SELECT p_name AS name, p_retailprice AS price FROM part"
