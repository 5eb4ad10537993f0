"""Message feeds derived from the warehouse tables.

The service consumes JSON messages; the test tables are relational.  These
readers turn table rows into message-shaped data by fixed, documented rules,
so every downstream query reads the given tables and its work grows with them.

* :func:`sales_events` -- one sale per ``events`` row (typed, no JSON).
* :func:`transaction_feed` -- one raw JSON transaction per ``orders`` row,
  with the basket built from that order's ``lineitem`` rows.
* :func:`noisy_transaction_feed` -- the same feed where rules on the order key
  break individual messages in the ways a real feed breaks (bad JSON, wrong
  types, missing fields, bad basket lines, unusable timestamps).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.binding import bind
from ..schemas import AGGREGATED_FIELDS
from .tables import read_table

# --- Fixed values of the derivation rules -----------------------------------
STORE_MODULUS = 10            # sales: STORE_(user_id % 10 + 1)
LATE_EVERY = 13               # every 13th event arrives ...
LATE_BY = 50                  # ... 50 places late
TXN_STORE_MODULUS = 11        # transactions: STORE_(o_custkey % 11 + 1), 11 is invalid
TXN_CASHIER_MODULUS = 9       # CASHIER_(o_orderkey % 9 + 1), 9 is invalid
FAILURE_EVERY = 1000          # payment_status 'failure' (invalid) every 1000th order
BAD_RECEIPT_EVERY, BAD_RECEIPT_AT = 500, 1   # receipt total -1 when key % 500 = 1
LOYALTY_MODULUS = 6
PRIORITY_TO_METHOD = {
    "1-URGENT": "credit_card",
    "2-HIGH": "cash",
    "3-MEDIUM": "debit_card",
    "5-LOW": "voucher",
    "4-NOT SPECIFIED": "bitcoin",
}
STATUS_TO_PAYMENT = {"F": "failed", "O": "success", "P": "success"}


def sales_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as point-of-sale sales.

    Columns: event_id, store_id, event_time (TIMESTAMP, UTC), timestamp (ISO
    text with ``Z``), total_amount, arrival_key (arrival order: every 13th
    event is delivered 50 positions late; ties broken by event_id).
    """
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "value"])
    event_time = F.col("ts").cast("timestamp")
    return ev.select(
        "event_id",
        F.concat(F.lit("STORE_"), (F.col("user_id") % STORE_MODULUS + 1).cast("string")).alias("store_id"),
        event_time.alias("event_time"),
        F.date_format(event_time, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"),
        F.col("value").alias("total_amount"),
        (F.col("event_id") + F.when(F.col("event_id") % LATE_EVERY == 0, LATE_BY).otherwise(0))
        .alias("arrival_key"),
    )


#: Damage rules of the sales feed (event_id modulus, residue), first match wins.
NO_STORE_EVERY, NO_TOTAL_EVERY, BAD_TIME_EVERY, FAR_TIME_EVERY = 89, 97, 101, 103
APART_DAYS = 30


def damaged_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales of which some have no store, no amount, a garbage time or one at the end of all time."""
    s = sales_events(spark, sf_dir)
    k = F.col("event_id")
    stamp = F.when(k % BAD_TIME_EVERY == 0, "garbage").when(k % FAR_TIME_EVERY == 0, "9999-12-31T00:00:00Z").otherwise(
        F.col("timestamp"))
    return s.withColumns({"store_id": F.when(k % NO_STORE_EVERY != 0, F.col("store_id")),
                          "total_amount": F.when(k % NO_TOTAL_EVERY != 0, F.col("total_amount")), "timestamp": stamp})


def apart(sales: DataFrame) -> DataFrame:
    """Sales with every store's times moved by its number of months of 30 days, in unchanged arrival order."""
    n = F.regexp_extract("store_id", r"\d+", 0).cast("int")
    moved = F.timestamp_micros(F.unix_micros("event_time") + n * F.lit(APART_DAYS * 86_400_000_000))
    return sales.withColumn("event_time", moved).withColumn(
        "timestamp", F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))


def _map_col(mapping: dict[str, str], col: Column) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = (F.when(col == k, v) if expr is None else expr.when(col == k, v))
    return expr


def baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order key with its basket lines in a fixed order.

    Lines are sorted by (linenumber, partkey, suppkey, quantity, price); the
    aggregation shuffles on l_orderkey with map-side partial collection, and
    the later join with ``orders`` reuses that partitioning.
    """
    li = read_table(spark, sf_dir, "lineitem",
                    ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"])
    line = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    return li.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(line)).alias("lines"))


def transaction_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed transaction columns (before serialisation), one per order."""
    orders = read_table(spark, sf_dir, "orders",
                        ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                         "o_orderpriority"])
    b = baskets(spark, sf_dir)
    # Both sides grow with the data: hash-join on the order key.  The basket
    # side is already hash-partitioned by its aggregation, so only ``orders``
    # is exchanged, and the CPU-heavy message building and validation after
    # the join run with full parallelism (a broadcast would leave them on the
    # scan partitions of ``orders``).
    j = orders.join(b.hint("shuffle_hash"), orders.o_orderkey == b.l_orderkey, "left")
    k = F.col("o_orderkey")
    lines = F.coalesce(F.col("lines"), F.array().cast(b.schema["lines"].dataType))
    items = F.transform(lines, lambda l: F.struct(
        l["l_partkey"].cast("string").alias("item_id"),
        F.concat(F.lit("part "), l["l_partkey"].cast("string")).alias("name"),
        l["l_quantity"].alias("quantity"),
        (l["l_extendedprice"] / l["l_quantity"]).alias("price_per_unit"),
        l["l_extendedprice"].alias("total_price"),
    ))
    line_fold = F.aggregate(lines, F.lit(0.0).cast("double"), lambda a, l: a + l["l_extendedprice"])
    ts = F.timestamp_micros(F.unix_micros(F.col("o_orderdate").cast("timestamp"))
                            + (k % 86400) * F.lit(1_000_000))
    ts_text = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    total = F.when((k % 2 == 0) & (F.size(lines) > 0), line_fold).otherwise(F.col("o_totalprice"))
    method = _map_col(PRIORITY_TO_METHOD, F.col("o_orderpriority"))
    status = F.when(k % FAILURE_EVERY == 0, F.lit("failure")).otherwise(
        _map_col(STATUS_TO_PAYMENT, F.col("o_orderstatus")))
    tid = F.concat(F.lit("00000000-0000-0000-0000-"), F.lpad(k.cast("string"), 12, "0"))
    return j.select(
        k.alias("o_orderkey"),
        tid.alias("transaction_id"),
        ts_text.alias("timestamp"),
        F.concat(F.lit("STORE_"), (F.col("o_custkey") % TXN_STORE_MODULUS + 1).cast("string")).alias("store_id"),
        F.concat(F.lit("CASHIER_"), (k % TXN_CASHIER_MODULUS + 1).cast("string")).alias("cashier_id"),
        items.alias("items"),
        total.alias("total_amount"),
        method.alias("payment_method"),
        status.alias("payment_status"),
        F.concat(F.lit("CUSTOMER_"), F.col("o_custkey").cast("string")).alias("customer_id"),
        (k % LOYALTY_MODULUS).cast("int").alias("loyalty_points_earned"),
        F.struct(
            F.concat(F.lit("R-"), k.cast("string")).alias("receipt_id"),
            ts_text.alias("date"),
            F.when(k % BAD_RECEIPT_EVERY == BAD_RECEIPT_AT, F.lit(-1.0)).otherwise(total).alias("total_amount"),
            method.alias("payment_method"),
            tid.alias("transaction_id"),
        ).alias("receipt"),
    )


TXN_JSON_FIELDS = ["transaction_id", "timestamp", "store_id", "cashier_id", "items", "total_amount",
                   "payment_method", "payment_status", "customer_id", "loyalty_points_earned", "receipt"]


def transaction_feed(spark: SparkSession, sf_dir: str, sent_at: bool = False) -> DataFrame:
    """Raw JSON transactions: ``o_orderkey`` (arrival order), ``value`` and, if asked for, ``sent_at`` (event time text)."""
    rows = transaction_rows(spark, sf_dir)
    extra = [F.col("timestamp").alias("sent_at")] if sent_at else []
    # Bound: a message is made once, however often its text is read.
    message = bind(rows.select("o_orderkey", *extra, *TXN_JSON_FIELDS), {"value": F.to_json(F.struct(*TXN_JSON_FIELDS))})
    return message.drop(*TXN_JSON_FIELDS)


# --- Fixed values: damage rules of aggregate bodies (first matching rule wins) --
AGGREGATE_NOISE = (
    ("missing_total", 31, 1),
    ("total_as_text", 37, 2),
    ("nonpositive_total", 41, 3),
    ("bad_uuid", 43, 4),
    ("uuid_as_number", 47, 5),
    ("missing_store", 53, 6),
    ("store_as_number", 59, 7),
    ("null_end", 61, 8),
    ("two_errors", 67, 9),
    ("truncated", 71, 10),
    ("total_as_true", 73, 11),
    ("uuid_braced", 79, 12),
)


def aggregate_bodies(aggregates: DataFrame) -> DataFrame:
    """AggregatedEvent rows as JSON bodies, some damaged by a rule on window number plus store number.

    Columns: store_id, window_start, noise, value.
    """
    k = F.floor(F.unix_micros("window_start") / F.lit(10_000_000)) + F.regexp_extract("store_id", r"\d+", 0).cast("long")
    kind = None
    for name, modulus, residue in AGGREGATE_NOISE:
        hit = k % modulus == residue
        kind = F.when(hit, name) if kind is None else kind.when(hit, name)
    body = F.to_json(F.struct(*AGGREGATED_FIELDS))
    out = bind(aggregates.select("store_id", "window_start", kind.alias("noise"), body.alias("value")),
               {"noise": F.col("noise"), "value": F.col("value")})
    v, kind = F.col("value"), F.col("noise")

    def edit(pattern: str, text: str, of: Column = v) -> Column:
        return F.regexp_replace(of, pattern, text)

    total, event = r'"total_amount":([^,]+),', r'"event_id":"([^"]*)"'
    damaged = (
        F.when(kind == "missing_total", edit(total, ""))
        .when(kind == "total_as_text", edit(total, '"total_amount":"$1",'))
        .when(kind == "nonpositive_total", edit(total, '"total_amount":0,'))
        .when(kind == "total_as_true", edit(total, '"total_amount":true,'))
        .when(kind == "bad_uuid", edit(event, '"event_id":"x"'))
        .when(kind == "uuid_as_number", edit(event, '"event_id":5'))
        .when(kind == "uuid_braced", edit(event, '"event_id":"{$1}"'))
        .when(kind == "missing_store", edit(r'"store_id":"[^"]*",', ""))
        .when(kind == "store_as_number", edit(r'"store_id":"[^"]*"', '"store_id":7'))
        .when(kind == "null_end", edit(r'"end_stream_aggregator":"[^"]*"', '"end_stream_aggregator":null'))
        .when(kind == "two_errors", edit(r'"begin_stream_aggregator":"[^"]*",', "", edit(event, '"event_id":"x"')))
        .when(kind == "truncated", v.substr(F.lit(1), F.length(v) - 1))
        .otherwise(v))
    return out.withColumn("value", damaged)


# --- Fixed values: damage rules of the noisy feed (first matching rule wins) --
# (name, modulus, residue)
NOISE_RULES = (
    ("truncated", 137, 9),
    ("trailing_garbage", 139, 10),
    ("json_null", 149, 11),
    ("json_array", 151, 12),
    ("items_not_objects", 179, 17),
    ("receipt_not_object", 173, 16),
    ("total_as_string", 109, 2),
    ("zero_quantity", 101, 7),
    ("negative_unit_price", 103, 5),
    ("fractional_quantity", 107, 3),
    ("customer_as_number", 113, 4),
    ("missing_timestamp", 127, 6),
    ("garbage_timestamp", 131, 8),
    ("loyalty_as_text", 157, 13),
    ("uuid_simple_upper", 163, 14),
    ("uuid_invalid", 167, 15),
    ("padded_store_id", 191, 18),
    ("forged_end", 193, 19),
    ("forged_array_end", 197, 20),
    ("nonpositive_total", 199, 21),
    ("negative_line_total", 211, 22),
)


def noise_kind(k: Column) -> Column:
    """Name of the damage rule applied to order key ``k`` (NULL: untouched)."""
    expr = None
    for name, mod, res in NOISE_RULES:
        cond = k % mod == res
        expr = F.when(cond, name) if expr is None else expr.when(cond, name)
    return expr


def noisy_transaction_feed(spark: SparkSession, sf_dir: str, sent_at: bool = False) -> DataFrame:
    """Transaction feed with rule-based damage; columns o_orderkey, noise, value (and ``sent_at``, undamaged)."""
    # The kind is bound: it is one of many cases, and 21 rules ask for it.
    feed = bind(transaction_feed(spark, sf_dir, sent_at), {"noise": noise_kind(F.col("o_orderkey"))})
    v, kind = F.col("value"), F.col("noise")
    first_item = r'"items":\[\{"item_id":"[^"]*","name":"[^"]*","quantity":'
    damaged = (
        F.when(kind.isNull(), v)
        .when(kind == "truncated", v.substr(F.lit(1), (F.length(v) / 2).cast("int")))
        .when(kind == "trailing_garbage", F.concat(v, F.lit(" x")))
        .when(kind == "json_null", F.lit("null"))
        .when(kind == "json_array", F.lit("[]"))
        .when(kind == "items_not_objects",
              F.regexp_replace(F.regexp_replace(v, r'"items":\[\{', '"items":[7,{'), r'"items":\[\]', '"items":[7]'))
        .when(kind == "receipt_not_object", F.regexp_replace(v, r'"receipt":\{.*\}\}$', '"receipt":"R"}'))
        .when(kind == "total_as_string", F.regexp_replace(v, r'\],"total_amount":([^,]+),', '],"total_amount":"$1",'))
        .when(kind == "zero_quantity", F.regexp_replace(v, "(" + first_item + r")[^,]+,", "$10,"))
        .when(kind == "negative_unit_price",
              F.regexp_replace(v, r'("items":\[\{[^}]*"price_per_unit":)[^,]+,', "$1-1.0,"))
        .when(kind == "fractional_quantity", F.regexp_replace(v, "(" + first_item + r")[^,]+,", "$12.5,"))
        .when(kind == "customer_as_number", F.regexp_replace(v, r'"customer_id":"CUSTOMER_([0-9]+)"', '"customer_id":$1'))
        .when(kind == "missing_timestamp", F.regexp_replace(v, r'"timestamp":"[^"]*",', ""))
        .when(kind == "garbage_timestamp", F.regexp_replace(v, r'^\{"transaction_id":"([^"]*)","timestamp":"[^"]*"',
                                                            '{"transaction_id":"$1","timestamp":"garbage"'))
        .when(kind == "loyalty_as_text", F.regexp_replace(v, r'"loyalty_points_earned":([0-9]+)',
                                                          '"loyalty_points_earned":"$1"'))
        .when(kind == "uuid_simple_upper", F.regexp_replace(v, r'^\{"transaction_id":"00000000-0000-0000-0000-',
                                                            '{"transaction_id":"0000000000000000ABCD'))
        .when(kind == "uuid_invalid", F.regexp_replace(v, r'^\{"transaction_id":"[^"]*"', '{"transaction_id":"not-a-uuid"'))
        .when(kind == "forged_end", F.concat(v, F.lit(',"end of message"')))
        .when(kind == "forged_array_end", F.concat(v, F.lit(',"end of message"] junk')))
        .when(kind == "nonpositive_total", F.regexp_replace(v, r'\],"total_amount":[^,]+,', '],"total_amount":-0.5,'))
        .when(kind == "negative_line_total",
              F.regexp_replace(v, r'("items":\[\{[^}]*"total_price":)[^}]+\}', "$1-1.0}"))
        .when(kind == "padded_store_id", F.regexp_replace(v, r'"store_id":"STORE_([0-9]+)"', '"store_id":"STORE_0$1"'))
        .otherwise(v)
    )
    out = feed.select("o_orderkey", *(["sent_at"] if sent_at else []), "noise", v)
    return bind(out, {"value": damaged})
