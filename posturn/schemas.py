"""Declared schemas of every message and table the library reads or writes.

Schemas are always explicit; nothing is inferred from data.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Field order of the contracts (serialisation order of published payloads).
TRANSACTION_FIELDS = (
    "transaction_id", "timestamp", "store_id", "cashier_id", "items", "total_amount",
    "payment_method", "payment_status", "customer_id", "loyalty_points_earned", "receipt",
)
ITEM_FIELDS = ("item_id", "name", "quantity", "price_per_unit", "total_price")
RECEIPT_FIELDS = ("receipt_id", "date", "total_amount", "payment_method", "transaction_id")
AGGREGATED_FIELDS = ("total_amount", "event_id", "store_id",
                     "begin_stream_aggregator", "end_stream_aggregator")

ITEM = T.StructType([
    T.StructField("item_id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("quantity", T.LongType()),   # Python ints are unbounded
    T.StructField("price_per_unit", T.DoubleType()),
    T.StructField("total_price", T.DoubleType()),
])

RECEIPT = T.StructType([
    T.StructField("receipt_id", T.StringType()),
    T.StructField("date", T.StringType()),
    T.StructField("total_amount", T.DoubleType()),
    T.StructField("payment_method", T.StringType()),
    T.StructField("transaction_id", T.StringType()),
])

TRANSACTION = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("store_id", T.StringType()),
    T.StructField("cashier_id", T.StringType()),
    T.StructField("items", T.ArrayType(ITEM)),
    T.StructField("total_amount", T.DoubleType()),
    T.StructField("payment_method", T.StringType()),
    T.StructField("payment_status", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("loyalty_points_earned", T.LongType()),
    T.StructField("receipt", RECEIPT),
])

AGGREGATED_EVENT = T.StructType([
    T.StructField("total_amount", T.DoubleType()),
    T.StructField("event_id", T.StringType()),
    T.StructField("store_id", T.StringType()),
    T.StructField("begin_stream_aggregator", T.StringType()),
    T.StructField("end_stream_aggregator", T.StringType()),
])

# Slim schema the turnover stage needs from a published transaction: column
# pruning reaches into the JSON parse, only three fields are materialised.
SALE_SLIM = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("store_id", T.StringType()),
    T.StructField("total_amount", T.DoubleType()),
])

# Published message envelope (Kafka-style record).
HEADER = T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.BinaryType())])
ENVELOPE = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("headers", T.ArrayType(HEADER)),
])

# Landed messages (file twin of a broker topic).
LANDING = T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.StringType())])

# Lookup documents of the producer side.
CATALOG_ITEM = T.StructType([T.StructField("name", T.StringType()), T.StructField("price", T.DoubleType())])
