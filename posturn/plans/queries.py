"""Driver queries: one per operator, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the warehouse tables (through the fixture readers) in
full; none uses a sample, an id subset or a row cap.  Output columns are
aliased to the names used by the SQL oracles in :mod:`posturn.plans.oracle`.
Timestamps leave as ISO text so both engines render them identically.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions.timefmt import iso_utc, parse_event_time
from ..operators.correct import basket_sum
from ..operators.delivery import deliver
from ..operators.lateness import on_time, tag_late, tag_late_by_rank
from ..operators.metrics import lag_histogram, observe_progress, outcome_counts
from ..operators.route import aggregate_envelopes, parse_topic, subscribe, transaction_envelopes
from ..operators.turnover import format_aggregated_event, merge_turnover, turnover
from ..operators.rules import rule_flags, validate_aggregate_messages
from ..operators.validate import validate_aggregates
from ..sources.fixtures import aggregate_bodies, noisy_transaction_feed, sales_events, transaction_feed
from ..sinks.envelopes import broker_records, message_path
from ..sources.tables import read_table
from . import batch

Query = Callable[[SparkSession, str], DataFrame]

OFFSET_ORIGIN = datetime(2024, 11, 15, 0, 0, 3, 500000, tzinfo=timezone.utc)
# Subscriptions exercised by the topic filter query.
FILTER_SUBSCRIPTIONS = (C.TOPIC_PREFIX + "/receipt/STORE_3/>", C.TOPIC_PREFIX + "/aggregations/STORE_7/>")
# Synthetic delivery lag of an event: (event_id % 61) tenths of a second.
LAG_MODULUS, LAG_STEP_MS = 61, 100


def errors_text(col: str = "errors"):
    return F.array_join(F.col(col), " | ").alias("errors_text")


def turnover_columns(df: DataFrame) -> DataFrame:
    """Turnover rows -> the compared projection (timestamps as ISO text)."""
    return df.select("store_id", iso_utc(F.col("window_start")).alias("window_start"),
                     iso_utc(F.col("window_end")).alias("window_end"), "total_amount", "n_events",
                     iso_utc(F.col("min_ts")).alias("begin_stream_aggregator"),
                     iso_utc(F.col("max_ts")).alias("end_stream_aggregator"))


# --- windowed turnover --------------------------------------------------------
def q_turnover_10s(spark: SparkSession, sf: str) -> DataFrame:
    return turnover_columns(turnover(sales_events(spark, sf)))


def q_turnover_1h(spark: SparkSession, sf: str) -> DataFrame:
    return turnover_columns(turnover(sales_events(spark, sf), length_seconds=3600))


def q_turnover_offset_origin(spark: SparkSession, sf: str) -> DataFrame:
    return turnover_columns(turnover(sales_events(spark, sf), align_to=OFFSET_ORIGIN))


def q_turnover_formatted(spark: SparkSession, sf: str) -> DataFrame:
    return format_aggregated_event(turnover(sales_events(spark, sf))).select(
        "total_amount", "event_id", "store_id", "begin_stream_aggregator", "end_stream_aggregator")


def q_turnover_merge(spark: SparkSession, sf: str) -> DataFrame:
    s = sales_events(spark, sf)
    even = turnover(s.where(F.col("event_id") % 2 == 0))
    odd = turnover(s.where(F.col("event_id") % 2 == 1))
    return turnover_columns(merge_turnover(even, odd))


# --- lateness -----------------------------------------------------------------
def q_late_split(spark: SparkSession, sf: str) -> DataFrame:
    return tag_late(sales_events(spark, sf)).select("event_id", "store_id", "late")


def q_late_split_ranked(spark: SparkSession, sf: str) -> DataFrame:
    """Late tags where arrival is a time of day in whole hours, so many rows share one and most hours are far apart."""
    hours = F.floor(F.unix_micros("event_time") / F.lit(3_600_000_000)) * F.lit(3_600_000_000)
    sales = sales_events(spark, sf).withColumn("arrival_key", hours + F.col("arrival_key") - F.col("event_id"))
    return tag_late_by_rank(sales).select("event_id", "store_id", "late")


def q_turnover_on_time(spark: SparkSession, sf: str) -> DataFrame:
    return turnover_columns(turnover(on_time(sales_events(spark, sf))))


# --- validation stage -----------------------------------------------------------
def _validated(spark: SparkSession, sf: str) -> DataFrame:
    """Validated clean feed; lazy, so a query is one pass over the feed."""
    return batch.validate_stage(transaction_feed(spark, sf))


def _noisy_validated(spark: SparkSession, sf: str) -> DataFrame:
    return batch.validate_stage(noisy_transaction_feed(spark, sf))


def q_json_parse_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    return _noisy_validated(spark, sf).select("o_orderkey", "noise", "outcome", errors_text())


def q_rule_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    return rule_flags(noisy_transaction_feed(spark, sf)).select(
        "o_orderkey", "store_ok", "cashier_ok", "total_ok", "method_ok", "status_ok", "quantity_ok", "price_ok",
        "line_total_ok", "receipt_ok", "present_ok", "uuid_ok", "types_ok")


def q_agg_body_validation(spark: SparkSession, sf: str) -> DataFrame:
    """Raw aggregate bodies (VAL-A1, Q, U, Y) through the same rule registry as the transactions' flags."""
    bodies = aggregate_bodies(format_aggregated_event(turnover(sales_events(spark, sf))))
    v = validate_aggregate_messages(bodies)
    return v.select("store_id", iso_utc(F.col("window_start")).alias("window_start"), "noise", "outcome", errors_text(),
                    F.col("aggregate.event_id").alias("event_id"), F.col("aggregate.total_amount").alias("total_amount"))


def q_validation_errors(spark: SparkSession, sf: str) -> DataFrame:
    v = _validated(spark, sf)
    return v.select("o_orderkey", "outcome", F.size("errors").alias("n_errors"), errors_text())


def q_rejects(spark: SparkSession, sf: str) -> DataFrame:
    v = _noisy_validated(spark, sf)
    return batch.rejects(v, keep=("o_orderkey",)).select("o_orderkey", "reject_stage", errors_text())


def q_accept_ack(spark: SparkSession, sf: str) -> DataFrame:
    return _ack(_noisy_validated(spark, sf))


def _ack(v: DataFrame) -> DataFrame:
    accepted = F.col("outcome").isin(C.OUTCOME_PUBLISHED, C.OUTCOME_UNPAID)
    return v.select(
        "o_orderkey",
        F.when(accepted, F.lit(C.STATUS_SUCCESS)).otherwise(F.lit(C.STATUS_ERROR)).alias("status"),
        F.when(accepted, F.col("txn.transaction_id")).alias("transaction_id"),
        F.when(accepted, F.lit(C.MSG_TXN_ACCEPTED)).otherwise(F.lit(C.MSG_REQUEST_FAILED)).alias("message"))


def q_corrected_totals(spark: SparkSession, sf: str) -> DataFrame:
    v = _validated(spark, sf).where(F.col("outcome").isin(C.OUTCOME_PUBLISHED, C.OUTCOME_UNPAID))
    return v.select(F.col("txn.transaction_id").alias("transaction_id"), "original_total", "corrected",
                    F.col("txn.total_amount").alias("total_amount"))


def q_basket_sum(spark: SparkSession, sf: str) -> DataFrame:
    v = _validated(spark, sf).where(F.col("outcome").isin(C.OUTCOME_PUBLISHED, C.OUTCOME_UNPAID))
    return v.select(F.col("txn.transaction_id").alias("transaction_id"),
                    F.size("txn.items").alias("n_items"), basket_sum(F.col("txn.items")).alias("basket_sum"))


def q_payment_gate(spark: SparkSession, sf: str) -> DataFrame:
    v = batch.published(_validated(spark, sf))
    return v.select(F.col("txn.transaction_id").alias("transaction_id"), F.col("txn.store_id").alias("store_id"),
                    F.col("txn.total_amount").alias("total_amount"))


def q_unpaid(spark: SparkSession, sf: str) -> DataFrame:
    v = _validated(spark, sf).where(F.col("outcome") == C.OUTCOME_UNPAID)
    return v.select(F.col("txn.transaction_id").alias("transaction_id"),
                    F.col("txn.payment_status").alias("payment_status"))


# --- envelopes, topics, routing ---------------------------------------------------
def _envelope_columns(env: DataFrame, id_field: str, *extra) -> DataFrame:
    return env.select(
        "topic", "key", *extra,
        F.col("headers")[0]["key"].alias("header_key"),
        F.col("headers")[0]["value"].cast("string").alias("header_value"),
        F.get_json_object("value", "$.total_amount").try_cast("double").alias("payload_total_amount"),
        F.get_json_object("value", "$.store_id").alias("payload_store_id"),
        F.get_json_object("value", f"$.{id_field}").alias("payload_id"))


def q_txn_envelope(spark: SparkSession, sf: str) -> DataFrame:
    env = transaction_envelopes(batch.published(_validated(spark, sf)))
    return _envelope_columns(env, "transaction_id",
                             F.json_array_length(F.get_json_object("value", "$.items")).alias("payload_n_items"))


def q_agg_envelope(spark: SparkSession, sf: str) -> DataFrame:
    agg = format_aggregated_event(turnover(sales_events(spark, sf)))
    return _envelope_columns(aggregate_envelopes(agg, require_key=False), "event_id")


def q_topic_filter(spark: SparkSession, sf: str) -> DataFrame:
    txn_env = transaction_envelopes(batch.published(_validated(spark, sf)))
    agg_env = aggregate_envelopes(format_aggregated_event(turnover(sales_events(spark, sf))), require_key=False)
    both = txn_env.select("topic", "key").unionByName(agg_env.select("topic", "key"))
    return subscribe(both, *FILTER_SUBSCRIPTIONS)


def table_subscriptions(spark: SparkSession, sf: str) -> DataFrame:
    """``(queue, subscription)``: customers to their receipts (even ones twice, in two forms), regions and nations to stores."""
    def subscriptions(name: str, column: str, queue: str, *texts: str) -> DataFrame:
        rows = read_table(spark, sf, name, [column])
        return rows.select(F.concat(F.lit(queue), F.col(column).cast("string")).alias("queue"),
                           F.explode(F.array(*[F.expr(t) for t in texts])).alias("subscription"))

    p, own = C.TOPIC_PREFIX, "/*" * 7
    receipts = "'/CUSTOMER_' || cast(c_custkey AS string)"
    return subscriptions("customer", "c_custkey", "customer_", f"'{p}/receipt/*{own}' || {receipts}",
                         f"CASE WHEN c_custkey % 2 = 0 THEN '{p}/receipt/STORE_*{own}' || {receipts} END") \
        .unionByName(subscriptions("region", "r_regionkey", "region_",
                                   f"'{p}/receipt/STORE_' || cast(r_regionkey + 1 AS string) || '/>'")) \
        .unionByName(subscriptions("nation", "n_nationkey", "nation_",
                                   f"'{p}/receipt/STORE_' || cast(n_nationkey AS string) || '*/>'"))


def q_topic_deliveries(spark: SparkSession, sf: str) -> DataFrame:
    env = transaction_envelopes(batch.published(_validated(spark, sf))).select("topic", "key")
    return deliver(env, table_subscriptions(spark, sf)).select("queue", "key")


def q_broker_records(spark: SparkSession, sf: str) -> DataFrame:
    records = broker_records(transaction_envelopes(batch.published(_validated(spark, sf))))
    return records.select("topic", "key", message_path(F.col("headers")).alias("path"))


def q_topic_parse(spark: SparkSession, sf: str) -> DataFrame:
    env = transaction_envelopes(batch.published(_validated(spark, sf)))
    parsed = parse_topic(env)
    return parsed.select("key", *[c for c in parsed.columns if c.startswith("t_")])


def _noisy_aggregates(spark: SparkSession, sf: str) -> DataFrame:
    pub = batch.published(_noisy_validated(spark, sf))
    usable, _ = batch.split_event_time(batch.sales_from_published(pub))
    return batch.turnover_stage(usable)


def q_store_routes(spark: SparkSession, sf: str) -> DataFrame:
    routed = batch.publish_aggregates_stage(_noisy_aggregates(spark, sf))
    return routed.select("queue", "topic", "key")


def q_agg_validation(spark: SparkSession, sf: str) -> DataFrame:
    pub = batch.published(_validated(spark, sf))
    usable, _ = batch.split_event_time(batch.sales_from_published(pub))
    checked = validate_aggregates(batch.turnover_stage(usable))
    return checked.select("store_id", iso_utc(F.col("window_start")).alias("window_start"), "total_amount",
                          "n_events", "status", "message", errors_text())


def q_bad_event_time(spark: SparkSession, sf: str) -> DataFrame:
    pub = batch.published(_noisy_validated(spark, sf))
    sales = pub.select("o_orderkey", F.col("txn.timestamp").alias("timestamp"),
                       parse_event_time(F.col("txn.timestamp")).alias("event_time"))
    _, bad = batch.split_event_time(sales)
    return bad.select("o_orderkey", "timestamp", "reason")


# --- counters -----------------------------------------------------------------------
def q_outcome_counts(spark: SparkSession, sf: str) -> DataFrame:
    return outcome_counts(_noisy_validated(spark, sf))


def q_lag_histogram(spark: SparkSession, sf: str) -> DataFrame:
    ev = read_table(spark, sf, "events", ["event_id", "ts", "event_type"])
    event_time = F.col("ts").cast("timestamp")
    arrival = F.timestamp_micros(F.unix_micros(event_time)
                                 + (F.col("event_id") % LAG_MODULUS) * F.lit(LAG_STEP_MS * 1000))
    lagged = ev.select("event_type", ((F.unix_micros(arrival) - F.unix_micros(event_time)) / 1e6)
                       .alias("lag_seconds"))
    return lag_histogram(lagged, by=("event_type",))


def q_progress_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Counters of one pass over the noisy feed, read from its observation after the action."""
    counters = {name: F.count(F.when(F.col("outcome") == name, 1)) for name in C.OUTCOMES}
    observed, progress = observe_progress(_noisy_validated(spark, sf).select("outcome"), counters=counters)
    observed.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame(sorted(progress.get.items()), "counter string, n long")


# --- extension points -------------------------------------------------------------
def q_generic_fold(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators.fold import (TURNOVER_ACC, tumbling_fold, turnover_builder, turnover_folder,
                                  turnover_merger, turnover_total)
    s = sales_events(spark, sf).withColumn("event_time_us", F.unix_micros("event_time"))
    folded = tumbling_fold(s, "store_id", "event_time", ["event_time_us", "total_amount"],
                           turnover_builder, turnover_folder, turnover_merger, TURNOVER_ACC)
    return folded.select(
        "store_id", iso_utc(F.col("window_start")).alias("window_start"),
        iso_utc(F.col("window_end")).alias("window_end"),
        turnover_total().alias("total_amount"), "n_events",
        iso_utc(F.timestamp_micros("min_us")).alias("begin_stream_aggregator"),
        iso_utc(F.timestamp_micros("max_us")).alias("end_stream_aggregator"))


def q_longest_rise(spark: SparkSession, sf: str) -> DataFrame:
    """Longest stretch of rising sales per store and hour: a fold in the order of the rows."""
    from ..operators.segments import LONGEST_RISE, ordered_fold
    folded = ordered_fold(sales_events(spark, sf), "store_id", "event_time", ["total_amount"], ["event_time", "event_id"],
                          LONGEST_RISE, length_seconds=3600)
    return folded.select("store_id", iso_utc(F.col("window_start")).alias("window_start"), "n_events",
                         F.col("first").alias("first_amount"), F.col("last").alias("last_amount"),
                         F.col("longest").alias("longest_rise"))


def q_json_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Item catalogue (from ``part``) as JSON array documents, read back."""
    import uuid

    from ..schemas import CATALOG_ITEM
    from ..session import scratch_path
    from ..sources.lookups import read_json_documents, write_json_documents
    path = scratch_path(spark, "lookups", f"catalog-{uuid.uuid4().hex}")
    part = read_table(spark, sf, "part", ["p_name", "p_retailprice"])
    write_json_documents(part.select(F.col("p_name").alias("name"), F.col("p_retailprice").alias("price")), path)
    return read_json_documents(spark, path, CATALOG_ITEM)


def q_string_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """The order priorities as an array of strings in one JSON document, read back."""
    import uuid

    from ..session import scratch_path
    from ..sources.lookups import read_string_list
    path = scratch_path(spark, "lookups", f"names-{uuid.uuid4().hex}")
    names = read_table(spark, sf, "orders", ["o_orderpriority"]).agg(
        F.to_json(F.array_sort(F.collect_set("o_orderpriority"))).alias("value"))
    names.write.text(path)
    return read_string_list(spark, path).toDF("name")


QUERIES: dict[str, Query] = {
    "turnover_10s": q_turnover_10s,
    "turnover_1h": q_turnover_1h,
    "turnover_offset_origin": q_turnover_offset_origin,
    "turnover_formatted": q_turnover_formatted,
    "turnover_merge": q_turnover_merge,
    "late_split": q_late_split,
    "late_split_ranked": q_late_split_ranked,
    "turnover_on_time": q_turnover_on_time,
    "json_parse_outcomes": q_json_parse_outcomes,
    "rule_outcomes": q_rule_outcomes,
    "validation_errors": q_validation_errors,
    "rejects": q_rejects,
    "accept_ack": q_accept_ack,
    "corrected_totals": q_corrected_totals,
    "basket_sum": q_basket_sum,
    "payment_gate": q_payment_gate,
    "unpaid": q_unpaid,
    "txn_envelope": q_txn_envelope,
    "agg_envelope": q_agg_envelope,
    "topic_filter": q_topic_filter,
    "topic_deliveries": q_topic_deliveries,
    "broker_records": q_broker_records,
    "topic_parse": q_topic_parse,
    "store_routes": q_store_routes,
    "agg_validation": q_agg_validation,
    "agg_body_validation": q_agg_body_validation,
    "progress_counts": q_progress_counts,
    "string_lookup": q_string_lookup,
    "bad_event_time": q_bad_event_time,
    "outcome_counts": q_outcome_counts,
    "lag_histogram": q_lag_histogram,
    "generic_fold": q_generic_fold,
    "longest_rise": q_longest_rise,
    "json_lookup": q_json_lookup,
}


def all_queries() -> dict[str, Query]:
    """Batch queries plus the stream runners (imported lazily: they need pandas/pyarrow)."""
    from .stream_queries import STREAM_QUERIES
    return {**QUERIES, **STREAM_QUERIES}
