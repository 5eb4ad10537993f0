"""The three service stages as batch plans over DataFrames.

A. raw messages -> validated, corrected, gated -> {published, unpaid, rejects}
B. published transactions -> event time -> windowed turnover (+ time quarantine)
C. aggregated events -> validated -> envelopes routed to per-store queues

Stage A is one narrow stage (no shuffle); stage B has one hash exchange on
(window, store) after a partial aggregate; stage C is narrow again.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.binding import bind
from ..functions.timefmt import parse_event_time
from ..operators.correct import correct_totals, payment_gate
from ..operators.route import aggregate_envelopes, route_to_stores
from ..operators.turnover import format_aggregated_event, turnover
from ..operators.validate import judge_transactions, validate_aggregates, with_transaction


def validate_stage(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """Stage A: every input row with its final ``outcome``, ``errors`` and ``txn``.

    Narrow and lazy.  The judgement is bound, so a filter on ``outcome`` reads
    it instead of validating again.  The gate needs only the payment status:
    the record and its total are made above it, for the rows and queries that
    read them.
    """
    judged = payment_gate(judge_transactions(raw, value_col), txn_col="_gate")
    bound = bind(judged.drop("_gate"), {c: F.col(c) for c in ("outcome", "errors", "_fast", "_j", "_s_txn")})
    v = correct_totals(with_transaction(bound))
    return v.select(*[c for c in raw.columns if not c.startswith("_")], "outcome", "errors", "txn", "original_total", "corrected")


def published(validated: DataFrame) -> DataFrame:
    return validated.where(F.col("outcome") == C.OUTCOME_PUBLISHED)


def rejects(validated: DataFrame, value_col: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Quarantine rows: raw text, outcome and errors (plus ``keep`` columns)."""
    bad = F.col("outcome").isin(C.OUTCOME_MALFORMED, C.OUTCOME_SERVER_ERROR, C.OUTCOME_REJECTED)
    return validated.where(bad).select(*keep, value_col, F.col("outcome").alias("reject_stage"), "errors")


def sales_from_published(pub: DataFrame) -> DataFrame:
    """Published transactions -> (store_id, event_time, total_amount, timestamp)."""
    return pub.select(F.col("txn.store_id").alias("store_id"), F.col("txn.timestamp").alias("timestamp"),
                      parse_event_time(F.col("txn.timestamp")).alias("event_time"),
                      F.col("txn.total_amount").alias("total_amount"))


def split_event_time(sales: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(usable, quarantined): rows whose timestamp text does not parse go aside."""
    ok = F.col("event_time").isNotNull()
    bad = sales.where(~ok).withColumn("reason", F.lit(C.REASON_BAD_EVENT_TIME))
    return sales.where(ok), bad


def turnover_stage(sales: DataFrame, length_seconds: float = C.WINDOW_LENGTH_SECONDS,
                   align_to: datetime = C.WINDOW_ALIGN_TO) -> DataFrame:
    """Stage B on usable sales: AggregatedEvent rows with window bounds."""
    return format_aggregated_event(turnover(sales, length_seconds=length_seconds, align_to=align_to))


def publish_aggregates_stage(aggregated: DataFrame) -> DataFrame:
    """Stage C: validated aggregates -> routed envelopes (accepted ones only).

    ``aggregated`` comes from ``turnover_stage``, so every event id is set.
    """
    checked = validate_aggregates(aggregated)
    ok = checked.where(F.col("status") == C.STATUS_SUCCESS)
    return route_to_stores(aggregate_envelopes(ok, require_key=False))
