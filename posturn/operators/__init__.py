"""DataFrame -> DataFrame operators; each works on batch and streaming input."""

from .correct import basket_fold, basket_sum, correct_totals, payment_gate
from .lateness import on_time, tag_late
from .metrics import lag_histogram, observe_progress, outcome_counts
from .route import (aggregate_envelopes, parse_topic, route_to_stores, store_queue, subscribe,
                    transaction_envelopes)
from .turnover import format_aggregated_event, merge_turnover, tumbling_window, turnover
from .validate import validate_aggregates, validate_transactions

__all__ = [
    "basket_fold", "basket_sum", "correct_totals", "payment_gate",
    "on_time", "tag_late",
    "lag_histogram", "observe_progress", "outcome_counts",
    "aggregate_envelopes", "parse_topic", "route_to_stores", "store_queue", "subscribe",
    "transaction_envelopes",
    "format_aggregated_event", "merge_turnover", "tumbling_window", "turnover",
    "validate_aggregates", "validate_transactions",
]
