"""Turnover per key in aligned, event-time tumbling windows.

Physical shape: partial hash aggregate per task -> one hash exchange on
(window, key) -> final aggregate.  Only partial states cross the network, so
a store that holds a third of all sales costs no more shuffle than any other;
the sums are exact, unrounded and merge in any order.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.ids import deterministic_uuid
from ..functions.money import money_sum
from ..functions.timefmt import iso_utc


def tumbling_window(time_col: Column, length_seconds: float = C.WINDOW_LENGTH_SECONDS,
                    align_to: datetime = C.WINDOW_ALIGN_TO) -> Column:
    """Half-open ``[start, end)`` window STRUCT aligned to ``align_to``."""
    length_us = int(round(length_seconds * 1_000_000))
    offset_us = C.window_offset_micros(length_seconds, align_to)
    return F.window(time_col, f"{length_us} microseconds", startTime=f"{offset_us} microseconds")


def turnover(df: DataFrame, key: str = "store_id", time_col: str = "event_time",
             amount_col: str = "total_amount", length_seconds: float = C.WINDOW_LENGTH_SECONDS,
             align_to: datetime = C.WINDOW_ALIGN_TO) -> DataFrame:
    """Accumulate (sum, min time, max time, count) per (key, window).

    Columns: key, window_start, window_end (TIMESTAMP), total_amount (DOUBLE,
    unrounded), min_ts, max_ts, n_events.  Works unchanged on a streaming
    DataFrame that carries a watermark on ``time_col``.
    """
    w = tumbling_window(F.col(time_col), length_seconds, align_to)
    return (df.groupBy(w.alias("window"), F.col(key))
              .agg(money_sum(F.col(amount_col)).alias("total_amount"),
                   F.min(time_col).alias("min_ts"),
                   F.max(time_col).alias("max_ts"),
                   F.count(F.lit(1)).alias("n_events"))
              .select(key, F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                      "total_amount", "min_ts", "max_ts", "n_events"))


def merge_turnover(*parts: DataFrame, key: str = "store_id") -> DataFrame:
    """Merge partial turnover tables of the same windowing (sum/min/max/count).

    Null-tolerant on either side like the streaming merger; exact because the
    partial totals are not rounded.
    """
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return (u.groupBy(key, "window_start", "window_end")
             .agg(money_sum(F.col("total_amount")).alias("total_amount"),
                  F.min("min_ts").alias("min_ts"), F.max("max_ts").alias("max_ts"),
                  F.sum("n_events").alias("n_events")))


def format_aggregated_event(df: DataFrame, key: str = "store_id") -> DataFrame:
    """Turnover rows -> AggregatedEvent rows (+ window bounds kept internally).

    ``begin/end_stream_aggregator`` are the first and last event times seen in
    the window (ISO text); ``event_id`` is derived from (key, window start) so
    a replayed window carries the same id.
    """
    return df.select(
        F.round(F.col("total_amount"), 2).alias("total_amount"),
        deterministic_uuid(F.col(key), iso_utc(F.col("window_start"))).alias("event_id"),
        F.col(key).alias("store_id"),
        iso_utc(F.col("min_ts")).alias("begin_stream_aggregator"),
        iso_utc(F.col("max_ts")).alias("end_stream_aggregator"),
        "window_start", "window_end", "n_events",
    )
