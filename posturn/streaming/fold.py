"""User-defined window fold on a stream (``applyInPandasWithState``).

The streaming twin of :func:`posturn.operators.fold.tumbling_fold`: the same
``builder`` / ``folder`` and accumulator schema, state per (key, window) in the
state store, and one output row per window when the watermark passes the
window end -- the "emit once at close" semantics of the service's window
operator.  A row is late when its window has closed, as in the native window
aggregate; Spark leaves such rows out before the fold, so a closed window is
never emitted twice and an out-of-order row of an open window still counts.

A call of Python costs far more than a row, and most windows hold few rows.  So a
group is not one window but one of ``BUCKETS`` hash buckets of (key, window): its
state holds the accumulators of its open windows, and one call folds its rows of
a micro-batch and emits what has closed.  A hot store is split into its
windows, and one group's rows in one micro-batch are bounded by the trigger size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import datetime

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from .. import config as C
from ..operators.fold import Acc
from ..operators.turnover import tumbling_window
from .closing import before_close

#: Groups of a fold, whatever the number of its windows; part of the state's layout.
BUCKETS = 128


def tumbling_fold_stream(df: DataFrame, key: str, time_col: str, value_cols: list[str],
                         builder: Callable[[], Acc], folder: Callable[[Acc, dict], Acc],
                         acc_schema: T.StructType, length_seconds: float = C.WINDOW_LENGTH_SECONDS,
                         align_to: datetime = C.WINDOW_ALIGN_TO,
                         lateness_ms: int = C.ALLOWED_LATENESS_MS) -> DataFrame:
    """Fold ``value_cols`` per (key, tumbling window) of a streaming DataFrame.

    Output columns: ``key``, window_start, window_end and the accumulator
    fields, appended once per window after it closes.  A row whose time is
    ``CLOSE_TIME`` moves the watermark and is not folded; one without a time is
    in no window.
    """
    w = tumbling_window(F.col(time_col), length_seconds, align_to)
    # Window bounds travel as epoch microseconds: no time-zone conversion in
    # Python, whatever the executors' local zone.
    # The window end, not the row's own time, is what lateness is judged by; it
    # carries the watermark's mark, and the time column travels without it.
    delay = {"spark.watermarkDelayMs": int(lateness_ms)}
    rows = (before_close(df.withWatermark(time_col, f"{int(lateness_ms)} milliseconds"), time_col)
              .select(F.pmod(F.xxhash64(F.col(key), w.start), F.lit(BUCKETS)).alias("_bucket"), F.col(key).alias("_key"),
                      F.col(key).isNull().alias("_none"), F.unix_micros(w.start).alias("_ws"),
                      F.unix_micros(w.end).alias("_we"),
                      F.timestamp_micros(F.unix_micros(w.end)).alias("_close", metadata=delay),
                      F.timestamp_micros(F.unix_micros(F.col(time_col))).alias(time_col),
                      *[c for c in value_cols if c != time_col]))
    acc_fields = [f.name for f in acc_schema.fields]
    key_type = df.schema[key].dataType
    out_schema = T.StructType([T.StructField("_key", key_type), T.StructField("_ws", T.LongType()),
                               T.StructField("_we", T.LongType()), *acc_schema.fields])
    state_schema = T.StructType([T.StructField("open", T.ArrayType(out_schema))])
    # pandas turns whole numbers with a NULL among them into doubles, so a NULL key travels as a flag.
    if isinstance(key_type, (T.IntegralType, T.BooleanType)):
        rows = rows.withColumn("_key", F.coalesce("_key", F.lit(0).cast(key_type)))
    passed = [c for c in rows.columns if c != "_close"]

    def fold(group: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = state.get[0] if state.exists else []
        open_accs = {(r[0], r[1], r[2]): dict(zip(acc_fields, r[3:])) for r in held}
        if not state.hasTimedOut:
            for pdf in pdfs:
                for rec in pdf[passed].to_dict("records"):
                    at = None if rec["_none"] else rec["_key"], rec["_ws"], rec["_we"]
                    acc = open_accs.get(at)
                    open_accs[at] = folder(builder() if acc is None else acc, rec)
        # A row is late from the batch on after the watermark has reached its window's end: none follows what is emitted.
        watermark_us = state.getCurrentWatermarkMs() * 1000
        closed = [at for at in open_accs if at[2] <= watermark_us]
        if closed:
            yield pd.DataFrame([_row(at, open_accs.pop(at)) for at in closed], columns=out_schema.names, dtype=object)
        if open_accs:
            state.update(([_row(at, acc) for at, acc in open_accs.items()],))
            # Fires once the watermark reaches the first window end (watermark > end - 1 ms);
            # a timeout must lie ahead of the batch's watermark.
            first = min(end for _, _, end in open_accs)
            state.setTimeoutTimestamp(max(-(-first // 1000) - 1, watermark_us // 1000 + 1))
        elif state.exists:
            state.remove()

    def _row(at: tuple, acc: Acc) -> tuple:
        return (*at, *[acc.get(f) for f in acc_fields])

    folded = rows.groupBy("_bucket").applyInPandasWithState(
        fold, out_schema, state_schema, "append", GroupStateTimeout.EventTimeTimeout)
    return folded.select(F.col("_key").alias(key), F.timestamp_micros("_ws").alias("window_start"),
                         F.timestamp_micros("_we").alias("window_end"), *acc_fields)
