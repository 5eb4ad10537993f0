"""User-defined window fold: builder / folder / merger over (key, window).

The built-in turnover uses Spark aggregates.  For an arbitrary Python fold
the same shape is kept as a two-level aggregation, so a hot key is never
gathered into one task:

1. ``mapInPandas``: every input partition, sorted by (key, window), folds its own
   rows into one accumulator per group with ``builder`` and ``folder``;
2. one shuffle of those partial accumulators on (key, window);
3. ``mapInPandas`` over the exchanged partials, sorted again: the partials of a
   group (at most one per input partition) are combined with ``merger``; one
   Python call per task, not per group, and one accumulator held at a time.

Accumulators are dicts whose fields follow ``acc_schema``.  Window bounds are
computed JVM-side before any Python runs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import datetime
from decimal import ROUND_HALF_UP, Context, Decimal

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from .turnover import tumbling_window

Acc = dict


def tumbling_fold(df: DataFrame, key: str, time_col: str, value_cols: list[str],
                  builder: Callable[[], Acc], folder: Callable[[Acc, dict], Acc],
                  merger: Callable[[Acc, Acc], Acc], acc_schema: T.StructType,
                  length_seconds: float = C.WINDOW_LENGTH_SECONDS,
                  align_to: datetime = C.WINDOW_ALIGN_TO) -> DataFrame:
    """Fold ``value_cols`` per (key, tumbling window); returns key, window bounds, accumulator fields."""
    w = tumbling_window(F.col(time_col), length_seconds, align_to)
    rows = df.select(F.col(key).alias("_key"), w.start.alias("window_start"), w.end.alias("window_end"),
                     *value_cols)
    acc_fields = [f.name for f in acc_schema.fields]
    out_schema = T.StructType([T.StructField("_key", df.schema[key].dataType),
                               T.StructField("window_start", T.TimestampType()),
                               T.StructField("window_end", T.TimestampType()), *acc_schema.fields])

    group = ["_key", "window_start", "window_end"]

    def by_group(start: Callable[[dict], Acc], add: Callable[[Acc, dict], Acc]):
        """Accumulators of sorted rows; one is held at a time, beside the finished ones of a batch."""
        def row(g: tuple, acc: Acc) -> dict:
            return {**dict(zip(group, g)), **{f: acc.get(f) for f in acc_fields}}

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            here, acc = None, None
            for pdf in batches:
                done = []
                for rec in pdf.to_dict("records"):
                    g = tuple(None if pd.isna(rec[c]) else rec[c] for c in group)
                    if g == here:
                        acc = add(acc, rec)
                        continue
                    if here is not None:
                        done.append(row(here, acc))
                    here, acc = g, start(rec)
                if done:
                    yield pd.DataFrame(done)
            if here is not None:
                yield pd.DataFrame([row(here, acc)])
        return run

    partial = by_group(lambda rec: folder(builder(), rec), folder)
    merge = by_group(lambda rec: {f: rec[f] for f in acc_fields},
                     lambda acc, rec: merger(acc, {f: rec[f] for f in acc_fields}))

    partials = rows.sortWithinPartitions(*group).mapInPandas(partial, out_schema)
    # Hash exchange on the group: every group's partials meet in one task.
    merged = partials.repartition(*group).sortWithinPartitions(*group).mapInPandas(merge, out_schema)
    return merged.withColumnRenamed("_key", key)


# --- The turnover accumulator expressed as a fold (used by the driver query) ----
TURNOVER_ACC = T.StructType([
    T.StructField("total", T.DecimalType(38, 10)),
    T.StructField("misfits", T.DoubleType()),
    T.StructField("min_us", T.LongType()),
    T.StructField("max_us", T.LongType()),
    T.StructField("n_events", T.LongType()),
])


#: Amounts are added with ten decimals, as in ``functions.money``; what they cannot hold is added as a double.
_UNIT, _EXACT = Decimal(1).scaleb(-10), Context(prec=60)


def turnover_total() -> Column:
    """The accumulator's unrounded sum, as DOUBLE; NULL without amounts."""
    exact, misfits = F.col("total").cast("double"), F.col("misfits")
    return F.when(misfits.isNull(), exact).otherwise(F.coalesce(exact, F.lit(0.0)) + misfits)


def turnover_builder() -> Acc:
    return {"total": None, "misfits": None, "min_us": None, "max_us": None, "n_events": 0}


def turnover_folder(acc: Acc, row: dict) -> Acc:
    t = int(row["event_time_us"])
    amount = row["total_amount"]
    if not pd.isna(amount):
        if abs(amount) < 1e18:
            unit = Decimal(repr(float(amount))).quantize(_UNIT, ROUND_HALF_UP, _EXACT)
            acc["total"] = unit if pd.isna(acc["total"]) else _EXACT.add(acc["total"], unit)
        else:
            acc["misfits"] = amount if pd.isna(acc["misfits"]) else acc["misfits"] + amount
    acc["min_us"] = t if acc["min_us"] is None else min(acc["min_us"], t)
    acc["max_us"] = t if acc["max_us"] is None else max(acc["max_us"], t)
    acc["n_events"] += 1
    return acc


def turnover_merger(a: Acc, b: Acc) -> Acc:
    def pick(f, x, y):
        if x is None or pd.isna(x):
            return y
        if y is None or pd.isna(y):
            return x
        return f(x, y)
    return {"total": pick(_EXACT.add, a["total"], b["total"]),
            "misfits": pick(float.__add__, a["misfits"], b["misfits"]),
            "min_us": pick(min, a["min_us"], b["min_us"]),
            "max_us": pick(max, a["max_us"], b["max_us"]),
            "n_events": int(a["n_events"]) + int(b["n_events"])}
