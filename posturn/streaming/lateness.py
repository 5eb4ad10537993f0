"""Strict per-key lateness for streams (``applyInPandasWithState``).

Spark's watermark is global to a query and only moves at batch ends, so it
keeps rows that a per-store event clock would already call late.  The strict
mode keeps one number of state per store -- the largest event time seen so
far -- and tags each arriving row as late when it lies more than the allowed
lateness behind that clock.  Within a micro-batch the rows of a store are put
in arrival order first (batch order after the exchange is not promised).

State is O(1) per key.  The rows of one store in one micro-batch are handled
by one task, so a hot store costs at most one trigger's worth of its rows;
``maxOffsetsPerTrigger`` / ``maxFilesPerTrigger`` bound that.

:func:`strict_late_scan_writer` gives the same tags without that limit: each
micro-batch is tagged JVM-side by the batch prefix scan
(:func:`~posturn.operators.lateness.tag_late`, chunked, so a store's rows
spread over many tasks), seeded with every store's clock carried over from
the previous batch.  The carry is a table with one row per store, written per
batch id, so a replayed batch reads the same carry and rewrites the same
output.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from .. import config as C
from ..operators.lateness import DEFAULT_CHUNK_SPAN, tag_late
from .sources import epoch_dir

TAG_SCHEMA = ("store_id string, event_id long, event_time_us long, total_amount double, "
              "arrival_key long, late boolean")
STATE_SCHEMA = "max_seen_us long"


def _tagger(lateness_us: int):
    def tag(key: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        parts = [p for p in pdfs if len(p)]
        if not parts:
            return
        batch = pd.concat(parts, ignore_index=True)
        batch = batch.sort_values(["arrival_key", "event_id"], kind="stable", ignore_index=True)
        t = batch["event_time_us"].to_numpy(dtype=np.int64)
        prior = state.get[0] if state.exists else None
        running = np.maximum.accumulate(t)
        clock = np.empty(len(t), dtype=np.float64)
        clock[0] = np.nan if prior is None else prior
        if len(t) > 1:
            clock[1:] = running[:-1] if prior is None else np.maximum(running[:-1], prior)
        late = np.where(np.isnan(clock), False, t < clock - lateness_us)
        new_max = int(running[-1]) if prior is None else max(int(prior), int(running[-1]))
        state.update((new_max,))
        batch["late"] = late
        yield batch[["store_id", "event_id", "event_time_us", "total_amount", "arrival_key", "late"]]
    return tag


def strict_late_tags(sales: DataFrame, lateness_ms: int = C.ALLOWED_LATENESS_MS) -> DataFrame:
    """Streaming sales -> the same rows with a per-store strict ``late`` tag.

    Input columns: store_id, event_id, event_time (TIMESTAMP), total_amount,
    arrival_key.  A row without an event time is neither late nor on time: its
    tag is NULL, and it moves no clock.
    """
    prepared = sales.select("store_id", "event_id", F.unix_micros("event_time").alias("event_time_us"),
                            "total_amount", "arrival_key")
    tagged = prepared.where("event_time_us is not null").groupBy("store_id").applyInPandasWithState(
        _tagger(int(lateness_ms) * 1000), TAG_SCHEMA, STATE_SCHEMA, "append", GroupStateTimeout.NoTimeout)
    return tagged.unionByName(prepared.where("event_time_us is null").withColumn("late", F.lit(None).cast("boolean")))


def strict_late_scan_writer(out_root: str, lateness_ms: int = C.ALLOWED_LATENESS_MS, key: str = "store_id",
                            time_col: str = "event_time", arrival_col: str = "arrival_key",
                            tie_col: str = "event_id", chunk_span: int = DEFAULT_CHUNK_SPAN):
    """``foreachBatch`` body: strict per-key lateness by a parallel scan.

    Writes ``tagged/batch_id=<n>`` (the batch rows with ``clock`` and
    ``late``) and ``clocks/batch_id=<n>`` (per key, the largest event time
    seen up to and including batch n).  Batch n reads the clocks of batch
    n-1; streaming batch ids are consecutive, and every batch, empty ones
    included, writes its clocks.
    """
    def write(batch_df: DataFrame, epoch_id: int) -> None:
        spark = batch_df.sparkSession
        carry = spark.read.parquet(epoch_dir(out_root, "clocks", epoch_id - 1)) if epoch_id > 0 else None
        tagged = tag_late(batch_df, key=key, time_col=time_col, arrival_col=arrival_col, tie_col=tie_col,
                          lateness_ms=lateness_ms, chunk_span=chunk_span, initial_clock=carry)
        target = epoch_dir(out_root, "tagged", epoch_id)
        tagged.write.mode("overwrite").parquet(target)
        seen = spark.read.parquet(target).groupBy(key).agg(F.max(time_col).alias("clock"))
        if carry is not None:
            seen = carry.unionByName(seen).groupBy(key).agg(F.max("clock").alias("clock"))
        seen.write.mode("overwrite").parquet(epoch_dir(out_root, "clocks", epoch_id))
    return write


def start_strict_late_scan(sales: DataFrame, out_root: str, checkpoint: str, available_now: bool = True,
                           lateness_ms: int = C.ALLOWED_LATENESS_MS):
    """Run :func:`strict_late_scan_writer` over a streaming sales DataFrame."""
    w = sales.writeStream.foreachBatch(strict_late_scan_writer(out_root, lateness_ms)) \
        .option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 second")
    return w.start()
