"""Allowed lateness, batch form: tag records that arrive behind the clock.

A record is late when, among the records of the same key that arrived before
it, the largest event time minus the allowed lateness is already past the
record's own event time (a per-key event-time clock that never moves back).

This is a running maximum in arrival order.  Computing it with one window
partitioned by key would put every record of a key into one task, and a key
may hold a third of all data.  Instead it is a two-level parallel prefix scan:

1. cut each key's arrival order into chunks of ``chunk_span`` arrival
   positions and take ``max(event_time)`` per (key, chunk) -- a partial
   aggregate whose output has one row per chunk;
2. a running maximum over the chunk table gives, per chunk, the clock before
   the chunk's first record (the table is data/chunk_span rows, tiny);
3. inside each (key, chunk) a running maximum over the preceding rows, and
   the clock of a record is the greater of the two.

Chunks of arrival positions have as many rows as the keys make them.  Where
arrival keys are not positions (times, or one key for many rows),
:func:`tag_late_by_rank` cuts chunks of an exact number of rows instead.

The join in (3) is left to Spark: AQE turns it into a broadcast join at run
time only when the measured chunk table is below the broadcast threshold, and
keeps a shuffle join otherwise.  No task ever holds more than one chunk of
one key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from .ranking import arrival_ranks

DEFAULT_CHUNK_SPAN = 1 << 20
#: Rows of a chunk where chunks are cut by rank.
CHUNK_ROWS = 1 << 20


def tag_late(df: DataFrame, key: str = "store_id", time_col: str = "event_time",
             arrival_col: str = "arrival_key", tie_col: str = "event_id",
             lateness_ms: int = C.ALLOWED_LATENESS_MS, chunk_span: int = DEFAULT_CHUNK_SPAN,
             initial_clock: DataFrame | None = None) -> DataFrame:
    """Add ``clock`` (max earlier event time of the key) and ``late`` (BOOLEAN).

    A row without an event time or without a key is neither late nor on time
    (``late`` is NULL) and moves no clock.

    ``initial_clock`` (columns ``key``, ``clock``) seeds each key's clock with
    what came before ``df`` -- the carry of earlier micro-batches.  It is
    joined to the chunk table, never to the rows.
    """
    chunk = F.floor(F.col(arrival_col) / F.lit(chunk_span)).cast("bigint")
    d = df.withColumn("_chunk", chunk)
    per_chunk = d.groupBy(key, "_chunk").agg(F.max(time_col).alias("_chunk_max"))
    before = per_chunk.select(
        key, "_chunk",
        F.max("_chunk_max").over(Window.partitionBy(key).orderBy("_chunk")
                                 .rowsBetween(Window.unboundedPreceding, -1)).alias("_before_chunk"))
    if initial_clock is not None:
        seed = initial_clock.select(key, F.col("clock").alias("_seed"))
        before = before.join(seed, key, "left").select(
            key, "_chunk", F.greatest("_before_chunk", "_seed").alias("_before_chunk"))
    inner = Window.partitionBy(key, "_chunk").orderBy(arrival_col, tie_col) \
        .rowsBetween(Window.unboundedPreceding, -1)
    tagged = (d.join(before, [key, "_chunk"], "left")
               .withColumn("clock", F.greatest(F.col("_before_chunk"), F.max(time_col).over(inner))))
    late = F.coalesce(F.col(time_col) < F.col("clock") - F.expr(f"INTERVAL {int(lateness_ms)} MILLISECONDS"),
                      F.col(time_col).isNull() & F.lit(None).cast("boolean"))
    late = F.when(F.col(key).isNotNull(), late)
    return tagged.withColumn("late", late).drop("_chunk", "_before_chunk")


def tag_late_by_rank(df: DataFrame, key: str = "store_id", time_col: str = "event_time",
                     arrival_col: str = "arrival_key", tie_col: str = "event_id",
                     lateness_ms: int = C.ALLOWED_LATENESS_MS, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """:func:`tag_late` for any arrival keys: no chunk has more than ``chunk_rows`` rows, and few have less."""
    ranked = arrival_ranks(df, key, arrival_col, tie_col, "_arrival", range_rows=chunk_rows)
    return tag_late(ranked, key=key, time_col=time_col, arrival_col="_arrival", tie_col="_arrival",
                    lateness_ms=lateness_ms, chunk_span=chunk_rows).drop("_arrival")


def on_time(df: DataFrame, **kwargs) -> DataFrame:
    """Records that are not late (the ones the window aggregation keeps)."""
    return tag_late(df, **kwargs).where(~F.col("late")).drop("late", "clock")
