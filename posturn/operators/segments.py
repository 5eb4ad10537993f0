"""User-defined folds over the ordered rows of a (key, window), without a Python call per row.

For folds that Spark's aggregates cannot express because the order of the rows
matters.  The fold must be mergeable: a stretch of rows has an accumulator, and
those of two neighbouring stretches make that of both.

1. Rows are range partitioned by (key, window, order), so a hot group is spread
   over several tasks, each of which holds one stretch of it.
2. ``mapInArrow``: a batch is cut into segments of equal (key, window), and the
   user's ``fold`` gets whole columns and the segments' first rows.
3. One exchange of the accumulators, at most one per group and task, sorted by
   group and stretch; neighbours are merged pairwise, all pairs of a batch in one call.

A task holds one Arrow batch and one accumulator carried to the next batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import datetime

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .. import config as C
from .turnover import tumbling_window

Columns = dict[str, np.ndarray]
_GROUP = ["_key", "_start", "_end"]


@dataclass(frozen=True)
class SegmentFold:
    """A mergeable fold.

    ``fold(columns, firsts)`` gives one accumulator per segment, as arrays; segment k has the rows from
    ``firsts[k]`` up to ``firsts[k + 1]``, in order.  A null is a NaN.  ``merge(a, b)`` gives the accumulators of the
    stretches a[k] followed by b[k]; it must be associative.
    """

    schema: T.StructType
    fold: Callable[[Columns, np.ndarray], Columns]
    merge: Callable[[Columns, Columns], Columns]


def segment_starts(columns: list[pa.Array]) -> np.ndarray:
    """First rows of the runs of equal values; nulls are equal."""
    n = len(columns[0])
    first = np.zeros(n, bool)
    first[:1] = True
    for c in columns:
        here, before = c.slice(1), c.slice(0, max(n - 1, 0))
        differ = pc.or_(pc.fill_null(pc.not_equal(here, before), False),
                        pc.not_equal(pc.is_null(here), pc.is_null(before)))
        first[1:] |= differ.to_numpy(zero_copy_only=False)
    return np.flatnonzero(first)


def merge_segments(acc: Columns, firsts: np.ndarray, merge: Callable[[Columns, Columns], Columns]) -> Columns:
    """One accumulator per segment of neighbouring ones, in a logarithmic number of calls."""
    n = len(next(iter(acc.values())))
    while n > len(firsts):
        sizes = np.diff(np.append(firsts, n))
        place = np.arange(n) - np.repeat(firsts, sizes)
        left = place % 2 == 0
        paired = left & (place + 1 < np.repeat(sizes, sizes))
        at = np.flatnonzero(paired)
        both = merge({c: v[at] for c, v in acc.items()}, {c: v[at + 1] for c, v in acc.items()})
        acc = {c: v[left] for c, v in acc.items()}
        for c in acc:
            acc[c][paired[left]] = both[c]
        sizes = (sizes + 1) // 2
        firsts, n = np.cumsum(sizes) - sizes, int(sizes.sum())
    return acc


def _arrays(batch: pa.RecordBatch, names: list[str]) -> Columns:
    return {c: batch.column(c).to_numpy(zero_copy_only=False) for c in names}


def ordered_fold(df: DataFrame, key: str, time_col: str, value_cols: list[str], order_cols: list[str],
                 how: SegmentFold, length_seconds: float = C.WINDOW_LENGTH_SECONDS,
                 align_to: datetime = C.WINDOW_ALIGN_TO) -> DataFrame:
    """Fold ``value_cols`` per (key, tumbling window) in the order of ``order_cols``.

    Returns key, window_start, window_end and the accumulator's fields.  Rows without a time are in no window; a null
    key is a key.  Rows that tie in ``order_cols`` come in any order, so these should end in a unique column; rows of one
    group with one order value share a task.  Nulls in ``order_cols`` come first.  An empty table gives no rows.
    """
    w = tumbling_window(F.col(time_col), length_seconds, align_to)
    rows = df.where(F.col(time_col).isNotNull()).select(
        F.col(key).alias("_key"), F.unix_micros(w.start).alias("_start"), F.unix_micros(w.end).alias("_end"),
        *[F.col(c).alias(f"_o{k}") for k, c in enumerate(order_cols)], *value_cols)
    fields = how.schema.fieldNames()
    kind = T.StructType([T.StructField("_key", df.schema[key].dataType), T.StructField("_start", T.LongType()),
                         T.StructField("_end", T.LongType()), *how.schema.fields])
    stretch = T.StructType([*kind.fields, T.StructField("_stretch", T.IntegerType())])

    def merged(parts: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        """Merge neighbouring accumulators of a group; the last one of a batch waits for the next batch."""
        carried = None
        for part in parts:
            if carried is not None:
                part = pa.Table.from_batches([carried, part]).combine_chunks().to_batches()[0]
            firsts = segment_starts([part.column(c) for c in _GROUP])
            acc = merge_segments(_arrays(part, fields), firsts, how.merge)
            done = part.select([c for c in schema.names if c not in fields]).take(pa.array(firsts))
            done = pa.RecordBatch.from_arrays(
                [pa.array(acc[c], schema.field(c).type) if c in acc else done.column(c) for c in schema.names], schema=schema)
            if done.num_rows > 1:
                yield done.slice(0, done.num_rows - 1)
            carried = done.slice(done.num_rows - 1)
        if carried is not None:
            yield carried

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(stretch)

        def folded() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                firsts = segment_starts([batch.column(c) for c in _GROUP])
                acc = how.fold(_arrays(batch, value_cols), firsts)
                heads = batch.take(pa.array(firsts))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(acc[c], schema.field(c).type) if c in acc else heads.column(c).cast(schema.field(c).type)
                     for c in schema.names], schema=schema)
        yield from merged(folded(), schema)

    def final(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(kind)

        def plain() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    yield pa.RecordBatch.from_arrays([batch.column(c).cast(schema.field(c).type) for c in schema.names],
                                                     schema=schema)
        yield from merged(plain(), schema)

    order = [f"_o{k}" for k in range(len(order_cols))]
    stretches = rows.repartitionByRange(*_GROUP, *order).sortWithinPartitions(*_GROUP, *order) \
        .withColumn("_stretch", F.spark_partition_id()).mapInArrow(partial, stretch)
    whole = stretches.repartition(*_GROUP).sortWithinPartitions(*_GROUP, "_stretch").mapInArrow(final, kind)
    return whole.select(F.col("_key").alias(key), F.timestamp_micros("_start").alias("window_start"),
                        F.timestamp_micros("_end").alias("window_end"), *fields)


# --- Longest rise: a fold whose result depends on the order ---------------------
def _runs(columns: Columns, firsts: np.ndarray) -> Columns:
    amount = columns["total_amount"].astype(np.float64)
    n = len(amount)
    breaks = np.ones(n, bool)
    breaks[1:] = ~(amount[1:] > amount[:-1])
    breaks[firsts] = True
    runs = np.flatnonzero(breaks)
    lengths = np.diff(np.append(runs, n))
    first_run = np.searchsorted(runs, firsts)
    last_run = np.append(first_run[1:], len(runs)) - 1
    ends = np.append(firsts[1:], n)
    return {"n_events": ends - firsts, "first": amount[firsts], "last": amount[ends - 1], "head": lengths[first_run],
            "tail": lengths[last_run], "longest": np.maximum.reduceat(lengths, first_run)}


def _joined_runs(a: Columns, b: Columns) -> Columns:
    rises = a["last"] < b["first"]
    return {"n_events": a["n_events"] + b["n_events"], "first": a["first"], "last": b["last"],
            "head": a["head"] + np.where(rises & (a["head"] == a["n_events"]), b["head"], 0),
            "tail": b["tail"] + np.where(rises & (b["tail"] == b["n_events"]), a["tail"], 0),
            "longest": np.maximum(np.maximum(a["longest"], b["longest"]), np.where(rises, a["tail"] + b["head"], 0))}


#: Length of the longest stretch of sales each of which is above the one before; an amount that is missing ends it.
LONGEST_RISE = SegmentFold(
    T.StructType([T.StructField("n_events", T.LongType()), T.StructField("first", T.DoubleType()),
                  T.StructField("last", T.DoubleType()), T.StructField("head", T.LongType()),
                  T.StructField("tail", T.LongType()), T.StructField("longest", T.LongType())]), _runs, _joined_runs)
