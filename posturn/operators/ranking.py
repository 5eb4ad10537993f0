"""Ranks of rows in arrival order, without a task per key.

``row_number`` over a window per key puts all rows of a key into one task.
Here the rows are dealt by ranges of (key, arrival, tie), so a hot key is spread
over as many tasks as it has rows for; they are numbered within each range, and
the ranges' row counts, added up, turn that into a rank:

1. one range exchange, written once to the shared folder (the ranges come
   from a sample, so they must not be drawn again);
2. a count per range and its running total (one row per range);
3. a number within each range, plus the total before it, less the rank at which
   the key starts.

The ranks of a key are dense, so chunks of ``n`` ranks have exactly ``n`` rows,
whatever the arrival keys are: sparse, microseconds, or the same for many rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sinks.tables import materialize

#: Rows that a range has, about; a task sorts one range at a time.
RANGE_ROWS = 1 << 20


def arrival_ranks(df: DataFrame, key: str = "store_id", arrival_col: str = "arrival_key", tie_col: str = "event_id",
                  name: str = "rank", range_rows: int = RANGE_ROWS) -> DataFrame:
    """``df`` with ``name``: 0, 1, 2, ... per key in the order of arrival and tie (nulls first, equal rows in any order)."""
    order = [key, arrival_col, tie_col]
    ranges = max(1, -(-df.count() // range_rows))
    dealt = df.repartitionByRange(ranges, *order) if ranges > 1 else df.coalesce(1)
    dealt = materialize(df.sparkSession, dealt.withColumn("_range", F.spark_partition_id()), "ranks")
    before = dealt.groupBy("_range").agg(F.count(F.lit(1)).alias("_n")).select(
        "_range", (F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")).alias("_before"))
    number = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    ranked = dealt.withColumn("_number", number).join(before, "_range").withColumn(
        "_rank", F.col("_before") + F.col("_number") - 1)
    # A key's first rank: its least number in the first range that holds it.
    starts = dealt.groupBy(F.col(key).alias("_key"), "_range").agg(F.count(F.lit(1)).alias("_rows"))
    per_range = Window.partitionBy("_range").orderBy(F.col("_key").asc_nulls_first())
    starts = starts.withColumn("_lower", F.sum("_rows").over(per_range) - F.col("_rows")).join(before, "_range")
    starts = starts.groupBy("_key").agg(F.min(F.col("_before") + F.col("_lower")).alias("_first"))
    return ranked.join(starts, F.col(key).eqNullSafe(F.col("_key"))).withColumn(
        name, F.col("_rank") - F.col("_first")).drop("_range", "_number", "_before", "_rank", "_key", "_first")
