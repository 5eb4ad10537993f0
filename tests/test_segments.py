"""Ordered folds by segments, and sums by whole cents, against plain Python."""

import random
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from posturn.functions.money import money_sum
from posturn.operators.segments import LONGEST_RISE, merge_segments, ordered_fold, segment_starts

SCHEMA = "store_id string, us long, nth long, total_amount double"


def longest(amounts):
    best = run = 0
    before = None
    for a in amounts:
        run = run + 1 if before is not None and a is not None and a > before else 1
        best, before = max(best, run), a
    return best


def folded(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5).withColumn("event_time", F.timestamp_micros("us"))
    got = ordered_fold(df, "store_id", "event_time", ["total_amount"], ["event_time", "nth"], LONGEST_RISE, length_seconds=10)
    return {(r.store_id, r.ws): (r.longest, r.n_events) for r in got.withColumn("ws", F.unix_micros("window_start")).collect()}


def test_segments_of_nulls_and_repeats():
    a = pa.array(["x", "x", None, None, "y", "x"])
    b = pa.array([1, 2, 2, 2, None, None])
    assert segment_starts([a, b]).tolist() == [0, 1, 2, 4, 5]
    assert segment_starts([pa.array([7])]).tolist() == [0]


def test_merge_keeps_the_order():
    def joined(a, b):
        return {"t": np.array([x + y for x, y in zip(a["t"], b["t"])], object)}
    text = "abcdefghijklm"
    got = merge_segments({"t": np.array(list(text), object)}, np.array([0, 1, 6, 8]), joined)
    assert got["t"].tolist() == ["a", "bcdef", "gh", "ijklm"]


def test_longest_rise_equals_brute_force(spark):
    """A store with two thirds of all rows in one window, batches of 7 rows, missing amounts, stores and times."""
    rnd = random.Random(3)
    rows = [("hot" if k % 3 else rnd.choice(["a", "b", None]), 1_700_000_000_000_000 + rnd.randrange(4) * 2_000_000
             if k % 3 else rnd.choice([None, 1_700_000_000_000_000 + rnd.randrange(60_000_000)]), k,
             None if rnd.random() < 0.03 else float(rnd.randrange(40) + k % 50)) for k in range(1500)]
    kept = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = folded(spark, rows)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", kept)
    groups = {}
    for store, us, nth, amount in sorted((r for r in rows if r[1] is not None), key=lambda r: r[1:3]):
        groups.setdefault((store, us // 10_000_000 * 10_000_000), []).append(amount)
    assert got == {g: (longest(v), len(v)) for g, v in groups.items()}


def test_one_long_rise_over_all_tasks(spark):
    rows = [("s", 1_700_000_000_000_000 + k, k, k / 4) for k in range(2000)]
    assert folded(spark, rows) == {("s", 1_700_000_000_000_000): (2000, 2000)}


def test_empty_table(spark):
    assert folded(spark, []) == {}


def test_sums_of_cents_and_other_amounts_are_exact(spark):
    """Whole cents, more digits, amounts around the limit of the cents, signs, zeros and nulls, alone and mixed."""
    rnd = random.Random(5)
    kinds = [lambda: rnd.randint(-10 ** 6, 10 ** 6) / 100, lambda: rnd.randint(-10 ** 14, 10 ** 14) / 100,
             lambda: rnd.uniform(-1e9, 1e9), lambda: rnd.randint(-10 ** 6, 10 ** 6) / 1000,
             lambda: rnd.uniform(-1e13, 1e13) * 1000, lambda: rnd.choice([None, -0.0, 0.005, 1.115]),
             lambda: rnd.choice([1e13, 1e13 - 0.01, 99999999999999.98, -12.34]), lambda: rnd.choice([0.1, 0.07, 1e-9, 123456.789])]
    rows = [(g, kinds[g % 8]() if g % 16 < 8 else rnd.choice(kinds)()) for g in range(160) for _ in range(rnd.randint(1, 30))]
    got = dict(spark.createDataFrame(rows, "g int, a double").repartition(5).groupBy("g").agg(
        money_sum(F.col("a")).alias("total")).collect())
    for g in got:
        amounts = [Decimal(repr(a)) for k, a in rows if k == g and a is not None]
        assert got[g] == (float(sum(round(a, 10) for a in amounts)) if amounts else None), g


def test_sums_of_amounts_beyond_the_decimals(spark):
    def total(*amounts):
        return spark.createDataFrame([(a,) for a in amounts], "a double").agg(money_sum(F.col("a"))).first()[0]
    assert total(1e18, 0.5, 0.25) == 1e18 and total(1e18, -1e18) == 0.0 and total(float("inf"), 1.0) == float("inf")
    assert total(None, None) is None and total(float("nan"), 1.0) != total(float("nan"), 1.0)
