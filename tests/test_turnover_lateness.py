"""Windowed turnover, merge, aggregate validation and batch lateness."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from posturn.operators.lateness import tag_late
from posturn.operators.turnover import format_aggregated_event, merge_turnover, turnover
from posturn.operators.validate import validate_aggregates
from posturn.sources.fixtures import sales_events

from conftest import SF001

T0 = datetime(2024, 11, 15)


def sales_df(spark, rows):
    return spark.createDataFrame(rows, "store_id string, event_time timestamp, total_amount double, "
                                       "event_id long, arrival_key long")


def test_window_boundary_half_open(spark):
    rows = [("STORE_1", T0 + timedelta(seconds=9, microseconds=999999), 1.0, 1, 1),
            ("STORE_1", T0 + timedelta(seconds=10), 2.0, 2, 2)]
    out = turnover(sales_df(spark, rows)).orderBy("window_start").collect()
    assert [(r.window_start, r.total_amount) for r in out] == [(T0, 1.0), (T0 + timedelta(seconds=10), 2.0)]


def test_merge_equals_whole(spark):
    s = sales_events(spark, SF001)
    whole = turnover(s)
    halves = merge_turnover(turnover(s.where("event_id % 3 = 0")), turnover(s.where("event_id % 3 <> 0")))
    cols = ["store_id", "window_start", "total_amount", "min_ts", "max_ts", "n_events"]
    assert sorted(whole.select(cols).collect()) == sorted(halves.select(cols).collect())


def test_sum_of_windows_equals_sum_of_sales(spark):
    s = sales_events(spark, SF001)
    a = s.agg(F.sum(F.col("total_amount").cast("decimal(18,2)"))).first()[0]
    b = turnover(s).agg(F.sum(F.col("total_amount").cast("decimal(18,2)"))).first()[0]
    assert a == b


def test_zero_window_is_rejected(spark):
    rows = [("STORE_2", T0, 0.0, 1, 1), ("STORE_3", T0, 4.5, 2, 2)]
    out = validate_aggregates(format_aggregated_event(turnover(sales_df(spark, rows))))
    got = {r.store_id: r.status for r in out.collect()}
    assert got == {"STORE_2": "error", "STORE_3": "success"}


def test_strict_arrival_example(spark):
    """Arrivals at 05, 01, 03, 06 s: 01 and 03 are late under a 100 ms clock."""
    rows = [("STORE_1", T0 + timedelta(seconds=s), 1.0, i, i) for i, s in enumerate([5, 1, 3, 6])]
    out = tag_late(sales_df(spark, rows)).orderBy("arrival_key").collect()
    assert [r.late for r in out] == [False, True, True, False]


def brute_force_late(rows, lateness_us=100_000):
    by_store, out = {}, {}
    for store, t, _, eid, arr in sorted(rows, key=lambda r: (r[4], r[3])):
        clock = by_store.get(store)
        out[eid] = clock is not None and t < clock - timedelta(microseconds=lateness_us)
        by_store[store] = t if clock is None else max(clock, t)
    return out


def test_chunked_prefix_scan_matches_brute_force(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        store = "STORE_1" if rnd.random() < 0.4 else f"STORE_{rnd.randint(2, 5)}"
        t = T0 + timedelta(milliseconds=i * 37 + rnd.randint(-900, 900))
        rows.append((store, t, 1.0, i, i + (rnd.randint(0, 40) if i % 7 == 0 else 0)))
    expect = brute_force_late(rows)
    for span in (1, 17, 250, 1 << 20):
        got = {r.event_id: r.late for r in tag_late(sales_df(spark, rows), chunk_span=span).collect()}
        assert got == expect, span


def test_fixture_late_counts(spark):
    assert tag_late(sales_events(spark, SF001)).where("late").count() == 76


def test_fold_adds_amounts_unrounded(spark):
    from posturn.operators.fold import (TURNOVER_ACC, tumbling_fold, turnover_builder, turnover_folder,
                                        turnover_merger, turnover_total)
    rows = [(s, 1_700_000_000_000_000 + 20_000_000 * w, a) for w in range(3)
            for s, a in [("s1", 0.004)] * 10 + [("s2", 1.005), ("s2", None), ("s3", 1e18), ("s3", 0.5), (None, 0.125)]]
    df = spark.createDataFrame(rows, "store_id string, event_time_us long, total_amount double").repartition(4) \
        .selectExpr("*", "timestamp_micros(event_time_us) AS event_time")
    got = tumbling_fold(df, "store_id", "event_time", ["event_time_us", "total_amount"], turnover_builder,
                        turnover_folder, turnover_merger, TURNOVER_ACC)
    found = [(r[0], r[1], r[2]) for r in got.select("store_id", turnover_total(), "n_events").collect()]
    want = [("s1", 0.04, 10), ("s2", 1.005, 2), ("s3", 1e18 + 0.5, 2), (None, 0.125, 1)] * 3
    assert sorted(found, key=str) == sorted(want, key=str)


def test_ranks_are_dense_and_chunks_bounded(spark):
    """A hot key, one arrival key for many rows, null keys and arrivals; ranges far smaller than the key."""
    import random
    from collections import Counter

    from posturn.operators.lateness import tag_late, tag_late_by_rank
    from posturn.operators.ranking import arrival_ranks
    rnd = random.Random(11)
    rows = [("HOT" if rnd.random() < 0.7 else rnd.choice(["A", "B", None]), k, rnd.choice([0, 0, 0, k * 1_000_003, None]),
             rnd.randint(0, 5_000_000)) for k in range(3000)]
    df = spark.createDataFrame(rows, "store_id string, event_id long, arrival_key long, t long").repartition(7).withColumn(
        "event_time", F.timestamp_micros("t"))
    got = arrival_ranks(df, range_rows=100)
    assert got.columns == [*df.columns, "rank"]
    order = {}
    for store, eid, arrival, _ in sorted(rows, key=lambda r: (r[2] is not None, r[2] or 0, r[1])):
        order[eid] = sum(1 for _ in order.setdefault(("n", store), []))
        order[("n", store)].append(eid)
    assert {r.event_id: r["rank"] for r in got.collect()} == {k: v for k, v in order.items() if isinstance(k, int)}
    chunks = Counter((r.store_id, r["rank"] // 100) for r in got.collect())
    assert max(chunks.values()) == 100 and len(chunks) < 3000 / 100 + 5
    whole = tag_late(got, arrival_col="rank", tie_col="rank", chunk_span=1 << 40)
    want = {r.event_id: r.late for r in whole.collect()}
    assert {r.event_id: r.late for r in tag_late_by_rank(df, chunk_rows=100).collect()} == want and any(want.values())
    assert {want[r[1]] for r in rows if r[0] is None} == {None}
    assert arrival_ranks(df.limit(0)).count() == 0
