"""Streams: same results as batch; restart does not duplicate output."""

import os

from pyspark.sql import functions as F

import __spark_entry__ as E
from posturn.plans import stream_queries as SQ
from posturn.session import scratch_path, stateful
from posturn.sources.fixtures import sales_events
from posturn.streaming.closing import CLOSE_KEY, land_closing
from posturn.streaming import sources
from posturn.streaming.lateness import strict_late_scan_writer, strict_late_tags
from posturn.streaming.queries import start_turnover_stream
from posturn.streaming.sources import kafka_options, land_in_order, read_landing
from posturn.streaming.strict import OUTPUT, closed_windows, strict_turnover

from conftest import SF001, register_tables
from test_queries_oracle import digest


def _check(spark, duck, name, oracle_name):
    register_tables(duck, SF001)
    df = E.queries()[name](spark, SF001)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[oracle_name])
    ocols = [d[0] for d in res.description]
    assert digest(df.columns, rows) == digest(ocols, [tuple(r) for r in res.fetchall()])


def _progress(spark, monkeypatch):
    """Input rows of every micro-batch of the queries that follow, by query."""
    seen = {}

    def finished(query):
        query.awaitTermination()
        seen.setdefault(str(query.id), []).extend(p["numInputRows"] for p in query.recentProgress)
    monkeypatch.setattr(SQ, "_finished", finished)
    return seen


def test_stream_turnover_equals_batch(spark, duck):
    _check(spark, duck, "stream_turnover", "turnover_10s")


def test_stream_strict_late_equals_batch(spark, duck):
    _check(spark, duck, "stream_strict_late", "late_split")


def test_stream_validate_equals_batch(spark, duck):
    _check(spark, duck, "stream_validate", "stream_validate")


def test_stream_chain_equals_batch_routes(spark, duck):
    _check(spark, duck, "stream_chain", "store_routes")


def test_stream_strict_late_scan_equals_batch(spark, duck):
    _check(spark, duck, "stream_strict_late_scan", "late_split")


def test_strict_scan_carries_clock_and_replays_idempotently(spark):
    """Arrivals 05, 01 | 03, 06 | 33 (seconds) -> late F, T | T, F | F."""
    root = scratch_path(spark, "streams", "strict-scan-unit")
    write = strict_late_scan_writer(root)
    batches = [[(1, 5), (2, 1)], [(3, 3), (4, 6)], [(5, 33)]]
    for epoch, rows in enumerate(batches):
        df = spark.createDataFrame([("STORE_1", eid, sec, 1.0, eid) for eid, sec in rows],
                                   "store_id string, event_id long, sec int, total_amount double, arrival_key long")
        df = df.select("store_id", "event_id", F.timestamp_seconds("sec").alias("event_time"), "total_amount",
                       "arrival_key")
        write(df, epoch)
        if epoch == 1:
            write(df, epoch)   # a replayed batch rewrites the same output
    tagged = spark.read.parquet(os.path.join(root, "tagged"))
    assert sorted((r.event_id, r.late) for r in tagged.collect()) == [
        (1, False), (2, True), (3, True), (4, False), (5, False)]
    clocks = spark.read.parquet(os.path.join(root, "clocks", "batch_id=2")).collect()
    assert [(r.store_id, r.clock.second) for r in clocks] == [("STORE_1", 33)]


def test_strict_scan_carries_clock_over_empty_batches(spark):
    root = scratch_path(spark, "streams", "strict-scan-empty")
    write = strict_late_scan_writer(root)
    schema = "store_id string, event_id long, sec int, total_amount double, arrival_key long"

    def batch(rows):
        df = spark.createDataFrame(rows, schema)
        return df.select("store_id", "event_id", F.timestamp_seconds("sec").alias("event_time"), "total_amount",
                         "arrival_key")
    for epoch, rows in enumerate([[], [("S", 1, 5, 1.0, 1), ("S", 2, 1, 1.0, 2)], [], [("S", 3, 3, 1.0, 3)]]):
        write(batch(rows), epoch)
    tagged = spark.read.parquet(os.path.join(root, "tagged"))
    assert sorted((r.event_id, r.late) for r in tagged.collect()) == [(1, False), (2, True), (3, True)]


def test_strict_scan_hot_store_matches_brute_force(spark):
    """One store holds most rows; chunks split each batch; clocks carry across batches."""
    import random
    rnd = random.Random(5)
    rows = []
    for eid in range(3000):
        store = "STORE_1" if rnd.random() < 0.8 else f"STORE_{rnd.randint(2, 4)}"
        rows.append((store, eid, eid * 1000 + rnd.randint(-400_000, 50_000), eid))
    root = scratch_path(spark, "streams", "strict-scan-hot")
    write = strict_late_scan_writer(root, lateness_ms=100, chunk_span=64)
    for epoch in range(3):
        part = spark.createDataFrame(rows[epoch * 1000:(epoch + 1) * 1000],
                                     "store_id string, event_id long, t_ms long, arrival_key long")
        write(part.select("store_id", "event_id", F.timestamp_millis("t_ms").alias("event_time"),
                          F.lit(1.0).alias("total_amount"), "arrival_key"), epoch)
    clock, expected = {}, {}
    for store, eid, t_ms, _ in rows:          # rows are in arrival order
        c = clock.get(store)
        expected[eid] = c is not None and t_ms < c - 100
        clock[store] = t_ms if c is None else max(c, t_ms)
    got = {r.event_id: r.late for r in spark.read.parquet(os.path.join(root, "tagged")).collect()}
    assert got == expected and sum(expected.values()) > 100


def test_stream_generic_fold_equals_turnover(spark, duck):
    _check(spark, duck, "stream_generic_fold", "turnover_10s")


def test_stream_fold_calls_python_per_bucket_not_per_window(spark, monkeypatch):
    """State has a row per bucket; null and numeric keys, late rows and restarts count as in a window each."""
    from posturn.operators.fold import TURNOVER_ACC, turnover_builder, turnover_folder
    from posturn.streaming import fold
    monkeypatch.setattr(fold, "BUCKETS", 4)
    root = scratch_path(spark, "streams", "fold-buckets")
    schema = "shop long, event_time_us long, total_amount double"
    runs = [[(k % 7 or None, k * 1_000_000, 1.0) for k in range(700)], [(1, 5_000_000, 9.0), (2, 695_000_000, 2.0)],
            [(3, 10**12, 1.0)], [(4, 2 * 10**12, 1.0)]]
    for rows in runs:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(os.path.join(root, "in"))
        sales = spark.readStream.schema(schema).parquet(os.path.join(root, "in")) \
            .withColumn("event_time", F.timestamp_micros("event_time_us"))
        folded = fold.tumbling_fold_stream(sales, "shop", "event_time", ["event_time_us", "total_amount"], turnover_builder,
                                           turnover_folder, TURNOVER_ACC)
        q = folded.writeStream.format("parquet").option("path", os.path.join(root, "out")) \
            .option("checkpointLocation", os.path.join(root, "ckpt")).trigger(availableNow=True).start()
        q.awaitTermination()
        assert all(p["stateOperators"][0]["numRowsTotal"] <= 4 for p in q.recentProgress)
    want = {}
    for shop, us, amount in runs[0] + [runs[1][1]] + runs[2]:
        at = shop, us // 10_000_000
        n, total = want.get(at, (0, 0.0))
        want[at] = n + 1, total + amount
    got = [((r.shop, r.window_start.minute * 6 + r.window_start.second // 10 if r.min_us < 10**12 else 10**5),
            (r.n_events, float(r.total))) for r in spark.read.parquet(os.path.join(root, "out")).collect()]
    assert sorted(got, key=repr) == sorted(want.items(), key=repr) and len(got) > 400


def test_generic_fold_equals_turnover(spark, duck):
    _check(spark, duck, "generic_fold", "turnover_10s")


def test_batches_are_bounded_by_bytes(spark, duck, monkeypatch):
    """Small files and triggers: several batches in order, and the same result from state alone."""
    register_tables(duck, SF001)
    seen = _progress(spark, monkeypatch)
    monkeypatch.setattr(SQ, "land_in_order", lambda df, cols, path: sources.land_in_order(df, cols, path, file_bytes=16 << 10))
    for name, run in (("turnover_10s", SQ.q_stream_turnover), ("late_split", SQ.q_stream_strict_late),
                      ("late_split", SQ.q_stream_strict_late_scan), ("turnover_10s", SQ.q_stream_generic_fold)):
        df = run(spark, SF001, trigger_bytes=20_000)
        res = duck.execute(E.oracle_sql()[name])
        assert digest(df.columns, [tuple(r) for r in df.collect()]) == digest(
            [d[0] for d in res.description], [tuple(r) for r in res.fetchall()]), run.__name__
    assert all(sum(n > 0 for n in rows) >= 3 for rows in seen.values())


def test_chain_reads_its_own_batches(spark, duck, monkeypatch):
    register_tables(duck, SF001)
    seen = _progress(spark, monkeypatch)
    monkeypatch.setattr(SQ, "land_in_order", lambda df, cols, path: sources.land_in_order(df, cols, path, file_bytes=200 << 10))
    df = SQ.q_stream_chain(spark, SF001, file_rows=100, trigger_bytes=40_000)
    res = duck.execute(E.oracle_sql()["store_routes"])
    assert digest(df.columns, [tuple(r) for r in df.collect()]) == digest(
        [d[0] for d in res.description], [tuple(r) for r in res.fetchall()])
    assert [sum(n > 0 for n in rows) >= 3 for rows in seen.values()] == [True, True]


def _sale(event_id, store, seconds, amount=1.0):
    import json
    stamp = seconds if isinstance(seconds, str) else f"2024-11-15T{seconds // 3600:02}:{seconds // 60 % 60:02}:{seconds % 60:02}Z"
    return (str(event_id), json.dumps({"event_id": event_id, "store_id": store, "timestamp": stamp, "total_amount": amount,
                                       "arrival_key": event_id}))


def _emitted(spark, out):
    from pyspark.sql import types as T
    rows = spark.read.schema(T._parse_datatype_string(OUTPUT)).parquet(out)
    windows = sorted((r.store_id, r.window_start.minute * 60 + r.window_start.second, r.total_amount, r.n_events)
                     for r in closed_windows(rows).collect())
    aside = sorted(((r.event_id, r.kind, r.reason) for r in rows.where("kind <> 'window'").collect()), key=repr)
    return windows, aside


def test_strict_turnover_over_restarts_and_late_rows(spark):
    """Windows close by the store's own clock, over several runs; the mark emits what is open; nothing twice."""
    root = scratch_path(spark, "streams", "strict-unit")
    landing, out = os.path.join(root, "landing"), os.path.join(root, "out")
    stateful(spark)
    runs = [
        [_sale(1, "A", 5, 0.1), _sale(2, "A", 6, 0.2), _sale(3, "B", 3000), _sale(4, "A", 9, 1e18)],
        [_sale(5, "A", 13), _sale(6, "A", 8), _sale(7, None, 9), _sale(8, "A", "soon"), _sale(9, "B", 3001, None),
         _sale(10, "B", "9999-01-01T00:00:00Z"), _sale(11, "C", 1, -2.5)],
        [_sale(12, "B", 3002, 2.0), _sale(13, "C", 2, 2.5), (CLOSE_KEY, "{}")],
        [],
    ]
    shown = []
    for k, rows in enumerate(runs):
        if rows:
            spark.createDataFrame(rows, "key string, value string").coalesce(1).write.mode("append").parquet(landing)
        else:
            land_closing(spark, landing)
        stream = strict_turnover(SQ.parse_sale_messages(read_landing(spark, landing)))
        q = (stream.writeStream.format("parquet").option("path", out).partitionBy("kind")
             .option("checkpointLocation", os.path.join(root, "checkpoint")).trigger(availableNow=True).start())
        q.awaitTermination()
        shown.append(_emitted(spark, out))
    bad = [(7, "unusable", "missing_store"), (8, "unusable", "bad_event_time"), (9, "unusable", "missing_total"),
           (10, "unusable", "bad_event_time")]
    assert shown[0] == ([], [])
    assert shown[1][0] == [("A", 0, 1e18 + 0.3, 3)]
    assert shown[1][1] == sorted([(6, "late", None), *bad], key=repr)
    # A forged mark has a value and is only an unusable message.
    assert shown[2][0] == shown[1][0] and (None, "unusable", "missing_store") in shown[2][1]
    assert shown[3][0] == [("A", 0, 1e18 + 0.3, 3), ("A", 10, 1.0, 1), ("B", 3000, 3.0, 2), ("C", 0, 0.0, 2)]
    assert shown[3][1] == shown[2][1]


def test_null_event_time_is_neither_late_nor_on_time(spark):
    from posturn.operators.lateness import on_time, tag_late
    df = spark.createDataFrame([("S", 1, 5, 1), ("S", 2, None, 2), ("S", 3, 4, 3), ("T", 4, None, 4)],
                               "store_id string, event_id long, sec int, arrival_key long")
    df = df.select("store_id", "event_id", F.timestamp_seconds("sec").alias("event_time"), F.lit(1.0).alias("total_amount"),
                   "arrival_key")
    want = [(1, False), (2, None), (3, True), (4, None)]
    assert sorted((r.event_id, r.late) for r in tag_late(df).collect()) == want
    assert [r.event_id for r in on_time(df).collect()] == [1]
    root = scratch_path(spark, "streams", "null-time")
    df.write.parquet(os.path.join(root, "in"))
    tagged = strict_late_tags(spark.readStream.schema(df.schema).parquet(os.path.join(root, "in")))
    q = (tagged.writeStream.format("parquet").option("path", os.path.join(root, "out"))
         .option("checkpointLocation", os.path.join(root, "checkpoint")).trigger(availableNow=True).start())
    q.awaitTermination()
    assert sorted((r.event_id, r.late) for r in spark.read.parquet(os.path.join(root, "out")).collect()) == want


def test_empty_feeds(spark, tmp_path):
    """Tables without rows give streams without rows, not errors."""
    for t in ("events", "orders", "lineitem"):
        spark.read.parquet(os.path.join(SF001, f"{t}.parquet")).limit(0).write.parquet(str(tmp_path / f"{t}.parquet"))
    for name, run in SQ.STREAM_QUERIES.items():
        assert run(spark, str(tmp_path)).count() == 0, name


def test_restart_emits_no_duplicates(spark):
    root = scratch_path(spark, "streams", "restart-test")
    landing = SQ.landed_sales(spark, root, sales_events(spark, SF001), "event_time_us")
    for _ in range(2):   # second run resumes from the checkpoint: nothing new to emit
        q = start_turnover_stream(read_landing(spark, landing), os.path.join(root, "out"),
                                  os.path.join(root, "checkpoint"))
        q.awaitTermination()
    agg = spark.read.parquet(os.path.join(root, "out", "aggregates"))
    assert agg.count() == agg.select("event_id").distinct().count() > 0


def test_broker_records_are_decoded(spark):
    from posturn.streaming.sources import decoded_messages
    raw = spark.createDataFrame([(b"k", '{"a": "é"}'.encode(), "t"), (None, None, "t"), (b"x", b"\xff{", "t")],
                                "key binary, value binary, topic string").withColumn("timestamp", F.current_timestamp())
    rows = decoded_messages(raw).collect()
    assert [(r.key, r.value) for r in rows] == [("k", '{"a": "é"}'), (None, None), ("x", "\ufffd{")]
    assert rows[0].asDict().keys() == {"key", "value", "topic", "broker_time"}


def test_kafka_options():
    o = kafka_options("broker:9092", subscription="sale/pos/transaction/receipt/>", max_offsets_per_trigger=1000)
    assert o["subscribePattern"] == r"sale/pos/transaction/receipt/[^/]+(?:/[^/]+)*"
    assert o["maxOffsetsPerTrigger"] == "1000"
    assert kafka_options("b", topics=("a", "b"))["subscribe"] == "a,b"


def test_kafka_sink_writer_is_declared(spark):
    from posturn.sinks.envelopes import kafka_sink_options, stream_envelopes_kafka
    df = spark.readStream.format("rate").load().selectExpr(
        "'t/a' AS topic", "CAST(value AS STRING) AS key", "'{}' AS value",
        "array(named_struct('key', 'application', 'value', CAST('json' AS BINARY))) AS headers")
    w = stream_envelopes_kafka(df, kafka_sink_options("broker:9092"), "/tmp/unused-ckpt")
    assert w is not None   # starting it needs the connector, which plain PySpark lacks


def test_feed_is_made_once_for_landing(spark, tmp_path):
    """Size, range bounds and files are three passes, but the feed's own work is done once."""
    made = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def value(k):
        made.add(1)
        return f"message {k}"

    feed = spark.range(0, 1000, 1, 4).select(F.col("id").cast("string").alias("key"), value("id").alias("value"),
                                             (-F.col("id")).alias("place"))
    path = land_in_order(feed, ["place"], str(tmp_path / "landing"), file_bytes=2000)
    assert made.value == 1000
    files = sorted(f for f in os.listdir(path) if f.startswith("part-"))
    assert len(files) > 3 and sorted(files, key=lambda f: os.path.getmtime(os.path.join(path, f))) == files
    keys = [[int(r["key"]) for r in spark.read.parquet(os.path.join(path, f)).collect()] for f in files]
    assert all(min(a) > max(b) for a, b in zip(keys, keys[1:])) and sum(map(len, keys)) == 1000


def test_consumed_folders_are_gone(spark, tmp_path, monkeypatch):
    """The copy a feed is landed from, the landed feed and A's topic go once they are read; A's and B's outputs stay."""
    feed = spark.range(200).select(F.col("id").cast("string").alias("key"), F.lit("x").alias("value"), "id")
    land_in_order(feed, ["id"], str(tmp_path / "landing"), file_bytes=50)
    assert sorted(os.listdir(tmp_path)) == ["landing"]
    assert spark.read.parquet(str(tmp_path / "landing")).count() == 200

    root = str(tmp_path / "chain")
    monkeypatch.setattr(SQ, "_run_root", lambda spark, name: root)
    monkeypatch.setattr(SQ, "noisy_transaction_feed", lambda spark, sf, sent_at: spark.createDataFrame(
        [(k, "not a message", k) for k in range(20)], "o_orderkey long, value string, sent_at long"))
    SQ.q_stream_chain(spark, "no tables").collect()
    assert {"a", "b"} <= set(os.listdir(root)) and not {"landing", "landing-made"} & set(os.listdir(root))
    assert "validated" in os.listdir(os.path.join(root, "a")) and "published" not in os.listdir(os.path.join(root, "a"))
    assert spark.read.parquet(os.path.join(root, "a", "validated")).count() == 20
