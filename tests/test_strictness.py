"""Sums rounded once, one JSON value per message, full timestamps only, late and empty stream input."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from posturn import config as C
from posturn.functions.jsonv import is_json_object, parse_single_json
from posturn.functions.timefmt import parse_event_time
from posturn.operators.correct import basket_sum
from posturn.operators.turnover import format_aggregated_event, turnover
from posturn.plans import batch
from posturn.streaming.fold import tumbling_fold_stream


def test_sales_are_summed_before_rounding(spark):
    t = dt.datetime(2024, 11, 15, 0, 0, 1)
    amounts = {"a": [0.004] * 10, "b": [0.335] * 3, "c": [1e300, 1.5], "d": [0.1] * 3}
    df = spark.createDataFrame([(k, t, x) for k, xs in amounts.items() for x in xs],
                               "store_id string, event_time timestamp, total_amount double")
    got = {r.store_id: r.total_amount for r in format_aggregated_event(turnover(df)).collect()}
    assert got == {"a": 0.04, "b": 1.01, "c": 1e300, "d": 0.3}


def test_basket_lines_are_summed_before_rounding(spark):
    baskets = [[0.335] * 3, [], [0.004] * 10, [1e300, 1.0], [2.5, 1.25]]
    df = spark.createDataFrame([(k, [(x,) for x in b]) for k, b in enumerate(baskets)],
                               "k int, items array<struct<total_price: double>>")
    got = [r[0] for r in df.orderBy("k").select(basket_sum(F.col("items"))).collect()]
    assert got == [1.01, 0.0, 0.04, 1e300, 3.75]


@pytest.mark.parametrize("text,ok", [
    ('{"a": 1}', True), (' {"a": {"b": [1, "]"]}}\n', True), ('{"a": 1}}', False), ('{"a": 1} {"b": 2}', False),
    ('{"a": 1} junk}', False), ('{"a": 1},{"b": 2}', False), ('{"a": 1}],[{"b": 2}', False), ('{"a": 1}]', False),
    ("null", False), ("5", False), ("[]", False), ("", False), ("{bad", False), ('{"a": 1', False),
])
def test_one_json_object_and_nothing_else(spark, text, ok):
    row = spark.createDataFrame([(text,)], "value string").withColumn("v", parse_single_json(F.col("value"))) \
        .select(is_json_object(F.col("v"))).first()
    assert row[0] is ok


def test_event_time_needs_a_full_date(spark):
    good = {"2024-11-15T00:00:09.5Z": "2024-11-15 00:00:09.500000", "2024-11-15": "2024-11-15 00:00:00.000000",
            "20241115T000009": "2024-11-15 00:00:09.000000", "20241115T000009.25+0130": "2024-11-14 22:30:09.250000",
            "2024-11-15T01:00:00+01": "2024-11-15 00:00:00.000000", "2024-11-15 10:20": "2024-11-15 10:20:00.000000",
            "20241115": "2024-11-15 00:00:00.000000", "2024-11-15T00:00:00,125-05:30": "2024-11-15 05:30:00.125000"}
    bad = ["12:30:00", "T12:30", "2024", "2024-11", "2024-11-15T0:0:5", "2024-11-15T00:00:00 Europe/Paris", "garbage", "",
           "2024-13-01", "2024-02-30T00:00:00Z", "2024-11-15T25:00:00", "2024-11-15T00:00:00Z ", "epoch", "now"]
    df = spark.createDataFrame([(t,) for t in [*good, *bad, None]], "t string")
    got = {r.t: r.x for r in df.select("t", F.date_format(parse_event_time(F.col("t")), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("x")).collect()}
    assert {t: got[t] for t in good} == good
    assert all(got[t] is None for t in [*bad, None])


def test_empty_batch_is_read_back(spark):
    raw = spark.createDataFrame([], "key string, value string")
    stored = batch.validate_stage(raw)
    assert stored.count() == 0 and batch.rejects(stored).count() == 0


def _folded(spark, tmp_path, batches):
    """Counts per window of a stream fold fed one file per batch."""
    src = str(tmp_path / "in")
    schema = "store_id string, event_time timestamp, total_amount double"
    for k, seconds in enumerate(batches):
        rows = [("S", dt.datetime(2024, 11, 15, 0, 0, 0) + dt.timedelta(seconds=s), 1.0) for s in seconds]
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{src}/b={k}")
        for name in os.listdir(f"{src}/b={k}"):
            os.utime(f"{src}/b={k}/{name}", (1e9 + k, 1e9 + k))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{src}/b=*")
    acc = T.StructType([T.StructField("n", T.LongType())])
    out = tumbling_fold_stream(stream, "store_id", "event_time", ["total_amount"], lambda: {"n": 0},
                               lambda a, r: {"n": int(a["n"]) + 1}, acc)
    q = out.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "ck")).outputMode("append") \
        .trigger(availableNow=True).start(str(tmp_path / "out"))
    q.awaitTermination(200)
    assert q.exception() is None
    return {r.window_start.second: r.n for r in spark.read.parquet(str(tmp_path / "out")).collect()}


def test_out_of_order_rows_of_open_windows_count_and_late_ones_do_not_stop_the_stream(spark, tmp_path):
    assert _folded(spark, tmp_path, [[26], [27], [21], [45], [5], [50]])[20] == 3


def test_published_stream_messages_keep_headers_and_bad_times_apart(spark, tmp_path):
    from posturn.streaming.queries import validation_batch_writer
    from tests.test_validation_golden import msg

    df = spark.createDataFrame([("1", msg()), ("2", msg(timestamp="12:30:00"))], "key string, value string")
    validation_batch_writer(str(tmp_path))(df, 0)
    published = spark.read.parquet(str(tmp_path / "published"))
    assert "headers" in published.columns and published.count() == 2
    bad = spark.read.parquet(str(tmp_path / "bad_event_time")).collect()
    assert len(bad) == 1 and bad[0].reason == C.REASON_BAD_EVENT_TIME
    assert json.loads(bad[0].value)["timestamp"] == "12:30:00"
    validation_batch_writer(str(tmp_path))(df.limit(0), 1)
