"""Column functions: number text, ISO time, ids, topics, routing."""

from datetime import datetime, timezone

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from posturn.functions.ids import canonical_uuid, deterministic_uuid
from posturn.functions.money import py_float_text
from posturn.functions.timefmt import iso_utc, parse_event_time
from posturn.functions.topics import topic_matches
from posturn.operators.route import store_queue


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(min_value=1e-4, max_value=1e15, allow_nan=False), min_size=50, max_size=200))
def test_py_float_text_matches_repr(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for r in df.select("x", py_float_text(F.col("x")).alias("t")).collect():
        assert r.t == repr(r.x)


def test_money_texts(spark):
    vals = [10.5, 1234567.5, 12345678.5, 100.0, 0.30000000000000004, 188236.40000000002]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    assert [r.t for r in df.select(py_float_text(F.col("x")).alias("t")).collect()] == [repr(v) for v in vals]


def test_iso_and_parse(spark):
    df = spark.createDataFrame([("2024-11-15T00:00:09.999999Z",), ("2024-11-15T00:00:10Z",),
                                ("2024-11-15T01:00:10+01:00",), ("garbage",)], "s string")
    out = df.select(iso_utc(parse_event_time(F.col("s"))).alias("t")).collect()
    assert [r.t for r in out] == ["2024-11-15T00:00:09.999999+00:00", "2024-11-15T00:00:10+00:00",
                                  "2024-11-15T00:00:10+00:00", None]


def test_uuid_forms(spark):
    forms = ["3F2B8C1E-9D4A-4E6B-8A7C-2D1E0F9B8A76", "{3f2b8c1e-9d4a-4e6b-8a7c-2d1e0f9b8a76}",
             "urn:uuid:3f2b8c1e-9d4a-4e6b-8a7c-2d1e0f9b8a76", "3f2b8c1e9d4a4e6b8a7c2d1e0f9b8a76", "nope"]
    df = spark.createDataFrame([(f,) for f in forms], "s string")
    got = [r.u for r in df.select(canonical_uuid(F.col("s")).alias("u")).collect()]
    assert got == ["3f2b8c1e-9d4a-4e6b-8a7c-2d1e0f9b8a76"] * 4 + [None]


def test_deterministic_uuid_is_stable_and_valid(spark):
    import uuid
    df = spark.createDataFrame([("STORE_1", "2024-11-15T00:00:00+00:00")] * 2, "a string, b string")
    ids = [r.u for r in df.select(deterministic_uuid(F.col("a"), F.col("b")).alias("u")).collect()]
    assert ids[0] == ids[1] and uuid.UUID(ids[0]).version == 3


def test_topic_subscriptions_and_queues(spark):
    topics = ["sale/pos/transaction/aggregations/STORE_1/e/1.0",
              "sale/pos/transaction/aggregations/STORE_10/e/1.0",
              "sale/pos/transaction/aggregations/STORE_01/e/1.0",
              "sale/pos/transaction/aggregations/STORE_1",
              "sale/pos/transaction/receipt/STORE_1/a/b"]
    df = spark.createDataFrame([(t,) for t in topics], "topic string")
    out = df.select(store_queue(F.col("topic")).alias("q"),
                    topic_matches(F.col("topic"), "sale/pos/transaction/receipt/>").alias("r"),
                    topic_matches(F.col("topic"), "sale/pos/transaction/aggregations/*/>").alias("a")).collect()
    assert [r.q for r in out] == ["sale_pos_transaction_aggregations_store1.q",
                                  "sale_pos_transaction_aggregations_store10.q", "unrouted", "unrouted", "unrouted"]
    assert [r.r for r in out] == [False, False, False, False, True]
    assert [r.a for r in out] == [True, True, True, False, False]


def test_window_alignment_constant():
    from posturn import config as C
    assert C.window_offset_micros(10, C.WINDOW_ALIGN_TO) == 0
    assert C.window_offset_micros(10, datetime(2024, 11, 15, 0, 0, 3, 500000, tzinfo=timezone.utc)) == 3_500_000


def test_string_list_document(spark, tmp_path):
    from posturn.sources.lookups import read_string_list
    p = tmp_path / "methods"
    p.mkdir()
    (p / "doc.json").write_text('[\n  "credit_card",\n  "cash",\n  "debit_card",\n  "voucher"\n]\n')
    got = [r.value for r in read_string_list(spark, str(p)).collect()]
    assert got == ["credit_card", "cash", "debit_card", "voucher"]


def test_progress_observation(spark):
    from posturn.operators.metrics import observe_progress
    df, obs = observe_progress(spark.range(1234))
    df.write.format("noop").mode("overwrite").save()
    assert obs.get["rows"] == 1234


def test_topic_levels_past_the_end_are_null(spark):
    from posturn.operators.route import parse_topic
    df = spark.createDataFrame([("sale/pos/transaction/aggregations/STORE_1/abc/10.5",), ("x",)], "topic string")
    rows = parse_topic(df).orderBy("topic").collect()
    assert rows[0].t_store_id == "STORE_1" and rows[0].t_customer_id is None
    assert rows[1].t_kind is None


def test_py_float_text_outside_positional_range(spark):
    vals = [1e16, 1.5e16, 1e-5, 1.5e-05, -2.5e-7, 1.2e100, -1e20, float("nan"), float("inf"), float("-inf"),
            2.0265540556310872e16, 9.5130661033235008e16]   # the JVM prints 17 digits for the last two
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r.t for r in df.select(py_float_text(F.col("x")).alias("t")).collect()]
    assert got == [repr(v) for v in vals]


def test_message_text_is_parsed_once(spark):
    """The mark and the value are read from one parse, and forged or trailing text stays malformed."""
    from pyspark.sql import functions as F
    from posturn.functions.jsonv import parse_single_json
    texts = ['{"a":1}', '{"a":1} x', '{"a":1},"end"', 'null', '[1]', '{"a":1},"b"]', '', None]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    parsed = df.select("value", F.to_json(parse_single_json(F.col("value"))).alias("v"))
    assert [r.v for r in parsed.collect()] == ['{"a":1}', None, None, 'null', '[1]', None, None, None]
    plan = parsed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") == 1


def test_noise_kind_is_computed_once(spark):
    """The chain of damage rules is bound, not repeated for each of the rules that asks for it."""
    from posturn.sources.fixtures import NOISE_RULES, noisy_transaction_feed
    plan = noisy_transaction_feed(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(f"% {NOISE_RULES[0][1]}") == 1
