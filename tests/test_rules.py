"""The rule registry: single rules, its own order, extensions; the end of a JSON message; bound columns."""

import json

import pytest
from pyspark.sql import functions as F

from posturn import config as C
from posturn.functions.binding import bind
from posturn.functions.jsonv import parse_single_json
from posturn.operators.rules import (AGGREGATE, NUMBER, STRING, TRANSACTION, Rule, rule_flags, validate_aggregate_messages)
from posturn.operators.route import transaction_envelopes
from posturn.plans import batch
from posturn.sources.fixtures import transaction_feed

from conftest import SF001

UUID = "6f1e7c1a-0b1c-4c52-9a8e-0123456789ab"
BODY = {"total_amount": 12.5, "event_id": UUID, "store_id": "STORE_1", "begin_stream_aggregator": "b",
        "end_stream_aggregator": "e"}


def without(*names, **changed):
    return json.dumps({k: v for k, v in {**BODY, **changed}.items() if k not in names})


def error(field, text):
    return f"Field '{field}' validation failed: {text}"


CASES = [
    (json.dumps(BODY), "accepted", []),
    (without(event_id="{%s}" % UUID.upper()), "accepted", []),
    (without(total_amount=True), "accepted", []),
    (without(total_amount=1e-300), "accepted", []),
    (without(total_amount=10 ** 30), "accepted", []),
    (without(total_amount=0), "rejected", [error("body", "Value error, " + C.MSG_TOTAL)]),
    (without("store_id", total_amount=-1), "rejected", [error("body", "Value error, " + C.MSG_TOTAL)]),
    (without(total_amount="3"), "server_error", ["missing_or_wrong_type:total_amount"]),
    (without("total_amount"), "server_error", ["missing_or_wrong_type:total_amount"]),
    (without(total_amount=None), "server_error", ["missing_or_wrong_type:total_amount"]),
    (without(event_id="x"), "rejected", [error("event_id", C.MSG_UUID)]),
    (without(event_id=None), "rejected", [error("event_id", C.MSG_UUID_TYPE)]),
    (without("event_id", store_id=3, end_stream_aggregator=None), "rejected",
     [error("event_id", C.MSG_REQUIRED), error("store_id", C.MSG_STRING), error("end_stream_aggregator", C.MSG_STRING)]),
    (json.dumps([BODY]), "malformed", [error("body", C.MSG_JSON)]),
    ("null", "malformed", [error("body", C.MSG_JSON)]),
    ("", "malformed", [error("body", C.MSG_JSON)]),
    (None, "malformed", [error("body", C.MSG_JSON)]),
    (json.dumps(BODY) + " {}", "malformed", [error("body", C.MSG_JSON)]),
]


def test_aggregate_bodies(spark):
    df = spark.createDataFrame([(k, v) for k, (v, _, _) in enumerate(CASES)], "k int, value string")
    rows = validate_aggregate_messages(df).orderBy("k").collect()
    assert [(r.outcome, r.errors) for r in rows] == [c[1:] for c in CASES]
    assert all((r.aggregate is not None) == (r.outcome == "accepted") for r in rows)
    assert rows[1].aggregate.event_id == UUID and rows[2].aggregate.total_amount == 1.0


def test_sets_are_extended(spark):
    """A user's rule runs in its place; one of a known name replaces that one."""
    mine = AGGREGATE.with_rules(Rule("total", "$.total_amount", NUMBER, lambda x: x > 100, "too little"),
                                Rule("store", "$.store_id", STRING, lambda x: x.startswith("STORE_"), "no store"))
    assert [r.name for r in mine.rules] == ["total", "store"] and [r.name for r in AGGREGATE.rules] == ["total"]
    df = spark.createDataFrame([(without(total_amount=99),), (without(total_amount=101, store_id="S"),),
                                (without("store_id", total_amount=101),), (without(total_amount=101),)], "value string")
    rows = validate_aggregate_messages(df, rules=mine).collect()
    assert [(r.outcome, r.errors) for r in rows] == [
        ("rejected", [error("body", "Value error, too little")]), ("rejected", [error("body", "Value error, no store")]),
        ("server_error", ["missing_or_wrong_type:store_id"]), ("accepted", [])]
    assert [r.store_ok for r in rule_flags(df, rules=mine).collect()] == [True, False, False, True]


def test_single_flags_of_a_transaction(spark):
    message = json.loads(transaction_feed(spark, SF001).where("o_orderkey = 2").first()["value"])
    line = message["items"][0]

    def flags(**changed):
        df = spark.createDataFrame([(json.dumps({**message, **changed}),)], "value string")
        row = rule_flags(df).drop("value").first().asDict()
        return {k.removesuffix("_ok") for k, v in row.items() if not v}

    names = {r.name for r in TRANSACTION.rules}
    message |= {"store_id": "STORE_1", "cashier_id": "CASHIER_1", "payment_method": "cash", "payment_status": "success"}
    assert flags() == set()
    assert flags(total_amount=-1) == {"total"} and flags(total_amount="1") == {"total", "types"}
    assert flags(items=[{**line, "total_price": 0}, line]) == {"line_total"}
    assert flags(items=[{**line, "quantity": 0.5}]) == {"types"} and flags(items=[{**line, "quantity": -1}]) == {"quantity"}
    assert flags(items=[{**line, "price_per_unit": None}]) == {"price", "present"}
    assert flags(items=[3]) == {"quantity", "price", "line_total", "present", "types"} and flags(items=[]) == set()
    assert flags(receipt=None) == {"receipt", "present"} and flags(transaction_id="7") == {"uuid"}
    assert flags(loyalty_points_earned="12") == set() and flags(loyalty_points_earned="x") == {"types"}
    broken = rule_flags(spark.createDataFrame([("{",), ("[]",), (None,)], "value string")).drop("value").collect()
    assert all(set(r.asDict().values()) == {False} for r in broken) and len(broken[0]) == len(names) + 3


@pytest.mark.parametrize("tail", ["", " ", "\n"])
def test_one_value_and_space(spark, tail):
    df = spark.createDataFrame([('{"a":1}' + tail,)], "v string")
    assert df.select(F.to_json(parse_single_json(F.col("v")))).first()[0] == '{"a":1}'


@pytest.mark.parametrize("tail", [',"end of message"', ',"end of message"] junk', "]", "}", ",", " x", '{"b":2}', ",2"])
def test_nothing_after_the_value(spark, tail):
    df = spark.createDataFrame([('{"a":1}' + tail,)], "v string")
    assert df.select(parse_single_json(F.col("v")).isNull()).first()[0]


def test_bound_columns_are_computed_once(spark):
    df = bind(spark.range(10), {"x": F.col("id") + 1})
    assert df.columns == ["id", "x"] and [r.x for r in df.where("x > 8").collect()] == [9, 10]
    plan = df.where("x > 8").select("x", (F.col("x") * 2).alias("y"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Filter") < plan.index("Generate") and plan.count("id#") <= 4


def test_validation_is_lazy_and_filters_stay_above(spark):
    sc = spark.sparkContext
    feed = transaction_feed(spark, SF001)   # reads the tables' schemas
    sc.setJobGroup("lazy-validation", "")
    env = transaction_envelopes(batch.published(batch.validate_stage(feed)))
    plan = env._jdf.queryExecution().optimizedPlan().toString()
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert len(sc.statusTracker().getJobIdsForGroup("lazy-validation")) == 0
    assert "published" in plan[:plan.index("Generate")] and "published" not in plan[plan.index("Generate"):].split("CASE WHEN")[0]
    assert plan.count("try_parse_json") <= 1 or plan.count("TryParseJson") <= 1
