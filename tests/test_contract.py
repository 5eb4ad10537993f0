"""Messages told as plain from their text, and those of the same content that are not: equal results on both paths."""

import json

import pytest
from pyspark.sql import functions as F

from posturn.operators.contract import is_plain, is_written, typed_message
from posturn.operators.rules import STRING, TRANSACTION, Rule, rule_flags
from posturn.plans.batch import validate_stage

LINE = {"item_id": "7", "name": "part 7", "quantity": 2, "price_per_unit": 1.5, "total_price": 3.0}
MESSAGE = {
    "transaction_id": "00000000-0000-0000-0000-00000000ABCD", "timestamp": "2024-11-15T00:00:09Z", "store_id": "STORE_3",
    "cashier_id": "CASHIER_2", "items": [LINE, {**LINE, "quantity": 1.0}], "total_amount": 6, "payment_method": "cash",
    "payment_status": "success", "customer_id": "CUSTOMER_1", "loyalty_points_earned": 4,
    "receipt": {"receipt_id": "R-1", "date": "2024-11-15", "total_amount": -0.5e1, "payment_method": "cash",
                "transaction_id": "x"},
}
TEXT = json.dumps(MESSAGE)


def edited(**fields):
    return {**MESSAGE, **fields}


SAME_ON_BOTH = [
    MESSAGE, edited(items=[]), edited(items=[{**LINE, "quantity": 2.5}]), edited(items=[{**LINE, "quantity": 0}]),
    edited(items=[{**LINE, "price_per_unit": -1.0}, {**LINE, "total_price": -0.0}]), edited(transaction_id="x"),
    edited(transaction_id="0" * 32), edited(store_id="STORE_11"), edited(total_amount=-1), edited(payment_method="bitcoin"),
    edited(payment_status="failed"), edited(receipt={**MESSAGE["receipt"], "total_amount": 6.0}), edited(store_id="Ω"),
]
NOT_PLAIN = [
    TEXT + " x", TEXT[:-1], TEXT.replace('"STORE_3"', '"STORE\\u005f3"'), TEXT.replace(": 6,", ": 06,"),
    TEXT.replace(": 6,", ": true,"), TEXT.replace(": 6,", ": 1234567890123456789,"), TEXT.replace(": 4,", ": 4.0,"),
    TEXT.replace('"cash"', "null"), json.dumps(dict(reversed(MESSAGE.items()))), TEXT.replace("{", '{"more": 1, ', 1),
    TEXT.replace('"items"', '"store_id": "STORE_4", "items"'), TEXT.replace('"part 7"', '"part\t7"'), "null", "", None,
    TEXT.replace(": 6,", ": 6.,"), TEXT.replace(": 6,", ": NaN,"), TEXT + TEXT, "[" + TEXT + "]",
]


@pytest.fixture(scope="module")
def judged(spark):
    def run(texts, **kw):
        df = spark.createDataFrame(list(enumerate(texts)), "k int, value string")
        flags = rule_flags(df, **kw).drop("value").orderBy("k").collect()
        return flags, validate_stage(df).drop("value").orderBy("k").collect()
    return run


def test_plain_texts(spark):
    texts = [json.dumps(m, ensure_ascii=False) for m in SAME_ON_BOTH] + [TEXT.replace(", ", " ,\n\t"), f"\r{TEXT} "]
    df = spark.createDataFrame([(t, True) for t in texts] + [(t, False) for t in NOT_PLAIN], "value string, plain boolean")
    got = df.select("value", "plain", is_plain(F.col("value"), typed_message(F.col("value"))).alias("got")).collect()
    assert [r["value"] for r in got if r["got"] is not r["plain"]] == []


def test_plain_and_reordered_messages_agree(judged):
    plain = judged([json.dumps(m) for m in SAME_ON_BOTH])
    assert plain == judged([json.dumps(dict(reversed(m.items()))) for m in SAME_ON_BOTH])
    assert {r["outcome"] for r in plain[1]} == {"rejected", "published"}


def test_rules_of_callers_agree_on_both(judged):
    texts = [json.dumps(m) for m in SAME_ON_BOTH]
    same = TRANSACTION.with_rules(Rule("customer", "$.customer_id", STRING, lambda c: c.startswith("CUSTOMER_"), "no"))
    other = same.with_rules(Rule("more", "$.more", STRING, lambda c: c == "x", "no"))
    quick, slow = judged(texts, rules=same)[0], judged(texts, rules=other)[0]
    assert same.within(TRANSACTION) and not other.within(TRANSACTION)
    assert [r.asDict() for r in quick] == [{k: v for k, v in r.asDict().items() if k != "more_ok"} for r in slow]
    assert not any(r["more_ok"] for r in slow)


def test_compact_texts_need_no_blanks_pattern():
    """The short pattern takes a subset of what the whole one takes: writers' blanks, not others."""
    import re

    from posturn.operators.contract import COMPACT_RE, MESSAGE_RE
    tight, usual, wide = json.dumps(MESSAGE, separators=(",", ":")), TEXT, json.dumps(MESSAGE, indent=1)
    texts = [tight, usual, wide, usual + " x", usual.replace("1.5", '"1.5"'), usual.replace('"part 7"', "null")]
    short, whole = ([bool(re.search(p.replace(r"\z", r"\Z"), t)) for t in texts] for p in (COMPACT_RE, MESSAGE_RE))
    assert short == [True, True, False, False, False, False]
    assert whole == [True, True, True, False, False, False]


def test_outcomes_do_not_build_the_record(spark):
    """A query that reads outcomes alone neither makes the typed record nor adds up its basket."""
    judged = validate_stage(spark.createDataFrame([(1, "{}")], "k long, value string"))

    def plan(*columns):
        return judged.select(*columns)._jdf.queryExecution().optimizedPlan().toString()
    assert "aggregate(" in plan("outcome", "txn")
    assert "aggregate(" not in plan("k", "outcome", "errors")


def test_written_texts(spark):
    """A text is told from the message written again only if that is the whole of it and every field is set."""
    tight = json.dumps(MESSAGE, separators=(",", ":")).replace('"quantity":2,', '"quantity":2.0,').replace(":6,", ":6.0,")
    others = [TEXT, tight + " x", tight + tight, tight.replace('"cash"', "null", 1), tight.replace("6.0,", '"NaN",', 1),
              tight.replace("6.0,", '"6.0",', 1), tight.replace("6.0,", '"-Infinity",', 1), tight.replace("6.0,", "6.00,", 1),
              tight.replace('"customer_id":"CUSTOMER_1",', ""), tight.replace("{", '{"more":1,', 1),
              tight.replace("[{", "[null,{", 1), tight.replace('"STORE_3"', "7"), "null", "", None]
    df = spark.createDataFrame([(t,) for t in [tight, *others]], "value string")
    got = [r[0] for r in df.select(is_written(F.col("value"), typed_message(F.col("value")))).collect()]
    assert got[0] is True and not any(got[1:])


def test_lines_of_every_kind_agree(judged):
    """Errors of lines, told from whole columns of lines at first, are those of each line on the slow path."""
    lines = [{**LINE, "quantity": q, "price_per_unit": p} for q in (1, 2.5, 0, -3, 1e19, 4e18) for p in (1.0, 0, -1e-9)]
    messages = [edited(receipt={**MESSAGE["receipt"], "total_amount": 6.0}, items=[LINE, line]) for line in lines]
    plain = judged([json.dumps(m) for m in messages])
    assert plain == judged([json.dumps(dict(reversed(m.items()))) for m in messages])
    wrong = judged([json.dumps({**m, "customer_id": 7}) for m in messages])[1]   # the slow path for certain
    assert [[e for e in r["errors"] if "customer_id" not in e] for r in wrong] == [r["errors"] for r in plain[1]]
