"""Golden message -> outcome cases (FIXTURES.md section 2) and rule order."""

import json

import pytest

from posturn import config as C
from posturn.plans.batch import validate_stage

BASE = {
    "transaction_id": "3f2b8c1e-9d4a-4e6b-8a7c-2d1e0f9b8a76",
    "timestamp": "2024-11-15T00:00:05.000000Z",
    "store_id": "STORE_1",
    "cashier_id": "CASHIER_1",
    "items": [
        {"item_id": "i1", "name": "Tea", "quantity": 2, "price_per_unit": 1.25, "total_price": 2.5},
        {"item_id": "i2", "name": "Milk", "quantity": 1, "price_per_unit": 0.99, "total_price": 0.99},
    ],
    "total_amount": 3.49,
    "payment_method": "cash",
    "payment_status": "success",
    "customer_id": "CUSTOMER_7",
    "loyalty_points_earned": 3,
    "receipt": {"receipt_id": "r1", "date": "2024-11-15T00:00:05Z", "total_amount": 3.49,
                "payment_method": "cash", "transaction_id": "other"},
}


def msg(**changes):
    m = json.loads(json.dumps(BASE))
    for k, v in changes.items():
        if v is DROP:
            m.pop(k)
        else:
            m[k] = v
    return json.dumps(m)


DROP = object()


def run(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, value string")
    rows = validate_stage(df).select("id", "outcome", "errors", "txn", "corrected").orderBy("id").collect()
    return rows


def body(msg_text):
    return "Field 'body' validation failed: Value error, " + msg_text


def test_valid_total_matches(spark):
    (r,) = run(spark, [msg()])
    assert r.outcome == C.OUTCOME_PUBLISHED and r.errors == [] and r.corrected is False
    assert r.txn.total_amount == 3.49


def test_valid_total_differs_is_corrected(spark):
    (r,) = run(spark, [msg(total_amount=10.0)])
    assert r.outcome == C.OUTCOME_PUBLISHED and r.corrected is True
    assert r.txn.total_amount == 3.49 and r.txn.receipt.total_amount == 3.49


def test_empty_basket_corrected_to_zero(spark):
    (r,) = run(spark, [msg(items=[], total_amount=5)])
    assert r.outcome == C.OUTCOME_PUBLISHED and r.txn.total_amount == 0.0


@pytest.mark.parametrize("store", ["STORE_1", "STORE_01", "STORE_001", "STORE_10"])
def test_store_ids_pass_unnormalised(spark, store):
    (r,) = run(spark, [msg(store_id=store)])
    assert r.outcome == C.OUTCOME_PUBLISHED and r.txn.store_id == store


@pytest.mark.parametrize("store", ["STORE_0", "STORE_11", "STORE_", "store_1", "STORE_1\n"])
def test_bad_store(spark, store):
    (r,) = run(spark, [msg(store_id=store)])
    assert r.outcome == C.OUTCOME_REJECTED and r.errors == [body(C.MSG_STORE)]


@pytest.mark.parametrize("cashier", ["CASHIER_0", "CASHIER_9"])
def test_bad_cashier(spark, cashier):
    (r,) = run(spark, [msg(cashier_id=cashier)])
    assert r.errors == [body(C.MSG_CASHIER)]


def test_only_first_rule_reported(spark):
    (r,) = run(spark, [msg(store_id="STORE_0", total_amount=-1)])
    assert r.errors == [body(C.MSG_STORE)]


def test_two_bad_items_and_bad_receipt_give_three_errors(spark):
    items = [dict(BASE["items"][0], quantity=0), dict(BASE["items"][1], price_per_unit=-1)]
    receipt = dict(BASE["receipt"], total_amount=0)
    (r,) = run(spark, [msg(items=items, receipt=receipt)])
    assert r.outcome == C.OUTCOME_REJECTED
    assert r.errors == [
        "Field '0' validation failed: Value error, " + C.MSG_QUANTITY,
        "Field '1' validation failed: Value error, " + C.MSG_PRICE,
        "Field 'receipt' validation failed: Value error, " + C.MSG_TOTAL,
    ]


def test_methods_and_statuses(spark):
    rows = run(spark, [msg(payment_method="bitcoin"), msg(payment_status="failure"),
                       msg(payment_status="failed")])
    assert rows[0].errors == [body(C.MSG_METHOD + "bitcoin")]
    assert rows[1].errors == [body(C.MSG_STATUS + "failure")]
    assert rows[2].outcome == C.OUTCOME_UNPAID


def test_missing_method_prints_none(spark):
    (r,) = run(spark, [msg(payment_method=DROP)])
    assert r.errors == [body(C.MSG_METHOD + "None")]


def test_unchecked_fields_pass(spark):
    rows = run(spark, [msg(loyalty_points_earned=-1), msg(receipt=dict(BASE["receipt"], transaction_id="x"))])
    assert [r.outcome for r in rows] == [C.OUTCOME_PUBLISHED, C.OUTCOME_PUBLISHED]


def test_type_errors(spark):
    rows = run(spark, [msg(customer_id=DROP), msg(total_amount="1.5"), msg(customer_id=5)])
    assert rows[0].errors == ["Field 'customer_id' validation failed: " + C.MSG_REQUIRED]
    assert rows[1].outcome == C.OUTCOME_SERVER_ERROR
    assert rows[1].errors == [C.REASON_MISSING_OR_WRONG_TYPE + "total_amount"]
    assert rows[2].errors == ["Field 'customer_id' validation failed: " + C.MSG_STRING]


def test_integral_quantity(spark):
    ok = [dict(BASE["items"][0], quantity=2.0)]
    bad = [dict(BASE["items"][0], quantity=2.5)]
    rows = run(spark, [msg(items=ok, total_amount=2.5), msg(items=bad)])
    assert rows[0].outcome == C.OUTCOME_PUBLISHED and rows[0].txn["items"][0].quantity == 2
    assert rows[1].errors == ["Field 'quantity' validation failed: " + C.MSG_INT_FRACTION]


@pytest.mark.parametrize("text", ["{bad", "null", "5", "[]", msg() + " x", msg() + "}", msg() + " " + msg(), msg() + " x}"])
def test_malformed(spark, text):
    (r,) = run(spark, [text])
    assert r.outcome == C.OUTCOME_MALFORMED
    assert r.errors == [f"Field 'body' validation failed: {C.MSG_JSON}"]


def test_duplicate_keys_keep_last_value(spark):
    """A repeated key keeps its last value, at top level and nested."""
    late_good = msg(store_id="STORE_99")[:-1] + ', "store_id": "STORE_2"}'
    late_bad = msg()[:-1] + ', "store_id": "STORE_99"}'
    receipt = json.dumps(BASE["receipt"])[:-1] + ', "total_amount": -1.0}'
    nested_bad = msg()[:msg().index('"receipt"')] + '"receipt": ' + receipt + "}"
    good, bad, nbad = run(spark, [late_good, late_bad, nested_bad])
    assert good.outcome == C.OUTCOME_PUBLISHED and good.txn.store_id == "STORE_2"
    assert bad.outcome == C.OUTCOME_REJECTED and bad.errors == [body(C.MSG_STORE)]
    assert nbad.outcome == C.OUTCOME_REJECTED


def test_amounts_beyond_decimal_range_do_not_fail_the_job(spark):
    """Amounts that no decimal holds are added as floats instead of raising."""
    from posturn.plans import batch
    huge = [{"item_id": "i1", "name": "Tea", "quantity": 2, "price_per_unit": 1e300, "total_price": 1e300}]
    texts = [msg(), msg(total_amount=1e300), msg(items=huge), msg(total_amount=1e17)]
    rows = run(spark, texts)
    assert [r.outcome for r in rows] == [C.OUTCOME_PUBLISHED] * 4
    assert [r.txn.total_amount for r in rows] == [3.49, 3.49, 1e300, 3.49]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, value string")
    pub = batch.published(validate_stage(df))
    usable, _ = batch.split_event_time(batch.sales_from_published(pub))
    (w,) = batch.turnover_stage(usable).collect()
    assert w.total_amount == 1e300 and w.n_events == 4


def test_large_integers_are_kept_or_refused_without_failing(spark):
    """Integers beyond 32 bits are kept (BIGINT); beyond 64 bits they are a field error."""
    def items(q):
        return [{"item_id": "i1", "name": "Tea", "quantity": q, "price_per_unit": 1.0, "total_price": 3.49}]
    texts = [msg(items=items(10**10)), msg(loyalty_points_earned=10**12),
             msg(loyalty_points_earned="99999999999"), msg(loyalty_points_earned=10**12, extra_field=1),
             msg(loyalty_points_earned=10**20), msg(items=items(1e20))]
    rows = run(spark, texts)
    assert [r.outcome for r in rows[:4]] == [C.OUTCOME_PUBLISHED] * 4
    assert rows[0].txn["items"][0].quantity == 10**10
    assert [r.txn.loyalty_points_earned for r in rows[1:4]] == [10**12, 99999999999, 10**12]
    assert rows[4].errors == ["Field 'loyalty_points_earned' validation failed: " + C.MSG_INT_RANGE]
    assert rows[5].errors == ["Field 'quantity' validation failed: " + C.MSG_INT_RANGE]


def test_uuid_is_canonicalised(spark):
    (r,) = run(spark, [msg(transaction_id="3F2B8C1E9D4A4E6B8A7C2D1E0F9B8A76")])
    assert r.txn.transaction_id == "3f2b8c1e-9d4a-4e6b-8a7c-2d1e0f9b8a76"


def test_slow_path_equals_fast_path(spark):
    """An extra unknown field forces the slow path; results must not change."""
    texts = [msg(store_id="STORE_0"), msg(total_amount=10.0), msg(payment_status="failed")]
    extra = [t[:-1] + ', "zz_extra": 1}' for t in texts]
    a, b = run(spark, texts), run(spark, extra)
    assert [(r.outcome, r.errors, r.txn) for r in a] == [(r.outcome, r.errors, r.txn) for r in b]
