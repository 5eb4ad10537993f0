"""Fixture branch coverage (FIXTURES.md section 3) and outcome invariants."""

from pyspark.sql import functions as F

from posturn import config as C
from posturn.plans import batch
from posturn.sources.fixtures import noisy_transaction_feed, transaction_feed

from conftest import SF001


def test_clean_feed_branch_counts(spark):
    v = batch.validate_stage(transaction_feed(spark, SF001))
    counts = {r.outcome: r["count"] for r in v.groupBy("outcome").count().collect()}
    assert sum(counts.values()) == 1500
    assert counts[C.OUTCOME_PUBLISHED] == 642
    first = v.select(F.get("errors", 0).alias("e")).groupBy("e").count().collect()
    by_msg = {r.e: r["count"] for r in first}
    assert by_msg["Field 'body' validation failed: Value error, " + C.MSG_STORE] == 144


def test_every_message_gets_exactly_one_outcome(spark):
    raw = noisy_transaction_feed(spark, SF001)
    v = batch.validate_stage(raw)
    assert v.count() == raw.count()
    outcomes = {r.outcome for r in v.select("outcome").distinct().collect()}
    assert outcomes <= {C.OUTCOME_MALFORMED, C.OUTCOME_SERVER_ERROR, C.OUTCOME_REJECTED,
                        C.OUTCOME_UNPAID, C.OUTCOME_PUBLISHED}
    # accepted rows carry a typed record, refused rows an error list
    bad = v.where(((F.col("outcome").isin(C.OUTCOME_PUBLISHED, C.OUTCOME_UNPAID)) & F.col("txn").isNull())
                  | (F.col("outcome").isin(C.OUTCOME_REJECTED, C.OUTCOME_SERVER_ERROR) & (F.size("errors") == 0)))
    assert bad.count() == 0


def test_correction_is_idempotent(spark):
    from posturn.operators.correct import correct_totals
    v = batch.validate_stage(transaction_feed(spark, SF001))
    pub = batch.published(v).select("txn")
    # The flag compares the float fold (noise may differ from the cent sum),
    # but a second correction never changes the value.
    again = correct_totals(pub).where(F.col("original_total") != F.col("txn.total_amount"))
    assert again.count() == 0
