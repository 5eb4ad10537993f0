"""Basket correction and the payment gate.

* :func:`basket_sum` -- sum of line totals of one basket, folded inside the
  array (``aggregate``): no explode, no shuffle.
* :func:`correct_totals` -- replaces ``total_amount`` by the basket sum
  rounded to cents when the two differ; ``corrected`` records it.  The
  comparison uses the left-to-right DOUBLE fold (what the service compares),
  the replacement value the exact cent sum.  The receipt total is left as sent.
* :func:`payment_gate` -- only ``success`` payments continue to publication.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.money import MONEY, exact_amount

_EXACT_SUM = "decimal(38,10)"


def basket_fold(items: Column) -> Column:
    """Left-to-right DOUBLE sum of ``items[*].total_price`` (0.0 when empty)."""
    return F.aggregate(items, F.lit(0.0).cast("double"), lambda a, x: a + x["total_price"])


def basket_sum(items: Column) -> Column:
    """Sum of ``items[*].total_price``, rounded once to cents, as DOUBLE.

    Lines are added exactly; one that a DECIMAL(28,10) cannot hold is added to
    the others' sum as a DOUBLE.
    """
    exact = F.aggregate(items, F.lit(0).cast(_EXACT_SUM), lambda a, x: (
        a + F.coalesce(exact_amount(x["total_price"]), F.lit(0).cast(MONEY))).cast(_EXACT_SUM))
    misfits = F.aggregate(items, F.lit(0.0).cast("double"), lambda a, x: F.when(
        exact_amount(x["total_price"]).isNull(), a + x["total_price"]).otherwise(a))
    return F.round(exact, 2).cast("double") + misfits


def correct_totals(df: DataFrame, txn_col: str = "txn") -> DataFrame:
    """Add ``original_total``, ``corrected`` and rewrite ``txn.total_amount``."""
    txn = F.col(txn_col)
    fold = basket_fold(txn["items"])
    corrected = F.coalesce(fold != txn["total_amount"], F.lit(False))
    new_total = F.when(corrected, basket_sum(txn["items"])).otherwise(txn["total_amount"])
    return (df.withColumns({"original_total": txn["total_amount"], "corrected": corrected})
              .withColumn(txn_col, txn.withField("total_amount", new_total)))


def payment_gate(df: DataFrame, txn_col: str = "txn", outcome_col: str = "outcome") -> DataFrame:
    """Final outcome of accepted rows: ``published`` (paid) or ``unpaid``."""
    paid = F.col(txn_col)["payment_status"] == "success"
    return df.withColumn(outcome_col, F.when(F.col(outcome_col) != "accepted", F.col(outcome_col))
                         .when(paid, F.lit(C.OUTCOME_PUBLISHED)).otherwise(F.lit(C.OUTCOME_UNPAID)))
