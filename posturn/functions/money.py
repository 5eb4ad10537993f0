"""Money arithmetic and the number text used in topic paths.

Amounts are summed with ten decimals, exactly and independent of the order in
which partial sums are merged across tasks, and rounded to cents only where a
message is made.  Results are returned as DOUBLE, the type of the message
contract.  An amount that a DECIMAL(28,10) cannot hold (|x| >= 1e18, not a
number) never raises: it is added to the others' exact sum as a DOUBLE.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

SCALE = 10
MONEY = f"decimal(28,{SCALE})"
#: One digit below the largest decimal, so that the sum of two keeps all decimals.
_TOTAL = f"decimal(37,{SCALE})"
#: Bits of the lower half of an amount in cents (below 2^50).
_HALF = 25


def exact_amount(amount: Column) -> Column:
    """DOUBLE amount -> DECIMAL(28,10); NULL when it does not fit."""
    return amount.try_cast(MONEY)


def amount_parts(amount: Column) -> tuple[Column, Column, Column]:
    """DOUBLE amount as ``(whole, part, misfit)``: exactly whole units and the rest in the smallest decimals, both
    BIGINT of the amount's sign, or a misfit DOUBLE where they cannot hold it.  The unused ones are zero."""
    exact = exact_amount(amount)
    whole = exact.cast("bigint")
    part = ((exact - whole.cast("decimal(18,0)")) * F.lit(10 ** SCALE)).cast("bigint")
    zero = F.lit(0).cast("bigint")
    return (F.coalesce(whole, zero), F.coalesce(part, zero),
            F.when(exact.isNull(), F.coalesce(amount, F.lit(0.0))).otherwise(F.lit(0.0)))


def whole_cents(amount: Column) -> Column:
    """BIGINT cents of a DOUBLE amount that is a number of cents below 1e13; NULL for any other.

    Up to 15 digits, a double has one decimal number that prints as it, so this
    is the same decimal that ``exact_amount`` gives, without its text.
    """
    cents = F.when(F.abs(amount) < 1e13, F.rint(amount * 100.0).cast("bigint"))
    return F.when(cents.cast("double") / F.lit(100.0) == amount, cents)


def money_sum(amount: Column) -> Column:
    """Aggregate: unrounded sum of DOUBLE amounts, as DOUBLE; NULL without amounts.

    Whole cents, the usual case, are added as two halves of 25 bits in BIGINTs, which cannot overflow below 2^38
    rows of a group; only other amounts become decimals.
    """
    cents = whole_cents(amount)
    odd = F.when(cents.isNull(), exact_amount(amount))
    misfit = F.when(cents.isNull() & exact_amount(amount).isNull(), amount)
    zero, none = F.lit(0).cast("decimal(19,0)"), F.lit(0).cast(_TOTAL)
    high, low = F.sum(F.shiftright(cents, _HALF)), F.sum(cents.bitwiseAND(F.lit((1 << _HALF) - 1).cast("bigint")))
    usual = ((F.coalesce(high.cast("decimal(19,0)"), zero) * F.lit(Decimal(1 << _HALF))
              + F.coalesce(low.cast("decimal(19,0)"), zero)) * F.lit(Decimal("0.01"))).cast(_TOTAL)
    rest = F.when(F.count(odd) == 0, none).otherwise(F.try_sum(odd).try_cast(_TOTAL))
    return F.when(F.count(amount) > 0, (usual + rest).cast("double") + F.coalesce(F.sum(misfit), F.lit(0.0)))


def py_float_text(x: Column) -> Column:
    """DOUBLE -> the text Python's ``str(float)`` prints for it.

    Spark's DOUBLE -> STRING cast already prints the shortest digits that read
    back as the same double, like Python; the two differ only in notation.
    Python is positional for 1e-4 <= |x| < 1e16, Spark switches to
    ``d.dddE<n>`` from 1e7 up and below 1e-3.  In that band the scientific
    text is rewritten to positional form by moving the decimal point, a
    fixed-size string expression.  Outside it, the notation is Python's
    (``1e+16``, ``1.5e-05``) and so are ``nan``/``inf``; there Spark's digits
    can, rarely, be one longer than Python's shortest.
    """
    s = x.cast("string")
    sci = r"\A(-?)([0-9])\.([0-9]+)E(-?[0-9]+)\z"
    sign, digits = F.regexp_extract(s, sci, 1), F.concat(F.regexp_extract(s, sci, 2), F.regexp_extract(s, sci, 3))
    exp = F.regexp_extract(s, sci, 4).try_cast("int")
    whole = exp + 1
    big = F.when(F.length(digits) <= whole, F.concat(F.rpad(digits, whole, "0"), F.lit(".0"))) \
        .otherwise(F.concat(digits.substr(F.lit(1), whole), F.lit("."), digits.substr(whole + 1, F.lit(64))))
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -exp - 1), F.regexp_replace(digits, "0+\\z", ""))
    positional = (F.abs(x) >= 1e-4) & (F.abs(x) < 1e16) & s.contains("E")
    frac = F.regexp_extract(s, sci, 3)
    mantissa = F.concat(sign, F.regexp_extract(s, sci, 2), F.when(frac != "0", F.concat(F.lit("."), frac))
                        .otherwise(F.lit("")))
    magnitude = F.abs(exp).cast("string")   # at least two digits, never truncated
    exponent = F.concat(F.when(exp < 0, F.lit("-")).otherwise(F.lit("+")),
                        F.when(F.abs(exp) < 10, F.concat(F.lit("0"), magnitude)).otherwise(magnitude))
    scientific = F.concat(mantissa, F.lit("e"), exponent)
    # Where the JVM printed 17 digits, a 15- or 16-digit form that reads back
    # as the same double is the shorter one Python prints ("%e" already writes
    # the exponent Python's way).  Shortest first.
    for precision in (15, 14):
        candidate = F.regexp_replace(F.format_string(f"%.{precision}e", x), r"\.?0+e", "e")
        shorter = (F.length(digits) >= 17) & F.coalesce(candidate.try_cast("double") == x, F.lit(False))
        scientific = F.when(shorter, candidate).otherwise(scientific)
    return (F.when(positional, F.concat(sign, F.when(exp >= 0, big).otherwise(small)))
             .when(s.contains("E"), scientific)
             .when(F.isnan(x), F.lit("nan"))
             .when(x == float("inf"), F.lit("inf"))
             .when(x == float("-inf"), F.lit("-inf"))
             .otherwise(s))
