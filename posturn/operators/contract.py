"""Messages written as the contract has them, told from their text alone.

Most messages are one JSON object of the declared fields, in the declared
order, each of its declared type, strings without escapes and numbers of up to
18 digits.  One pattern tells such a text, whitespace aside; it is valid JSON,
nothing in it is missing, mistyped or named twice, and a typed parse reads it
without loss.  Every other text needs the analysis of its parsed VARIANT.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import ITEM_FIELDS, RECEIPT_FIELDS, TRANSACTION_FIELDS

TYPED = ("struct<transaction_id string, timestamp string, store_id string, cashier_id string, "
         "items array<struct<item_id string, name string, quantity double, price_per_unit double, "
         "total_price double>>, total_amount double, payment_method string, payment_status string, "
         "customer_id string, loyalty_points_earned bigint, receipt struct<receipt_id string, date string, "
         "total_amount double, payment_method string, transaction_id string>>")

_WS = r"[ \t\n\r]*+"
#: No blank, or the one that JSON writers set after a comma or colon.
_BLANK = " ?+"
_TEXT = r'"[^"\\\x00-\x1F]*+"'
_WHOLE = r"-?(?:0|[1-9][0-9]{0,17}+)"
_NUMBER = _WHOLE + r"(?:\.[0-9]{1,18}+)?+(?:[eE][+-]?[0-9]{1,2}+)?+"
_NUMBERS = ("quantity", "price_per_unit", "total_price", "total_amount")


def _message(ws: str, after: str) -> str:
    """Pattern of a message with the blanks ``ws`` anywhere between its parts, ``after`` commas and colons."""
    def object_of(fields: tuple[str, ...], inner: dict[str, str]) -> str:
        def value(name: str) -> str:
            return inner.get(name, _NUMBER if name in _NUMBERS else _TEXT)
        return rf"\{{{ws}" + f"{ws},{after}".join(f'"{f}"{ws}:{after}{value(f)}' for f in fields) + rf"{ws}\}}"

    line = object_of(ITEM_FIELDS, {})
    lines = rf"\[{ws}(?:{line}(?:{ws},{after}{line})*+)?+{ws}\]"
    return rf"\A{ws}" + object_of(TRANSACTION_FIELDS, {
        "items": lines, "receipt": object_of(RECEIPT_FIELDS, {}), "loyalty_points_earned": _WHOLE}) + rf"{ws}\z"


MESSAGE_RE = _message(_WS, _WS)
#: The same without other blanks than writers set, which is less to try; a text with others is soon given up.
COMPACT_RE = _message("", _BLANK)


def typed_message(text: Column) -> Column:
    """The declared fields as far as a typed parse finds them."""
    return F.from_json(text, TYPED)


def lines_complete(message: Column) -> Column:
    """Whether a typed message has lines of which no field is NULL; NULL where it has no lines at all."""
    return F.forall(message["items"], lambda x: x["item_id"].isNotNull() & x["name"].isNotNull()
                    & x["quantity"].isNotNull() & x["price_per_unit"].isNotNull() & x["total_price"].isNotNull())


def is_written(text: Column, message: Column) -> Column:
    """Whether a text is letter for letter what JSON writers make of its typed ``message``, every field set.

    Such a text is one JSON object with the declared fields in their order, each
    once and of its type: another type, blank, escape or number form, a field
    named twice or anything after the object would be written otherwise.  A text
    with a null or a number that is none, or that names one, is not told here.
    """
    return (F.to_json(message, {"ignoreNullFields": "false"}) == text) & ~text.contains("null") \
        & ~text.contains("NaN") & ~text.contains("Infinity")


def is_plain(text: Column, message: Column) -> Column:
    """Whether a text with the typed ``message`` is written as the contract has it.

    Writing the message again costs less than a pattern, so that is tried first.
    """
    matches = lines_complete(message) & (text.rlike(COMPACT_RE) | text.rlike(MESSAGE_RE))
    return F.coalesce(is_written(text, message), F.lit(False)) | F.coalesce(matches, F.lit(False))
