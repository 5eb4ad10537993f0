"""Fixed values and default parameters.

Everything a result depends on lives here, so that a deployment can override
it in one place and a test can read the same constant the code uses.
"""

from __future__ import annotations

from datetime import datetime, timezone

# --- Fixed values: must equal the validated service's contract -------------
# Topic root of the point-of-sale domain.
TOPIC_PREFIX = "sale/pos/transaction"
# Allowed enumerations, in the order the service lists them.
PAYMENT_METHODS = ("credit_card", "cash", "debit_card", "voucher")
PAYMENT_STATUSES = ("success", "failed")
# Store and cashier id ranges (inclusive).
STORE_MIN, STORE_MAX = 1, 10
CASHIER_MIN, CASHIER_MAX = 1, 8
# Number of per-store queues and their name pattern.
NUMBER_OF_STORES = 10
STORE_QUEUE_PATTERN = "sale_pos_transaction_aggregations_store{n}.q"
UNROUTED_QUEUE = "unrouted"
# Window parameters of the turnover aggregation.
WINDOW_LENGTH_SECONDS = 10
WINDOW_ALIGN_TO = datetime(2024, 11, 15, 0, 0, 0, tzinfo=timezone.utc)
ALLOWED_LATENESS_MS = 100
# Latency histogram bucket bounds (seconds).
LAG_BUCKETS = (0.1, 0.3, 1.2, 5.0)

# --- Fixed values: validation messages ---------------------------------------
MSG_STORE = "Store ID must be in the format STORE_01 to STORE_10"
MSG_CASHIER = "Cashier ID must be in the format CASHIER_1 to CASHIER_8"
MSG_TOTAL = "Total amount must be positive"
MSG_METHOD = "Invalid payment method: "
MSG_STATUS = "Invalid payment status: "
MSG_QUANTITY = "Quantity must be positive"
MSG_PRICE = "Price per unit must be positive"
MSG_LINE_TOTAL = "Total price must be positive"
VALUE_ERROR_PREFIX = "Value error, "
FIELD_ERROR_FORMAT = "Field '%s' validation failed: %s"
MSG_JSON = "Input should be one JSON object"
MSG_REQUIRED = "Field required"
MSG_STRING = "Input should be a valid string"
MSG_INT = "Input should be a valid integer"
MSG_INT_FRACTION = "Input should be a valid integer, got a number with a fractional part"
MSG_INT_PARSE = "Input should be a valid integer, unable to parse string as an integer"
# Our own text (no counterpart in the service, whose integers are unbounded):
# an integral value that does not fit a 64-bit BIGINT.
MSG_INT_RANGE = "Input should be an integer within the 64-bit range"
MSG_NUMBER = "Input should be a valid number"
MSG_LIST = "Input should be a valid list"
MSG_UUID = "Input should be a valid UUID"
MSG_UUID_TYPE = "UUID input should be a string, bytes or UUID object"
# Response texts.
STATUS_ERROR = "error"
STATUS_SUCCESS = "success"
MSG_REQUEST_FAILED = "Validation failed for the request body"
MSG_TXN_ACCEPTED = "Transaction accepted"
MSG_AGG_ACCEPTED = "Aggregated data received successfully."
# Message property attached to every published envelope.
ENVELOPE_HEADERS = (("application", "json"),)

# --- Outcomes of the validation stage ----------------------------------------
OUTCOME_ACCEPTED = "accepted"
OUTCOME_MALFORMED = "malformed"
OUTCOME_SERVER_ERROR = "server_error"
OUTCOME_REJECTED = "rejected"
OUTCOME_UNPAID = "unpaid"
OUTCOME_PUBLISHED = "published"
OUTCOMES = (OUTCOME_PUBLISHED, OUTCOME_UNPAID, OUTCOME_REJECTED, OUTCOME_SERVER_ERROR, OUTCOME_MALFORMED)
# Quarantine reasons of the aggregation stage.
REASON_BAD_EVENT_TIME = "bad_event_time"
REASON_NO_STORE = "missing_store"
REASON_NO_TOTAL = "missing_total"
REASON_MISSING_OR_WRONG_TYPE = "missing_or_wrong_type:"


def window_offset_micros(length_seconds: float, align_to: datetime) -> int:
    """Offset of tumbling windows of ``length_seconds`` aligned to ``align_to``."""
    length_us = int(round(length_seconds * 1_000_000))
    align_us = int(round(align_to.timestamp() * 1_000_000))
    return align_us % length_us
