"""Transaction validation: rules, error order and the typed record.

Input: a DataFrame with a JSON text column.  Output: the same rows plus

* ``outcome``  -- ``malformed`` (not a JSON object), ``server_error`` (a rule
  hit a missing or wrongly typed field and could not be evaluated),
  ``rejected`` (one or more validation errors) or ``accepted``;
* ``errors``   -- ARRAY<STRING> of formatted messages (empty when accepted);
* ``txn``      -- the typed transaction STRUCT (NULL unless accepted).

Evaluation order follows the service:

1. The five transaction rules run first, in order store -> cashier -> total ->
   method -> status; the first failure is the only error reported.  A rule
   that meets an absent or wrongly typed value cannot run at all and the
   record is refused as a server error naming that field.
2. Otherwise every field is validated and all errors are collected in field
   order: per basket line the first failing line rule (or that line's field
   errors), the receipt rule (or the receipt's field errors), and missing or
   mistyped fields.  A basket line or receipt that is not an object, or whose
   checked amount is not a number, is again a server error.

Everything is a Column expression over one parsed VARIANT: one narrow stage,
whole-stage codegen where Spark supports it, no Python in the hot path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.ids import canonical_uuid, is_uuid_text
from ..functions.jsonv import JType, get_double, get_string, json_type, parse_single_json, python_str
from ..schemas import RECEIPT_FIELDS, TRANSACTION_FIELDS
from .contract import is_plain, lines_complete, typed_message
from .rules import CASHIER_RE, STORE_RE

_INT_TEXT_RE = r"\A\s*[+-]?[0-9]+\s*\z"


def _field_error(field: str | Column, msg: str | Column) -> Column:
    f = F.lit(field) if isinstance(field, str) else field
    m = F.lit(msg) if isinstance(msg, str) else msg
    return F.format_string(C.FIELD_ERROR_FORMAT, f, m)


def _value_error(field: str | Column, msg: str | Column) -> Column:
    m = F.lit(msg) if isinstance(msg, str) else msg
    return _field_error(field, F.concat(F.lit(C.VALUE_ERROR_PREFIX), m))


def _string_field_errors(jt: JType, field: str) -> Column:
    return F.when(jt.missing, F.array(_field_error(field, C.MSG_REQUIRED))) \
        .when(~jt.is_str, F.array(_field_error(field, C.MSG_STRING))) \
        .otherwise(F.array().cast("array<string>"))


def _number_field_errors(jt: JType, field: str) -> Column:
    return F.when(jt.missing, F.array(_field_error(field, C.MSG_REQUIRED))) \
        .when(~jt.is_num, F.array(_field_error(field, C.MSG_NUMBER))) \
        .otherwise(F.array().cast("array<string>"))


def _integral(x: Column) -> Column:
    # rint() stays DOUBLE; floor() would return BIGINT and overflow past 2^63, round() makes a decimal of each value.
    return F.coalesce((x == F.rint(x)) & ~F.isnan(x), F.lit(False))


def _item_parts(x: Column) -> Column:
    """Per basket line: the types and values its checks read, each got once."""
    return F.struct(
        F.schema_of_variant(x).alias("t"), json_type(x, "$.quantity").alias("tq"),
        json_type(x, "$.price_per_unit").alias("tp"), json_type(x, "$.total_price").alias("tt"),
        json_type(x, "$.item_id").alias("ti"), json_type(x, "$.name").alias("tn"),
        get_double(x, "$.quantity").alias("q"), get_double(x, "$.price_per_unit").alias("p"),
        get_double(x, "$.total_price").alias("total"), get_string(x, "$.item_id").alias("id"),
        get_string(x, "$.name").alias("name"))


def _item_info(x: Column, i: Column) -> Column:
    """Per basket line of :func:`_item_parts`: crash flag, error list and typed line."""
    jq, jid, jname = JType(x["tq"]), JType(x["ti"]), JType(x["tn"])
    q, p, t = x["q"], x["p"], x["total"]
    crash = ~JType(x["t"]).is_obj | ~jq.is_num | ~JType(x["tp"]).is_num | ~JType(x["tt"]).is_num
    rule = (F.when(q <= 0, F.lit(C.MSG_QUANTITY)).when(p <= 0, F.lit(C.MSG_PRICE))
            .when(t <= 0, F.lit(C.MSG_LINE_TOTAL)))
    qty_errors = F.when(~jq.is_bool & ~_integral(q), F.array(_field_error("quantity", C.MSG_INT_FRACTION))) \
        .when(~jq.is_bool & q.try_cast("bigint").isNull(), F.array(_field_error("quantity", C.MSG_INT_RANGE))) \
        .otherwise(F.array().cast("array<string>"))
    field_errors = F.concat(_string_field_errors(jid, "item_id"), _string_field_errors(jname, "name"),
                            qty_errors)
    errors = F.when(rule.isNotNull(), F.array(_value_error(i.cast("string"), rule))).otherwise(field_errors)
    typed = F.struct(x["id"].alias("item_id"), x["name"].alias("name"),
                     q.try_cast("bigint").alias("quantity"), p.alias("price_per_unit"), t.alias("total_price"))
    return F.struct(crash.alias("crash"), F.when(crash, F.array().cast("array<string>"))
                    .otherwise(errors).alias("errors"), typed.alias("item"))


# Type-name patterns of a message that has exactly the contract's shape; such
# messages take the fast path (one typed parse, no per-field type logic).
_NUM_T = r"(?:BIGINT|INT|SMALLINT|TINYINT|DOUBLE|FLOAT|DECIMAL\(\d+,\d+\))"
_LINE_SHAPE = (r"OBJECT<item_id: STRING, name: STRING, price_per_unit: %s, quantity: %s, total_price: %s>"
               % (_NUM_T, _NUM_T, _NUM_T))
_RECEIPT_SHAPE_IN = (r"OBJECT<date: STRING, payment_method: STRING, receipt_id: STRING, total_amount: %s, "
                     r"transaction_id: STRING>" % _NUM_T)
_MESSAGE_SHAPE = (r"\AOBJECT<cashier_id: STRING, customer_id: STRING, items: ARRAY<(?:VOID|%s)>, "
                  r"loyalty_points_earned: (?:BIGINT|INT|SMALLINT|TINYINT), payment_method: STRING, "
                  r"payment_status: STRING, receipt: %s, store_id: STRING, timestamp: STRING, "
                  r"total_amount: %s, transaction_id: STRING>\z" % (_LINE_SHAPE, _RECEIPT_SHAPE_IN, _NUM_T))


def _rule_message(store: Column, cashier: Column, total: Column, method: Column, status: Column,
                  method_text: Column, status_text: Column) -> Column:
    """First failing transaction rule on well-typed values (NULL: all pass)."""
    return (F.when(~F.coalesce(store.rlike(STORE_RE), F.lit(False)), F.lit(C.MSG_STORE))
            .when(~F.coalesce(cashier.rlike(CASHIER_RE), F.lit(False)), F.lit(C.MSG_CASHIER))
            .when(total <= 0, F.lit(C.MSG_TOTAL))
            .when(~F.coalesce(method.isin(*C.PAYMENT_METHODS), F.lit(False)),
                  F.concat(F.lit(C.MSG_METHOD), method_text))
            .when(~F.coalesce(status.isin(*C.PAYMENT_STATUSES), F.lit(False)),
                  F.concat(F.lit(C.MSG_STATUS), status_text)))


def _typed_item_error(x: Column, i: Column) -> Column:
    rule = (F.when(x["quantity"] <= 0, F.lit(C.MSG_QUANTITY)).when(x["price_per_unit"] <= 0, F.lit(C.MSG_PRICE))
            .when(x["total_price"] <= 0, F.lit(C.MSG_LINE_TOTAL)))
    return F.when(rule.isNotNull(), _value_error(i.cast("string"), rule)) \
        .when(~_integral(x["quantity"]), _field_error("quantity", C.MSG_INT_FRACTION)) \
        .when(x["quantity"].try_cast("bigint").isNull(), _field_error("quantity", C.MSG_INT_RANGE))


def _lines_hold(items: Column) -> Column:
    """Whether no typed line has an error, told from whole columns of lines, without a call per line."""
    quantity = items["quantity"]
    positive = [F.array_min(items[f]) > 0 for f in ("quantity", "price_per_unit", "total_price")]
    whole = quantity.try_cast("array<bigint>").cast("array<double>") == quantity
    return F.coalesce(positive[0] & positive[1] & positive[2] & whole, F.lit(False))


def _typed_items(items: Column) -> Column:
    return F.transform(items, lambda x: F.struct(
        x["item_id"].alias("item_id"), x["name"].alias("name"), x["quantity"].try_cast("bigint").alias("quantity"),
        x["price_per_unit"].alias("price_per_unit"), x["total_price"].alias("total_price")))


def validate_transactions(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Attach ``outcome``, ``errors`` and ``txn`` to each raw message."""
    return with_transaction(judge_transactions(df, value_col))


def with_transaction(judged: DataFrame) -> DataFrame:
    """Messages of :func:`judge_transactions` with their ``txn`` instead of the parts it is made of."""
    j, held = F.col("_j"), F.col("outcome").isin("accepted", C.OUTCOME_PUBLISHED, C.OUTCOME_UNPAID)
    f_txn = F.struct(
        canonical_uuid(j["transaction_id"]).alias("transaction_id"),
        j["timestamp"].alias("timestamp"), j["store_id"].alias("store_id"), j["cashier_id"].alias("cashier_id"),
        _typed_items(j["items"]).alias("items"), j["total_amount"].alias("total_amount"),
        j["payment_method"].alias("payment_method"), j["payment_status"].alias("payment_status"),
        j["customer_id"].alias("customer_id"), j["loyalty_points_earned"].alias("loyalty_points_earned"),
        j["receipt"].alias("receipt"))
    txn = F.when(~held, F.lit(None)).when(F.col("_fast"), f_txn).otherwise(F.col("_s_txn"))
    return judged.withColumn("txn", txn).drop(*JUDGED_PARTS)


#: What a typed record is made of, beside ``outcome`` and ``errors``.
JUDGED_PARTS = ("_fast", "_j", "_s_txn", "_gate")


def judge_transactions(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Attach ``outcome``, ``errors`` and ``JUDGED_PARTS`` (``_gate``: the payment status of an accepted message).

    The typed record is left to :func:`with_transaction`, so a query that only
    counts or lists outcomes does not build it.

    Fast path: a message whose every field has the contract's JSON type (the
    common case) is checked on one typed parse; where its text is plain
    (:mod:`.contract`), that is its only parse.  Slow path: everything else
    gets the field-by-field type analysis.  Slow-path helper columns are gated
    on ``NOT _fast`` and staged as separate projections, so each is computed
    once, only for the rows that need it, and the generated code stays small.
    Both paths implement the same rules and produce the same outputs.
    """
    value = F.col(value_col)
    out = df.withColumn("_j", typed_message(value))
    j, plain, vc = F.col("_j"), F.col("_plain"), F.col("_v")
    out = out.withColumn("_plain", is_plain(value, j))
    out = out.withColumn("_v", F.when(~plain, parse_single_json(value)))
    out = out.withColumn("_s", F.schema_of_variant(vc))
    is_obj = plain | (vc.isNotNull() & F.coalesce(F.col("_s").startswith("OBJECT"), F.lit(False)))
    out = out.withColumn("_is_obj", is_obj)
    # The message type string lists fields in key order and merges basket
    # lines into one element type (a line of another type or shape makes it
    # differ); missing line fields show up as NULLs in the typed parse.
    out = out.withColumn("_fast", plain | (F.col("_is_obj")
                         & F.coalesce(F.col("_s").rlike(_MESSAGE_SHAPE), F.lit(False))
                         & F.coalesce(lines_complete(j), F.lit(False))))
    slow = F.col("_is_obj") & ~F.col("_fast")

    # ---- fast path ---------------------------------------------------------
    f_rule = _rule_message(j["store_id"], j["cashier_id"], j["total_amount"], j["payment_method"],
                           j["payment_status"], j["payment_method"], j["payment_status"])
    f_field_errors = F.concat(
        F.when(~is_uuid_text(j["transaction_id"]), F.array(_field_error("transaction_id", C.MSG_UUID)))
        .otherwise(F.array().cast("array<string>")),
        F.when(_lines_hold(j["items"]), F.array().cast("array<string>"))
        .otherwise(F.filter(F.transform(j["items"], _typed_item_error), lambda e: e.isNotNull())),
        F.when(j["receipt"]["total_amount"] <= 0, F.array(_value_error("receipt", C.MSG_TOTAL)))
        .otherwise(F.array().cast("array<string>")),
    )
    out = out.withColumns({"_f_rule": F.when(F.col("_fast"), f_rule),
                           "_f_field_errors": F.when(F.col("_fast"), f_field_errors),
                           "_f_status": F.when(F.col("_fast"), j["payment_status"])})
    f_outcome = F.when(F.col("_f_rule").isNotNull(), F.lit(C.OUTCOME_REJECTED)) \
        .when(F.size("_f_field_errors") > 0, F.lit(C.OUTCOME_REJECTED)).otherwise(F.lit("accepted"))
    f_errors = F.when(F.col("_f_rule").isNotNull(), F.array(_value_error("body", F.col("_f_rule")))) \
        .otherwise(F.col("_f_field_errors"))

    # ---- slow path -----------------------------------------------------------
    for stage in _slow_stages(vc):
        out = out.withColumns({name: F.when(slow, expr) for name, expr in stage.items()})

    is_fast = F.col("_fast")
    outcome = (F.when(~F.col("_is_obj"), F.lit(C.OUTCOME_MALFORMED))
               .when(is_fast, f_outcome).otherwise(F.col("_s_outcome")))
    errors = (F.when(~F.col("_is_obj"), F.array(_field_error("body", C.MSG_JSON)))
              .when(is_fast, f_errors).otherwise(F.col("_s_errors")))
    out = out.withColumns({"outcome": outcome, "errors": errors})
    # Not read from the record, which is then made only where it is asked for.
    status = F.when(is_fast, F.col("_f_status")).otherwise(F.col("_s_status"))
    out = out.withColumn("_gate", F.struct(F.when(F.col("outcome") == "accepted", status).alias("payment_status")))
    helpers = [c for c in out.columns if c.startswith("_") and c not in JUDGED_PARTS]
    return out.drop(*helpers)


def _slow_stages(vc: Column) -> list[dict[str, Column]]:
    """Field-by-field analysis for messages without the contract's shape.

    Returned as ordered stages of named columns; later stages refer to the
    earlier ones by name.
    """
    types = {f"_t_{f}": json_type(vc, f"$.{f}") for f in TRANSACTION_FIELDS}
    types |= {f"_rt_{f}": json_type(vc, f"$.receipt.{f}") for f in RECEIPT_FIELDS}
    t = {f: JType(F.col(f"_t_{f}")) for f in TRANSACTION_FIELDS}
    rt = {f: JType(F.col(f"_rt_{f}")) for f in RECEIPT_FIELDS}

    store = get_string(vc, "$.store_id")
    cashier = get_string(vc, "$.cashier_id")
    total = get_double(vc, "$.total_amount")
    method = get_string(vc, "$.payment_method")
    status = get_string(vc, "$.payment_status")

    # Transaction rules, first event wins (crash or failure).
    def step(kind: str, detail: Column | str) -> Column:
        d = F.lit(detail) if isinstance(detail, str) else detail
        return F.struct(F.lit(kind).alias("kind"), d.alias("detail"))

    method_ok = t["payment_method"].is_str & F.coalesce(method.isin(*C.PAYMENT_METHODS), F.lit(False))
    status_ok = t["payment_status"].is_str & F.coalesce(status.isin(*C.PAYMENT_STATUSES), F.lit(False))
    first_rule = F.coalesce(
        F.when(~t["store_id"].is_str, step("crash", "store_id")),
        F.when(~F.coalesce(store.rlike(STORE_RE), F.lit(False)), step("fail", C.MSG_STORE)),
        F.when(~t["cashier_id"].is_str, step("crash", "cashier_id")),
        F.when(~F.coalesce(cashier.rlike(CASHIER_RE), F.lit(False)), step("fail", C.MSG_CASHIER)),
        F.when(~t["total_amount"].is_num, step("crash", "total_amount")),
        F.when(total <= 0, step("fail", C.MSG_TOTAL)),
        F.when(~method_ok, step("fail", F.concat(F.lit(C.MSG_METHOD),
                                                 python_str(vc, "$.payment_method", t["payment_method"])))),
        F.when(~status_ok, step("fail", F.concat(F.lit(C.MSG_STATUS),
                                                 python_str(vc, "$.payment_status", t["payment_status"])))),
    )
    items_info = F.transform(F.transform(F.try_variant_get(vc, "$.items", "array<variant>"), _item_parts), _item_info)

    # Field validation.
    items = F.col("_s_items")
    items_crash = F.coalesce(F.exists(items, lambda s: s["crash"]), F.lit(False))
    receipt_crash = ~t["receipt"].missing & (~t["receipt"].is_obj | ~rt["total_amount"].is_num)
    receipt_total = get_double(vc, "$.receipt.total_amount")
    tid = get_string(vc, "$.transaction_id")
    tid_errors = F.when(t["transaction_id"].missing, F.array(_field_error("transaction_id", C.MSG_REQUIRED))) \
        .when(~t["transaction_id"].is_str, F.array(_field_error("transaction_id", C.MSG_UUID_TYPE))) \
        .when(~is_uuid_text(tid), F.array(_field_error("transaction_id", C.MSG_UUID))) \
        .otherwise(F.array().cast("array<string>"))
    items_errors = F.when(t["items"].missing, F.array(_field_error("items", C.MSG_REQUIRED))) \
        .when(~t["items"].is_arr, F.array(_field_error("items", C.MSG_LIST))) \
        .otherwise(F.flatten(F.transform(items, lambda s: s["errors"])))
    jl = t["loyalty_points_earned"]
    loyalty_num = get_double(vc, "$.loyalty_points_earned")
    loyalty_text = get_string(vc, "$.loyalty_points_earned")
    loyalty = F.when(jl.is_str, F.trim(loyalty_text).try_cast("bigint")).otherwise(loyalty_num.try_cast("bigint"))
    loyalty_errors = (
        F.when(jl.missing, F.array(_field_error("loyalty_points_earned", C.MSG_REQUIRED)))
        .when(jl.is_str & ~F.coalesce(loyalty_text.rlike(_INT_TEXT_RE), F.lit(False)),
              F.array(_field_error("loyalty_points_earned", C.MSG_INT_PARSE)))
        .when(jl.is_str & loyalty.isNull(), F.array(_field_error("loyalty_points_earned", C.MSG_INT_RANGE)))
        .when(jl.is_str | jl.is_bool, F.array().cast("array<string>"))
        .when(jl.is_num & ~_integral(loyalty_num),
              F.array(_field_error("loyalty_points_earned", C.MSG_INT_FRACTION)))
        .when(jl.is_num & loyalty.isNull(), F.array(_field_error("loyalty_points_earned", C.MSG_INT_RANGE)))
        .when(~jl.is_num, F.array(_field_error("loyalty_points_earned", C.MSG_INT)))
        .otherwise(F.array().cast("array<string>")))
    receipt_errors = (
        F.when(t["receipt"].missing, F.array(_field_error("receipt", C.MSG_REQUIRED)))
        .when(receipt_total <= 0, F.array(_value_error("receipt", C.MSG_TOTAL)))
        .otherwise(F.concat(_string_field_errors(rt["receipt_id"], "receipt_id"),
                            _string_field_errors(rt["date"], "date"),
                            _number_field_errors(rt["total_amount"], "total_amount"),
                            _string_field_errors(rt["payment_method"], "payment_method"),
                            _string_field_errors(rt["transaction_id"], "transaction_id"))))
    field_errors = F.concat(tid_errors, _string_field_errors(t["timestamp"], "timestamp"), items_errors,
                            _string_field_errors(t["customer_id"], "customer_id"), loyalty_errors, receipt_errors)
    fr = F.col("_s_fr")
    field_crash = F.when(items_crash, F.lit("items")).when(receipt_crash, F.lit("receipt"))
    crash_field = F.when(fr["kind"] == "crash", fr["detail"]).otherwise(F.when(fr.isNull(), field_crash))

    # Outcome, errors, typed record.
    crash = F.col("_s_crash")
    outcome = (F.when(crash.isNotNull(), F.lit(C.OUTCOME_SERVER_ERROR))
               .when(fr.isNotNull(), F.lit(C.OUTCOME_REJECTED))
               .when(F.size("_s_field_errors") > 0, F.lit(C.OUTCOME_REJECTED))
               .otherwise(F.lit("accepted")))
    errors = (F.when(crash.isNotNull(), F.array(F.concat(F.lit(C.REASON_MISSING_OR_WRONG_TYPE), crash)))
              .when(fr.isNotNull(), F.array(_value_error("body", fr["detail"])))
              .otherwise(F.col("_s_field_errors")))
    txn = F.struct(
        canonical_uuid(tid).alias("transaction_id"),
        get_string(vc, "$.timestamp").alias("timestamp"),
        store.alias("store_id"),
        cashier.alias("cashier_id"),
        F.transform(items, lambda s: s["item"]).alias("items"),
        total.alias("total_amount"),
        method.alias("payment_method"),
        status.alias("payment_status"),
        get_string(vc, "$.customer_id").alias("customer_id"),
        loyalty.alias("loyalty_points_earned"),
        F.struct(get_string(vc, "$.receipt.receipt_id").alias("receipt_id"),
                 get_string(vc, "$.receipt.date").alias("date"),
                 receipt_total.alias("total_amount"),
                 get_string(vc, "$.receipt.payment_method").alias("payment_method"),
                 get_string(vc, "$.receipt.transaction_id").alias("transaction_id")).alias("receipt"),
    )
    return [
        types,
        {"_s_fr": first_rule, "_s_items": items_info},
        {"_s_crash": crash_field, "_s_field_errors": field_errors, "_s_status": status},
        {"_s_outcome": outcome, "_s_errors": errors, "_s_txn": txn},
    ]


def validate_aggregates(df: DataFrame) -> DataFrame:
    """Rule VAL-A1 on AggregatedEvent rows: the total must be positive.

    Adds ``status``, ``message`` and ``errors``; a window whose sales were all
    corrected to zero (empty baskets) is rejected here.
    """
    ok = F.coalesce(F.col("total_amount") > 0, F.lit(False))
    return df.withColumns({
        "status": F.when(ok, F.lit(C.STATUS_SUCCESS)).otherwise(F.lit(C.STATUS_ERROR)),
        "message": F.when(ok, F.lit(C.MSG_AGG_ACCEPTED)).otherwise(F.lit(C.MSG_REQUEST_FAILED)),
        "errors": F.when(ok, F.array().cast("array<string>"))
                   .otherwise(F.array(_value_error("body", C.MSG_TOTAL))),
    })
