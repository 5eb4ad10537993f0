"""A registry of message rules, compiled into expressions over one parsed VARIANT.

A rule names a field by its path, the JSON type that the field must have, a
predicate on its value and the message of a failure.  Rules of a set run in
their order.  ``RuleSet`` compiles to

* ``flags``   -- every rule on its own, as a boolean per name;
* ``verdict`` -- the service's order: the first rule that cannot run (its field
  is absent or has another type: a server error) or fails decides; otherwise
  all field errors are collected in the order of the declared fields.

A caller extends a set with its own rules (``with_rules``).  Everything stays
Column expressions; a path with ``[*]`` runs for every element of one array.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.binding import bind
from ..functions.ids import canonical_uuid, is_uuid_text
from ..functions.jsonv import JType, get_double, get_string, json_type, parse_single_json, with_parsed_json
from .contract import is_plain, typed_message

#: The step of a path that stands for every element of an array.
EACH = "[*]"
STRING, NUMBER, INTEGER, UUID, LIST, OBJECT = "string", "number", "integer", "uuid", "list", "object"
_INT_TEXT_RE = r"\A\s*[+-]?[0-9]+\s*\z"


@dataclass(frozen=True)
class Rule:
    """A predicate on the value at ``path``; it fails with ``message``."""

    name: str
    path: str
    type: str
    holds: Callable[[Column], Column]
    message: str


@dataclass(frozen=True)
class Field:
    """A declared field: where it is and what it must be."""

    path: str
    type: str

    @property
    def label(self) -> str:
        return self.path.rsplit(".", 1)[-1]


def _true(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def _value(v: Column, path: str, kind: str) -> Column:
    return get_double(v, path) if kind in (NUMBER, INTEGER) else get_string(v, path)


def _typed(v: Column, path: str, kind: str) -> Column:
    """Whether the value at ``path`` is there and has the type, as lax validation sees it."""
    return _typed_as(JType(json_type(v, path)), kind, lambda: get_double(v, path), lambda: get_string(v, path))


def _typed_as(t: JType, kind: str, number: Callable[[], Column], text: Callable[[], Column]) -> Column:
    if kind == INTEGER:
        whole = _true((number() == F.round(number(), 0)) & ~F.isnan(number()))
        return (t.is_num & whole) | t.is_bool | (t.is_str & _true(text().rlike(_INT_TEXT_RE)))
    return {STRING: t.is_str, UUID: t.is_str, NUMBER: t.is_num, LIST: t.is_arr, OBJECT: t.is_obj}[kind]


class _Reading:
    """What the tests ask of the value at one path, read once as a struct (``columns``) and tested there (``of``).

    The type name of an array or object spells out all that is in it, so those are told by a cast instead.
    """

    def __init__(self) -> None:
        self.parts: dict[str, Callable[[Column, str], Column]] = {}

    def needs(self, kind: str, value: bool = False) -> None:
        if kind == LIST:
            self.parts["there"], self.parts["list"] = _present_value, _cast_holds("array<variant>")
        elif kind == OBJECT:
            self.parts["there"], self.parts["object"] = _present_value, _cast_holds("struct<_ variant>")
        else:
            self.parts["type"] = json_type
        if kind == INTEGER or (value and kind == NUMBER):
            self.parts["number"] = get_double
        if kind in (INTEGER, UUID) or (value and kind != NUMBER):
            self.parts["text"] = get_string

    def columns(self, v: Column, path: str) -> Column:
        return F.struct(*[read(v, path).alias(name) for name, read in self.parts.items()])

    def present(self, r: Column) -> Column:
        return r["there"] if "there" in self.parts else ~(JType(r["type"]).missing | JType(r["type"]).is_null)

    def typed(self, r: Column, kind: str) -> Column:
        if kind in (LIST, OBJECT):
            return r[kind]
        return _typed_as(JType(r["type"]), kind, lambda: r["number"], lambda: r["text"])

    def value(self, r: Column, kind: str) -> Column:
        return r["number"] if kind in (NUMBER, INTEGER) else r["text"]


def _present_value(v: Column, path: str) -> Column:
    return _true(~F.is_variant_null(F.variant_get(v, path, "variant")))


def _cast_holds(kind: str) -> Callable[[Column, str], Column]:
    return lambda v, path: F.try_variant_get(v, path, kind).isNotNull()


@dataclass(frozen=True)
class RuleSet:
    """Rules in order, and the declared fields of the message."""

    rules: tuple[Rule, ...]
    fields: tuple[Field, ...]

    def with_rules(self, *more: Rule) -> RuleSet:
        """The set with further rules at its end; a rule of a known name takes that one's place."""
        known = {r.name: r for r in more}
        kept = tuple(known.pop(r.name, r) for r in self.rules)
        return replace(self, rules=kept + tuple(known.values()))

    def _readings(self) -> dict[str, _Reading]:
        out: dict[str, _Reading] = {}
        for f in self.fields:
            out.setdefault(f.path, _Reading()).needs(f.type)
        for r in self.rules:
            out.setdefault(r.path, _Reading()).needs(r.type, value=True)
        return out

    def read(self, v: Column) -> Column:
        """All that ``flags`` needs of a message, each path read once; an array's elements once for all their paths."""
        readings = self._readings()
        flat = [reading.columns(v, path).alias(path) for path, reading in readings.items() if EACH not in path]
        outers: dict[str, dict[str, _Reading]] = {}
        for path, reading in readings.items():
            if EACH in path:
                outers.setdefault(path.split(EACH, 1)[0], {})[path] = reading

        def of_each(inner: dict[str, _Reading]) -> Callable[[Column], Column]:
            return lambda x: F.struct(*[reading.columns(x, "$" + path.split(EACH, 1)[1]).alias(path)
                                        for path, reading in inner.items()])

        each = [F.transform(F.try_variant_get(v, outer, "array<variant>"), of_each(inner)).alias(outer + EACH)
                for outer, inner in outers.items()]
        return F.struct(*flat, *each)

    def flags(self, seen: Column, is_object: Column) -> dict[str, Column]:
        """One boolean per rule, and ``present``, ``uuid`` and ``types`` over all declared fields, of what ``read`` gave.

        A rule whose field is absent or mistyped does not hold.  ``types``
        judges the fields that are there; an empty array satisfies all.
        """
        readings = self._readings()

        def everywhere(path: str, test: Callable[[_Reading, Column], Column]) -> Column:
            if EACH not in path:
                return _true(test(readings[path], seen[path]))
            each = seen[path.split(EACH, 1)[0] + EACH]
            return _true(F.forall(each, lambda x: _true(test(readings[path], x[path]))))

        def rule(r: Rule) -> Column:
            return everywhere(r.path, lambda at, x: at.typed(x, r.type) & _true(r.holds(at.value(x, r.type))))

        def over(fields, test) -> Column:
            """``test`` of all fields; those within one array in one pass over it."""
            out, inner = F.lit(True), {}
            for f in fields:
                if EACH in f.path:
                    inner.setdefault(f.path.split(EACH, 1)[0] + EACH, []).append(f)
                else:
                    out = out & _true(test(readings[f.path], seen[f.path], f.type))
            for each, of in inner.items():
                out = out & _true(F.forall(seen[each], lambda x: reduce(
                    Column.__and__, [_true(test(readings[f.path], x[f.path], f.type)) for f in of])))
            return out

        uuids = [f for f in self.fields if f.type == UUID]
        out = {r.name: rule(r) for r in self.rules}
        out["present"] = over(self.fields, lambda at, x, kind: at.present(x))
        out["uuid"] = over(uuids, lambda at, x, kind: is_uuid_text(x["text"]))
        out["types"] = over(self.fields, lambda at, x, kind: ~at.present(x) | at.typed(x, kind))
        return {name: _true(c) & is_object for name, c in out.items()}

    def within(self, declared: RuleSet) -> bool:
        """Whether all rules and fields are about ``declared`` fields, as single values of the declared types."""
        kinds = {f.path: f.type for f in declared.fields}
        return all(kinds.get(f.path) == f.type for f in self.fields) and all(
            r.type not in (LIST, OBJECT) and (kinds.get(r.path) == r.type or (r.type, kinds.get(r.path)) == (NUMBER, INTEGER))
            for r in self.rules)

    def typed_flags(self, message: Column) -> dict[str, Column]:
        """``flags`` of a message that has every declared field in its JSON type, from the typed ``message``.

        Nothing is missing or mistyped there, but a number may be no integer and a text no UUID.
        """
        def at(x: Column, path: str) -> Column:
            return reduce(lambda c, name: c[name], path.removeprefix("$").strip(".").split("."), x)

        def everywhere(path: str, test: Callable[[Column], Column]) -> Column:
            if EACH not in path:
                return _true(test(at(message, path)))
            outer, inner = path.split(EACH, 1)
            return _true(F.forall(at(message, outer), lambda x: _true(test(at(x, inner)))))

        def whole(x: Column) -> Column:
            x = x.cast("double")
            return (x == F.round(x, 0)) & ~F.isnan(x)

        def rule(r: Rule) -> Column:
            if r.type == INTEGER:
                return everywhere(r.path, lambda x: whole(x) & _true(r.holds(x.cast("double"))))
            return everywhere(r.path, r.holds)

        out = {r.name: rule(r) for r in self.rules}
        out["present"] = F.lit(True)
        out["uuid"] = reduce(Column.__and__, [everywhere(f.path, is_uuid_text) for f in self.fields if f.type == UUID], F.lit(True))
        out["types"] = reduce(Column.__and__, [everywhere(f.path, whole) for f in self.fields if f.type == INTEGER], F.lit(True))
        return out

    def verdict(self, v: Column) -> tuple[Column, Column]:
        """``(decided, errors)``: the first rule's crash or failure as ``struct<kind, detail>`` or NULL, and the
        texts of all field errors.  For flat messages (no array paths)."""
        first = None
        for r in self.rules:
            typed = _typed(v, r.path, r.type)
            crash = F.struct(F.lit("crash").alias("kind"), F.lit(r.path.removeprefix("$.")).alias("detail"))
            fail = F.struct(F.lit("fail").alias("kind"), F.lit(r.message).alias("detail"))
            step = F.when(~typed, crash).when(~_true(r.holds(_value(v, r.path, r.type))), fail)
            first = step if first is None else F.coalesce(first, step)
        errors = [field_error(v, f) for f in self.fields]
        return first, F.filter(F.array(*errors), lambda e: e.isNotNull())


def field_error(v: Column, f: Field) -> Column:
    """The text of a declared field's error; NULL if it has none."""
    t = JType(json_type(v, f.path))
    wrong = {STRING: C.MSG_STRING, UUID: C.MSG_UUID_TYPE, NUMBER: C.MSG_NUMBER, INTEGER: C.MSG_INT, LIST: C.MSG_LIST}[f.type]
    said = F.when(t.missing, C.MSG_REQUIRED).when(~_typed(v, f.path, f.type), wrong)
    if f.type == UUID:
        said = said.when(~is_uuid_text(get_string(v, f.path)), C.MSG_UUID)
    return F.when(said.isNotNull(), F.format_string(C.FIELD_ERROR_FORMAT, F.lit(f.label), said))


def _positive(x: Column) -> Column:
    return x > 0


def _one_of(*allowed: str) -> Callable[[Column], Column]:
    return lambda x: x.isin(*allowed)


def _matches(pattern: str) -> Callable[[Column], Column]:
    return lambda x: x.rlike(pattern)


STORE_RE = r"\ASTORE_0*([1-9]|10)\z"
CASHIER_RE = r"\ACASHIER_0*[1-8]\z"

TRANSACTION = RuleSet(
    rules=(
        Rule("store", "$.store_id", STRING, _matches(STORE_RE), C.MSG_STORE),
        Rule("cashier", "$.cashier_id", STRING, _matches(CASHIER_RE), C.MSG_CASHIER),
        Rule("total", "$.total_amount", NUMBER, _positive, C.MSG_TOTAL),
        Rule("method", "$.payment_method", STRING, _one_of(*C.PAYMENT_METHODS), C.MSG_METHOD),
        Rule("status", "$.payment_status", STRING, _one_of(*C.PAYMENT_STATUSES), C.MSG_STATUS),
        Rule("quantity", "$.items[*].quantity", NUMBER, _positive, C.MSG_QUANTITY),
        Rule("price", "$.items[*].price_per_unit", NUMBER, _positive, C.MSG_PRICE),
        Rule("line_total", "$.items[*].total_price", NUMBER, _positive, C.MSG_LINE_TOTAL),
        Rule("receipt", "$.receipt.total_amount", NUMBER, _positive, C.MSG_TOTAL),
    ),
    fields=(
        Field("$.transaction_id", UUID), Field("$.timestamp", STRING), Field("$.store_id", STRING),
        Field("$.cashier_id", STRING), Field("$.items", LIST), Field("$.items[*]", OBJECT), Field("$.items[*].item_id", STRING),
        Field("$.items[*].name", STRING), Field("$.items[*].quantity", INTEGER), Field("$.items[*].price_per_unit", NUMBER),
        Field("$.items[*].total_price", NUMBER), Field("$.total_amount", NUMBER), Field("$.payment_method", STRING),
        Field("$.payment_status", STRING), Field("$.customer_id", STRING), Field("$.loyalty_points_earned", INTEGER),
        Field("$.receipt", OBJECT), Field("$.receipt.receipt_id", STRING), Field("$.receipt.date", STRING),
        Field("$.receipt.total_amount", NUMBER), Field("$.receipt.payment_method", STRING),
        Field("$.receipt.transaction_id", STRING),
    ),
)

AGGREGATE = RuleSet(
    rules=(Rule("total", "$.total_amount", NUMBER, _positive, C.MSG_TOTAL),),
    fields=(Field("$.total_amount", NUMBER), Field("$.event_id", UUID), Field("$.store_id", STRING),
            Field("$.begin_stream_aggregator", STRING), Field("$.end_stream_aggregator", STRING)),
)


def rule_flags(df: DataFrame, value_col: str = "value", rules: RuleSet = TRANSACTION) -> DataFrame:
    """``df`` with ``<name>_ok`` per rule and ``present_ok``, ``uuid_ok``, ``types_ok``; no rule waits for another."""
    text, plain, v = F.col(value_col), F.col("_plain"), F.col("_v")
    known = rules.within(TRANSACTION)
    message = typed_message(text) if known else F.lit(None)
    read = bind(df, {"_j": message})
    read = bind(read, {"_j": F.col("_j"), "_plain": is_plain(text, F.col("_j")) if known else F.lit(False)})
    # Only a text that is not plain is parsed as a VARIANT.
    parsed = bind(read, {"_j": F.col("_j"), "_plain": plain, "_v": F.when(~plain, parse_single_json(text))})
    seen = bind(parsed, {"_j": F.col("_j"), "_plain": plain,
                         "_is_obj": F.try_variant_get(v, "$", "struct<_ variant>").isNotNull(),
                         "_seen": F.when(~plain, rules.read(v))})
    flags = rules.flags(F.col("_seen"), F.col("_is_obj"))
    if known:
        quick = rules.typed_flags(F.col("_j"))
        flags = {name: F.when(plain, quick[name]).otherwise(c) for name, c in flags.items()}
    return seen.withColumns({f"{name}_ok": c for name, c in flags.items()}).drop("_v", "_is_obj", "_seen", "_j", "_plain")


def validate_aggregate_messages(df: DataFrame, value_col: str = "value", rules: RuleSet = AGGREGATE) -> DataFrame:
    """Raw aggregate bodies -> the same rows with ``outcome``, ``errors`` and the typed ``aggregate``.

    ``malformed``: not one JSON object.  ``server_error``: a rule's field is
    absent or mistyped.  ``rejected``: a rule fails, or fields are missing,
    mistyped or no UUID.  Otherwise ``accepted``, with the id in canonical
    form.  ``aggregate`` is NULL unless accepted.
    """
    parsed = bind(with_parsed_json(df, value_col), {"_v": F.col("_v"), "_is_obj": F.col("_is_obj")})
    v = F.col("_v")
    first, errors = rules.verdict(v)
    judged = bind(parsed, {"_v": v, "_is_obj": F.col("_is_obj"), "_first": first, "_errors": errors})
    kind, detail = F.col("_first.kind"), F.col("_first.detail")
    malformed, failed = ~F.col("_is_obj"), F.size("_errors") > 0
    body = F.format_string(C.FIELD_ERROR_FORMAT, F.lit("body"), F.concat(F.lit(C.VALUE_ERROR_PREFIX), detail))
    outcome = (F.when(malformed, C.OUTCOME_MALFORMED).when(kind == "crash", C.OUTCOME_SERVER_ERROR)
               .when((kind == "fail") | failed, C.OUTCOME_REJECTED).otherwise(C.OUTCOME_ACCEPTED))
    texts = (F.when(malformed, F.array(F.format_string(C.FIELD_ERROR_FORMAT, F.lit("body"), F.lit(C.MSG_JSON))))
             .when(kind == "crash", F.array(F.concat(F.lit(C.REASON_MISSING_OR_WRONG_TYPE), detail)))
             .when(kind == "fail", F.array(body)).otherwise(F.col("_errors")))
    typed = F.struct(get_double(v, "$.total_amount").alias("total_amount"),
                     canonical_uuid(get_string(v, "$.event_id")).alias("event_id"),
                     *[get_string(v, f"$.{f}").alias(f) for f in
                       ("store_id", "begin_stream_aggregator", "end_stream_aggregator")])
    out = judged.withColumns({"outcome": outcome, "errors": texts})
    out = out.withColumn("aggregate", F.when(F.col("outcome") == C.OUTCOME_ACCEPTED, typed))
    return bind(out.drop("_v", "_is_obj", "_first", "_errors"), {c: F.col(c) for c in ("outcome", "errors", "aggregate")})
