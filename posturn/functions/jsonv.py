"""JSON value inspection on top of Spark's VARIANT type.

``from_json`` coerces types silently (a number read into a STRING field
becomes its text, a numeric string read into a DOUBLE field becomes NULL), so
the service's typed checks need the JSON type of each value.  Messages are
parsed once with ``try_parse_json`` and every field is typed with
``schema_of_variant``; everything stays JVM-side.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from .money import py_float_text

_INTEGER_TYPES = ("BIGINT", "INT", "SMALLINT", "TINYINT")
_NUMBER_TYPES = _INTEGER_TYPES + ("DOUBLE", "FLOAT", "BOOLEAN")


def parse_single_json(text: Column) -> Column:
    """The VARIANT of a text that is one JSON value and nothing more, else NULL.

    The parser stops after the first value and ignores what follows.  So the
    text is parsed as the first of two array elements, the second being an end
    mark: anything after the value breaks the array or takes the mark's place.
    The mark is the text's own MD5, which no text can hold, so a sender cannot
    put it there.
    """
    end = F.md5(text)

    def sole(marked: Column) -> Column:
        wrapped, end = marked["wrapped"], marked["end"]
        return F.when(F.try_variant_get(wrapped, "$[1]", "string") == end, F.try_variant_get(wrapped, "$[0]", "variant"))

    # Lambda variables: the text is parsed once, not again for the value than for the mark.
    of_end = F.transform(F.array(end), lambda e: F.struct(
        e.alias("end"), F.try_parse_json(F.concat(F.lit("["), text, F.lit(',"'), e, F.lit('"]'))).alias("wrapped")))
    return F.get(F.transform(of_end, sole), 0)


def is_json_object(v: Column) -> Column:
    """True when the parsed variant ``v`` is a JSON object, not NULL or another value (``null``, ``5``, ``[]``)."""
    return v.isNotNull() & F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))


def with_parsed_json(df, text_col: str, variant_col: str = "_v", object_col: str = "_is_obj"):
    """Add the parsed VARIANT and the is-object flag (one parse per row)."""
    out = df.withColumn(variant_col, parse_single_json(F.col(text_col)))
    return out.withColumn(object_col, is_json_object(F.col(variant_col)))


def json_type(v: Column, path: str) -> Column:
    """Type name of the value at ``path``: NULL when absent, ``VOID`` for null."""
    return F.schema_of_variant(F.variant_get(v, path, "variant"))


@dataclass(frozen=True)
class JType:
    """Predicates over a type-name column produced by :func:`json_type`."""

    t: Column

    @property
    def missing(self) -> Column:
        return self.t.isNull()

    @property
    def is_null(self) -> Column:
        return F.coalesce(self.t == "VOID", F.lit(False))

    @property
    def is_str(self) -> Column:
        return F.coalesce(self.t == "STRING", F.lit(False))

    @property
    def is_bool(self) -> Column:
        return F.coalesce(self.t == "BOOLEAN", F.lit(False))

    @property
    def is_num(self) -> Column:
        """JSON number (booleans count, as in lax numeric validation)."""
        return F.coalesce(self.t.isin(*_NUMBER_TYPES) | self.t.startswith("DECIMAL"),
                          F.lit(False))

    @property
    def is_obj(self) -> Column:
        return F.coalesce(self.t.startswith("OBJECT"), F.lit(False))

    @property
    def is_arr(self) -> Column:
        return F.coalesce(self.t.startswith("ARRAY"), F.lit(False))


def get_double(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "double")


def get_string(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "string")


def python_str(v: Column, path: str, jt: JType) -> Column:
    """Text Python's ``str()`` gives for the decoded JSON value at ``path``.

    Strings print as-is, null and absent values as ``None``, booleans as
    ``True``/``False``, numbers in Python float/int notation; containers fall
    back to their JSON text.
    """
    value = F.variant_get(v, path, "variant")
    num = get_double(v, path)
    is_int = F.coalesce(jt.t.isin(*_INTEGER_TYPES), F.lit(False))
    return (F.when(jt.missing | jt.is_null, F.lit("None"))
            .when(jt.is_str, get_string(v, path))
            .when(jt.is_bool, F.when(F.try_variant_get(v, path, "boolean"), "True").otherwise("False"))
            .when(is_int, F.try_variant_get(v, path, "bigint").cast("string"))
            .when(jt.is_num, py_float_text(num))
            .otherwise(F.to_json(value)))
