"""UUID recognition, canonical form and replay-safe ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_HY = "[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}"
# Accepted spellings: simple (32 hex), hyphenated, braced, URN.
UUID_PATTERN = r"\A(?:[0-9a-fA-F]{32}|%s|\{%s\}|urn:uuid:%s)\z" % (_HY, _HY, _HY)


def is_uuid_text(text: Column) -> Column:
    """True when ``text`` is one of the accepted UUID spellings."""
    return F.coalesce(text.rlike(UUID_PATTERN), F.lit(False))


def _hyphenate(hex32: Column) -> Column:
    return F.concat_ws("-", hex32.substr(1, 8), hex32.substr(9, 4), hex32.substr(13, 4),
                       hex32.substr(17, 4), hex32.substr(21, 12))


def canonical_uuid(text: Column) -> Column:
    """Accepted UUID spelling -> lower-case hyphenated form; NULL otherwise."""
    hex32 = F.lower(F.regexp_replace(F.regexp_replace(text, r"^urn:uuid:", ""), r"[{}-]", ""))
    return F.when(text.rlike(rf"\A{_HY}\z"), F.lower(text)).when(is_uuid_text(text), _hyphenate(hex32))


def deterministic_uuid(*parts: Column) -> Column:
    """Name-based (version 3 layout) UUID from an MD5 of the parts.

    Used instead of a random id so that a replayed window produces the same
    event id and a sink can de-duplicate.
    """
    h = F.md5(F.concat_ws("|", *parts))
    variant_nibble = F.substr(F.lit("89ab"),
                              (F.instr(F.lit("0123456789abcdef"), h.substr(17, 1)) - 1) % 4 + 1,
                              F.lit(1))
    hex32 = F.concat(h.substr(1, 12), F.lit("3"), h.substr(14, 3), variant_nibble, h.substr(18, 15))
    return _hyphenate(hex32)
