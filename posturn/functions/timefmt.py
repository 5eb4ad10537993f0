"""Event-time parsing and ISO-8601 rendering."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The usual form is parsed as it is; the others are brought to it first.
_OFFSET = r"(?:Z|[+-]\d\d(?::?\d\d)?)?"
_PLAIN = r"\A\d{4}-\d\d-\d\d(?:[T ]\d\d:\d\d:\d\d(?:\.\d{1,6})?(?:Z|[+-]\d\d:\d\d)?)?\z"
_ISO = (r"\A(?:\d{4}-\d\d-\d\d(?:[T ]\d\d:\d\d(?::\d\d(?:[.,]\d{1,9})?)?%s)?"
        r"|\d{8}(?:[T ]\d{6}(?:[.,]\d{1,9})?%s)?)\z" % (_OFFSET, _OFFSET))
_BASIC = r"\A(\d{4})(\d\d)(\d\d)[T ](\d\d)(\d\d)(\d\d)(.*)\z"
_BASIC_DATE = r"\A(\d{4})(\d\d)(\d\d)\z"

def parse_event_time(text: Column) -> Column:
    """ISO-8601 text -> TIMESTAMP (UTC instant); NULL when unparseable.

    Accepts a full date, optionally with a time of hours and minutes, seconds
    and a fraction, and a trailing ``Z`` or numeric offset; extended
    (``2024-11-15T00:00:09``) or basic (``20241115T000009``) format.  A time
    alone, a year or month alone, single digits and zone names are refused.
    Offset-free text is read as UTC (the session time zone is pinned to UTC).
    Never raises, so one bad record cannot stop a job.
    """
    offset = F.regexp_replace(F.regexp_replace(text, r"([T ].*[+-]\d\d)(\d\d)\z", "$1:$2"), r"([T ].*[+-]\d\d)\z", "$1:00")
    extended = F.regexp_replace(F.regexp_replace(offset, _BASIC, "$1-$2-$3T$4:$5:$6$7"), _BASIC_DATE, "$1-$2-$3")
    return F.when(text.rlike(_PLAIN), F.try_to_timestamp(text)) \
        .when(text.rlike(_ISO), F.try_to_timestamp(F.translate(extended, ",", ".")))


def iso_utc(ts: Column) -> Column:
    """TIMESTAMP -> ``datetime.isoformat()`` text of an aware UTC value.

    The fraction is printed with six digits and omitted when it is zero; the
    offset is always ``+00:00``.
    """
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ssxxx")
    fraction = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    return F.when(ts.isNull(), F.lit(None).cast("string")).when(
        F.unix_micros(ts) % 1_000_000 == 0, whole).otherwise(fraction)
