"""Column-level functions (built-in Spark expressions only, no Python UDFs)."""

from .ids import canonical_uuid, deterministic_uuid, is_uuid_text
from .money import exact_amount, money_sum, py_float_text
from .timefmt import iso_utc, parse_event_time
from .topics import topic_level, topic_matches, topic_regex

__all__ = [
    "canonical_uuid", "deterministic_uuid", "is_uuid_text",
    "exact_amount", "money_sum", "py_float_text",
    "iso_utc", "parse_event_time",
    "topic_level", "topic_matches", "topic_regex",
]
