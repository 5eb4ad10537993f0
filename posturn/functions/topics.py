"""Hierarchical topic strings: level access and wildcard subscriptions.

Subscription syntax: levels separated by ``/``; ``*`` matches exactly one
level, ``>`` as the last level matches one or more remaining levels, and a
level ending in ``*`` (``STORE_*``) matches that prefix within one level.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def topic_regex(subscription: str) -> str:
    """Compile a subscription into an anchored Java regular expression."""
    levels = subscription.split("/")
    parts = []
    for i, level in enumerate(levels):
        last = i == len(levels) - 1
        if level == ">" and last:
            parts.append("[^/]+(?:/[^/]+)*")
        elif level == "*":
            parts.append("[^/]*")
        elif level.endswith("*"):
            parts.append(re.escape(level[:-1]) + "[^/]*")
        else:
            parts.append(re.escape(level))
    return r"\A" + "/".join(parts) + r"\z"


def topic_matches(topic: Column, subscription: str) -> Column:
    """Column predicate: ``topic`` is delivered to ``subscription``."""
    return F.coalesce(topic.rlike(topic_regex(subscription)), F.lit(False))


def topic_level(topic: Column, index: int) -> Column:
    """1-based level of a topic (negative counts from the end); NULL past either end."""
    return F.try_element_at(F.split(topic, "/"), F.lit(index))
