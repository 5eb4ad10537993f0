"""Deliveries of messages to many subscribers with wildcard subscriptions.

``route.subscribe`` matches a few subscriptions with one regular expression.
Here the subscriptions are a table of any size.  A subscription's *shape* says
for each of its levels whether it is a literal, any level (``*``), a prefix of a
given length (``STORE_*``) or the rest (``>``); its *key* is the text of the
literals and prefixes.  A topic gives one key per shape that it fits, so all
subscriptions are met by one equi-join on (shape, key).  There are few shapes,
however many subscriptions: they are the level prefixes of a topic trie with
the literals taken out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Subscription tables of up to so many rows (a few MB) may be broadcast; larger ones are joined by shuffle.
BROADCAST_SUBSCRIPTIONS = 20_000


def _levels(topic: str) -> Column:
    return F.split(F.col(topic), "/")


def _kinds(subscription: str) -> Column:
    """The shape as text, a word per level: ``=`` literal, ``*``, ``<n>`` prefix of n characters, ``>`` rest."""
    levels = _levels(subscription)
    last = F.size(levels)
    return F.array_join(F.transform(levels, lambda x, i: (
        F.when((x == ">") & (i + 1 == last), ">").when(x == "*", "*")
        .when(x.endswith("*"), (F.length(x) - 1).cast("string")).otherwise("="))), "/")


def _subscription_key(subscription: str) -> Column:
    levels = _levels(subscription)
    last = F.size(levels)
    return F.array_join(F.transform(levels, lambda x, i: (
        F.when(((x == ">") & (i + 1 == last)) | (x == "*"), "")
        .when(x.endswith("*"), F.substring(x, F.lit(1), F.length(x) - 1))
        .otherwise(x))), "/")


def _topic_key(levels: Column, shape: str) -> Column:
    """Key of a topic under a shape; NULL where it does not fit."""
    kinds = shape.split("/")
    rest = kinds[-1] == ">"
    parts = []
    for i, kind in enumerate(kinds):
        level = F.get(levels, F.lit(i))
        parts.append(F.lit("") if kind in ("*", ">") else level if kind == "=" else F.substring(level, 1, int(kind)))
    fits = F.size(levels) >= len(kinds) if rest else F.size(levels) == len(kinds)
    if rest:  # each level of the rest has at least one character
        fits = fits & ~F.exists(F.slice(levels, len(kinds), F.greatest(F.size(levels), F.lit(1))), lambda x: x == "")
    return F.when(fits, F.concat_ws("/", *parts))


def deliver(df: DataFrame, subscriptions: DataFrame, topic_col: str = "topic", queue_col: str = "queue",
            broadcast_rows: int = BROADCAST_SUBSCRIPTIONS) -> DataFrame:
    """One row of ``df`` with ``queue_col`` per queue that it is delivered to.

    ``subscriptions`` has the columns ``queue`` and ``subscription``.  A queue
    gets a row once, however many of its subscriptions match; repeated rows are
    delivered each.  Rows that no queue wants, rows with a null topic and null
    queues or subscriptions are left out.  Subscriptions are matched as by ``functions.topics.topic_regex``.
    """
    if queue_col in df.columns:
        raise ValueError(f"the messages have a column {queue_col} already")
    subs = subscriptions.where("queue is not null and subscription is not null") \
        .select(F.col("queue").alias("__queue"), _kinds("subscription").alias("__shape"),
                _subscription_key("subscription").alias("__key")).distinct()
    shapes = [r[0] for r in subs.select("__shape").distinct().orderBy("__shape").collect()]
    if not shapes:
        return df.withColumn(queue_col, F.lit(None).cast("string")).where(F.lit(False))
    small = subscriptions.count() <= broadcast_rows
    topics = df.where(F.col(topic_col).isNotNull()).select(F.col(topic_col).alias("__topic")).distinct()
    levels = _levels("__topic")
    fits = F.filter(F.array(*[F.struct(F.lit(s).alias("__shape"), _topic_key(levels, s).alias("__key")) for s in shapes]),
                    lambda x: x["__key"].isNotNull())
    wanted = topics.select("__topic", F.explode(fits).alias("__fit")).select("__topic", "__fit.*") \
        .join(F.broadcast(subs) if small else subs, ["__shape", "__key"]).select("__topic", "__queue").distinct()
    return df.join(wanted, F.col(topic_col) == F.col("__topic")).drop("__topic").withColumnRenamed("__queue", queue_col)
