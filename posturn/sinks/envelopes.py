"""Envelope sinks: a broker topic per message kind, or folders per queue.

The hierarchical topic of an envelope names one message, so it cannot be a
topic of a broker that keeps a log per topic.  ``broker_records`` sends each
message kind to one physical topic and carries the path as a header, where a
consumer's subscriptions find it.  The broker sink is ``format("kafka")`` with
the ``topic`` column choosing the destination per row.  Where the connector is
absent the file sink writes one folder per queue (partition pruning serves a
per-queue consumer).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from .. import config as C


PATH_HEADER = "path"


def broker_records(envelopes: DataFrame, prefix: str = C.TOPIC_PREFIX) -> DataFrame:
    """Envelopes with a physical topic per message kind and the whole path as the header ``path``.

    The physical topic is the prefix and the kind with dots for slashes; a
    topic outside the prefix goes to ``<prefix>.other``.
    """
    kind = F.regexp_extract("topic", r"\A" + re.escape(prefix) + r"/([A-Za-z0-9_-]+)(?:/|\z)", 1)
    path = F.struct(F.lit(PATH_HEADER).alias("key"), F.encode("topic", "utf-8").alias("value"))
    return envelopes.select(
        F.concat(F.lit(prefix.replace("/", ".") + "."), F.when(kind != "", kind).otherwise("other")).alias("topic"),
        "key", "value", F.concat(F.coalesce("headers", F.array().cast(envelopes.schema["headers"].dataType)),
                                 F.array(path)).alias("headers"))


def message_path(headers: Column) -> Column:
    """The path that a record's headers carry; NULL without one."""
    return F.decode(F.get(F.filter(headers, lambda h: h["key"] == PATH_HEADER), F.lit(0))["value"], "utf-8")


def kafka_sink_options(bootstrap_servers: str, extra: dict[str, str] | None = None) -> dict[str, str]:
    """Options of a Kafka sink that takes the topic from each row."""
    return {"kafka.bootstrap.servers": bootstrap_servers, **(extra or {})}


def write_envelopes_kafka(envelopes: DataFrame, options: dict[str, str]) -> None:
    """Batch write of envelopes to the broker (needs the Kafka connector)."""
    broker_records(envelopes).write.format("kafka").options(**options).save()


def stream_envelopes_kafka(envelopes: DataFrame, options: dict[str, str], checkpoint: str) -> DataStreamWriter:
    """Streaming writer of envelopes to the broker (start it with ``.start()``)."""
    return (broker_records(envelopes).writeStream.format("kafka")
            .options(**options).option("checkpointLocation", checkpoint))
